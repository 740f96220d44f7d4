"""Benchmark decontamination: every passage of every document is a query on a BM25 inverted index
of the test items.

Index. Items are the collection: each posting holds an item's BM25 weight of a term divided by the
item's weight of all its terms, so a score is the share (0 to 1) of the item that a passage holds
and one threshold fits all. Items lie in blocks; each term has its largest weight in every block.

Search, by a block-max filter: lists of frequent terms cannot lift an item over the threshold
alone, so what they can add at most is known for each block, and only the lists of the other terms
are walked. A block is opened for a passage where the block maxima of the passage's terms plus
that rest reach the threshold; items of an opened block are scored in full. This is not block-max
WAND, which moves cursors of ordered lists past documents below a pivot: here the threshold is fixed,
the lists are short, and all passages of a chunk are bounded at once by array operations. The bound is
never below a score, so all items above the threshold are found.

Verification. A retrieved item counts when the passage covers both its question and its answer:
the share of words that lie in an n-gram of words which the passage holds too. One changed word can
take n words from that share, so a part so short that these are too many counts by its single
words, aligned in order where an n-gram of the item says that the part should stand. Of a part of two
or three words one may be missing; a part of one word may be, if nearly the whole item is there.

Passages are windows of twice as many words as the items of a length class have at most, that
advance by half their length, so that any item that a document holds lies in one passage. Classes
end at fixed lengths, and document frequencies, the number of items and their mean length are those
of all items, so an item's decisions do not depend on which others share its index.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premiumlake.llm import _text
from premiumlake.llm._store import shared, stored


@dataclass(frozen=True)
class Search:
    """``threshold``: the least share of an item's weight; ``overlap``: the least share of covered
    words of question and answer; ``whole``: the least share of an item's words where its part of
    one word is not asked for; ``n``: words of an n-gram; ``block``: items to a block;
    ``frequent``: lists of more than this share of the items count as frequent; ``items``: items of
    one index, of which there are as many as the items need."""

    threshold: float = 0.6
    overlap: float = 0.7
    whole: float = 0.9
    n: int = 3
    block: int = 8
    frequent: float = 0.05
    items: int = 20_000
    k1: float = 1.2
    b: float = 0.75


def question_and_answer(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, question, answer): the last sentence of an item's text is its answer, what stands
    before is its question; a text of one sentence is a question without an answer."""
    text = F.trim(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    cut = r"(?s)^(.*[.!?])\s+(\S[^.!?]*[.!?]*)$"
    two = text.rlike(cut)
    return items.select(
        F.col(id_col).alias("item"),
        F.when(two, F.regexp_extract(text, cut, 1)).otherwise(text).alias("question"),
        F.when(two, F.regexp_extract(text, cut, 2)).otherwise(F.lit("")).alias("answer"),
    )


@dataclass(frozen=True)
class Totals:
    """Of all items that have words in their question: their number, their words, and the number of
    them that have each word (hashes, sorted)."""

    items: int
    length: int
    words: np.ndarray
    df: np.ndarray


def length_class(words: int) -> int:
    """The most words of an item of the class."""
    most = 16
    while most < words:
        most *= 4
    return most


def _item_words(question: pa.Array, answer: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """(whether the question has words, the words) of each item."""
    (q, _, at), (a, _, to) = _text.lower_words(question), _text.lower_words(answer)
    return np.diff(at) > 0, [np.concatenate([q[at[k] : at[k + 1]], a[to[k] : to[k + 1]]]) for k in range(len(question))]


def _word_counts(distinct: DataFrame) -> DataFrame:
    """(word, items, length): the items that have each word; the word null has the sums of all."""

    def run(batches):
        for batch in batches:
            asked, words = _item_words(batch.column("question"), batch.column("answer"))
            copies = batch.column("copies").to_numpy()
            kept = np.flatnonzero(asked)
            own = [np.unique(words[k]).astype(np.int64) for k in kept]
            size = [len(x) for x in own]
            word = pa.array(np.concatenate([np.zeros(0, np.int64), *own]))
            length = np.array([len(words[k]) for k in kept], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([word, pa.nulls(len(kept), pa.int64())]),
                    pa.array(np.r_[np.repeat(copies[kept], size), copies[kept]].astype(np.int64)),
                    pa.array(np.r_[np.zeros(len(word), np.int64), copies[kept] * length].astype(np.int64)),
                ],
                names=["word", "items", "length"],
            )

    counts = distinct.select("question", "answer", "copies").mapInArrow(run, "word long, items long, length long")
    return counts.groupBy("word").agg(F.sum("items").alias("items"), F.sum("length").alias("length"))


def indexes(own: dict, search: Search, total: Totals | None = None) -> list[Index]:
    """An index for each length class of the items (key, question, answer, copies)."""
    asked, words = _item_words(*[pa.array(own[c], pa.string()) for c in ("question", "answer")])
    if total is None:
        kept = np.flatnonzero(asked)
        vocabulary, at = np.unique(np.concatenate([np.zeros(0, np.uint64), *[np.unique(words[k]) for k in kept]]), return_inverse=True)
        times = np.array([own["copies"][k] for k in kept], np.int64)
        df = np.bincount(at, weights=np.repeat(times, [len(np.unique(words[k])) for k in kept]), minlength=len(vocabulary))
        total = Totals(int(times.sum()), sum(int(t) * len(words[k]) for t, k in zip(times, kept)), vocabulary, df)
    classes: dict[int, list[int]] = {}
    for k in np.flatnonzero(asked).tolist():
        classes.setdefault(length_class(len(words[k])), []).append(k)
    pick = lambda c, of: [own[c][k] for k in of]
    return [Index(pick("key", of), pick("question", of), pick("answer", of), search, pick("copies", of), total) for _, of in sorted(classes.items())]


def common_words(a: list, b: list) -> int:
    """The length of a longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b):
            last, row[k + 1] = row[k + 1], last + 1 if x == y else max(row[k + 1], row[k])
    return row[-1]


class Index:
    """BM25 postings of items, their block maxima, and the items' words for verification."""

    def __init__(
        self, items: list, questions: list[str | None], answers: list[str | None], search: Search, copies: list[int] | None = None, total: Totals | None = None
    ):
        """``copies``: how often each item occurs; ``total``: of all items, if there are others."""
        self.search = search
        parts = [_text.lower_words(pa.array(x, pa.string())) for x in (questions, answers)]
        both = [[h[at[k] : at[k + 1]] for h, _, at in parts] for k in range(len(items))]
        kept = [k for k in range(len(items)) if len(both[k][0])]  # nothing can hold an item without words
        self.items = [items[k] for k in kept]
        self.words = [both[k] for k in kept]
        length = np.array([len(q) + len(a) for q, a in self.words], np.int64)
        self.step = length_class(int(length.max()) if kept else 0)

        terms = [np.unique(np.concatenate(w), return_counts=True) for w in self.words]
        self.vocabulary = np.unique(np.concatenate([t for t, _ in terms])) if kept else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(kept)), [len(t) for t, _ in terms])
        term = np.searchsorted(self.vocabulary, np.concatenate([t for t, _ in terms])) if kept else item
        tf = np.concatenate([c for _, c in terms]) if kept else item
        times = np.array([copies[k] for k in kept] if copies is not None else [1] * len(kept), np.int64)
        if total is None:
            total = Totals(int(times.sum()), int((times * length).sum()), self.vocabulary, np.bincount(term, weights=times[item], minlength=len(self.vocabulary)))
        df = total.df[np.searchsorted(total.words, self.vocabulary)]
        idf = np.log1p((total.items - df + 0.5) / (df + 0.5))
        mean = total.length / total.items if kept else 1.0
        weight = idf[term] * tf * (search.k1 + 1) / (tf + search.k1 * (1 - search.b + search.b * length[item] / mean))
        weight = weight / np.bincount(item, weights=weight, minlength=len(kept))[item]
        at = np.searchsorted(item, np.arange(len(kept) + 1))
        self.weights = [dict(zip(term[a:b].tolist(), weight[a:b].tolist())) for a, b in zip(at[:-1], at[1:])]

        block = item // search.block
        self.blocks = int(block.max()) + 1 if kept else 0
        common = df > max(2, search.frequent * total.items)
        rest = np.bincount(item, weights=weight * common[term], minlength=len(kept))
        self.rest = np.zeros(self.blocks)
        np.maximum.at(self.rest, np.arange(len(kept)) // search.block, rest)
        # the postings of the other terms by block: (term, block) with the largest weight there
        rare = ~common[term]
        key = term[rare] * max(self.blocks, 1) + block[rare]
        order = np.argsort(key, kind="stable")
        unique, first = np.unique(key[order], return_index=True)
        top = np.maximum.reduceat(weight[rare][order], first) if len(first) else np.zeros(0)
        self.post_block, self.post_top = unique % max(self.blocks, 1), top
        self.post_at = np.searchsorted(unique // max(self.blocks, 1), np.arange(len(self.vocabulary) + 1))

    def terms(self, words: np.ndarray) -> np.ndarray:
        """Term numbers of word hashes, -1 for words that no item has."""
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at, -1)

    def open_blocks(self, passage: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, block) pairs whose upper bound reaches the threshold, for distinct
        (passage, term) rows."""
        count = self.post_at[term + 1] - self.post_at[term]
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.post_at[term], count)
        key = np.repeat(passage, count) * self.blocks + self.post_block[at]
        pair, inverse = np.unique(key, return_inverse=True)
        bound = np.bincount(inverse, weights=self.post_top[at], minlength=len(pair)) + self.rest[pair % self.blocks]
        reached = pair[bound >= self.search.threshold - 1e-9]
        # blocks whose frequent terms could do it alone are opened for every passage
        alone = np.flatnonzero(self.rest >= self.search.threshold - 1e-9)
        if len(alone):
            every = (np.unique(passage)[:, None] * self.blocks + alone).ravel()
            reached = np.union1d(reached, every)
        return reached // self.blocks, reached % self.blocks

    def cover(self, words: np.ndarray, grams: set) -> float:
        """The share of words within an n-gram of the set; 1 for no words."""
        if not len(words):
            return 1.0
        n = min(self.search.n, len(words))
        covered = np.zeros(len(words), bool)
        for k in range(len(words) - n + 1):
            if tuple(words[k : k + n].tolist()) in grams:
                covered[k : k + n] = True
        return float(covered.mean())

    def short(self, words: np.ndarray) -> bool:
        """Whether one changed word can take too much of a part's n-gram cover."""
        return 0 < len(words) and self.search.n > (1 - self.search.overlap) * len(words) + 1e-9

    def aligned(self, own: np.ndarray, parts: tuple[np.ndarray, np.ndarray], covers: tuple[float, float]) -> tuple[float, float]:
        """The covers, those of short parts raised to their share of single words that stand, in
        order, where an n-gram of the item that the passage holds too says they should."""
        passage, item = own.tolist(), np.concatenate(parts).tolist()
        n = max(1, min(self.search.n, len(item) // 2))  # one changed word leaves a run of half the others
        places: dict[tuple, list[int]] = {}
        for k in range(len(item) - n + 1):
            places.setdefault(tuple(item[k : k + n]), []).append(k)
        starts = {x - k for x, g in enumerate(zip(*[passage[k:] for k in range(n)])) for k in places.get(g, ())}
        out, before = list(covers), 0
        for j, part in enumerate(parts):
            if self.short(part):
                slack = max(1, int((1 - self.search.overlap) * len(part)))
                for low, high in {(max(0, s + before - slack), s + before + len(part) + slack) for s in starts}:
                    if high > 0:
                        out[j] = max(out[j], common_words(passage[low:high], part.tolist()) / len(part))
            before += len(part)
        return out[0], out[1]

    def held(self, parts: tuple[np.ndarray, np.ndarray], covers: tuple[float, float]) -> bool:
        """Whether enough of both parts is covered: the least share, or all words but one; a part of
        one word may be missing where nearly the whole item is there."""
        size = [len(x) for x in parts]
        words = [c * k for c, k in zip(covers, size)]
        excused = sum(words) >= self.search.whole * sum(size) - 1e-9
        return all(w >= min(self.search.overlap * k, max(k - 1, 1)) - 1e-9 or (k == 1 and excused) for w, k in zip(words, size))

    def passage_grams(self, words: np.ndarray, sizes: set[int]) -> set:
        return {g for n in sizes for g in zip(*[words[k:].tolist() for k in range(n)])}

    def find(self, words: np.ndarray, row: np.ndarray, at: np.ndarray) -> list[tuple[int, int, float, float, float]]:
        """(row, item number, score, question's cover, answer's cover), the best passage of each."""
        if not self.items or not len(words):
            return []
        step = self.step
        inside = np.arange(len(words)) - at[row]
        # passage numbers: (row, k) covers the words [k * step, (k + 2) * step) of the row
        pieces = np.maximum(1, -(-np.diff(at) // step))
        base = np.cumsum(pieces) - pieces
        piece = base[row] + inside // step
        term = self.terms(words)
        known = np.flatnonzero(term >= 0)
        early = known[(inside[known] >= step)]
        width = len(self.vocabulary)
        key = np.unique(np.concatenate([piece[known] * width + term[known], (piece[early] - 1) * width + term[early]]))
        passage, block = self.open_blocks(key // width, key % width)
        bounds = np.searchsorted(key, np.stack([passage, passage + 1]) * width)
        owner = np.searchsorted(base, passage, "right") - 1
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        held, grams_of = None, {}
        for p, b, low, high, r in zip(passage.tolist(), block.tolist(), *bounds.tolist(), owner.tolist()):
            if p != held:
                held, present, grams_of = p, set((key[low:high] % width).tolist()), {}
                begin = at[r] + (p - base[r]) * step
                own = words[begin : min(begin + 2 * step, at[r + 1])]
            for k in range(b * self.search.block, min((b + 1) * self.search.block, len(self.items))):
                score = sum(w for t, w in self.weights[k].items() if t in present)
                if score < self.search.threshold - 1e-9:
                    continue
                question, answer = self.words[k]
                sizes = {min(self.search.n, len(x)) for x in (question, answer) if len(x)}
                for n in sizes - grams_of.keys():
                    grams_of[n] = self.passage_grams(own, {n})
                grams = set().union(*[grams_of[n] for n in sizes])
                covers = self.cover(question, grams), self.cover(answer, grams)
                if not self.held(self.words[k], covers) and (self.short(question) or self.short(answer)):
                    covers = self.aligned(own, self.words[k], covers)
                if self.held(self.words[k], covers):
                    best[r, k] = max(best.get((r, k), (0, 0, 0)), (score, *covers))
        return [(r, k, *found) for (r, k), found in sorted(best.items())]


def find_leaks(
    docs: DataFrame, items: DataFrame, search: Search = Search(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_col, item, score, question_overlap, answer_overlap): a row for each document row and
    item that one of its passages holds. ``items``: (item, question, answer).

    Items without words in their question are never found, items without an answer need only their
    question; items that repeat give rows each. Null and empty texts hold nothing. Rows that repeat
    give repeated rows; no items or no documents give no rows. Equal items are searched once. The
    items reach the executors in parts of at most ``search.items`` of them; every part is one pass
    over the documents, and how many there are does not change the result.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("question", "answer")]
    keyed = items.select("item", *texts).withColumn("key", F.md5(F.concat_ws(":", F.length("question"), "question", "answer").cast("binary")))
    distinct = keyed.groupBy("key").agg(F.first("question").alias("question"), F.first("answer").alias("answer"), F.count(F.lit(1)).alias("copies"))
    schema = f"id {kind}, key string, score double, question_overlap double, answer_overlap double"
    parts = max(1, -(-distinct.count() // max(1, search.items // 2)))  # half full on average, so that none is over
    counts = stored(_word_counts(distinct), "item-words") if parts > 1 else None
    found = []
    for part in range(parts):
        own = distinct.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == part) if parts > 1 else distinct
        total = _totals(counts, own) if parts > 1 else None
        index = shared(spark, indexes(own.orderBy("key").toArrow().to_pydict(), search, total))
        found.append(rows.mapInArrow(_searcher(index), schema))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    out = out.join(keyed.select("key", "item"), "key")
    return out.select(F.col("id").alias(id_col), "item", "score", "question_overlap", "answer_overlap")


def _totals(counts: DataFrame, own: DataFrame) -> Totals:
    """The sums of all items, and the counts of the words that these items have."""
    (sums,) = counts.where("word IS NULL").collect() or [None]
    words = _word_counts(own).where("word IS NOT NULL").select("word")
    table = counts.join(words, "word").select("word", "items").toArrow()
    word, df = table.column("word").to_numpy().astype(np.uint64), table.column("items").to_numpy()
    order = np.argsort(word)
    return Totals(sums["items"] if sums else 0, sums["length"] if sums else 0, word[order], df[order])


def _searcher(index):
    def run(batches):
        loaded = pickle.loads(index.value)
        for part in _text.chunks(batches, "text"):
            words = _text.lower_words(part.column("text"))
            for own in loaded:
                hits = own.find(*words)
                if hits:
                    row, item, score, question, answer = zip(*hits)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id").take(pa.array(row)), pa.array([own.items[k] for k in item]), *[pa.array(x, pa.float64()) for x in (score, question, answer)]],
                        names=["id", "key", "score", "question_overlap", "answer_overlap"],
                    )

    return run
