"""Near duplicates: all pairs of texts whose sets of word shingles have a Jaccard similarity of at
least a threshold, found with MinHash values, Bayesian pruning and exact verification.

1. Equal texts are one text with copies. Every text gets ``bands`` x ``rows`` MinHash values over
   its whole text; texts that agree on all values of a band share that band's bucket.
2. A pair is judged once, in the first band on which it agrees. There its MinHash values are
   compared step by step; after each step the pair is dropped if the posterior probability (uniform
   prior) that its similarity reaches the threshold is below ``tolerance``.
3. Texts with a pair left in a bucket are joined with their shingles, and what is left is verified
   exactly. Only counts of links and the edges of a spanning forest leave a task, never the pairs
   of a group.
4. Components over the forests are the classes.

Buckets of more than ``block`` texts are cut into blocks of that size, and pairs of blocks are
dealt to tasks, so that no task holds more than two blocks whatever the size of a group. A link of
similarity s is missed if it agrees on no band, (1 - s^rows)^bands: 4e-7 at the threshold of 0.8
and less above, or if pruned wrongly, at most ``tolerance`` a step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premiumlake.llm import _text
from premiumlake.llm._groups import changes, components, whole_groups
from premiumlake.llm._store import stored


#: Bytes of text that a task shingles at a time, and of rows whose pairs it compares.
CHUNK_BYTES, TABLE_BYTES = 1 << 18, 8 << 20


@dataclass(frozen=True)
class Join:
    threshold: float = 0.8
    shingle: int = 5
    bands: int = 28
    rows: int = 4
    step: int = 16
    tolerance: float = 1e-7
    block: int = 1024
    seed: int = 7

    @property
    def values(self) -> int:
        return self.bands * self.rows


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the word shingles of every row; a row of fewer words is one shingle."""
    start, end, row = _text.word_spans(data, offsets)
    words = _text.span_hashes(data, start, end)
    hashes, first = _text.window_hashes(words, row, size)
    rows = row[first]
    count = np.bincount(row, minlength=len(offsets) - 1)
    extra_hash, extra_row = [], []
    at = np.searchsorted(row, np.arange(len(offsets)))
    for r in np.flatnonzero((count > 0) & (count < size)):
        found = np.zeros(1, np.uint64)
        for k, w in enumerate(words[at[r] : at[r + 1]]):
            found = _text.mix(found * np.uint64(31) + w + np.uint64(k + 1))
        extra_hash.append(_text.mix(found + np.uint64(count[r]))[0])
        extra_row.append(r)
    if extra_row:
        hashes = np.concatenate([hashes, np.array(extra_hash, np.uint64)])
        rows = np.concatenate([rows, np.array(extra_row)])
        order = np.argsort(rows, kind="stable")
        hashes, rows = hashes[order], rows[order]
    return hashes, rows


def signatures(hashes: np.ndarray, rows: np.ndarray, n: int, join: Join) -> np.ndarray:
    """n x values MinHash values, 16 bits of each; rows without shingles have zeros."""
    out = np.zeros((n, join.values), np.uint16)
    if not len(rows):
        return out
    rng = np.random.default_rng(join.seed)
    turns = rng.integers(0, 1 << 63, (join.values, 2), dtype=np.uint64)
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    for k, (a, c) in enumerate(turns):
        least = np.minimum.reduceat((hashes ^ c) * (a | np.uint64(1)), first)
        out[rows[first], k] = _text.mix(least).astype(np.uint16)
    return out


def band_keys(values: np.ndarray, join: Join) -> np.ndarray:
    """n x bands bucket keys: hashes of the values of a band (of all their bits, up to four)."""
    packed = np.zeros((len(values), join.bands), np.uint64)
    for k in range(join.rows):
        packed = packed * np.uint64(1 << 16) + values[:, k :: join.rows]
        packed = _text.mix(packed) if k >= 3 else packed
    return _text.mix(packed ^ _text.mix(np.arange(1, join.bands + 1, dtype=np.uint64))[None, :])


def least_matches(threshold: float, step: int, values: int, tolerance: float) -> list[int]:
    """For n = step, 2 step, ... compared values: the fewest matches with which the posterior
    probability of reaching the threshold is still at least the tolerance."""
    s = (np.arange(200_000) + 0.5) / 200_000
    out = []
    for n in range(step, values + 1, step):
        for m in range(n + 1):
            log = m * np.log(s) + (n - m) * np.log1p(-s)
            density = np.exp(log - log.max())
            if density[s >= threshold].sum() >= tolerance * density.sum():
                out.append(m)
                break
    return out


def surviving_pairs(values: np.ndarray, group: np.ndarray, block: np.ndarray, split: np.ndarray, band: np.ndarray, join: Join, need: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b) of rows of one group whose first common band is the group's and that no step
    of the comparison drops. Rows are sorted by group; in a ``split`` group (two blocks) only
    pairs across blocks count. ``need``: ``least_matches``."""
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, np.int64)
    size = np.diff(np.r_[first, len(group)])
    last = np.repeat(first + size, size)
    later = last - np.arange(len(group)) - 1
    total = np.cumsum(later)
    found, low = [], 0
    while low < len(group):  # about a quarter of a million pairs at a time
        high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + (1 << 18), "right")))
        count = later[low:high]
        a = np.repeat(np.arange(low, high), count)
        b = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count) + a + 1
        low = high
        keep = ~split[a] | (block[a] != block[b])
        a, b = a[keep], b[keep]
        matches, old = np.zeros(len(a), np.int64), np.zeros(len(a), bool)
        for k, n in enumerate(range(0, join.values, join.step)):
            stop = min(n + join.step, join.values)
            same = values[a, n:stop] == values[b, n:stop]
            matches += same.sum(axis=1)
            # bands that end here and come before the group's own
            for t in range(-(-n // join.rows), stop // join.rows):
                begin = t * join.rows
                whole = (values[a, begin : begin + join.rows] == values[b, begin : begin + join.rows]).all(axis=1)
                old |= whole & (t < band[a])
            keep = ~old
            if stop - n == join.step:
                keep &= matches >= need[k]
            a, b, matches, old = a[keep], b[keep], matches[keep], old[keep]
        found.append((a, b))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def intersections(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sorted distinct arrays, for pairs of them."""
    if len(a) < 500:
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b)], np.int64)
    member = np.unique(np.concatenate([a, b]))
    place = np.searchsorted(member, np.arange(len(sets)))
    owner = np.repeat(np.arange(len(member)), [len(sets[m]) for m in member])
    _, column, count = np.unique(np.concatenate([sets[m] for m in member]), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(member), len(member)), np.float32)
    width = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        x, y = np.searchsorted(column, [low, low + width])
        dense = np.zeros((len(member), width), np.float32)
        dense[owner[x:y], column[x:y] - low] = 1
        common += dense @ dense.T
    return common[place[a], place[b]].astype(np.int64)


def shingle_sets(table: pa.Table, wanted: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of the rows that are ``wanted``, empty for others. A text of
    several rows (by ``text_id``) is cut once, and a chunk of texts at a time: shingling takes many
    times the memory of its text."""
    ids, first, of = np.unique(table.column("text_id").to_numpy()[wanted], return_index=True, return_inverse=True)
    texts = table.select(["text"]).take(pa.array(wanted[first]))
    found = []
    for part in _text.chunks(texts.to_batches(), "text", CHUNK_BYTES):
        hashes, rows = shingles(*_text.buffers(part.column("text")), size)
        at = np.searchsorted(rows, np.arange(part.num_rows + 1))
        found += [np.unique(hashes[x:y]) for x, y in zip(at[:-1], at[1:])]
    sets = [np.zeros(0, np.uint64)] * table.num_rows
    for row, k in zip(wanted.tolist(), of.tolist()):
        sets[row] = found[k]
    return sets


def _sign(docs: DataFrame, join: Join) -> DataFrame:
    """A row for each distinct text: text_id, digest, copies, lowest id, MinHash values, keys."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for part in _text.chunks(batches, "text", CHUNK_BYTES):
            hashes, rows = shingles(*_text.buffers(part.column("text")), join.shingle)
            values = signatures(hashes, rows, part.num_rows, join)
            has = np.bincount(rows, minlength=part.num_rows) > 0
            keys = band_keys(values, join).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(has * join.bands)].astype(np.int32)), pa.array(keys[has].ravel()))
            packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * join.values), part.num_rows, [None, pa.py_buffer(values)])
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("digest"), packed.cast(pa.binary()), lists], names=["id", "digest", "minhash", "keys"])

    signed = docs.mapInArrow(run, f"id {kind}, digest string, minhash binary, keys array<long>")
    texts = signed.groupBy("digest").agg(
        F.min("id").alias("lowest"), F.count(F.lit(1)).alias("copies"), F.first("minhash").alias("minhash"), F.first("keys").alias("keys")
    )
    return stored(texts.withColumn("text_id", F.monotonically_increasing_id()), "texts")


def _units(signed: DataFrame, join: Join) -> DataFrame:
    """(key, i, j, band, block, text_id): the texts of each bucket of two or more, by pairs of
    blocks i <= j; a bucket of one block has the pair (0, 0)."""
    rows = signed.select("text_id", F.posexplode("keys").alias("band", "key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(sizes, "key").withColumn("blocks", F.ceil(F.col("n") / join.block).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("text_id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "band", "block", "text_id")


_UNIT = ["key", "i", "j"]


def _arrays(table: pa.Table, join: Join):
    """(values, group, block, split, band) of a table of whole units."""
    raw, _ = _text.buffers(table.column("minhash").combine_chunks())
    values = np.frombuffer(raw.tobytes(), np.uint16).reshape(table.num_rows, join.values)
    column = lambda c: table.column(c).to_numpy()
    return values, np.cumsum(changes(table, _UNIT)), column("block"), column("i") != column("j"), column("band")


def find_links(docs: DataFrame, join: Join = Join()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For (id, digest, text) rows: the distinct texts (``_sign``), (text_id, texts, docs) with the
    number of other texts and of their documents that each text links to, and (a, b) edges of text
    ids that span every group of links."""
    need = least_matches(join.threshold, join.step, join.values, join.tolerance)
    signed = _sign(docs, join)
    units = stored(_units(signed, join), "units")

    def prune(batches):
        for table in whole_groups(batches, _UNIT, TABLE_BYTES):
            a, b = surviving_pairs(*_arrays(table, join), join, need)
            some = pa.array(np.unique(np.concatenate([a, b])))
            if len(some):
                yield from table.take(some).combine_chunks().to_batches()

    kinds = "key long, i int, j int, band int, block int, text_id long, minhash binary, copies long, digest string"
    rows = units.join(signed.select("text_id", "minhash", "copies", "digest"), "text_id")
    rows = rows.select(*[k.split()[0] for k in kinds.split(", ")])
    left = stored(rows.repartition(*_UNIT).sortWithinPartitions(*_UNIT, "text_id").mapInArrow(prune, kinds), "left")

    def verify(batches):
        for table in whole_groups(batches, _UNIT, TABLE_BYTES):
            arrays = _arrays(table, join)
            a, b = surviving_pairs(*arrays, join, need)
            if not len(a):
                continue
            sets = shingle_sets(table, np.union1d(a, b), join.shingle)
            size = np.array([len(x) for x in sets])
            linked = np.zeros(len(a), bool)
            group = arrays[1][a]
            edges = np.r_[np.flatnonzero(np.r_[True, group[1:] != group[:-1]]), len(a)]
            for low, high in zip(edges[:-1], edges[1:]):
                part = np.arange(low, high)
                common = intersections(sets, a[part], b[part])
                either = size[a[part]] + size[b[part]] - common
                linked[part] = common >= join.threshold * either - 1e-9
            a, b = a[linked], b[linked]
            copies, ids = table.column("copies").to_numpy(), table.column("text_id").to_numpy()
            n = table.num_rows
            texts = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
            documents = np.bincount(a, weights=copies[b], minlength=n) + np.bincount(b, weights=copies[a], minlength=n)
            some = np.flatnonzero(texts)
            parent = list(range(n))

            def root(x: int) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            forest = []
            for x, y in zip(a.tolist(), b.tolist()):
                rx, ry = root(x), root(y)
                if rx != ry:
                    parent[max(rx, ry)] = min(rx, ry)
                    forest.append((x, y))
            ends = np.array(forest, np.int64).reshape(-1, 2)
            none = np.zeros(len(ends), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[ids[some], ids[ends[:, 0]]]),
                    pa.array(np.r_[ids[some], ids[ends[:, 1]]]),
                    pa.array(np.r_[texts[some], none]),
                    pa.array(np.r_[documents[some].astype(np.int64), none]),
                ],
                names=["a", "b", "texts", "docs"],
            )

    # one row of each text that is still needed; copies are combined before their shuffle
    wanted = left.select("digest").distinct()
    text = docs.select("digest", "text").join(wanted, "digest", "left_semi").groupBy("digest").agg(F.first("text").alias("text"))
    full = left.drop("digest").join(text.join(left.select("digest", F.col("text_id").alias("of")).distinct(), "digest").drop("digest"), F.col("text_id") == F.col("of"))
    full = full.select("key", "i", "j", "band", "block", "text_id", "minhash", "copies", "text")
    out = stored(full.repartition(*_UNIT).sortWithinPartitions(*_UNIT, "text_id").mapInArrow(verify, "a long, b long, texts long, docs long"), "links")
    counts = out.where("a = b").groupBy(F.col("a").alias("text_id")).agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    return signed, counts, out.where("a <> b").select("a", "b")


def near_duplicates(docs: DataFrame, join: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, class_id, n_links, n_copies, text_links, class_no, digest) for every row of ``docs``.

    ``class_id``: the lowest id of the documents that are connected by links (null if all their ids
    are). ``n_links``: the other documents whose texts have a similarity of ``threshold`` or more,
    copies included; ``n_copies`` of them are equal texts, ``text_links`` is the number of different
    texts among the rest. ``digest`` identifies a text, ``class_no`` a class also without ids.

    Words are runs of bytes other than white space. Null texts are empty ones; texts without words
    are linked to their copies only; rows that repeat are copies of each other; null ids are
    documents like others. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.md5(F.col("text").cast("binary")))
    signed, counts, edges = find_links(rows, join)
    roots = components(edges, "classes")
    texts = signed.select("digest", "text_id", "lowest", "copies")
    texts = texts.join(counts, "text_id", "left").join(roots.withColumnRenamed("node", "text_id"), "text_id", "left")
    texts = stored(texts.withColumn("root", F.coalesce("root", "text_id")), "classed")
    lowest = texts.groupBy("root").agg(F.min("lowest").alias("class_id"))
    texts = texts.join(lowest, "root").select(
        "digest", "class_id",
        (F.coalesce("docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        (F.col("copies") - 1).alias("n_copies"),
        F.coalesce("texts", F.lit(0)).alias("text_links"),
        F.col("root").alias("class_no"),
    )
    found = rows.select("id", "digest").join(texts, "digest")
    return found.select(F.col("id").alias(id_col), "class_id", "n_links", "n_copies", "text_links", "class_no", "digest")
