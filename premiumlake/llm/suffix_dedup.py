"""Exact substring deduplication across documents: a byte goes if a string of ``length`` bytes
that covers it also starts in a document with a smaller id.

1. Equal texts become one text with the smallest id of its documents.
2. Every window of ``length`` bytes has a seed: its least ``gram``-byte string by hash, with the
   bytes around it that all windows hold which have it in the same half of their places. Equal
   windows have equal seeds, and about one byte in fourteen starts one. Seeds that only one text has
   are dropped; no window of theirs can recur. A seed is twice as long as a gram, so few texts share
   one by chance, however many there are.
3. The stretches of text that a remaining seed owns (the windows with this seed, a hundred bytes at
   most) meet in the shard of the seed, in blocks of about ``block`` stretches, dealt by text and
   place. Blocks go through suffix array jobs of a bounded size: induced sorting and permuted common
   prefixes group the windows that agree on ``length`` bytes, and the smallest document of each
   group decides. Stretches that differ from all others close to their seed, on both sides, have no
   such window and are left out of the sort. Stretches go straight to their shards and are not
   written in between.
4. Where a seed has several blocks, each block's job gives the smallest document of each of its
   windows once; these meet by window, and the smallest of all blocks marks the others.
5. The marked windows go back to their text, are merged into spans, and removed.

Texts are keyed by a 64-bit hash of their digest.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from premiumlake.llm import _text
from premiumlake.llm._groups import whole_groups
from premiumlake.llm._store import folder, release_shuffles, stored
from premiumlake.llm._suffix import common_prefixes, suffix_array

LAST = (1 << 63) - 1
PLACE = np.uint64((1 << 32) - 1)


@dataclass(frozen=True)
class Repeats:
    length: int = 50
    gram: int = 16
    block: int = 4_000
    job_bytes: int = 1 << 20
    contexts: int = 4

    @property
    def reach(self) -> int:
        """Grams of a window: also the most windows of one stretch."""
        return self.length - self.gram + 1

    @property
    def half(self) -> int:
        return -(-self.reach // 2)

    @property
    def halves(self) -> list[tuple[int, int]]:
        return [(0, self.half), (self.half, self.reach)]


def gram_hashes(data: np.ndarray, rule: Repeats) -> np.ndarray:
    """A hash of the ``gram`` bytes from every position on."""
    grams = len(data) - rule.gram + 1
    views = np.lib.stride_tricks.sliding_window_view(data, 8)
    hashed = np.zeros(grams, np.uint64)
    for at in range(0, rule.gram, 8):  # eight bytes at a time, the last ones aligned to the gram's end
        at = min(at, rule.gram - 8)
        word = np.ascontiguousarray(views[at : at + grams]).view(np.uint64).ravel()
        hashed = _text.mix(hashed + word)
    return hashed


def common_hashes(grams: np.ndarray, at: np.ndarray, low: int, high: int, rule: Repeats) -> np.ndarray:
    """Of places of grams: a hash of the bytes that all windows have which hold the gram from their
    byte ``low`` or a later one on, before ``high``. ``grams``: the hashes of all grams."""
    size = rule.length - (high - 1 - low)
    found = np.full(len(at), low, np.uint64)
    for k in range(0, size, rule.gram):
        found = _text.mix(found + grams[at - low + min(k, size - rule.gram)])
    return found


def window_seeds(data: np.ndarray, offsets: np.ndarray, rule: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """(seed, start) of every window within a row."""
    windows = len(data) - rule.length + 1
    if windows <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # half a hash, then the place: of a window's grams with the least hash the first one counts
    grams = gram_hashes(data, rule)
    least, width = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64), 1
    while 2 * width <= rule.reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if rule.reach > width:
        least = np.minimum(least[: -(rule.reach - width)], least[rule.reach - width :])
    row_end = np.repeat(offsets[1:], np.diff(offsets))[:windows]
    start = np.flatnonzero(np.arange(windows) + rule.length <= row_end)
    if not len(start):
        return np.zeros(0, np.uint64), start
    at = (least[start] & PLACE).astype(np.int64)
    later = at - start >= rule.half
    first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (later[1:] != later[:-1])])
    seed = np.empty(len(first), np.uint64)
    for side, bounds in zip((~later[first], later[first]), rule.halves):
        seed[side] = common_hashes(grams, at[first[side]], *bounds, rule)
    return np.repeat(seed, np.diff(np.r_[first, len(start)])), start


def _stretches(seed: np.ndarray, start: np.ndarray, rule: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first window, windows) of maximal runs of windows of one seed, cut to the
    length of the longest that a window's grams allow."""
    if not len(seed):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, (seed[1:] != seed[:-1]) | (start[1:] != start[:-1] + 1)])
    size = np.diff(np.r_[first, len(seed)])
    pieces = -(-size // rule.reach)
    number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.repeat(first, pieces) + number * rule.reach
    return begin, np.minimum(rule.reach, np.repeat(first + size, pieces) - begin)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)


def sharing(data: np.ndarray, offsets: np.ndarray, seed: np.ndarray, rule: Repeats) -> np.ndarray:
    """Whether a stretch may have a window in common with another one.

    A common window holds the seed's gram at the same place in both, up to ``length - gram`` bytes
    from its start. These places fall into about ``contexts`` ranges; windows whose gram lies in one
    of them agree on the bytes around it that all windows of the range have. A stretch none of whose
    contexts recurs shares no window: it need not be sorted.
    """
    grams = gram_hashes(data, rule)
    row_of = np.repeat(np.arange(len(seed)), np.diff(offsets))
    may = np.zeros(len(seed), bool)
    step = -(-rule.reach // rule.contexts)
    for low, high in rule.halves:
        every = np.arange(low, len(data) - rule.length + high)
        every = every[common_hashes(grams, every, low, high, rule) == seed.view(np.uint64)[row_of[every]]]
        for left in range(low, high, step):
            right = min(left + step, high)
            row, start = row_of[every], every - left
            inside = (start >= offsets[row]) & (start + rule.length - (right - 1 - left) <= offsets[row + 1])
            at, row = every[inside], row[inside]
            _, same, times = np.unique(common_hashes(grams, at, left, right, rule), return_inverse=True, return_counts=True)
            may[row[times[same] > 1]] = True
    return may


def least_owners(data: np.ndarray, offsets: np.ndarray, windows: np.ndarray, owner: np.ndarray, rule: Repeats) -> np.ndarray:
    """For each window of each stretch (the first ``windows`` positions of it), the smallest owner
    of an equal window, by the suffix array of all stretches and its common prefixes."""
    size = np.diff(offsets)
    # a separator follows each stretch: symbol 0, bytes are 1 to 256
    starts = offsets[:-1] + np.arange(len(size))
    s = np.zeros(len(data) + len(size), np.uint16)
    s[_ranges(starts, size)] = data.astype(np.uint16) + 1
    order = suffix_array(s)
    prefix = common_prefixes(s, order, starts, 3 * rule.length)
    least = np.full(len(s), LAST, np.int64)
    own = _ranges(starts, windows)
    least[own] = np.repeat(owner, windows)
    first = np.flatnonzero(np.r_[True, prefix[order[1:]] < rule.length])
    smallest = np.minimum.reduceat(least[order], first)
    least[order] = np.repeat(smallest, np.diff(np.r_[first, len(order)]))
    return least[own]


def _distinct_texts(docs: DataFrame, rule: Repeats) -> DataFrame:
    """Table of distinct texts, bucketed by their key so that later joins need not move them."""
    spark = docs.sparkSession
    texts = docs.groupBy("key").agg(F.min("rank").alias("lowest"), F.first("text").alias("text"))
    name = f"llm_texts_{uuid.uuid4().hex}"
    path = folder(spark, "distinct", table=name)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = texts.write.bucketBy(buckets, "key").option("path", path).option("compression", "zstd")
    writer.saveAsTable(name)
    del texts, writer
    release_shuffles(spark)
    return spark.table(name)


def _shared_seeds(texts: DataFrame, rule: Repeats) -> DataFrame:
    """(key, seeds array<struct<seed, blocks>>) of seeds that two texts or more have, and into how
    many blocks the stretches of all texts are dealt."""

    def run(batches):
        for part in _text.chunks(batches, "text"):
            data, offsets = _text.buffers(part.column("text"))
            seed, start = window_seeds(data, offsets, rule)
            begin, _ = _stretches(seed, start, rule)
            seed, row = seed[begin], np.searchsorted(offsets, start[begin], "right") - 1
            order = np.lexsort((seed, row))
            seed, row = seed[order], row[order]
            fresh = np.ones(len(seed), bool)
            fresh[1:] = (seed[1:] != seed[:-1]) | (row[1:] != row[:-1])
            at = np.flatnonzero(fresh)
            many = np.diff(np.r_[at, len(seed)]).astype(np.int32)
            ends = np.searchsorted(row[at], np.arange(part.num_rows + 1)).astype(np.int32)
            entries = pa.StructArray.from_arrays([pa.array(seed[at].astype(np.int64)), pa.array(many)], names=["seed", "many"])
            lists = pa.ListArray.from_arrays(pa.array(ends), entries)
            yield pa.RecordBatch.from_arrays([part.column("key"), lists], names=["key", "seeds"])

    lists = texts.select("key", "text").mapInArrow(run, "key long, seeds array<struct<seed: long, many: int>>")
    seeds = lists.select("key", F.inline("seeds"))
    by_seed = W.partitionBy("seed")
    blocks = F.ceil(F.sum("many").over(by_seed) / rule.block).cast("int")
    counted = seeds.select("key", "seed", F.count(F.lit(1)).over(by_seed).alias("n"), blocks.alias("blocks")).where("n > 1")
    return counted.groupBy("key").agg(F.collect_list(F.struct("seed", "blocks")).alias("seeds"))


def _candidates(texts: DataFrame, shared: DataFrame, rule: Repeats) -> DataFrame:
    """(seed, block, blocks, key, lowest, start, windows, bytes): the stretches of shared seeds."""

    def run(batches):
        for part in _text.chunks(batches, "text", 1 << 20):
            data, offsets = _text.buffers(part.column("text"))
            seed, start = window_seeds(data, offsets, rule)
            begin, windows = _stretches(seed, start, rule)
            seed, start = seed[begin].astype(np.int64), start[begin]
            row = np.searchsorted(offsets, start, "right") - 1
            lists = part.column("seeds")
            entry, many = (pc.struct_field(lists.flatten(), k).to_numpy(zero_copy_only=False) for k in (0, 1))
            of = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            # seeds of a row that are in its list, and their numbers of blocks
            known, at = np.unique(entry, return_inverse=True)
            if not len(known) or not len(seed):
                continue
            place = np.minimum(np.searchsorted(known, seed), len(known) - 1)
            hit = known[place] == seed
            listed = np.unique(of * len(known) + at)
            wanted = row * len(known) + place
            slot = np.minimum(np.searchsorted(listed, wanted), len(listed) - 1)
            hit &= listed[slot] == wanted
            count = np.zeros(len(known), np.int64)
            count[at] = many
            seed, start, windows, row, place = (x[hit] for x in (seed, start, windows, row, place))
            if not len(seed):
                continue
            blocks, begin = count[place], start - offsets[row]
            key = part.column("key").to_numpy()[row]
            block = _text.mix(_text.mix(key.view(np.uint64)) + begin.astype(np.uint64)) % blocks.astype(np.uint64)
            size = windows + rule.length - 1
            ends = np.r_[0, np.cumsum(size)].astype(np.int32)
            raw = pa.Array.from_buffers(pa.binary(), len(seed), [None, pa.py_buffer(ends), pa.py_buffer(data[_ranges(start, size)])])
            rows = pa.array(row)
            for low in range(0, len(seed), 20_000):
                yield pa.RecordBatch.from_arrays(
                    [
                        x.slice(low, 20_000)
                        for x in (
                            pa.array(seed), pa.array(block.astype(np.int32)), pa.array(blocks.astype(np.int32)), pa.array(key),
                            part.column("lowest").take(rows), pa.array(begin.astype(np.int64)), pa.array(windows.astype(np.int32)), raw,
                        )
                    ],
                    names=["seed", "block", "blocks", "key", "lowest", "start", "windows", "bytes"],
                )

    joined = texts.join(shared, "key").select("key", "lowest", "text", "seeds")
    return joined.mapInArrow(run, "seed long, block int, blocks int, key long, lowest long, start long, windows int, bytes binary")


def _sorted_blocks(candidates: DataFrame, rule: Repeats) -> DataFrame:
    """(key, first, after, least, window), job by job: byte spans of windows that a smaller document
    of the job has, with null ``least`` and ``window``; and, of seeds with several blocks, every
    window of the job's smallest document, with that document."""

    def run(batches):
        for table in whole_groups(batches, ["seed", "block"], rule.job_bytes):
            data, offsets = _text.buffers(table.column("bytes").combine_chunks())
            lowest, windows, begin, key = (table.column(c).to_numpy() for c in ("lowest", "windows", "start", "key"))
            # equal stretches are sorted once, for the smallest of their documents; those that share
            # no window with another need no sorting: all their windows are that document's
            code = _text.span_hashes(data, offsets[:-1], offsets[1:])
            _, sample, of = np.unique(code, return_index=True, return_inverse=True)
            smallest = np.full(len(sample), LAST, np.int64)
            np.minimum.at(smallest, of, lowest)
            size = np.diff(offsets)[sample]
            ends = np.r_[0, np.cumsum(size)]
            distinct = data[_ranges(offsets[sample], size)]
            may = sharing(distinct, ends, table.column("seed").to_numpy()[sample], rule)
            least = np.repeat(smallest, windows[sample])
            if may.any():
                some = np.repeat(may, size)
                least[np.repeat(may, windows[sample])] = least_owners(
                    distinct[some], np.r_[0, np.cumsum(size[may])], windows[sample][may], smallest[may], rule
                )
            at = np.cumsum(windows[sample]) - windows[sample]
            marked = least[_ranges(at[of], windows)] < np.repeat(lowest, windows)
            row = np.repeat(np.arange(len(key)), windows)
            place = np.repeat(begin, windows) + _ranges(np.zeros(len(key), np.int64), windows)
            open_ = ~marked & np.repeat(table.column("blocks").to_numpy() > 1, windows)
            yield from marked_spans(key, row[marked], place[marked])
            yield from first_windows(data, offsets, key, lowest, begin, row[open_], place[open_])

    def marked_spans(key, row, place):
        if not len(row):
            return
        # runs of marked windows within a stretch
        first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)])
        last = np.r_[first[1:], len(row)] - 1
        none = [pa.nulls(len(first), pa.int64()), pa.nulls(len(first), pa.binary())]
        spans = [pa.array(key[row[first]]), pa.array(place[first]), pa.array(place[last] + rule.length)]
        yield pa.RecordBatch.from_arrays(spans + none, names=names)

    def first_windows(data, offsets, key, lowest, begin, row, place):
        for low in range(0, len(row), 20_000):
            of, at = row[low : low + 20_000], place[low : low + 20_000]
            size = np.full(len(of), rule.length)
            raw = pa.py_buffer(data[_ranges(offsets[of] + at - begin[of], size)])
            ends = pa.py_buffer((np.arange(len(of) + 1) * rule.length).astype(np.int32))
            window = pa.Array.from_buffers(pa.binary(), len(of), [None, ends, raw])
            spans = [pa.array(key[of]), pa.array(at), pa.array(at + rule.length), pa.array(lowest[of])]
            yield pa.RecordBatch.from_arrays([*spans, window], names=names)

    names = ["key", "first", "after", "least", "window"]
    rows = candidates.repartition("seed", "block").sortWithinPartitions("seed", "block")
    return rows.mapInArrow(run, "key long, first long, after long, least long, window binary")


def _marks(blocks: DataFrame) -> DataFrame:
    """(key, first, after) of all windows that a smaller document has: those that their own block
    marked, and those that another block of their seed marks."""
    firsts = blocks.where("window is not null")
    smallest = firsts.groupBy("window").agg(F.min("least").alias("smallest"))
    across = firsts.join(smallest, "window").where("smallest < least")
    return blocks.where("window is null").unionByName(across.drop("smallest")).select("key", "first", "after")


def kept_texts(
    docs: DataFrame, rule: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text", whole_characters: bool = False
) -> DataFrame:
    """(key, lowest, n_bytes, spans array<struct<first, after>>, kept binary) for each distinct text:
    what of it repeats documents with smaller ids, and what is left, for the document of the
    smallest id. ``per_document`` gives every row its result. With ``whole_characters`` a character
    goes only if all its bytes do, so that what is left is text again."""
    rows = _keyed(docs, id_col, text_col)
    texts = _distinct_texts(rows, rule)
    shared = stored(_shared_seeds(texts, rule), "shared")
    blocks = stored(_sorted_blocks(_candidates(texts, shared, rule), rule), "blocks")
    spans = _marks(blocks).groupBy("key").agg(F.collect_list(F.struct("first", "after")).alias("marks"))

    def cut(batches):
        for part in _text.chunks(batches, "text"):
            data, offsets = _text.buffers(part.column("text"))
            lists = part.column("marks")
            of = np.repeat(np.arange(part.num_rows), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            first, after = (pc.struct_field(lists.flatten(), k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
            cover = np.zeros(len(data) + 1, np.int64)
            np.add.at(cover, offsets[of] + first, 1)
            np.add.at(cover, offsets[of] + after, -1)
            gone = np.cumsum(cover[:-1]) > 0
            if whole_characters and len(data):
                begins = np.flatnonzero((data & 0xC0) != 0x80)
                gone = np.repeat(np.logical_and.reduceat(gone, begins), np.diff(np.r_[begins, len(data)]))
            left = np.zeros(len(data) + 1, np.int64)
            np.cumsum(~gone, out=left[1:])
            # runs end at the ends of rows
            border = np.zeros(len(data) + 1, bool)
            border[offsets] = True
            before = np.r_[False, gone[:-1]] if len(gone) else gone
            begin = np.flatnonzero(gone & (~before | border[:-1]))
            end = np.flatnonzero(gone & (~np.r_[gone[1:], False] | border[1:])) + 1 if len(gone) else begin
            row = np.searchsorted(offsets, begin, "right") - 1
            ends = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
            runs = pa.StructArray.from_arrays([pa.array((x - offsets[row]).astype(np.int64)) for x in (begin, end)], names=["first", "after"])
            kept = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(left[offsets].astype(np.int32)), pa.py_buffer(data[~gone])])
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("lowest"), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(ends), runs), kept],
                names=["key", "lowest", "n_bytes", "spans", "kept"],
            )

    whole = texts.join(spans, "key", "left").select("key", "lowest", "text", "marks")
    return whole.mapInArrow(cut, "key long, lowest long, n_bytes long, spans array<struct<first: long, after: long>>, kept binary")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rank = F.coalesce(F.col(id_col).try_cast("long"), F.lit(LAST))
    return docs.select(F.col(id_col).alias("id"), rank.alias("rank"), F.xxhash64(F.md5(text.cast("binary"))).alias("key"), text.alias("text"))


def per_document(
    docs: DataFrame, texts: DataFrame, kept: str, nothing, rule: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, ``kept``) for every row of ``docs``.

    ``texts``: ``kept_texts`` or a projection with key, lowest, n_bytes, n_removed, n_spans and
    ``kept``; ``nothing``: its value where nothing is left. A document whose text a smaller id also
    has loses all of it, unless it is shorter than ``length``.

    Ids are integers; a null id, or one that is no integer, is larger than all others. Null texts are empty. Rows that repeat,
    and rows of one id with different texts, don't remove each other's strings. An empty table
    gives an empty result.
    """
    rows = _keyed(docs, id_col, text_col).drop("text").join(texts, "key")
    copy = (F.col("rank") > F.col("lowest")) & (F.col("n_bytes") >= rule.length)
    return rows.select(
        F.col("id").alias(id_col),
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(copy, nothing).otherwise(F.col(kept)).alias(kept),  # a copy keeps nothing
    )


def with_counts(texts: DataFrame) -> DataFrame:
    """``kept_texts`` with n_removed and n_spans."""
    removed = F.col("n_bytes") - F.octet_length("kept")
    return texts.withColumn("n_removed", removed).withColumn("n_spans", F.size("spans").cast("long"))
