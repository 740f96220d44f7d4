"""Quality rules: base rules on words, then a hashed n-gram log-likelihood ratio.

The method holds two multinomials over hashed byte n-grams: one of the trusted target (documents
that a table of labels marks good) and one of the raw corpus (all documents), both counted over
whole texts and all rows. A document's score is the mean of log(target / raw) over its n-grams,
so its length cancels; it is kept when it passes the base rules and its score reaches a fixed
threshold. Nothing is drawn at random: equal texts get equal verdicts.

The counts are ``buckets`` rows per task before the shuffle and ``buckets`` rows after it, which
is all that reaches the driver, whatever the size of the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premiumlake.llm import _text

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

#: Bytes of text that a task works on at a time; the figures of a chunk take a hundred times its size.
CHUNK_BYTES = 1 << 18

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


@dataclass(frozen=True)
class Ratio:
    """Parameters of the likelihood ratio: bytes to an n-gram, hash buckets, the added count of
    each bucket, and the mean log ratio from which a document is kept."""

    n: int = 3
    buckets: int = 1 << 14
    smoothing: float = 1.0
    threshold: float = -0.25


def base_figures(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The figures of every row of a chunk: words, their code points, symbol characters, lines
    with a word that equal an earlier one, and words within a 5-word window that recurs."""
    n = len(offsets) - 1
    start, end, row = _text.word_spans(data, offsets)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    figures = {
        "n_words": np.bincount(row, minlength=n).astype(np.int64),
        "word_chars": _text.per_row(points[end] - points[start], row, n),
        "n_symbols": _text.span_sums(_SYMBOL[data], offsets),
    }

    breaks = np.zeros(256, bool)
    breaks[0x0A] = True
    begin, stop, of = _text.word_spans(data, offsets, breaks)
    letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~_text.SEPARATORS[data], out=letters[1:])
    written = letters[stop] > letters[begin]
    begin, stop, of = begin[written], stop[written], of[written]
    lines = _text.span_hashes(data, begin, stop)
    order = np.lexsort((lines, of))
    same = (lines[order][1:] == lines[order][:-1]) & (of[order][1:] == of[order][:-1])
    figures["n_dup_lines"] = np.bincount(of[order][1:][same], minlength=n).astype(np.int64)

    windows, first = _text.window_hashes(_text.span_hashes(data, start, end), row, WINDOW)
    of = row[first]
    order = np.lexsort((windows, of))
    same = (windows[order][1:] == windows[order][:-1]) & (of[order][1:] == of[order][:-1])
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(len(row) + 1, np.int64)
    np.add.at(inside, first[twice], 1)
    np.add.at(inside, first[twice] + WINDOW, -1)
    figures["n_repeat_words"] = _text.per_row(np.cumsum(inside)[:-1] > 0, row, n)
    return figures


def gram_buckets(data: np.ndarray, offsets: np.ndarray, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every n-gram of bytes within a row."""
    size = len(data) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.zeros(size, np.uint64)
    for k in range(n):
        code = code * np.uint64(257) + data[k : size + k]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = row[:size] == row[n - 1 :]
    return (_text.mix(code[whole]) % np.uint64(buckets)).astype(np.int64), row[:size][whole]


def corpus_counts(docs: DataFrame, labels: DataFrame | None, ratio: Ratio, id_col: str, text_col: str) -> DataFrame:
    """(bucket, raw, target): counts of n-grams over all documents and over the trusted ones.

    ``labels`` has the ids of trusted documents in its first column; an id that it repeats counts
    once, null ids never match.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    if labels is None:
        rows = rows.select("text", F.lit(False).alias("trusted"))
    else:
        good = labels.select(F.col(labels.columns[0]).alias("id")).where("id is not null").distinct()
        # always a merge join: the plan is the same at every size of the label table
        rows = rows.join(good.withColumn("trusted", F.lit(True)).hint("merge"), "id", "left").select("text", "trusted")

    def run(batches):
        raw, target = np.zeros(ratio.buckets, np.int64), np.zeros(ratio.buckets, np.int64)
        for part in _text.chunks(batches, "text", CHUNK_BYTES):
            data, offsets = _text.buffers(part.column("text"))
            bucket, row = gram_buckets(data, offsets, ratio.n, ratio.buckets)
            good = part.column("trusted").fill_null(False).to_numpy(zero_copy_only=False)
            raw += np.bincount(bucket, minlength=ratio.buckets)
            target += np.bincount(bucket[good[row]], minlength=ratio.buckets)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(target[used])], names=["bucket", "raw", "target"]
        )

    counted = rows.mapInArrow(run, "bucket int, raw long, target long")
    return counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, ratio: Ratio) -> np.ndarray:
    """log(target / raw) of each bucket with added counts; zeros if nothing is trusted."""
    table = np.zeros((ratio.buckets, 2))
    for bucket, raw, target in counts.select("bucket", "raw", "target").collect():  # at most ``buckets`` rows
        table[bucket] = raw, target
    if not table[:, 1].sum():
        return np.zeros(ratio.buckets)
    share = (table + ratio.smoothing) / (table.sum(axis=0) + ratio.smoothing * ratio.buckets)
    return np.log(share[:, 1] / share[:, 0])


def score_documents(
    docs: DataFrame, labels: DataFrame | None, ratio: Ratio = Ratio(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, llr and kept as added columns (in place of columns of these names in any case).

    ``labels``: ids of trusted documents in the first column, or None. Null and empty texts have
    no words and an llr of 0, and fail the base rules; texts shorter than an n-gram have an llr of
    0; without trusted documents every llr is 0 and only the base rules count. Rows that repeat
    are scored alike; an empty table gives an empty result.
    """
    values = docs.sparkSession.sparkContext.broadcast(log_ratios(corpus_counts(docs, labels, ratio, id_col, text_col), ratio))
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    whole = "text"
    while whole in {c.lower() for c in kept}:
        whole += "_"
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text_col).cast("string").alias(whole))

    def run(batches):
        for part in _text.chunks(batches, whole, CHUNK_BYTES):
            data, offsets = _text.buffers(part.column(whole))
            n = len(offsets) - 1
            f = base_figures(data, offsets)
            bucket, row = gram_buckets(data, offsets, ratio.n, ratio.buckets)
            grams = np.bincount(row, minlength=n)
            llr = np.bincount(row, weights=values.value[bucket], minlength=n) / np.maximum(grams, 1)
            failed = (f["n_words"] < MIN_WORDS) | (100 * f["n_repeat_words"] > MAX_REPEAT_PERCENT * f["n_words"])
            new = [pa.array(f[c]) for c in FIGURES] + [pa.array(failed), pa.array(llr), pa.array(~failed & (llr >= ratio.threshold))]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *new], names=[*part.schema.names[:-1], *ADDED])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{out}, {', '.join(f'{c} long' for c in FIGURES)}, base_failed boolean, llr double, kept boolean")


FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
ADDED = [*FIGURES, "base_failed", "llr", "kept"]
