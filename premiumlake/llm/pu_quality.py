"""Quality classifier learnt from trusted positives and unlabelled documents.

A linear score g(x) over text features minimises the non-negative unbiased risk

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)]),   l(z) = (1 - z)^2 / 4

of positive-unlabelled learning. With this loss the three expectations depend on the data only
through the first and second moments of the features, so one pass gathers them over every
document (a ``features`` x ``features`` matrix a task, summed by Spark) and the minimisation
itself needs no further pass. The text is read once; its features are written as a table. The class prior is estimated from all documents too:
it is the smallest ratio of the unlabelled to the positive tail mass over score thresholds, with
a margin for the sampling error. The prior then sets where the score crosses ``cut``.

Features describe the text alone: shares of byte classes and of pairs of neighbouring classes,
and rates of repetition. Ids, labels, language and source are never among them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premiumlake.llm import _text
from premiumlake.llm._store import stored
from premiumlake.llm.quality_rules import base_figures

#: Classes of bytes; any byte that is not listed is the last class, those above 0x7F the one before.
CLASSES = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\t\n\r\x0b\x0c",
    b".", b",", b"!?", b"'\"()", b";:-", b"#*$%&", b"|", b"<>", b"/\\@_=+~^`{}[]",
]
_HIGH, _OTHER = len(CLASSES), len(CLASSES) + 1
N_CLASSES = len(CLASSES) + 2
CLASS = np.full(256, _OTHER, np.uint8)
CLASS[0x80:] = _HIGH
for _k, _members in enumerate(CLASSES):
    CLASS[list(_members)] = _k
N_FEATURES = N_CLASSES + N_CLASSES**2 + 9
BINS = 2000


@dataclass(frozen=True)
class Fit:
    """``positives``: bound on the labelled rows that are used (those of the smallest hashes);
    ``cut``: the score where a document of average doubt lies, between the classes."""

    positives: int = 20_000
    first_prior: float = 0.8
    ridge: float = 1e-3
    steps: int = 200
    cut: float = 0.7
    margin: float = 2.0


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of features for every text of a chunk; an empty text has zeros but for the constant."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    kind = CLASS[data].astype(np.int64)
    single = np.bincount(row * N_CLASSES + kind, minlength=n * N_CLASSES).reshape(n, -1)
    pair = kind[:-1] * N_CLASSES + kind[1:]
    inside = row[:-1] == row[1:]
    double = np.bincount(row[:-1][inside] * N_CLASSES**2 + pair[inside], minlength=n * N_CLASSES**2).reshape(n, -1)
    f = base_figures(data, offsets)
    words = np.maximum(f["n_words"], 1)

    start, end, of = _text.word_spans(data, offsets)
    hashed = _text.span_hashes(data, start, end)
    again = np.zeros(n)
    if len(hashed):
        again = np.bincount(of[1:], weights=(hashed[1:] == hashed[:-1]) & (of[1:] == of[:-1]), minlength=n)
    order = np.lexsort((hashed, of))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (hashed[order][1:] != hashed[order][:-1]) | (of[order][1:] != of[order][:-1])
    distinct = np.bincount(of[order][fresh], minlength=n)
    rest = np.stack(
        [
            np.ones(n), f["n_repeat_words"] / words, np.minimum(f["n_dup_lines"] / words * 10, 1), again / words,
            np.sqrt(again / words), distinct / words, np.minimum(f["word_chars"] / words / 20, 2),
            np.log1p(f["n_words"]) / 10, f["n_words"] < 10,
        ],
        axis=1,
    )
    length = np.maximum(size, 1)[:, None]
    return np.concatenate([np.sqrt(single / length), np.sqrt(double / length), rest], axis=1).astype(np.float64)


def held_out(id_column: Column) -> Column:
    """Documents whose labels are never learnt from; null ids count as held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def _trusted(labels: DataFrame, fit: Fit, id_col: str, label_col: str) -> DataFrame:
    """Ids of at most ``fit.positives`` positives outside the held-out part, chosen by hash."""
    good = labels.where((F.col(label_col) == 1) & ~held_out(F.col(id_col))).select(F.col(id_col).alias("id")).distinct()
    return good.orderBy(F.xxhash64("id"), "id").limit(fit.positives)


def feature_table(docs: DataFrame, labels: DataFrame, fit: Fit, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(id, trusted, x) for every row, written once: x holds the features as 32-bit floats."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    trusted = _trusted(labels, fit, id_col, label_col).withColumn("trusted", F.lit(True))
    marked = rows.join(F.broadcast(trusted), "id", "left")  # at most fit.positives ids

    def run(batches):
        for part in _text.chunks(batches, "text"):
            x = features(*_text.buffers(part.column("text"))).astype(np.float32)
            ends = np.arange(len(x) + 1, dtype=np.int32) * (4 * N_FEATURES)
            packed = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x))])
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("trusted").fill_null(False), packed], names=["id", "trusted", "x"]
            )

    return stored(marked.mapInArrow(run, f"id {kind}, trusted boolean, x binary"), "features")


def _unpacked(batches):
    """(batch, features as doubles) for some thousand rows at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, 2048):
            part = batch.slice(k, 2048)
            raw, _ = _text.buffers(part.column("x"))
            yield part, np.frombuffer(raw.tobytes(), np.float32).reshape(part.num_rows, N_FEATURES).astype(np.float64)


def moments(table: DataFrame) -> dict[str, tuple[int, np.ndarray]]:
    """Of U (all rows) and P (trusted rows): their number and the matrix of sums of x x'."""

    def run(batches):
        number, total = np.zeros(2, np.int64), np.zeros((2, N_FEATURES, N_FEATURES))
        for part, x in _unpacked(batches):
            good = part.column("trusted").to_numpy(zero_copy_only=False)
            for k, some in enumerate((x, x[good])):
                number[k] += len(some)
                total[k] += some.T @ some
        for k in range(2):  # the upper triangle
            lines = range(N_FEATURES)
            sums = pa.array([total[k, line, line:] for line in lines], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * N_FEATURES, pa.int32()), pa.array(lines, pa.int32()), pa.array([number[k]] * N_FEATURES), sums],
                names=["part", "line", "number", "sums"],
            )

    parts = table.select("trusted", "x").mapInArrow(run, "part int, line int, number long, sums array<double>")
    flat = parts.select("part", "line", "number", F.posexplode("sums").alias("at", "value"))
    summed = flat.groupBy("part", "line", "at").agg(F.sum("number").alias("number"), F.sum("value").alias("value"))
    rows = summed.toArrow()  # features x (features + 1) rows
    out = {k: (0, np.zeros((N_FEATURES, N_FEATURES))) for k in "UP"}
    for k, name in enumerate("UP"):
        own = rows.filter(pc.equal(rows["part"], k))
        if own.num_rows:
            matrix, line = out[name][1], own["line"].to_numpy()
            at = line + own["at"].to_numpy()
            matrix[line, at] = matrix[at, line] = own["value"].to_numpy()
            out[name] = (int(own["number"][0].as_py()), matrix)
    return out


def minimise(m: dict[str, tuple[int, np.ndarray]], prior: float, fit: Fit) -> np.ndarray:
    """Weights that minimise the non-negative risk plus a ridge.

    With A_P, A_U the mean matrices and a_P, a_U the mean vectors (the constant's line), the risk
    is quadratic on either side of the clip: where the negative part E_U - prior E_P is positive
    it counts in full, where it would fall below zero it is left out of the value and its own
    gradient is followed backwards, as the non-negative estimator does.
    """
    one = N_CLASSES + N_CLASSES**2
    (n_u, s_u), (n_p, s_p) = m["U"], m["P"]
    if not n_p or not n_u:
        return np.zeros(N_FEATURES)
    a_u, a_p = s_u / n_u, s_p / n_p
    u, p = a_u[one], a_p[one]
    scale = np.sqrt(np.maximum(np.diag(a_u), 1e-12))
    ridge = np.diag((fit.ridge + 2 / n_p) * scale**2)
    # l(z) = (1 - 2z + z^2) / 4; the positives' share of both parts leaves only its linear term
    w = np.linalg.solve(a_u + ridge, 2 * prior * p - u)
    negative = lambda v: (1 + 2 * u @ v + v @ a_u @ v) / 4 - prior * (1 + 2 * p @ v + v @ a_p @ v) / 4
    step = 1.0 / np.linalg.eigvalsh((a_u + prior * a_p + ridge) / 2)[-1]
    best = (np.inf, w)
    for _ in range(fit.steps):
        positive_gradient = prior * (a_p @ w - p) / 2
        negative_gradient = (u + a_u @ w) / 2 - prior * (p + a_p @ w) / 2
        value = prior * (1 - 2 * p @ w + w @ a_p @ w) / 4 + max(0.0, negative(w)) + w @ ridge @ w / 4
        if value < best[0]:
            best = (value, w)
        if negative(w) >= 0:
            w = w - step * (positive_gradient + negative_gradient + ridge @ w / 2)
        else:
            w = w + step * negative_gradient
    return best[1]


def histograms(table: DataFrame, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of g over [-2, 2] in ``BINS`` bins for all rows and for the trusted ones."""

    def run(batches):
        total = np.zeros((2, BINS), np.int64)
        for part, x in _unpacked(batches):
            at = np.clip(((x @ w + 2) / 4 * BINS).astype(np.int64), 0, BINS - 1)
            good = part.column("trusted").to_numpy(zero_copy_only=False)
            total[0] += np.bincount(at, minlength=BINS)
            total[1] += np.bincount(at[good], minlength=BINS)
        used = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(total[0][used]), pa.array(total[1][used])], names=["bin", "u", "p"]
        )

    counted = table.select("trusted", "x").mapInArrow(run, "bin int, u long, p long")
    out = np.zeros((2, BINS))
    for at, u, p in counted.groupBy("bin").agg(F.sum("u"), F.sum("p")).collect():  # at most ``BINS`` rows
        out[:, at] = u, p
    return out[0], out[1]


def estimate_prior(u: np.ndarray, p: np.ndarray, margin: float) -> float:
    """The smallest upper bound of (share of U above t) / (share of P above t) over thresholds t."""
    if not u.sum() or not p.sum():
        return 1.0
    above_u, above_p = (np.cumsum(x[::-1])[::-1] / x.sum() for x in (u, p))
    error = margin * (np.sqrt(1 / (4 * u.sum())) + np.sqrt(1 / (4 * p.sum())))
    ok = above_p > max(0.2, error)
    return float(min(1.0, np.min((above_u[ok] + error) / above_p[ok])))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    fit: Fit = Fit(),
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """(id_col, held_out, score double in 0 to 1, predicted int) for every row of ``docs``.

    Null and empty texts have the features of an empty text and are scored like the rest; null
    ids are held out and never trusted; rows that repeat are scored alike; an empty table gives an
    empty result, and without trusted documents every score is ``fit.cut``.
    """
    table = feature_table(docs, labels, fit, id_col, text_col, label_col)
    m = moments(table)
    prior = estimate_prior(*histograms(table, minimise(m, fit.first_prior, fit)), fit.margin)
    w = minimise(m, prior, fit)
    level, steep = _scale(*histograms(table, w), prior)
    shift = np.log(fit.cut / (1 - fit.cut))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for part, x in _unpacked(batches):
            score = 1 / (1 + np.exp(-np.clip((x @ w - level) * steep + shift, -30, 30)))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(score)], names=["id", "score"])

    scored = table.select("id", "x").mapInArrow(run, f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= fit.cut).cast("int").alias("predicted"),
    )


def _scale(u: np.ndarray, p: np.ndarray, prior: float) -> tuple[float, float]:
    """(g at the cut, steepness): the cut lies midway between the median of the share of all rows
    that the prior leaves to the negatives and the median of the positives."""
    if not p.sum():
        return 0.0, 0.0
    middles = -2 + 4 * (np.arange(BINS) + 0.5) / BINS
    share = np.cumsum(u) / u.sum()
    low = middles[min(BINS - 1, int(np.searchsorted(share, (1 - prior) / 2)))]
    high = middles[np.searchsorted(np.cumsum(p) / p.sum(), 0.5)]
    return float((low + high) / 2), float(6 / max(high - low, 1e-3))
