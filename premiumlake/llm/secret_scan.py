"""Secret scan: patterns of known kinds, and random strings told by their token efficiency.

A byte-pair vocabulary is trained on running text and code: it spends about four characters a
token on them, but less than two on random strings, whose pairs were never merged. Every long run
of key characters in a text is a candidate; its characters a token under a tiktoken vocabulary
decide. Digests of known sizes or with a digest's label, and identifiers (numbers, words, words and
numbers with separators, UUIDs, time stamps, bank account numbers), are not candidates: they look
random, but aren't secrets.

Kinds, in the order of spans that start together:

``assign``   a password, token, secret or API key with a value of 8 or more characters
``access``   an access key id of 16 or more characters
``hex``      32 or more hexadecimal digits in lower case
``random``   a candidate below ``max_ratio`` that no span of the other kinds holds
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premiumlake.llm import _text
from premiumlake.llm.byte_bpe import read_ranks

KINDS = ("assign", "access", "hex", "random")

# Patterns of the base kinds and the least lengths of what they find.
ASSIGN = rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_VALUE = 8
ACCESS_MARK = b"AKIA"
ACCESS_LENGTH = 16
HEX_LENGTH = 32

# Hexadecimal digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_SIZES = (32, 40, 56, 64, 96, 128)

#: Longest stretch of a candidate that is encoded at once; longer ones go piece by piece.
PIECE = 1024

SPANS = "array<struct<kind: string, start: long, end: long, text: string, ratio: double>>"


@dataclass(frozen=True)
class TokenTest:
    """A candidate is a run of at least ``min_chars`` letters, digits, ``+``, ``/``, ``_`` and
    ``-``; it is random if it has less than ``max_ratio`` characters a token."""

    min_chars: int = 16
    max_ratio: float = 2.0


def _allowed(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(characters, np.uint8)] = True
    return table


_DIGITS = bytes(range(0x30, 0x3A))
_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))
_IN_HEX = _allowed(_DIGITS + b"abcdef")
_IN_ACCESS = _allowed(_UPPER + _DIGITS)
_IN_KEY = _allowed(_DIGITS + _UPPER + _LOWER + b"+/_-")

_LABEL = re.compile(rb"(?i)(?:^|[^a-z0-9])(?:md5|sha-?(?:1|224|256|384|512))[\"']?[ ]?[:=-][ ]?[\"']?$")
_LABELLED = re.compile(rb"(?i)(?:md5|sha-?(?:1|224|256|384|512))[-_:]")
_UUID = re.compile(rb"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}")
_STAMP = re.compile(rb"[0-9]{4}-?[0-9]{2}-?[0-9]{2}[T_-][0-9]{2}[-_]?[0-9]{2}(?:[-_]?[0-9]{2})?[A-Z]{0,4}")
_WORD = re.compile(rb"[A-Z]?[a-z]+|[A-Z]+")
_ACCOUNT = re.compile(rb"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")


def _is_digest(run: bytes, before: bytes) -> bool:
    """Hexadecimal digits of a digest's size in one case, or a value with a digest's label."""
    if len(run) in DIGEST_SIZES and re.fullmatch(rb"[0-9a-f]+|[0-9A-F]+", run):
        return True
    return bool(_LABEL.search(before) or _LABELLED.match(run))


def _is_account(run: bytes) -> bool:
    """An international bank account number: its check digits hold (ISO 13616, modulo 97)."""
    if not _ACCOUNT.fullmatch(run):
        return False
    moved = run[4:] + run[:4]
    return int("".join(str(int(chr(c), 36)) for c in moved)) % 97 == 1


def _is_identifier(run: bytes) -> bool:
    """Numbers and words, alone or with separators (a word: letters of one case, or capitalised),
    UUIDs, time stamps and bank account numbers."""
    if _UUID.fullmatch(run) or _STAMP.fullmatch(run) or _is_account(run):
        return True
    return all(not part or part.isdigit() or _WORD.fullmatch(part) for part in re.split(rb"[-+/_]", run))


def _encoding(ranks: dict[bytes, int], pattern: str):
    import tiktoken

    return tiktoken.Encoding("scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def characters_per_token(run: str, encoding) -> float:
    """Characters a token of a non-empty ASCII string."""
    return len(run) / sum(len(encoding.encode_ordinary(run[at : at + PIECE])) for at in range(0, len(run), PIECE))


def _base_spans(data: np.ndarray, offsets: np.ndarray, assign: re.Pattern) -> list[tuple[int, int, int, int, None]]:
    """(row, start, end, kind number, no ratio) in bytes of the chunk. Runs stand for the patterns
    ``AKIA[A-Z0-9]+`` and ``[0-9a-f]+``: a leftmost match takes the rest of its run."""
    raw, found = data.tobytes(), []
    for row in range(len(offsets) - 1):
        for match in assign.finditer(raw, offsets[row], offsets[row + 1]):
            if match.end(2) - match.start(2) >= ASSIGN_VALUE:
                found.append((row, match.start(), match.end(), 0, None))
    start, end, row = _text.word_spans(data, offsets, ~_IN_ACCESS)
    for k in np.flatnonzero(end - start >= ACCESS_LENGTH):
        at = raw.find(ACCESS_MARK, start[k], end[k])
        if at >= 0 and end[k] - at >= ACCESS_LENGTH:
            found.append((int(row[k]), at, int(end[k]), 1, None))
    start, end, row = _text.word_spans(data, offsets, ~_IN_HEX)
    for k in np.flatnonzero(end - start >= HEX_LENGTH):
        found.append((int(row[k]), int(start[k]), int(end[k]), 2, None))
    return found


def _random_spans(data: np.ndarray, offsets: np.ndarray, held: list, encoding, rule: TokenTest) -> list[tuple[int, int, int, int, float]]:
    """The same for candidates with few characters a token that no span of ``held`` holds."""
    start, end, row = _text.word_spans(data, offsets, ~_IN_KEY)
    long = end - start >= rule.min_chars
    start, end, row = start[long], end[long], row[long]
    # a span holds a candidate if one that starts no later ends no earlier
    held = sorted((first, last) for _, first, last, _, _ in held)
    starts = np.array([first for first, _ in held], np.int64)
    reach = np.maximum.accumulate(np.array([last for _, last in held], np.int64))
    raw, found = data.tobytes(), []
    for first, last, r in zip(start.tolist(), end.tolist(), row.tolist()):
        run = raw[first:last]
        first += len(run) - len(run.lstrip(b"+/_-"))
        run = run.strip(b"+/_-")
        last = first + len(run)
        known = int(np.searchsorted(starts, first, "right"))
        if len(run) < rule.min_chars or (known and reach[known - 1] >= last):
            continue
        if _is_digest(run, raw[max(int(offsets[r]), first - 12) : first]) or _is_identifier(run):
            continue
        ratio = characters_per_token(run.decode(), encoding)
        if ratio < rule.max_ratio:
            found.append((r, first, last, 3, ratio))
    return found


def scan_secrets(
    docs: DataFrame, rank_path: str, pattern: str, rule: TokenTest = TokenTest(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_col, spans array<struct<kind, start, end, text, ratio>>) per row: what of the whole text
    is a secret, by start, then kind. Offsets count code points, ends are exclusive; ``ratio`` is
    null for the base kinds.

    ``rank_path``, ``pattern``: a tiktoken vocabulary. Null and empty texts have no spans; rows that
    repeat are scanned each, whatever their ids; other columns are not read; an empty table gives
    an empty result. Memory is bounded by the longest text.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_path))  # one vocabulary
    min_chars, max_ratio = rule.min_chars, rule.max_ratio

    def run(batches):
        encoding, assign = _encoding(shipped.value, pattern), re.compile(ASSIGN, re.IGNORECASE)
        test = TokenTest(min_chars, max_ratio)
        for part in _text.chunks(batches, "text"):
            data, offsets = _text.buffers(part.column("text"))
            spans = _base_spans(data, offsets, assign)
            spans += _random_spans(data, offsets, spans, encoding, test)
            spans.sort(key=lambda x: (x[0], x[1], x[3]))
            points = np.zeros(len(data) + 1, np.int64)  # code points before each byte
            np.cumsum((data & 0xC0) != 0x80, out=points[1:])
            raw = data.tobytes()
            rows = np.array([x[0] for x in spans], np.int64)
            ends = np.searchsorted(rows, np.arange(part.num_rows + 1)).astype(np.int32)
            first, last = (np.array([x[k] for x in spans], np.int64) for k in (1, 2))
            before = points[offsets[rows]] if len(rows) else rows
            values = pa.StructArray.from_arrays(
                [
                    pa.array([KINDS[x[3]] for x in spans], pa.string()),
                    pa.array(points[first] - before),
                    pa.array(points[last] - before),
                    pa.array([raw[x[1] : x[2]].decode() for x in spans], pa.string()),
                    pa.array([x[4] for x in spans], pa.float64()),
                ],
                names=["kind", "start", "end", "text", "ratio"],
            )
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(pa.array(ends), values)], names=["id", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, spans {SPANS}").select(F.col("id").alias(id_col), "spans")
