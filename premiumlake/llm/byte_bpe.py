"""Byte-level BPE on a sentencepiece model that is serialised directly from a rank file.

Each of the 256 bytes is mapped to a printable code point, every vocabulary entry becomes a piece
of such characters scored by its negative rank, and the model normalises nothing. A pre-token is
then encoded by the model's merges (best score first, leftmost first), which are the merges by
lowest rank; decoding maps ids back to pieces and characters back to bytes. A pre-token that is
itself an entry is that entry, as in the rank-based library.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premiumlake.llm import _text

#: Distinct pre-tokens whose ids a task remembers; beyond it the memory starts anew.
REMEMBERED = 200_000


def byte_characters() -> list[str]:
    """A character for each byte: itself where it is printable Latin-1, else from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Entries of a rank file: base64 bytes and a rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """A protobuf field: length-delimited bytes, a varint, or a 32-bit float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece ModelProto. Piece 0 is the unknown piece, piece r + 1 the entry of rank r.

    Fixed values of the public format: pieces are field 1 (piece 1, score 2, type 3: 2 unknown,
    5 unused), the trainer 2 (model_type 3: 2 BPE, vocab_size 4, byte_fallback 35), the normaliser
    3 (name 1, add_dummy_prefix 3, remove_extra_whitespaces 4, escape_whitespaces 5).
    """
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be gapless from 0")
    characters = byte_characters()
    pieces = [_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))]
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        piece = "".join(characters[b] for b in token).encode()
        pieces.append(_field(1, _field(1, piece) + _field(2, float(-rank))))
    trainer = _field(3, 2) + _field(4, len(pieces))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class Encoder:
    """Ids of pre-tokens by the model."""

    def __init__(self, model: bytes, ranks: dict[bytes, int]):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.map = dict(enumerate(byte_characters()))
        self.ranks = ranks
        self.memory: dict[str, tuple[int, ...]] = {}

    def pretoken(self, text: str) -> tuple[int, ...]:
        raw = text.encode("utf-8", "replace")
        if (rank := self.ranks.get(raw)) is not None:
            return (rank,)
        ids = self.processor.encode(raw.decode("latin-1").translate(self.map))
        return tuple(x - 1 for x in ids)

    def text(self, pretokens: list[str]) -> list[tuple[int, ...]]:
        memory = self.memory
        if len(memory) > REMEMBERED:
            memory.clear()
        for new in {*pretokens}.difference(memory):
            memory[new] = self.pretoken(new)
        return [memory[x] for x in pretokens]


def _white_space(pattern: str) -> str:
    """The pattern with its white space classes spelt as the Unicode property, which is what they
    mean in the rank-based library (the regex module's own also match U+001C to U+001F)."""
    return pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


def _encoded(batches: Iterable[pa.RecordBatch], encoder: Encoder, pattern: str) -> Iterator[pa.RecordBatch]:
    """(id, ids) of batches of (id, text)."""
    import regex

    found = regex.compile(_white_space(pattern)).findall
    for part in _text.chunks(batches, "text", 1 << 19):
        sizes, flat = [], []
        for text in part.column("text").to_pylist():
            ids = np.fromiter(chain.from_iterable(encoder.text(found(text))), np.int32) if text else np.zeros(0, np.int32)
            sizes.append(len(ids))
            flat.append(ids)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        values = np.concatenate(flat)
        yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["id", "ids"])


def _piece_bytes(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(starts, bytes): the bytes of the piece of each id, its characters mapped back."""
    characters = byte_characters()
    back = {c: b for b, c in enumerate(characters)}
    pieces = ["".join(characters[b] for b in token) for token, _ in sorted(ranks.items(), key=lambda x: x[1])]
    size = np.array([len(p) for p in pieces], np.int64)
    return np.concatenate([[0], np.cumsum(size)]), np.frombuffer(bytes(back[c] for p in pieces for c in p), np.uint8)


def _decoded(batches: Iterable[pa.RecordBatch], starts: np.ndarray, table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(id, ids, decoded) of batches of (id, ids)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column("ids")
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        low = 0
        while low < len(sizes):  # rows of about half a million ids at a time
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + (1 << 19), "right")))
            part = lists.slice(low, high - low)
            ids = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if len(ids) and (ids.min() < 0 or ids.max() >= len(starts) - 1):
                raise ValueError("an id has no piece")
            length = starts[ids + 1] - starts[ids]
            to = np.concatenate([[0], np.cumsum(length)])
            at = np.arange(to[-1]) + np.repeat(starts[ids] - to[:-1], length)
            rows = np.concatenate([[0], np.cumsum(sizes[low:high])])
            decoded = pa.Array.from_buffers(pa.binary(), high - low, [None, pa.py_buffer(to[rows].astype(np.int32)), pa.py_buffer(table[at])])
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(low, high - low), part, decoded], names=["id", "ids", "decoded"])
            low = high


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>) per row: each match of ``pattern`` in the whole text encoded
    separately, without special tokens; null and empty texts have no ids. Rows that repeat are
    encoded each; other columns are not read; an empty table gives an empty result."""
    ranks = read_ranks(rank_path)
    shipped = docs.sparkSession.sparkContext.broadcast((serialise_model(ranks), ranks))

    def run(batches):
        yield from _encoded(batches, Encoder(*shipped.value), pattern)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").select(F.col("id").alias(id_col), "ids")


def decode(coded: DataFrame, rank_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, ids, decoded binary) per row by the inverse mapping: id to piece, piece's
    characters to bytes. No or null ids decode to no bytes; an id without a piece is an error."""
    shipped = coded.sparkSession.sparkContext.broadcast(_piece_bytes(read_ranks(rank_path)))

    def run(batches):
        yield from _decoded(batches, *shipped.value)

    kind = coded.schema[id_col].dataType.simpleString()
    rows = coded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    out = rows.mapInArrow(run, f"id {kind}, ids array<int>, decoded binary")
    return out.select(F.col("id").alias(id_col), "ids", "decoded")


def round_trip(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids, decoded): ``decode`` of ``encode`` in one pass, so that a task needs one Python
    worker and the ids cross to it once. Nulls, repeats and empty tables as there."""
    ranks = read_ranks(rank_path)
    shipped = docs.sparkSession.sparkContext.broadcast((serialise_model(ranks), ranks, *_piece_bytes(ranks)))

    def run(batches):
        model, ranks, starts, table = shipped.value
        yield from _decoded(_encoded(batches, Encoder(model, ranks), pattern), starts, table)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, f"id {kind}, ids array<int>, decoded binary")
    return out.select(F.col("id").alias(id_col), "ids", "decoded")
