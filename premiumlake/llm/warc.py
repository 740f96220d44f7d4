"""WARC archives of captures, written and read back by Spark, with a merged capture index.

Writing. Each capture becomes a record: the payload in full for the one that is stored
(``response``), headers only for every other record of the same payload (``revisit``). Records
are text lines that end in two CRLF, so Spark's own text writer makes the archives, gzipped, in
any folder that Spark can write to; an archive holds about ``archive_bytes`` of payload.

Reading. Whole archives are parsed record by record by their Content-Length. The captures of an
archive, sorted by URL key and time, are a run. Index merge: ranges of the key (URL key, time,
record) are dealt out by sampled bounds, so that even the history of one URL is split; the task of
a range merges its slices of all the runs with a loser tree, and the ranges in order are the
global order.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from premiumlake.llm._store import folder, stored

ARCHIVE_BYTES = 16 << 20
ROWS_PER_RANGE = 100_000
_END = b"\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """Reversed host labels, then path and query, lower-cased: the order of capture indexes."""
    if not url:
        return ""
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url).split("#", 1)[0].lower()
    host, slash, path = re.match(r"([^/?]*)(/?)(.*)", rest, re.S).groups()
    host = re.sub(r"^www\d*\.", "", host.rsplit("@", 1)[-1]).split(":", 1)[0]
    return ",".join(reversed(host.split("."))) + ")" + (slash + path if slash else "/" + path)


def base32_of(hexadecimal: str) -> Column:
    """Upper-case base32 of a column of 40 hexadecimal digits, by built-in functions: every five
    digits are four characters."""
    return F.expr(
        "array_join(transform(sequence(0, 31), k -> substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
        f"(shiftright(cast(conv(substr({hexadecimal}, (k div 4) * 5 + 1, 5), 16, 10) AS int), cast(15 - 5 * (k % 4) AS int)) & 31) + 1, 1)), '')"
    )


def _header_value(c: Column) -> Column:
    """Header values hold no line breaks."""
    return F.regexp_replace(c, r"[\r\n]+", "%0A")


def write_archives(
    captures: DataFrame, path: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> None:
    """Write (id, uri, date, payload) as gzipped archives below ``path``.

    Of records with equal payloads of at least ``least_bytes`` UTF-8 bytes, that with the largest
    id is the response and the others refer to it; shorter ones are all responses. A null payload
    is empty, a null uri is an empty one, a null date is left out; a null id is written as an empty
    one and is never referred to. Rows with equal ids are a record each, those with the largest id
    of their payload all responses.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = captures.select("id", empty("uri").alias("uri"), F.col("date").cast("timestamp").alias("date"), empty("payload").alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("sha1", F.sha1(F.col("payload").cast("binary")))
    # the newest holder of each payload: one row a digest, combined before the shuffle
    holders = rows.groupBy("sha1", "bytes").agg(F.max("id").alias("newest")).where(F.col("bytes") >= least_bytes)
    marked = rows.join(holders.hint("merge"), ["sha1", "bytes"], "left")
    holder = F.when(F.col("newest").isNotNull() & ~F.col("id").eqNullSafe(F.col("newest")), F.col("newest"))
    marked = marked.select("id", "uri", "date", "payload", "bytes", base32_of("sha1").alias("digest"), holder.alias("holder"))
    record_id = F.concat(F.lit("<urn:capture:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("holder").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    lines = [
        F.lit("WARC/1.0"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), record_id),
        F.concat(F.lit("WARC-Target-URI: "), _header_value(F.col("uri"))),
        F.concat(F.lit("WARC-Date: "), F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:capture:"), F.col("holder").cast("string"), F.lit(">"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    text = F.concat(F.array_join(F.array(*lines), "\r\n"), F.lit("\r\n\r\n"), block)
    size = rows.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    mean = (size[1] or 0) / max(size[0], 1) + 500
    writer = marked.select(text.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
    writer.option("maxRecordsPerFile", max(1, int(archive_bytes / mean))).text(path)


def parse_records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of every record; a malformed archive is an error."""
    at = 0
    while at < len(data):
        split = data.index(_END, at)
        version, *lines = data[at:split].decode("utf-8").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
        start = split + len(_END)
        end = start + int(headers["content-length"])
        if data[end : end + len(_END)] != _END:
            raise ValueError(f"the record at byte {at} has a wrong length")
        yield at, end - at, headers, data[start:end]
        at = end + len(_END)


_CAPTURE = [
    ("run", pa.int64()), ("offset", pa.int64()), ("url_key", pa.string()), ("date", pa.string()), ("record", pa.string()),
    ("uri", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("held", pa.string()),
]
_CAPTURE_SCHEMA = ", ".join(f"`{k}` {'long' if t == pa.int64() else 'string'}" for k, t in _CAPTURE)


def _urn(value: str | None) -> str | None:
    return value[len("<urn:capture:") : -1] if value else None


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record of the archives below ``path``: one run an archive, sorted by URL key,
    date and record. ``payload_bytes`` and ``payload_digest`` are the full payload's; ``held`` is
    the payload of a response, null for a revisit. A response whose payload is not what its headers
    say is an error."""
    import gzip

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    files = files.withColumn("run", F.xxhash64("path"))

    def run(batches):
        for batch in batches:
            for number, content in zip(batch.column("run").to_pylist(), batch.column("content")):
                rows = []
                for offset, _, h, block in parse_records(gzip.decompress(content.as_py())):
                    http, _, payload = block.partition(_END)
                    said = int(re.search(rb"(?m)^Content-Length: (\d+)", http)[1])
                    digest = h["warc-payload-digest"].removeprefix("sha1:")
                    kind = h["warc-type"]
                    if kind == "response" and (len(payload) != said or base32_sha1(payload) != digest):
                        raise ValueError(f"record {h['warc-record-id']} holds another payload")
                    uri = h.get("warc-target-uri", "")
                    rows.append((
                        number, offset, url_key(uri), h.get("warc-date"), _urn(h["warc-record-id"]), uri, kind,
                        _urn(h.get("warc-refers-to")), said, digest, payload.decode("utf-8") if kind == "response" else None,
                    ))
                rows.sort(key=run_order)
                for k in range(0, len(rows), 2000):
                    columns = list(zip(*rows[k : k + 2000]))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _CAPTURE)], names=[n for n, _ in _CAPTURE])

    return files.select("run", "content").mapInArrow(run, _CAPTURE_SCHEMA)


def run_order(row: Sequence) -> tuple:
    """URL key, date (none first), record as a number where it is one, archive, offset."""
    _, offset, key, date, record = row[:5]
    number = re.fullmatch(r"-?\d{1,18}", record or "")
    return key, date or "", int(record) if number else -(1 << 62), record or "", row[0], offset


class LoserTree:
    """Merges sorted sequences: each inner node holds the loser of its match, the winner moves up,
    so that the next item costs one comparison a level."""

    def __init__(self, runs: Sequence[Sequence], key):
        self.runs, self.key = [r for r in runs if len(r)], key
        self.k = len(self.runs)
        self.at = [0] * self.k
        self.head = [key(r[0]) for r in self.runs]
        self.loser = [-1] * max(self.k, 1)
        for leaf in range(self.k):
            self._play(leaf, building=True)

    def _less(self, a: int, b: int) -> bool:
        """Whether run a's head goes before run b's; ended runs go last, ties by run."""
        if self.head[a] is None or self.head[b] is None:
            return self.head[b] is None and (self.head[a] is not None or a < b)
        return (self.head[a], a) < (self.head[b], b)

    def _play(self, leaf: int, building: bool = False) -> None:
        node, winner = (leaf + self.k) >> 1, leaf
        while node:
            other = self.loser[node]
            if other < 0 and building:
                self.loser[node] = winner
                return
            if self._less(other, winner):
                self.loser[node], winner = winner, other
            node >>= 1
        self.loser[0] = winner

    def __iter__(self):
        while self.k:
            winner = self.loser[0]
            if self.head[winner] is None:
                return
            yield self.runs[winner][self.at[winner]]
            self.at[winner] += 1
            ended = self.at[winner] == len(self.runs[winner])
            self.head[winner] = None if ended else self.key(self.runs[winner][self.at[winner]])
            self._play(winner)


_INDEX = [(n, t) for n, t in _CAPTURE if n != "held"]
_INDEX_SCHEMA = ", ".join(f"`{k}` {'long' if t == pa.int64() else 'string'}" for k, t in _INDEX)


def merge_runs(runs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The captures of all runs in global order: ``part`` numbers the ranges of the key, ``place``
    the captures of a range, ``capture`` those of a URL key within the range.

    ``runs``: index columns of ``read_runs``, each archive's rows sorted. Bounds are sampled over
    (url_key, date, record, archive, offset), so a range has about ``rows_per_range`` rows whatever
    the history of one URL; slices are sorted again only if a shuffle did not keep their order.
    """
    table = stored(runs.select(*[n for n, _ in _INDEX]), "runs")
    ranges = max(1, -(-table.count() // rows_per_range))
    number = F.coalesce(F.when(F.col("record").rlike(r"^-?\d{1,18}$"), F.col("record")).cast("long"), F.lit(-(1 << 62)))
    dealt = table.repartitionByRange(ranges, "url_key", F.coalesce("date", F.lit("")), number, F.coalesce("record", F.lit("")), "run", "offset")

    def run(batches):
        slices: dict[int, list] = {}
        part = None
        for batch in batches:
            if part is None and batch.num_rows:
                part = batch.column("part")[0].as_py()
            for row in zip(*[batch.column(n).to_pylist() for n, _ in _INDEX]):
                slices.setdefault(row[0], []).append(row)
        for rows in slices.values():
            keys = [run_order(r) for r in rows]
            if any(b < a for a, b in zip(keys, keys[1:])):
                rows.sort(key=run_order)
        out, place, capture, last = [], 0, 0, None
        for row in LoserTree([slices[k] for k in sorted(slices)], run_order):
            capture = capture + 1 if row[2] == last else 0
            last = row[2]
            out.append((*row, part, place, capture))
            place += 1
            if len(out) == 5000:
                yield _index_batch(out)
                out = []
        if out:
            yield _index_batch(out)

    return dealt.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(run, _INDEX_SCHEMA + ", part long, place long, capture long")


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    named = [*_INDEX, ("part", pa.int64()), ("place", pa.int64()), ("capture", pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), named)], names=[n for n, _ in named])


def capture_histories(index: DataFrame) -> DataFrame:
    """``merge_runs`` with ``capture`` counted over the whole history of a URL key: what earlier
    ranges hold of the key is added, one count per range and key that spans ranges."""
    index = stored(index, "index")
    sizes = index.groupBy("url_key", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("url_key").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    earlier = sizes.select("url_key", "part", before.alias("before")).where("before > 0")
    return (
        index.join(earlier, ["url_key", "part"], "left")
        .withColumn("capture", F.col("capture") + F.coalesce("before", F.lit(0)))
        .drop("before")
    )


def archive_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: Column | None = None, least_bytes: int = 0
) -> DataFrame:
    """Write the pages as archives, read them back and merge their index: one row a page.

    ``date``: the capture's time (none: the pages carry none, and the epoch plus the id in seconds
    stands for it). The archives lie in the shared folder until the session ends.
    """
    when = F.timestamp_seconds(F.coalesce(F.col(id_col).cast("long"), F.lit(0))) if date is None else date
    captures = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("uri"), when.alias("date"), F.col(html_col).alias("payload"))
    path = folder(pages.sparkSession, "archives")
    write_archives(captures, path, least_bytes)
    index = capture_histories(merge_runs(read_runs(pages.sparkSession, path)))
    kind = pages.schema[id_col].dataType.simpleString()
    own = lambda c: F.when(F.col(c) != "", F.col(c)).cast(kind)
    return index.select(
        own("record").alias(id_col), "payload_bytes", "payload_digest", "record_type", own("refers_to").alias("refers_to"),
        "url_key", "date", "capture", "part", "place",
    )
