"""Registered queries of the numbered operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premiumlake.llm import byte_bpe, decontaminate, jaccard_join, license_scan, pu_quality, quality_rules, secret_scan, sharding, suffix_dedup, token_alignment, url_filter, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trusted_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of documents whose labels call them good."""
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def rank_file() -> tuple[str, str]:
    """(path, pattern) of the public vocabulary that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@register("op1_byte_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = rank_file()
    both = byte_bpe.round_trip(table(spark, sf_dir, "documents"), path, pattern)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register("op2_label_propagation")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register("op3_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = decontaminate.question_and_answer(table(spark, sf_dir, "benchmark"))
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), items).withColumnRenamed("item", "item_id")


_PAGES_SQL = """
WITH sized AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex, url FROM pages),
newest AS (SELECT *, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS top FROM sized)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * (k // 4), 5))::INTEGER >> (15 - 5 * (k % 4))) & 31)::INTEGER, 1)
    FOR k IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM newest
"""


@register("op4_warc_index", _PAGES_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive_pages(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op5_license_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@register("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_rules.score_documents(table(spark, sf_dir, "documents"), trusted_labels(spark, sf_dir))
    return scored.select("doc_id", *quality_rules.ADDED)


@register("op7_suffix_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    texts = suffix_dedup.with_counts(suffix_dedup.kept_texts(docs))
    texts = texts.select("key", "lowest", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return suffix_dedup.per_document(docs, suffix_dedup.stored(texts, "kept"), "kept_sha256", nothing)


@register("op8_jaccard_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).drop("digest", "class_no")


@register("op9_pu_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The rules of the query.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

_URL_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0
    THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '/.*$', 0, 's') AS path FROM cut
), marked AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM marked
"""


@register("op10_url_filter", _URL_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


@register("op11_token_efficiency")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = rank_file()
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"), path, pattern)
    base = F.filter("spans", lambda x: x["kind"] != "random")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@register("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return white.select("vec_id", "component", "n", F.col("deviation").cast("long"), "whitened", "explained", "identity_error")


@register("op13_cross_tokenizer")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_alignment.align_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )
