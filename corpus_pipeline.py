"""From raw documents to token ids: quality rules, near duplicates, repeated passages, benchmark
leaks, byte-level BPE. Every stage reads all that the one before kept, written as Parquet.

Stages keep all columns of their input, whatever their names, and put up with null or repeated
ids: a row is told by its id and its text. Null texts are empty, and empty documents go with the
first stage. ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from premiumlake.llm import byte_bpe, decontaminate, jaccard_join, quality_rules, suffix_dedup
from premiumlake.llm._store import drop_written, release_shuffles, stored, written
from premiumlake.llm.queries import rank_file, table, trusted_labels


_scratch = [0, 0]


def _stage(function):
    """A stage that removes what the stage before left in the shared folder. It is handed (doc_id,
    text, row), ``row`` being all columns of its input."""

    @wraps(function)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_written(*_scratch)
        release_shuffles(spark)
        _scratch[0] = written()
        rows = docs.select("doc_id", "text", F.struct("*").alias("row"))  # no name of the input can clash
        try:
            return function(spark, rows, sf_dir)
        finally:
            _scratch[1] = written()

    return call


def _digest() -> Column:
    return F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))


def _row_key(digest: Column) -> Column:
    """A non-null key of the rows with one id and one text."""
    return F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), digest)


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    scored = quality_rules.score_documents(docs, trusted_labels(spark, sf_dir))
    return scored.where("kept").select("row.*")


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: the one with the smallest id (null ids last), then the least digest;
    of rows with one id and text, the one whose columns have the least digest."""
    found = jaccard_join.near_duplicates(docs.select("doc_id", "text"))
    first = found.groupBy("class_no").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")).alias("first"))
    keys = first.select("first.*").select(_row_key(F.col("digest")).alias("key"))
    marked = docs.withColumn("key", _row_key(_digest())).join(keys, "key")
    chosen = marked.groupBy("key").agg(F.min_by("row", F.md5(F.to_json("row").cast("binary"))).alias("row"))
    return chosen.select("row.*")


@_stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what documents with smaller ids hold too; a document of which nothing is left
    goes."""
    texts = suffix_dedup.kept_texts(docs.select("doc_id", "text"), whole_characters=True)
    texts = texts.select("key", "lowest", "n_bytes", F.decode("kept", "UTF-8").alias("left"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # the text itself stays behind, the rest of the row goes with what is left of it
    rest = F.col("row").dropFields("text")
    rows = docs.select("doc_id", F.xxhash64(F.md5(text.cast("binary"))).alias("key"), rest.alias("rest")).join(texts, "key")
    rank = F.coalesce(F.col("doc_id").try_cast("long"), F.lit(suffix_dedup.LAST))
    copy = (rank > F.col("lowest")) & (F.col("n_bytes") >= suffix_dedup.Repeats().length)
    rows = rows.where(~copy & (F.length("left") > 0))
    fields = docs.schema["row"].dataType.fields
    size = {"n_chars": lambda kind: F.length("left").cast(kind), "text": lambda kind: F.col("left").cast(kind)}
    return rows.select(*[size[f.name](f.dataType).alias(f.name) if f.name in size else F.col("rest").getField(f.name).alias(f.name) for f in fields])


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = decontaminate.question_and_answer(table(spark, sf_dir, "benchmark"))
    marked = docs.withColumn("key", _row_key(_digest()))
    leaks = decontaminate.find_leaks(marked.select("key", "text"), items, id_col="key").select("key").distinct()
    return marked.join(leaks, "key", "left_anti").select("row.*")


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): the ids of every document, and the digest of the
    bytes that they decode to."""
    path, pattern = rank_file()
    both = byte_bpe.round_trip(docs, path, pattern)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", tokens),
]

#: No SQL can express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"stage-{number}")
    return docs
