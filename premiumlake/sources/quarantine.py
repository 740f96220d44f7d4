"""CSV loads with a quarantine: every record of a declared source is accepted, with its declared
types, or kept apart with the reasons; none is lost or turned into NULL without a word.

One pass parses the files, judges each record and writes it to the load's table, which is
partitioned by the verdict, so that accepted rows are read without the others. Reasons:

- ``fields``: the record has more or fewer fields than the source declares (a quote that never closes
  takes in the rest of its file, and the whole of it is one such record);
- ``bad <column>``: text that the column's type can't hold;
- ``missing <column>``: a required column is empty.

Records with quoted line breaks are read whole, for which a file is one task: feeds come as many
files. ``lines=True`` splits files that have no such records.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premiumlake.functions.exact import MONEY_IN
from premiumlake.operators.ingest import parse_amount
from premiumlake.sources import versions
from premiumlake.sources.catalog import SOURCES, Source, csv_options

CORRUPT, VERDICT, REASONS, FILE, RECORD = "_corrupt_record", "_rejected", "_reasons", "_source_file", "_record"
_OWN = (VERDICT, REASONS, FILE, RECORD)


@dataclass(frozen=True)
class Load:
    """The outcome of a load: ``accepted`` (typed rows), ``rejected`` (record, reasons, source file) and
    the number of records by verdict and reasons."""

    table: str
    records: DataFrame

    @property
    def accepted(self) -> DataFrame:
        return self.records.where(~F.col(VERDICT)).drop(*_OWN)

    @property
    def rejected(self) -> DataFrame:
        return self.records.where(F.col(VERDICT)).select(F.col(RECORD).alias("record"), F.col(REASONS).alias("reasons"), F.col(FILE).alias("source_file"))

    @property
    def counts(self) -> DataFrame:
        """(outcome, reason, records): the records add up to those of the files."""
        return self.counted()

    def counted(self, *measures: Column) -> DataFrame:
        """``counts`` with more aggregates of the records."""
        outcome = F.when(F.col(VERDICT), "rejected").otherwise("accepted").alias("outcome")
        return self.records.groupBy(outcome, F.concat_ws(", ", REASONS).alias("reason")).agg(F.count(F.lit(1)).alias("records"), *measures)


def _typed(field: T.StructField) -> Column:
    text = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return text
    if isinstance(field.dataType, (T.DoubleType, T.DecimalType)):  # figures of money
        return parse_amount(text).try_cast(MONEY_IN)
    return F.trim(text).try_cast(field.dataType)


def judged(spark: SparkSession, source: Source, path: str, header: bool = True, lines: bool = False) -> DataFrame:
    """The source's columns with their types, the verdict, its reasons, the file and, of rejected
    records, the text."""
    fields = source.schema.fields
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in fields] + [T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(texts).options(**csv_options(header, lines)).option("columnNameOfCorruptRecord", CORRUPT)
    parsed = reader.csv(path).withColumn(FILE, F.input_file_name())
    broken = F.col(CORRUPT).isNotNull()
    found = [F.when(broken, F.lit("fields"))]
    for f in fields:
        text = F.col(f"`{f.name}`")
        if not isinstance(f.dataType, T.StringType):
            found.append(F.when(~broken & text.isNotNull() & _typed(f).isNull(), F.lit(f"bad {f.name}")))
        if f.name in source.required:
            found.append(F.when(~broken & (F.coalesce(F.trim(text), F.lit("")) == ""), F.lit(f"missing {f.name}")))
    reasons = F.array_compact(F.array(*found))
    as_read = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    record = F.coalesce(F.rtrim(F.col(CORRUPT), F.lit("\r\n")), F.to_csv(F.struct(*[F.col(f"`{f.name}`") for f in fields]), as_read))
    return parsed.withColumn(REASONS, reasons).select(
        *[_typed(f).alias(f.name) for f in fields],
        REASONS,
        FILE,
        F.when(F.size(REASONS) > 0, record).alias(RECORD),
        (F.size(REASONS) > 0).alias(VERDICT),
    )


def load(spark: SparkSession, name: str, path: str, table: str, header: bool = True, lines: bool = False) -> Load:
    """Load the files of the declared CSV source ``name`` as a new version of ``table``."""
    source = SOURCES[name]
    if source.format != "csv":
        raise ValueError(f"{name} is no CSV source")
    versions.refresh(spark, judged(spark, source, path, header, lines), table, partition_by=[VERDICT])
    return Load(table, spark.table(table))
