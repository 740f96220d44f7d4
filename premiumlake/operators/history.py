"""Keyed table maintenance without a MERGE statement: SCD2 snapshot (M12), delete+insert load
(M13), schema sync (M14), keyed upsert (M15) and keyed delete (M16).

All are joins on the key, so they shuffle on the key only: closed SCD2 versions never enter
the join (they pass through a union untouched), and deletes / delete+insert are ``left_anti``
joins that keep no columns of the batch side. Results are new DataFrames; persisting them is
the caller's write to a *new* location (never overwrite a path the plan is still reading).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALID_FROM, VALID_TO, IS_CURRENT = "valid_from", "valid_to", "is_current"


def assert_unique_keys(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Fail the job (lazily, at execution) when a key occurs twice in ``df``.

    A window count partitioned by the key, so it reuses the hash partitioning the following
    key join needs anyway. The flag feeds a filter so the optimiser cannot prune the check.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    message = F.lit(f"duplicate key in {what}: {', '.join(keys)}")
    return (
        df.withColumn("_key_ok", F.when(n > 1, F.raise_error(message)).otherwise(F.lit(True)))
        .where(F.col("_key_ok"))
        .drop("_key_ok")
    )


def _changed(check_cols: Sequence[str]) -> Column:
    if not check_cols:
        raise ValueError("the check strategy needs at least one check column")
    return ~_all([F.col(f"h.{c}").eqNullSafe(F.col(f"s.{c}")) for c in check_cols])


def _all(cols: list[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out & c
    return out


def scd2_snapshot(
    history: DataFrame | None,
    current: DataFrame,
    key: str,
    check_cols: Sequence[str],
    at: dt.datetime,
    close_deletes: bool = True,
) -> DataFrame:
    """One snapshot run with the *check* strategy.

    ``history`` holds the source columns plus ``valid_from``, ``valid_to`` and ``is_current``
    (None on the first run). For each key of ``current``: no open version → open one; open
    version whose check columns differ (NULL-safe, so NULL → value is a change) → close it at
    ``at`` and open a new one; otherwise nothing, even when other columns changed. Open
    versions whose key vanished are closed when ``close_deletes``; a returning key later opens
    a new version. Duplicate keys in ``current`` fail the run.
    """
    cols = list(current.columns)
    ts = F.lit(at).cast("timestamp")
    src = assert_unique_keys(current, [key], "snapshot source")
    opened = lambda df: df.select(*cols, ts.alias(VALID_FROM), F.lit(None).cast("timestamp").alias(VALID_TO), F.lit(True).alias(IS_CURRENT))
    if history is None:
        return opened(src)
    closed_before = history.where(~F.col(IS_CURRENT)).select(*cols, VALID_FROM, VALID_TO, IS_CURRENT)
    # markers tell which side a joined row has, also where the key itself is NULL
    open_now = history.where(F.col(IS_CURRENT)).withColumn("_in_history", F.lit(True))
    src = src.withColumn("_in_source", F.lit(True))
    j = open_now.alias("h").join(src.alias("s"), F.col(f"h.{key}").eqNullSafe(F.col(f"s.{key}")), "full_outer")
    h_present, s_present = F.col("h._in_history").isNotNull(), F.col("s._in_source").isNotNull()
    changed = h_present & s_present & _changed(check_cols)
    close = changed | ((h_present & ~s_present) if close_deletes else F.lit(False))
    opens = changed | (s_present & ~h_present)
    types = {f.name: f.dataType for f in current.schema.fields}

    def version(side: str, valid_from: Column, valid_to: Column, is_current: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").cast(types[c]).alias(c) for c in cols],
            valid_from.cast("timestamp").alias(VALID_FROM),
            valid_to.cast("timestamp").alias(VALID_TO),
            is_current.alias(IS_CURRENT),
        )

    # One full outer join; each joined row emits the open version it carried (closed or still
    # current) and/or the version it opens. Filtering the join twice instead would make Catalyst
    # split it into a left and a right outer join, reading both tables twice.
    kept = F.when(
        h_present,
        version("h", F.col(f"h.{VALID_FROM}"), F.when(close, ts).otherwise(F.col(f"h.{VALID_TO}")), ~close),
    )
    opened_version = F.when(opens, version("s", ts, F.lit(None), F.lit(True)))
    # a version that a row lacks is a NULL struct, whose fields are NULL too
    versions = j.select(F.inline(F.array(kept, opened_version))).where(F.col(IS_CURRENT).isNotNull())
    return closed_before.unionByName(versions)


def sync_columns(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Align ``target`` to the batch's columns (order and types): new batch columns appear as
    NULL in old rows, columns the batch no longer has are dropped."""
    present = set(target.columns)
    return target.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in batch.schema.fields
        ]
    )


def delete_insert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], sync: bool = True, within: Sequence[str] = ()
) -> DataFrame:
    """Replace target rows whose key occurs in the batch, then add the whole batch.

    Target keys absent from the batch stay (so days after a late-arriving churn remain, as in
    the reference), and duplicate rows inside the batch are kept. With ``sync`` the target's
    columns are first aligned to the batch (schema evolution of an incremental load).

    ``within``: columns by which both sides are partitioned already, each a key or a function of the
    keys (the month of a key date). Rows then meet where they are: the batch's keys are folded into a
    set for each value of ``within`` and hashed, so neither side's rows are shuffled or sorted. The
    sets of one partition must fit a task.
    """
    base = sync_columns(target, batch) if sync else target
    rest = [k for k in keys if k not in within]
    if within and rest:
        value = F.col(rest[0]) if len(rest) == 1 else F.struct(*rest)
        whole = batch.where(_all([F.col(k).isNotNull() for k in keys]))  # a NULL key matches nothing
        folded = whole.groupBy(*within).agg(F.collect_set(value).alias("_keys"))
        folded = folded.select(*[F.col(c).alias(f"_in_{c}") for c in within], "_keys").hint("shuffle_hash")
        met = _all([F.col(c) == F.col(f"_in_{c}") for c in within]) & F.array_contains("_keys", value)
        return base.join(folded, met, "left_anti").unionByName(batch)
    # Distinct keys: a key repeated in the batch is combined map-side, and the aggregate's
    # hash partitioning on the keys is the one the anti join needs (no extra shuffle).
    batch_keys = batch.select(*keys).distinct()
    survivors = base.join(batch_keys, list(keys), "left_anti")
    return survivors.unionByName(batch)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    defaults: dict[str, Column] | None = None,
) -> DataFrame:
    """INSERT … ON CONFLICT (keys) DO UPDATE SET update_cols = EXCLUDED.update_cols.

    Matched rows take only ``update_cols`` from the batch and keep every other column (a
    creation timestamp stays untouched); new keys are inserted, target columns missing from the
    batch take ``defaults`` (else NULL). A key repeated inside the batch fails the run, as the
    database would refuse to touch the same row twice in one statement.
    """
    defaults = defaults or {}
    b = assert_unique_keys(batch, keys, "upsert batch")
    bcols = set(batch.columns)
    j = target.withColumn("_t", F.lit(True)).alias("t").join(
        b.withColumn("_b", F.lit(True)).alias("b"), list(keys), "full_outer"
    )
    in_t, in_b = F.col("t._t").isNotNull(), F.col("b._b").isNotNull()
    out = []
    for f in target.schema.fields:
        c = f.name
        if c in keys:
            out.append(F.col(c))
            continue
        from_batch = F.col(f"b.{c}") if c in bcols else defaults.get(c, F.lit(None)).cast(f.dataType)
        if c in update_cols:
            val = F.when(in_b, from_batch).otherwise(F.col(f"t.{c}"))
        else:
            val = F.when(in_t, F.col(f"t.{c}")).otherwise(from_batch)
        out.append(val.cast(f.dataType).alias(c))
    return j.select(*out)


def delete_keys(target: DataFrame, keys_df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Drop target rows whose key is in ``keys_df``."""
    keys = list(keys or keys_df.columns)
    return target.join(keys_df.select(*keys), keys, "left_anti")
