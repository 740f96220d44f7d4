"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is produced, nothing is
collected to the driver) and timed wall-clock; each runs ``BENCH_RUNS`` times (default 2) and
the best run is reported, the first-run total is kept as ``cold_total``. ``pipeline_build_sec``
is one full layered build of all models into a scratch warehouse (``BENCH_BUILD=0`` skips it).
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from premiumlake.plans.registry import QUERIES  # noqa: E402
from premiumlake.session import checkpoint_dir, local_session  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "2"))  # the reported time is the best (warm) run

HEADLINE = [
    "monthly_premiums",
    "reconcile",
    "churn_rate",
    "concentration_hhi",
    "mom_growth",
    "daily_activity_rows",
    "cohort_retention",
    "customer_ltv",
    "premium_waterfall",
    "suite_monthly",
    "suite_activity",
    "dq_silver_declared",
    "scd2_two_batches",
    "delete_insert",
    "keyed_upsert",
    "report_customers",
]


def pipeline_build(spark, sf_dir: str) -> float:
    """Wall time of one full layered build (all models, tables written) into the scratch
    warehouse: the reference's own workload, where silver is stored once and read by the marts."""
    import datetime as dt

    from premiumlake.plans import build as B
    from premiumlake.plans.inputs import Inputs
    from premiumlake.sources import fixtures

    i = Inputs(spark, sf_dir)
    t0 = time.perf_counter()
    sources = B.Sources(i.raw, fixtures.accounting_closing(i.silver), i.policies)
    B.build_all(spark, sources, dt.datetime(2025, 1, 1), fixtures.AS_OF, prefix="bench_")
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or (HEADLINE if os.environ.get("BENCH_ALL") != "1" else list(QUERIES))
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = local_session(
        cores=cpus,
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
        conf={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")},
    )
    checkpoint_dir(spark)  # the session's own setting when present, a scratch folder otherwise
    QUERIES["monthly_premiums"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        cold[name] = round(runs[0], 3)
        times[name] = round(min(runs), 3)
    build_sec = pipeline_build(spark, sf_dir) if os.environ.get("BENCH_BUILD", "1") == "1" else None
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
                "runs_per_query": RUNS,
                "cold_total": round(sum(cold.values()), 3),
                "pipeline_build_sec": build_sec,
            }
        )
    )


if __name__ == "__main__":
    main()
