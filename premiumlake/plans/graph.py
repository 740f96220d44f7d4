"""Model graph and write-audit-publish build.

A model declares its inputs, and the order of a build follows from them. ``select`` takes model
names and tags, with ``+`` for what lies upstream (``+name``) or downstream (``name+``).

Each model is written to a staging version first; its declared tests run there, all over the one
written table. The severity of what fails decides: warnings are reported, an error leaves the
published version as it was, removes the staged one and skips everything downstream. The report
is the only thing that comes to the driver: a row for each test and each model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from premiumlake.operators.quality import Check, run_suite
from premiumlake.sources import versions

REPORT = "model string, step string, test string, severity string, status string, failures long"


class CycleError(ValueError):
    """Models that depend on each other in a circle."""


@dataclass(frozen=True)
class Model:
    """``build`` takes a DataFrame for each of ``inputs``, in that order. ``publish``, if given, puts
    the audited staging table into the published one (incremental sinks); otherwise the staged
    version becomes the published one."""

    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    tests: tuple[Check, ...] = ()
    tags: tuple[str, ...] = ()
    table: str | None = None
    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[int, tuple[str, ...]] | None = None
    publish: Callable[[SparkSession, DataFrame, str], None] | None = None


def ordered(models: Iterable[Model], sources: Iterable[str] = ()) -> list[Model]:
    """Models after their inputs; among those that are free, in the order given. An input that is
    neither a model nor a source, a name given twice and a cycle are errors."""
    by_name: dict[str, Model] = {}
    known = set(sources)
    for model in models:
        if model.name in by_name or model.name in known:
            raise ValueError(f"{model.name} is declared twice")
        by_name[model.name] = model
    for model in by_name.values():
        if missing := [i for i in model.inputs if i not in by_name and i not in known]:
            raise ValueError(f"{model.name} reads what nothing makes: {', '.join(missing)}")
    placed: list[Model] = []
    done: set[str] = set(known)
    waiting = list(by_name.values())
    while waiting:
        free = [m for m in waiting if all(i in done for i in m.inputs)]
        if not free:
            raise CycleError("cycle: " + " -> ".join(_circle(waiting[0].name, by_name, done)))
        placed.append(free[0])
        done.add(free[0].name)
        waiting.remove(free[0])
    return placed


def _circle(start: str, by_name: Mapping[str, Model], done: set[str]) -> list[str]:
    path = [start]
    while True:
        following = next(i for i in by_name[path[-1]].inputs if i not in done)
        if following in path:
            return [*path[path.index(following) :], following]
        path.append(following)


def upstream(names: Iterable[str], models: Iterable[Model]) -> set[str]:
    """The models that ``names`` need, themselves included."""
    by_name = {m.name: m for m in models}
    found, waiting = set(), list(names)
    while waiting:
        name = waiting.pop()
        if name in by_name and name not in found:
            found.add(name)
            waiting += by_name[name].inputs
    return found


def downstream(names: Iterable[str], models: Iterable[Model]) -> set[str]:
    """The models that need one of ``names``, themselves included."""
    found = set(names)
    for model in ordered_free(models):
        if found.intersection(model.inputs):
            found.add(model.name)
    return found


def ordered_free(models: Iterable[Model]) -> list[Model]:
    """``ordered`` with all that is not a model taken for a source."""
    models = list(models)
    own = {m.name for m in models}
    return ordered(models, {i for m in models for i in m.inputs} - own)


def selected(select: Iterable[str] | None, models: Iterable[Model]) -> set[str]:
    """Names that a selection means: ``name``, ``tag:t``, ``+name``, ``name+``, ``+tag:t+`` ..."""
    models = list(models)
    names = {m.name for m in models}
    if select is None:
        return names
    found: set[str] = set()
    for term in select:
        bare = term.strip("+")
        own = {m.name for m in models if bare[4:] in m.tags} if bare.startswith("tag:") else {bare} & names
        if not own:
            raise ValueError(f"nothing is selected by {term!r}")
        found |= own
        if term.startswith("+"):
            found |= upstream(own, models)
        if term.endswith("+"):
            found |= downstream(own, models)
    return found


def build(
    spark: SparkSession, models: Iterable[Model], sources: Mapping[str, DataFrame], select: Iterable[str] | None = None, keep: int = 2
) -> DataFrame:
    """Build the selected models in order; returns the report.

    Inputs that are not selected are read from their published tables. Steps: ``test`` (status pass,
    warn, fail, or error for a test that could not run) and ``publish`` (published, rejected,
    skipped, or failed if the model could not be written).
    """
    models = ordered(models, sources)
    wanted = selected(select, models)
    table = {m.name: m.table or m.name for m in models}
    rows: list[tuple] = []
    stopped: set[str] = set()
    for model in (m for m in models if m.name in wanted):
        if stopped.intersection(model.inputs):
            stopped.add(model.name)
            rows.append((model.name, "publish", None, None, "skipped", None))
            continue
        try:
            made = model.build(*[sources[i] if i in sources else spark.table(table[i]) for i in model.inputs])
            if model.publish and not model.tests:  # nothing to audit
                model.publish(spark, made, table[model.name])
                rows.append((model.name, "publish", None, None, "published", None))
                continue
            staged = versions.stage(spark, made, table[model.name] + ("__batch" if model.publish else ""), model.partition_by, model.bucket_by)
        except Exception as failure:  # noqa: BLE001 - reported; the other branches of the graph go on
            stopped.add(model.name)
            rows.append((model.name, "publish", str(failure).split("\n")[0][:300], None, "failed", None))
            continue
        refused = False
        if model.tests:
            for r in run_suite(spark.table(staged), list(model.tests)).collect():  # a row for each test
                rows.append((model.name, "test", r["check_name"], r["severity"], r["status"], r["failures"]))
                refused |= r["status"] in ("fail", "error")
        if refused:
            versions.discard(spark, staged)
            stopped.add(model.name)
        elif model.publish:
            model.publish(spark, spark.table(staged), table[model.name])
            versions.discard(spark, staged)
        else:
            versions.swap(spark, table[model.name], staged, keep)
        rows.append((model.name, "publish", None, None, "rejected" if refused else "published", None))
    return spark.createDataFrame(rows, REPORT)
