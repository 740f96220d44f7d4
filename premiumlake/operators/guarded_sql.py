"""Read-only SQL entry points (M34–M37): validation, capped SELECTs, bound parameters and the
table-readiness gate.

A first-keyword test (SELECT / WITH) is not enough on Spark: ``WITH x AS (…) INSERT INTO t …``
passes it and ``spark.sql`` runs commands eagerly. Instead the text is wrapped as the body of a
subquery, ``SELECT * FROM (\\n<sql>\\n)``, which only a query can be: INSERT, DROP, multiple
statements and WITH…INSERT fail at parse time, before anything runs. A cap is applied as
``limit(n)`` on the DataFrame, whatever the text contains.

What a query may do is decided on its analysed plan, not on its text: every node, in subqueries and
CTEs too, must be one of ``_NODES``, every relation one of the catalog (a table or a view, so not a
path), and every expression one of Spark's built-in ones that does not call out of the engine.
Views are taken as they were registered; their definitions are not looked into.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Nodes of an analysed plan that only read, by class name.
_NODES = frozenset(
    """Aggregate CTERelationDef CTERelationRef Deduplicate Distinct Except Expand Filter Generate GlobalLimit
    Intersect Join LateralJoin LocalLimit LocalRelation LogicalRelation HiveTableRelation Offset OneRowRelation
    Pivot Project Range ResolvedHint Sample Sort SubqueryAlias Union Unpivot View Window WithCTE""".split()
)
_BUILT_IN = "org.apache.spark.sql.catalyst.expressions."
# Built-in expressions that run other code: methods of the JVM and user functions.
_CALLS_OUT = frozenset(("CallMethodViaReflection", "TryReflect", "ScalaUDF", "ScalaUDAF", "PythonUDF", "PythonUDAF", "PythonUDTF"))


def _each(seq) -> Iterator:
    return (seq.apply(k) for k in range(seq.size()))


def _class(node) -> tuple[str, str]:
    """(package, name) of a plan node or expression."""
    package, _, name = node.getClass().getName().rpartition(".")
    return f"{package}.", name.rstrip("$")


def _objection(plan) -> str | None:
    """What of an analysed plan a read-only query must not have, or None."""
    plans, expressions = [plan], []
    while plans or expressions:
        if expressions:
            expression = expressions.pop()
            package, name = _class(expression)
            if not package.startswith(_BUILT_IN) or name in _CALLS_OUT:
                return f"expression {expression.prettyName()}"
            expressions.extend(_each(expression.children()))
            continue
        node = plans.pop()
        _, name = _class(node)
        if name not in _NODES:
            return f"operation {name}"
        if name == "View":
            continue
        if name == "LogicalRelation" and node.catalogTable().isEmpty():
            return "a relation that is not in the catalog"
        expressions.extend(_each(node.expressions()))
        plans.extend(_each(node.children()))
        plans.extend(_each(node.subqueries()))
        if name == "WithCTE":
            plans.extend(_each(node.cteDefs()))
    return None


def _wrap(sql: str) -> str:
    body = sql.strip()
    while body.endswith(";"):
        body = body[:-1].rstrip()
    return f"SELECT * FROM (\n{body}\n)"


def validate_select(spark: SparkSession, sql: str, args: Mapping | Sequence | None = None) -> tuple[bool, str | None]:
    """(True, None) when ``sql`` is a query that analyses against the catalog, else (False,
    error text). Nothing is executed: parsing and analysis only."""
    try:
        plan = spark.sql(_wrap(sql), args=args)._jdf.queryExecution().analyzed()  # analysed, not run
        if found := _objection(plan):
            return False, f"not allowed in a read-only query: {found}"
        return True, None
    except Exception as exc:  # noqa: BLE001 - the error text is the result
        return False, str(exc).strip()


@dataclass
class SelectResult:
    """``df`` holds the rows (lazy); ``columns``, ``row_count`` and ``truncated`` (rows beyond the
    caller's limit exist) describe them, the last two by a job each."""

    df: DataFrame | None
    error: str | None
    limit: int | None = None
    whole: DataFrame | None = None

    @property
    def columns(self) -> list[str]:
        return self.df.columns if self.df is not None else []

    @property
    def row_count(self) -> int:
        return self.df.count() if self.df is not None else 0

    @property
    def truncated(self) -> bool:
        return self.limit is not None and self.whole is not None and not self.whole.offset(self.limit).isEmpty()

    @property
    def ok(self) -> bool:
        return self.error is None


def run_select(
    spark: SparkSession, sql: str, limit: int | None = None, args: Mapping | Sequence | None = None
) -> SelectResult:
    """Validated read-only query (lazy), cut to ``limit`` rows only where the caller asks for it.
    Errors come back as values."""
    ok, err = validate_select(spark, sql, args)
    if not ok:
        return SelectResult(None, err)
    whole = spark.sql(_wrap(sql), args=args)
    return SelectResult(whole if limit is None else whole.limit(limit), None, limit, whole)


def table_ready(spark: SparkSession, name: str) -> bool:
    """Publish gate: true once the table exists in the catalog."""
    return spark.catalog.tableExists(name)
