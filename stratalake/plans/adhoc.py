"""Guarded read-only SQL on the registered gold tables.

The text is parsed, not searched: the plan may hold only reading steps, relations that are registered, and functions
of the engine that neither call foreign code nor tell about files. The analysed plan, in which Spark has resolved all
scopes, may read registered views only.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession

# The plan nodes of reading statements.
READ_NODES = frozenset(
    "Project Filter Aggregate Sort GlobalLimit LocalLimit Offset Join LateralJoin SubqueryAlias UnresolvedSubqueryColumnAliases "
    "UnresolvedWith Distinct Union Except Intersect UnresolvedHaving WithWindowDefinition OneRowRelation Generate Pivot Unpivot "
    "UnresolvedHint Window".split())
# Leaves of an analysed plan that read nothing.
READ_LEAVES = frozenset("OneRowRelation CTERelationRef".split())
# Functions that run foreign code or tell about the machine or its files.
BLOCKED_FUNCTIONS = frozenset(
    "reflect java_method try_reflect input_file_name input_file_block_start input_file_block_length current_user user "
    "session_user current_catalog current_database current_schema version spark_partition_id".split())
_LOGICAL = "org.apache.spark.sql.catalyst.plans.logical."
_COMMANDS = "org.apache.spark.sql.execution."
_FENCE = re.compile(r"\A\s*```(?:sql)?|```\s*\Z", re.IGNORECASE)
# Literals, quoted names and comments, in which nothing is rewritten.
_FIXED = re.compile(r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/)""", re.S)


class UnsafeSql(ValueError):
    """The text is not a single read-only statement on registered tables."""


def strip_fences(text: str) -> str:
    """SQL without a surrounding code fence and closing semicolons."""
    return _FENCE.sub("", text).strip().rstrip("; \n\t")


def _nodes(value) -> Iterator[dict]:
    """All nodes of a parsed plan, those of expressions and subqueries too."""
    if isinstance(value, dict):
        yield value
        for inner in value.values():
            yield from _nodes(inner)
    elif isinstance(value, list):
        for inner in value:
            yield from _nodes(inner)


def _parts(name: str) -> list[str]:
    return [part.strip().lower() for part in name.strip("[]").split(",")]


def check_sql(spark: SparkSession, text: str, tables: Iterable[str] | None = None) -> None:
    """Raise ``UnsafeSql`` unless the text only reads ``tables`` (the session's temporary views by default)."""
    body = strip_fences(text)
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(body)
    except ParseException as error:
        raise UnsafeSql(f"not one statement: {error.getMessage()}") from error
    if tables is None:
        tables = [t.name for t in spark.catalog.listTables() if t.isTemporary]
    known = {name.lower() for name in tables}
    nodes = list(_nodes(json.loads(plan.toJSON())))
    known |= {str(n["_1"]).lower() for n in nodes if str(n.get("product-class", "")).startswith("scala.Tuple") and "_1" in n}
    for node in nodes:
        kind = str(node.get("class", ""))
        name = kind.rpartition(".")[2]
        if kind.startswith(_LOGICAL) and name not in READ_NODES or kind.startswith(_COMMANDS):
            raise UnsafeSql(f"{name} is not a reading step")
        if name == "UnresolvedRelation":
            parts = _parts(node["multipartIdentifier"])
            if len(parts) == 2 and parts[0] == "gold":
                parts = parts[1:]
            if len(parts) != 1 or parts[0] not in known:
                raise UnsafeSql(f"{'.'.join(parts)} is not a registered table")
        elif name == "UnresolvedFunction":
            parts = _parts(node["nameParts"])
            if len(parts) != 1 or parts[0] in BLOCKED_FUNCTIONS or not spark.catalog.functionExists(parts[0]):
                raise UnsafeSql(f"function {'.'.join(parts)} is not allowed")
        elif name in ("UnresolvedTableValuedFunction", "UnresolvedTVFAliases", "UnresolvedPathBasedTable", "PlanWithUnresolvedIdentifier",
                      "ExpressionWithUnresolvedIdentifier", "UnresolvedIdentifier"):
            raise UnsafeSql(f"{name} is not allowed")


def _sequence(items) -> list:
    return [items.apply(k) for k in range(items.size())]


def check_leaves(df: DataFrame, tables: Iterable[str]) -> None:
    """Raise ``UnsafeSql`` unless all that the analysed plan reads are temporary views of these names.

    Spark has resolved every name in its own scope by then, so a name that a common table expression defines elsewhere
    does not pass for a table. What a view reads is the view's affair.
    """
    known, waiting = {name.lower() for name in tables}, [df._jdf.queryExecution().analyzed()]
    while waiting:
        node = waiting.pop()
        kind = node.nodeName()
        if kind == "View":
            name = node.desc().identifier().table()
            if not node.isTempView() or name.lower() not in known:
                raise UnsafeSql(f"{name} is not a registered table")
            continue
        below = _sequence(node.children()) + _sequence(node.subqueries())
        if not below and kind not in READ_LEAVES:
            raise UnsafeSql(f"{kind} is not a registered table")
        waiting += below


def _analysed(spark: SparkSession, text: str, tables: Iterable[str] | None) -> DataFrame:
    if tables is None:
        tables = [t.name for t in spark.catalog.listTables() if t.isTemporary]
    tables = list(tables)
    check_sql(spark, text, tables)
    pieces = _FIXED.split(strip_fences(text))
    # Only before a table's name; a column of something that is called gold keeps its qualifier.
    names = "|".join(map(re.escape, tables)) or r"(?!)"
    prefix = re.compile(rf"\bgold\s*\.\s*(?=(?:{names})\b)", re.IGNORECASE)
    for k in range(0, len(pieces), 2):
        pieces[k] = prefix.sub("", pieces[k])
        if k + 1 < len(pieces) and re.fullmatch(f"`(?:{names})`", pieces[k + 1], re.IGNORECASE):
            pieces[k] = re.sub(r"\bgold\s*\.\s*\Z", "", pieces[k], flags=re.IGNORECASE)
    result = spark.sql("".join(pieces))
    check_leaves(result, tables)
    return result


def is_safe_select(spark: SparkSession, text: str, tables: Iterable[str] | None = None) -> bool:
    """Whether the text is one read-only statement on the tables."""
    try:
        _analysed(spark, text, tables)
    except UnsafeSql:
        return False
    except AnalysisException:
        pass  # safe, but it names a column that is not there
    return True


def safe_sql(spark: SparkSession, text: str, limit: int | None = None,
             tables: Iterable[str] | None = None) -> DataFrame:
    """Run one read-only statement; table names may carry a ``gold.`` prefix, literals stay as they are."""
    result = _analysed(spark, text, tables)
    return result if limit is None else result.limit(limit)
