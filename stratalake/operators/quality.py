"""Quality gates: all rules of a table in one pass, all failures reported together."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.aggregates import count_where, is_empty_flag


class GateError(ValueError):
    """A table broke at least one rule; ``failures`` maps each broken rule to its count."""

    def __init__(self, table: str, failures: dict[str, int]):
        self.table = table
        self.failures = failures
        listed = ", ".join(f"{rule} (count={n})" for rule, n in failures.items())
        super().__init__(f"{table}: {listed}")


@dataclass(frozen=True)
class Rule:
    """A named aggregate that must be zero, made when a session is there."""

    name: str
    violations: Callable[[], Column]


def not_null(column: str) -> Rule:
    return Rule(f"{column} is null", lambda: count_where(F.col(column).isNull()))


def not_negative(column: str) -> Rule:
    return Rule(f"{column} is negative", lambda: count_where(F.col(column) < 0))


def positive(column: str) -> Rule:
    return Rule(f"{column} is not positive", lambda: count_where(F.col(column) <= 0))


def not_empty() -> Rule:
    return Rule("table is empty", lambda: is_empty_flag().cast("bigint"))


@dataclass(frozen=True)
class Expectation:
    """What a column of a table should look like."""

    column: str
    types: tuple[str, ...]
    nullable: bool = True
    at_least: float | None = None
    above: float | None = None

    def rules(self) -> list[Rule]:
        found = [] if self.nullable else [not_null(self.column)]
        if self.at_least is not None:
            found.append(Rule(f"{self.column} is below {self.at_least:g}",
                              lambda: count_where(F.col(self.column) < self.at_least)))
        if self.above is not None:
            found.append(Rule(f"{self.column} is not above {self.above:g}",
                              lambda: count_where(F.col(self.column) <= self.above)))
        return found


def violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, violations): one row per rule from one aggregate over the table."""
    slots = [f"r{i}" for i in range(len(rules))]
    counts = df.agg(*[rule.violations().cast("bigint").alias(s) for rule, s in zip(rules, slots)])
    names = F.create_map(*[F.lit(x) for s, r in zip(slots, rules) for x in (s, r.name)])
    return counts.unpivot([], slots, "slot", "violations").select(
        names[F.col("slot")].alias("rule"), "violations"
    )


def schema_failures(df: DataFrame, expectations: Sequence[Expectation]) -> dict[str, int]:
    """Missing columns and wrong types; extra columns are allowed."""
    actual = {field.name: field.dataType.simpleString() for field in df.schema}
    failures = {}
    for expected in expectations:
        found = actual.get(expected.column)
        if found is None:
            failures[f"{expected.column} is missing"] = 1
        elif found not in expected.types:
            failures[f"{expected.column} is {found}, not {' or '.join(expected.types)}"] = 1
    return failures


def enforce(df: DataFrame, table: str, rules: Sequence[Rule] = (),
            expectations: Sequence[Expectation] = ()) -> None:
    """Raise GateError with every broken rule and expectation."""
    failures = schema_failures(df, expectations)
    present = set(df.columns)
    every = [*rules, *[r for e in expectations if e.column in present for r in e.rules()]]
    unique = list({rule.name: rule for rule in every}.values())
    if unique:
        for row in violations(df, unique).filter(F.col("violations") != 0).collect():
            failures[row["rule"]] = row["violations"]
    if failures:
        raise GateError(table, failures)
