"""Refresh of silver, gold and the key figures from new bronze rows only.

Every table is kept in parts (``sources/parts.py``): calls and all that comes from them by ranges of the call number,
incidents by ranges of theirs. New rows touch the parts of their keys, and each step takes the old contribution of a
touched part off and puts the new one in its place:

1. The winner of a key is the first of its old winner and its new rows, which is the first of all its rows, since the
   order is total. Only touched parts are read and written.
2. A changed incident reaches calls of other parts. A table of (incident part, call part) pairs, one row a pair, says which.
3. Calls of the touched parts are joined with the incidents of the parts they are linked to.
4. Members of the dimensions carry the number of rows that refer to them. Touched parts send the difference; a member
   without references goes, and a new one gets the next id, so that ids in untouched parts stay true.
5. Facts of touched parts are numbered by place; ids over the whole table are the places after the rows of earlier parts,
   that is the order of the call number, whatever the order of the drops.
6. Monthly and type figures are kept as counts and sums by part and added up at the end.

Parts are worked on in runs (``parts.runs``) where there are many rows, so that what is shuffled or stored for a step is that of
one run, not of the whole table. New rows are read again for each run, so they must be stored.

All versions are published together. The first refresh touches every part and is the full build.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratalake.operators import joins
from stratalake.operators.quality import enforce
from stratalake.operators.surrogate import ordered_ids
from stratalake.plans import gates, gold, silver
from stratalake.session import materialize, release_shuffles, remove_path, scratch_path, side_by_side
from stratalake.sources.parts import PART, PLACE, listed_sizes, part_of, part_sizes, read_parts, runs
from stratalake.sources.tables import Staged, Warehouse

#: Keys of one part. Calls and incidents are numbered in the order of time, so new rows touch few parts.
PART_KEYS = 1_000_000

CALLS, INCIDENTS, FACT = "silver.calls_clean", "silver.incidents_clean", "gold.fact_incident"
MATCHED, LINKS, DATES = "state.matched_calls", "state.part_links", "state.dates"
MONTHS, TYPES = "state.month_figures", "state.type_figures"
LOCATION, TYPE = "gold.dim_location", "gold.dim_incident_type"

_REFS = "_refs"
_INGESTED = "_ingested_ts"

#: Runs in which new rows are taken in; each reads all of them. Rows of a task that ranks them, about.
_SILVER_RUNS, _TASK_ROWS = 8, 100_000
#: What later refreshes need of a matched call: its members of the dimensions.
_MEMBER_COLUMNS = ("call_number", "incident_number", *gold.TYPE_COLUMNS, *gold.LOCATION_COLUMNS, PART)


class Refresh:
    """One refresh of a warehouse."""

    def __init__(self, store: Warehouse, width: int = PART_KEYS):
        self.store, self.spark, self.width = store, store.spark, width
        self.staged: dict[str, Staged] = {}
        #: Where the matched calls of each run lie until their facts are stored, and their columns.
        self.matched: list[tuple[str, StructType]] = []
        self.earlier = {name: store.listed(name) for name in (CALLS, INCIDENTS, MATCHED, FACT, MONTHS, TYPES, LOCATION, TYPE)}

    @staticmethod
    def possible(store: Warehouse) -> bool:
        """Whether the warehouse holds tables in parts to start from."""
        return all(store.listed(name) for name in (CALLS, INCIDENTS, MATCHED, FACT)) and store.exists(LINKS)

    def _old(self, table: str, touched: Iterable[int]) -> DataFrame | None:
        path = self.earlier[table]
        return None if path is None else read_parts(self.spark, path, touched, hidden=True)

    def _new(self, table: str, touched: Iterable[int] | None = None) -> DataFrame:
        return read_parts(self.spark, self.staged[table].path, touched, hidden=True)

    def _stage(self, table: str, df: DataFrame | Iterable[DataFrame], touched: Iterable[int], id_column: str | None = None,
               dealt: bool = False, order_by: Iterable[str] = ()) -> None:
        self.staged[table] = self.store.stage_parts(table, df, touched, id_column, self.earlier.get(table), dealt, order_by)

    def run(self, new_calls: DataFrame, new_incidents: DataFrame) -> dict[str, int]:
        """Take in stored bronze rows, which may be known already, and publish; returns the number of parts touched."""
        calls, incidents = side_by_side(
            lambda: self._silver(CALLS, silver.typed(new_calls, silver.CALL_FIELDS), "call_number",
                                 silver.latest_calls, silver.with_durations),
            lambda: self._silver(INCIDENTS, silver.typed(new_incidents, [*silver.INCIDENT_FIELDS, silver.Field(
                _INGESTED, "timestamp", ("_ingested_at_utc",))]), "incident_number",
                lambda rows, **how: silver.latest_incidents(rows, _INGESTED, **how)),
        )
        gates.check_silver(self._new(CALLS, calls).drop(PART), self._new(INCIDENTS, incidents).drop(PART, _INGESTED))
        release_shuffles(self.spark)
        star, links = self._linked(calls, incidents)
        self._match(star, links)
        release_shuffles(self.spark)
        side_by_side(
            lambda: self._dates(calls, incidents),
            lambda: self._members(LOCATION, self._difference(MATCHED, star, gold.LOCATION_COLUMNS).transform(gold.with_location_key),
                                  ["location_key"], gold.LOCATION_COLUMNS, "location_id"),
            lambda: self._members(TYPE, self._difference(MATCHED, star, gold.TYPE_COLUMNS, "incident_number IS NOT NULL"),
                                  gold.TYPE_COLUMNS, (), "incident_type_id"),
        )
        release_shuffles(self.spark)
        self._facts(star)
        release_shuffles(self.spark)
        self._figures(star)
        self.store.publish(*self.staged.values())
        return {"call_parts": len(calls), "incident_parts": len(incidents), "fact_parts": len(star)}

    def _silver(self, table: str, rows: DataFrame, key: str, winners, finish=lambda df: df) -> set[int]:
        """Winners of the touched parts from their old winners and the new rows."""
        part = part_of(key, self.width)
        sizes = part_sizes(rows.select(part.alias(PART)))
        found = runs(sizes, _SILVER_RUNS)
        # Rows are dealt and ranked by ranges of keys within a part, and stored by the same tasks. Those of a hot key are ranked where
        # they are read.
        hot = bool(joins.find_hot_keys(rows, [key], nulls=True))
        deal = part_of(key, -(-self.width // max(1, max(sizes.values(), default=0) // _TASK_ROWS)))

        def ranked(run: list[int]) -> DataFrame:
            new = rows if len(found) == 1 else rows.where(part.between(run[0], run[-1]))
            old = self._old(table, run)
            both = new if old is None else new.unionByName(old.select(*rows.columns))
            if hot:
                return winners(both, dealt=True)
            return winners(both.repartition(part, deal), dealt=True, dealt_by=[part, deal])

        self._stage(table, (finish(ranked(run)).withColumn(PART, part) for run in found), sizes, dealt=not hot, order_by=[key])
        return set(sizes)

    def _linked(self, calls: set[int], incidents: set[int]) -> tuple[set[int], list[tuple[int, int]]]:
        """Call parts whose stars change, and the pairs of incident and call parts."""
        pairs = self._new(CALLS, calls).where("incident_number IS NOT NULL").select(
            part_of("incident_number", self.width).alias("incident_part"), F.col(PART).alias("call_part"))
        known = self.store.read_optional(LINKS)
        pairs = (pairs if known is None else pairs.union(known)).distinct()
        self.staged[LINKS] = self.store.stage(LINKS, pairs)
        links = [(r["incident_part"], r["call_part"]) for r in self.store.read_staged(self.staged[LINKS]).collect()]
        return calls | {c for i, c in links if i in incidents}, links

    def _match(self, star: set[int], links: list[tuple[int, int]]) -> None:
        """Join the calls of the touched parts with their incidents; what only facts need is stored until then."""
        sizes = listed_sizes(self.spark, self.staged[CALLS].path, star)

        def members() -> Iterator[DataFrame]:
            for run in runs(sizes):
                calls = self._new(CALLS, run).drop(PART)
                incidents = self._new(INCIDENTS, {i for i, c in links if c in set(run)}).drop(PART, _INGESTED)
                matched = gold.matched_calls(calls, incidents).drop("location_key").withColumn(PART, part_of("call_number", self.width))
                path = scratch_path(self.spark, "matched")
                stored = materialize(matched, "matched", path)
                del matched
                release_shuffles(self.spark)
                self.matched.append((path, stored.schema))
                yield stored.select(*_MEMBER_COLUMNS)

        self._stage(MATCHED, members(), star, order_by=["call_number"])

    def _difference(self, table: str, touched: set[int], columns: Sequence[str], where: str = "true") -> DataFrame:
        """How many rows more or less the touched parts have of each combination of some columns."""
        new = self._new(table, touched).where(where).select(*columns, F.lit(1).cast("bigint").alias(_REFS))
        old = self._old(table, touched)
        if old is not None:
            new = new.union(old.where(where).select(*columns, F.lit(-1).cast("bigint").alias(_REFS)))
        return new.groupBy(*columns).agg(F.sum(_REFS).alias(_REFS)).where(F.col(_REFS) != 0)

    def _dates(self, calls: set[int], incidents: set[int]) -> None:
        days = self._difference(CALLS, calls, ["call_date"]).union(self._difference(INCIDENTS, incidents, ["incident_date"]))
        days = days.toDF("d", _REFS).where("d IS NOT NULL")
        known = self.store.read_optional(DATES)
        days = (days if known is None else days.union(known)).groupBy("d").agg(F.sum(_REFS).alias(_REFS)).where(F.col(_REFS) > 0)
        self.staged[DATES] = self.store.stage(DATES, days)
        self.staged["gold.dim_date"] = self.store.stage(
            "gold.dim_date", gold.calendar(self.store.read_staged(self.staged[DATES]).select("d")))

    def _members(self, table: str, change: DataFrame, key: Sequence[str], others: Sequence[str], name: str) -> None:
        """The members of a dimension after the difference; NULL is a value of a key like any other."""
        columns = [*key, *others]
        change = change.select(*columns, _REFS, F.lit(None).cast("bigint").alias(name))
        old = self._old(table, [0])
        last = 0
        if old is not None:
            last = old.agg(F.max(name)).first()[0] or 0
            change = change.unionByName(old.select(*columns, _REFS, name))
        now = change.groupBy(*columns).agg(F.sum(_REFS).alias(_REFS), F.max(name).alias(name)).where(F.col(_REFS) > 0)
        path = scratch_path(self.spark, "members")
        now = materialize(now, "members", path)
        fresh = ordered_ids(now.where(F.col(name).isNull()).drop(name), key, name)
        fresh = fresh.withColumn(name, F.col(name) + F.lit(last))
        members = now.where(F.col(name).isNotNull()).unionByName(fresh).select(name, *columns, _REFS)
        self._stage(table, members.withColumn(PART, F.lit(0).cast("bigint")), [0])
        remove_path(self.spark, path)

    def _facts(self, star: set[int]) -> None:
        dates = self.store.read_staged(self.staged["gold.dim_date"])
        types, places = self._new(TYPE), self._new(LOCATION)
        # A part has at most as many calls as keys.
        place = F.row_number().over(Window.partitionBy(PART).orderBy("call_number")).cast("bigint")

        def facts() -> Iterator[DataFrame]:
            for path, schema in self.matched:
                matched = self.spark.read.schema(schema).parquet(path).drop(PART).transform(gold.with_location_key)
                yield gold.fact_rows(matched, dates, types, places).withColumn(
                    PART, part_of("call_number", self.width)).withColumn(PLACE, place)
                remove_path(self.spark, path)

        self._stage(FACT, facts(), star, "incident_id", dealt=True)
        touched = self._new(FACT, star).drop(PART, PLACE)
        enforce(touched, "fact_incident", [rule for rule in gates.FACT_RULES if rule.name != "table is empty"])
        if not self.staged[FACT].rows:
            gates.check_gold(touched)

    def _figures(self, star: set[int]) -> None:
        fact = self._new(FACT, star)
        dates = self.store.read_staged(self.staged["gold.dim_date"]).select("date_id", "year", "month")
        types = self._new(TYPE).select("incident_type_id", "call_type_group", "call_type")
        sums = [F.count(F.lit(1)).alias("n"), F.count("response_time_sec").alias("n_response"), F.sum("response_time_sec").alias("response")]
        spread = ["call_number"]
        for table, dim, key, by in ((MONTHS, dates, "date_id", ["year", "month"]),
                                    (TYPES, types, "incident_type_id", ["call_type_group", "call_type"])):
            joined = joins.lookup(fact, dim, [key], spread, how="inner")
            self._stage(table, joined.groupBy(PART, *by).agg(*sums), star)
        average = (F.sum("response") / F.nullif(F.sum("n_response"), F.lit(0))).alias("avg_response_time_sec")
        n, answered = F.sum("n").alias("incident_count"), F.sum("n_response").alias("n_incidents")
        months, kinds = self._new(MONTHS).groupBy("year", "month"), self._new(TYPES).groupBy("call_type_group", "call_type")
        for name, figures in (
            ("v_kpi_response_time_month", months.agg(average, answered).where("n_incidents > 0")),
            ("v_kpi_incident_volume_month", months.agg(n)),
            ("v_kpi_top_incident_type", kinds.agg(n, average)),
        ):
            self.staged[f"gold.{name}"] = self.store.stage(f"gold.{name}", figures)
