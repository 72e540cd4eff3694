"""Refreshes from new rows against full rebuilds."""

import random

import pytest
from pyspark.sql import functions as F

from stratalake.plans import changes, gold, kpi, silver
from stratalake.plans.pipeline import DIMENSIONS, stage_star
from stratalake.sources import parts
from stratalake.sources.tables import Warehouse

STAR = ["gold.fact_incident", *[f"gold.{d}" for d in DIMENSIONS]]


def call(rng, number, at):
    """A raw call whose place, type and time depend on chance; small ranges, so that dimension members come and go."""
    day = rng.randrange(1, 9)
    return (str(number), rng.choice([None, str(number // 3 + 1), str(rng.randrange(1, 400))]), rng.choice(["Fire", "EMS", None]),
            f"2020-01-0{day}", f"2020-01-0{day} 10:00:{rng.randrange(10, 60)}", f"2020-01-0{day} 10:01:00",
            f"2020-01-0{day} 10:0{rng.randrange(2, 9)}:00", rng.choice(["Main", "Side", "Oak", f"Lane {rng.randrange(40)}"]), f"r{rng.randrange(5)}", at)


def incident(rng, number, at):
    return (str(number), str(number * 3), f"2020-02-0{rng.randrange(1, 9)}", f"2020-01-0{rng.randrange(1, 9)} 09:00:00",
            f"2020-01-09 1{rng.randrange(10)}:00:00", rng.choice(["Elm", "Ash", None]), rng.choice(["100", "300"]), at)


CALLS = "call_number string, incident_number string, call_type string, call_date string, received_dttm string, dispatch_dttm string, " \
        "on_scene_dttm string, address string, rowid string, _ingested_at_utc string"
INCIDENTS = "incident_number string, call_number string, incident_date string, alarm_dttm string, close_dttm string, address string, " \
            "primary_situation string, _ingested_at_utc string"


def star_content(frames):
    """Facts with the attributes of their members, the members and the figures, without surrogate keys."""
    fact, dates, types, places, *figures = frames
    t = types.select("incident_type_id", *[F.col(c).alias(f"t_{c}") for c in gold.TYPE_COLUMNS])
    p = places.select("location_id", *[F.col(c).alias(f"p_{c}") for c in gold.LOCATION_COLUMNS])
    joined = fact.join(t, "incident_type_id").join(p, "location_id").drop("incident_id", "incident_type_id", "location_id")
    plain = [joined, dates, types.drop("incident_type_id"), places.drop("location_id"), *figures]
    return [sorted((tuple(r) for r in f.select(*sorted(f.columns)).collect()), key=str) for f in plain]


def rebuilt(spark, root, calls, incidents):
    store = Warehouse(spark, root)
    staged = [store.stage("silver.calls_clean", silver.clean_calls(calls)),
              store.stage("silver.incidents_clean", silver.clean_incidents(incidents))]
    built = stage_star(store, *map(store.read_staged, staged))
    frames = [store.read_staged(built[n]) for n in ("fact_incident", *DIMENSIONS)]
    figures = kpi.kpi_tables(*frames[:3])
    return [*map(store.read_staged, staged)], [*frames, *[figures[n] for n in kpi.KPI_TABLES]]


@pytest.mark.parametrize("width, seed", [(50, 1), (7, 2), (10**6, 3)])
def test_refreshes_equal_a_rebuild(spark, tmp_path, width, seed):
    rng = random.Random(seed)
    store = Warehouse(spark, str(tmp_path / "house"))
    calls, incidents = [], []
    for turn in range(3):
        at = f"2020-03-0{turn + 1} 00:00:00"
        # New calls, late versions of old ones, rows that are known already, and incidents that change old calls.
        new_calls = [call(rng, n, at) for n in range(100 * turn + 1, 100 * turn + 101)] + [call(rng, rng.randrange(1, 100 * turn + 2), at) for _ in range(6 * turn)]
        new_calls += calls[:3]
        new_incidents = [incident(rng, n, at) for n in ([*range(1, 60, 2)] if turn == 0 else [rng.randrange(1, 90) for _ in range(4)])]
        calls, incidents = calls + new_calls, incidents + new_incidents
        changes.Refresh(store, width).run(spark.createDataFrame(new_calls, CALLS), spark.createDataFrame(new_incidents, INCIDENTS))
    silver_frames, wanted = rebuilt(spark, str(tmp_path / "again"), spark.createDataFrame(calls, CALLS), spark.createDataFrame(incidents, INCIDENTS))
    found = store.read(*STAR, *[f"gold.{n}" for n in kpi.KPI_TABLES])
    assert star_content(found) == star_content(wanted)
    for mine, other in zip(store.read("silver.calls_clean", "silver.incidents_clean"), silver_frames):
        assert mine.columns == other.columns and mine.exceptAll(other).isEmpty() and mine.count() == other.count()
    fact = found[0]
    assert [r.incident_id for r in fact.orderBy("call_number").collect()] == [*range(1, fact.count() + 1)]
    for dim, key in zip(found[2:4], ("incident_type_id", "location_id")):
        assert dim.count() == dim.select(key).distinct().count()


def test_only_touched_parts_are_read_and_written(spark, tmp_path):
    rng = random.Random(9)
    store = Warehouse(spark, str(tmp_path / "house"))
    first = [call(rng, n, "2020-03-01 00:00:00")[:1] + (str(n),) + call(rng, n, "2020-03-01 00:00:00")[2:] for n in range(1, 401)]
    changes.Refresh(store, 100).run(spark.createDataFrame(first, CALLS),
                                    spark.createDataFrame([incident(rng, n, "2020-03-01 00:00:00") for n in range(1, 401)], INCIDENTS))
    before = {t: {e["part"]: e["path"] for e in parts._entries(spark, store.listed(t))} for t in (changes.CALLS, changes.MATCHED, changes.FACT, changes.INCIDENTS)}
    # What an untouched part holds cannot be read any more.
    for table in (changes.CALLS, changes.MATCHED, changes.FACT, changes.INCIDENTS):
        for part, path in before[table].items():
            if part not in (1, 3):
                for file in (tmp_path / "house").rglob("*.parquet"):
                    if str(file.parent) == path.removeprefix("file:"):
                        file.write_bytes(b"spoilt")
    late = [("150", "150", "Late", "2020-01-01", "2021-01-01 10:00:00", "2021-01-01 10:01:00", "2021-01-01 10:02:00", "Main", "r", "2020-03-02 00:00:00")]
    changed = [incident(rng, 320, "2020-03-02 00:00:00")[:3] + ("2021-01-01 09:00:00",) + incident(rng, 320, "2020-03-02 00:00:00")[4:]]
    touched = changes.Refresh(store, 100).run(spark.createDataFrame(late, CALLS), spark.createDataFrame(changed, INCIDENTS))
    assert touched == {"call_parts": 1, "incident_parts": 1, "fact_parts": 2}
    for table in before:
        after = {e["part"]: e["path"] for e in parts._entries(spark, store.listed(table))}
        same = {p for p in after if after[p] == before[table][p]}
        assert same == set(after) - ({1} if table == changes.CALLS else {3} if table == changes.INCIDENTS else {1, 3})


def test_vacuum_keeps_listed_folders(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "house"))
    for turn in range(3):
        df = spark.range(turn * 10, turn * 10 + 10).select("id", parts.part_of("id", 5).alias("_part"))
        store.publish(store.stage_parts("gold.t", df, parts.part_numbers(df), earlier=store.listed("gold.t")))
    df = spark.range(3).select("id", F.lit(0).cast("long").alias("_part"))
    store.publish(store.stage_parts("gold.t", df, [0, 1], earlier=store.listed("gold.t")))
    assert store.vacuum(1) == 3 and sorted(r.id for r in store.read("gold.t").collect()) == [0, 1, 2, *range(10, 30)]
    assert len(list((tmp_path / "house" / "gold" / "t").glob("data=*"))) == 3
    empty = store.stage_parts("gold.t", df.where("false"), range(6), earlier=store.listed("gold.t"))
    assert store.read_staged(empty).columns == ["id"] and store.read_staged(empty).count() == 0


def test_refresh_in_runs_equals_a_rebuild(spark, tmp_path, monkeypatch):
    """Each run of parts is stored by itself, with the rows of its own parts, and nothing is left of what lay between the steps."""
    monkeypatch.setattr(parts, "RUN_ROWS", 25)
    rng = random.Random(4)
    calls = [call(rng, n, "2020-03-01 00:00:00") for n in [*range(1, 121), *range(1, 121, 7)]] + [call(rng, 0, "2020-03-01 00:00:00")]
    incidents = [incident(rng, n, "2020-03-01 00:00:00") for n in [*range(1, 90, 2), *range(1, 90, 9)]]
    calls = [(None if number == "0" else number, *others) for number, *others in calls]
    given = spark.createDataFrame(calls, CALLS), spark.createDataFrame(incidents, INCIDENTS)
    monkeypatch.setattr(changes.gates, "check_silver", lambda *tables: None)
    store = Warehouse(spark, str(tmp_path / "house"))
    refresh = changes.Refresh(store, 10)
    refresh.run(*given)
    for table in (changes.CALLS, changes.MATCHED, changes.FACT):
        entries = parts._entries(spark, store.listed(table))
        assert len({e["path"].rsplit("/", 1)[0] for e in entries}) >= 4
    assert len(refresh.matched) >= 4 and not any(store._is_there(path) for path, _ in refresh.matched)
    silver_frames, wanted = rebuilt(spark, str(tmp_path / "again"), *given)
    found = store.read(*STAR, *[f"gold.{n}" for n in kpi.KPI_TABLES])
    assert star_content(found) == star_content(wanted)
    for mine, other in zip(store.read("silver.calls_clean", "silver.incidents_clean"), silver_frames):
        assert mine.exceptAll(other).isEmpty() and mine.count() == other.count()


def test_runs_hold_neighbouring_parts(monkeypatch):
    monkeypatch.setattr(parts, "RUN_ROWS", 10)
    assert parts.runs({}) == [[]]
    assert parts.runs({3: 4, -1: 5, 7: 4, 8: 30, 9: 1}, 100) == [[-1, 3], [7], [8], [9]]
    assert parts.runs({n: 10 for n in range(100)}, 4) == [[*range(a, a + 25)] for a in (0, 25, 50, 75)]
