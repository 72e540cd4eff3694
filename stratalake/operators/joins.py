"""Joins that hold up under hot keys and NULL keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.session import small_frame

# A key is hot when it holds more than this part of the rows. At most 1 / HOT_SHARE keys can
# be hot, which bounds everything that is collected or broadcast about them.
HOT_SHARE = 1 / 1000
# Below this many rows a key is no load for one task, whatever its share.
HOT_MIN_ROWS = 1_000_000
# A dimension is broadcast only after its row count proved to be at most this.
BROADCAST_ROWS = 200_000
# NULL keys match nothing; their rows are spread over this many hash values.
NULL_SPREAD = 65_521

# Items the frequency sketch follows; it finds every key above HOT_SHARE.
SKETCH_ITEMS = 10_000

_SALT = "_salt"
_HASH = "_key_hash"


def find_hot_keys(df: DataFrame, on: Sequence[str], share: float = HOT_SHARE,
                  min_rows: int = HOT_MIN_ROWS, nulls: bool = False) -> dict[int, int]:
    """Hash of each hot key and the number of parts its rows should be split into.

    One scan of the key columns feeds a mergeable sketch of bounded size, so nothing is
    shuffled but the sketches. A key that is missed or split without need changes no result.
    """
    # A key is a load where it holds more rows than a task would get on average.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = min(share, max(1 / SKETCH_ITEMS, 1 / tasks))
    most = int(1 / share)
    keys = df.select(*on)
    found = (
        (keys if nulls else keys.dropna())
        .select(F.xxhash64(*on).alias(_HASH))
        .agg(
            F.expr(f"approx_top_k({_HASH}, {most}, {max(SKETCH_ITEMS, most)})").alias("top"),
            F.count(F.lit(1)).alias("total"),
        )
        .first()
    )
    limit = max(min_rows, found["total"] * share)
    return {
        item["item"]: -(-item["count"] // int(limit)) for item in found["top"] if item["count"] > limit
    }


def spread_left_join(left: DataFrame, right: DataFrame, on: Sequence[str],
                     spread_by: Sequence[str], how: str = "left",
                     share: float = HOT_SHARE, min_rows: int = HOT_MIN_ROWS) -> DataFrame:
    """Left or inner equi-join in which no key of the left side lands in one task.

    Rows of a hot key are split by a hash of ``spread_by``, columns that tell its rows apart,
    and only the matching right rows are repeated. A left join spreads NULL keys the same way.
    Without hot keys an inner join is a plain join.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    spread = F.xxhash64(*spread_by)
    null_key = reduce(or_, [F.col(name).isNull() for name in on])
    null_salt = F.pmod(spread, F.lit(NULL_SPREAD)).cast("int")
    hot = find_hot_keys(left, on, share, min_rows)
    if hot:
        rows = small_frame(left.sparkSession, hot.items(), f"{_HASH} bigint, _parts int")
        splits = F.broadcast(rows)
        parts = F.coalesce(F.col("_parts"), F.lit(1))
        key_hash = F.xxhash64(*on)
        left = left.withColumn(_HASH, key_hash).join(splits, _HASH, "left").withColumn(
            _SALT, F.when(null_key, null_salt).otherwise(F.pmod(spread, parts).cast("int"))
        ).drop(_HASH, "_parts")
        right = right.withColumn(_HASH, key_hash).join(splits, _HASH, "left").withColumn(
            _SALT, F.explode(F.sequence(F.lit(0), parts - 1))
        ).drop(_HASH, "_parts")
    elif how == "inner":
        return left.join(right, list(on))
    else:
        left = left.withColumn(_SALT, F.when(null_key, null_salt).otherwise(F.lit(0)))
        right = right.withColumn(_SALT, F.lit(0))
    return left.join(right, [*on, _SALT], how).drop(_SALT)


def _null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], spread_by: Sequence[str], how: str,
                    broadcast: bool) -> DataFrame:
    """Equi-join in which NULL equals NULL; values are compared as they are, whatever their type."""
    right = right.withColumnsRenamed({name: f"_dim_{name}" for name in on})
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_dim_{name}")) for name in on])
    drop = [f"_dim_{name}" for name in on]
    if broadcast:
        return left.join(F.broadcast(right), same, how).drop(*drop)
    hot = find_hot_keys(left, on, nulls=True)
    if not hot:
        return left.join(right, same, how).drop(*drop)
    splits = F.broadcast(small_frame(left.sparkSession, hot.items(), f"{_HASH} bigint, _parts int"))
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    left = left.withColumn(_HASH, F.xxhash64(*on)).join(splits, _HASH, "left").withColumn(
        _SALT, F.pmod(F.xxhash64(*spread_by), parts).cast("int")).drop(_HASH, "_parts")
    right = right.withColumn(_HASH, F.xxhash64(*drop)).join(splits, _HASH, "left").withColumn(
        f"_dim{_SALT}", F.explode(F.sequence(F.lit(0), parts - 1))).drop(_HASH, "_parts")
    same = same & (F.col(_SALT) == F.col(f"_dim{_SALT}"))
    return left.join(right, same, how).drop(*drop, _SALT, f"_dim{_SALT}")


def lookup(fact: DataFrame, dim: DataFrame, on: Sequence[str], spread_by: Sequence[str],
           how: str = "left", null_safe: bool = False,
           broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Fact to dimension join; the dimension holds each key once.

    The dimension is counted first and broadcast only when it is small. A larger one goes
    through the spread join. The dimension should be a stored table, which is counted from
    its file footers.
    """
    small = dim.count() <= broadcast_rows
    if null_safe:
        return _null_safe_join(fact, dim, on, spread_by, how, broadcast=small)
    if small:
        return fact.join(F.broadcast(dim), list(on), how)
    return spread_left_join(fact, dim, on, spread_by, how)


def not_present(df: DataFrame, known: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not among the known keys."""
    return df.join(known.select(*on), list(on), "left_anti")


def present(df: DataFrame, known: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is among the known keys, each row at most once."""
    return df.join(known.select(*on), list(on), "left_semi")
