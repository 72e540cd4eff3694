"""Distribution profiles, a regression on time features, and incidents derived from calls."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions import casts, times
from stratalake.operators import aggregates as agg
from stratalake.operators import filters, sampling, shape
from stratalake.session import materialize, remove_path, scratch_path

# Features, targets and categories of the call profile, and the model settings.
FEATURES = ("hour", "dow", "month", "is_weekend")
TARGETS = (
    "dispatch_delay_sec", "travel_time_sec", "response_time_sec", "number_of_alarms",
    "final_priority",
)
CATEGORIES = (
    "call_type_group", "call_type", "battalion", "station_area", "unit_type",
    "neighborhoods_analysis_boundaries",
)
TREES = 250
MIN_LEAF = 3
#: Groups of the rows of one combination of inputs, and the tasks that trees are grown by.
GROUPS = 32
GROW_TASKS = 8
SEED = 33


def time_features(df: DataFrame, ts: str) -> DataFrame:
    """Adds hour, weekday (Monday 0), month and a weekend flag."""
    moment = F.col(ts)
    return df.withColumns(
        {
            "hour": F.hour(moment),
            "dow": times.weekday_monday0(moment),
            "month": times.month(moment),
            "is_weekend": times.is_weekend(moment).cast("int"),
        }
    )


def target_columns() -> dict[str, Column]:
    """Targets as doubles: durations and alarms not below 0, priority whole and in 0..10."""
    cleaned = {name: casts.bounded_number(F.col(name), fill=0) for name in TARGETS[:-1]}
    cleaned["final_priority"] = casts.bounded_number(
        F.col("final_priority"), fill=3, low=0, high=10, digits=0
    )
    return cleaned


def feature_table(calls: DataFrame, sample: int | None = None) -> DataFrame:
    """Complete rows with time features and cleaned targets."""
    rows = calls if sample is None else sampling.sample_rows(calls, sample, ["call_number"])
    complete = shape.drop_incomplete(rows, ["received_ts", *TARGETS])
    return time_features(complete, "received_ts").withColumns(target_columns())


def distribution_profile(features: DataFrame, ts: str = "received_ts",
                         categories: Sequence[str] = CATEGORIES,
                         last_days: int | None = None) -> dict[str, DataFrame]:
    """Hour shares, category shares per weekday, and median rows per day for each weekday.

    ``last_days`` takes only the rows up to so many days before the latest one.
    """
    if last_days is not None:
        features = filters.trailing_days(features, ts, last_days)
    return {
        "hour_shares": agg.shares(features, ["hour"]),
        "category_shares": agg.category_shares(features, "dow", categories),
        "weekday_medians": agg.weekday_median(features, ts),
    }


def train_forest(features: DataFrame, targets: Sequence[str] = TARGETS,
                 inputs: Sequence[str] = FEATURES, trees: int = TREES, depth: int = 10) -> Mapping:
    """One random forest per target, trained on the cluster.

    All rows count, but trees are grown from groups of equal inputs: a split depends on the rows of each
    combination of inputs only through their number and average. A combination is split once more by a hash of the row into
    ``GROUPS`` groups, which a tree's bootstrap draws or leaves out together; with fewer rows a group is about a row. Leaves hold ``MIN_LEAF`` rows
    at least, by their weight. So the work of growing does not grow with the rows.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    group = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in features.columns]), F.lit(GROUPS))
    grouped = features.groupBy(*inputs, group.alias("_group")).agg(
        F.count(F.lit(1)).cast("double").alias("_rows"), *[F.avg(t).alias(t) for t in targets])
    path = scratch_path(features.sparkSession, "forest-groups")
    # A fixed order, so that the same rows give the same forest.
    stored = materialize(grouped.repartitionByRange(GROW_TASKS, *inputs, "_group").sortWithinPartitions(*inputs, "_group"),
                         "forest-groups", path)
    total = stored.agg(F.sum("_rows")).first()[0] or 1.0
    models = {}
    for target in targets:
        forest = RandomForestRegressor(
            featuresCol="_features", labelCol=target, predictionCol=f"pred_{target}", weightCol="_rows",
            numTrees=trees, minInstancesPerNode=1, minWeightFractionPerNode=min(MIN_LEAF / total, 0.499),
            maxDepth=depth, seed=SEED,
        )
        vector = VectorAssembler(inputCols=list(inputs), outputCol="_features")
        models[target] = Pipeline(stages=[vector, forest]).fit(stored)
    remove_path(features.sparkSession, path)
    return models


def predict(models: Mapping, features: DataFrame) -> DataFrame:
    """Adds one prediction per target, not below 0."""
    for target, model in models.items():
        name = f"pred_{target}"
        features = model.transform(features).drop("_features").withColumn(
            name, F.greatest(F.col(name), F.lit(0.0))
        )
    return features


def store_profile(profile: Mapping[str, DataFrame], folder: str) -> None:
    """Write each part of a profile as a table of its own."""
    for name, frame in profile.items():
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")


def load_profile(spark: SparkSession, folder: str,
                 names: Sequence[str] = ("hour_shares", "category_shares", "weekday_medians")) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def store_models(models: Mapping, folder: str) -> None:
    """Write each fitted model under the name of its target."""
    for target, model in models.items():
        model.write().overwrite().save(f"{folder}/{target}")


def load_models(folder: str, targets: Sequence[str] = TARGETS) -> Mapping:
    from pyspark.ml import PipelineModel

    return {target: PipelineModel.load(f"{folder}/{target}") for target in targets}


def rebuild_times(df: DataFrame, received: str = "received_ts") -> DataFrame:
    """Dispatch, on-scene and response times from the received time and the durations.

    Durations are rounded to whole seconds, halves to the even one.
    """
    start = F.col(received)
    whole = {c: F.rint(F.col(c)).cast("int") for c in TARGETS[:3]}
    dispatch = times.add_seconds(start, whole["dispatch_delay_sec"])
    return df.withColumns(
        {
            "dispatch_ts": dispatch,
            "on_scene_ts": times.add_seconds(dispatch, whole["travel_time_sec"]),
            "response_ts": times.add_seconds(start, whole["response_time_sec"]),
        }
    )


def derive_incidents(calls: DataFrame, header: Sequence[str], incident: str = "Incident Number",
                     call: str = "Call Number", received: str = "Received DtTm") -> DataFrame:
    """Raw incidents from raw calls: lowest call number and earliest time per incident.

    The result has all columns of the incidents header; those not derived are NULL.
    """
    moment = F.try_to_timestamp(F.col(f"`{received}`"), F.lit(times.RAW_TIMESTAMP_FORMAT)).cast(times.NTZ)
    first = calls.groupBy(F.col(f"`{incident}`").alias("IncidentNumber")).agg(
        F.min(f"`{call}`").alias("CallNumber"), F.min(moment).alias("_alarm")
    )
    derived = first.select(
        "IncidentNumber", "CallNumber",
        times.raw_date_text(F.col("_alarm")).alias("IncidentDate"),
        times.raw_timestamp_text(F.col("_alarm")).alias("AlarmDtTm"),
    )
    return shape.to_header(derived, header)
