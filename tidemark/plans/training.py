"""Training data and distributed regression fits for the trip and sensor models."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timekeys import round_to_minutes
from tidemark.operators.filters import features_of
from tidemark.operators.lookup import FeatureLookup, lookup_features, training_set
from tidemark.operators.metrics import regression_metrics
from tidemark.operators.split import hash_split
from tidemark.session import cut_lineage, require_utc, use_checkpoints
from tidemark.sources.feature_table import FeatureTable
from tidemark.sources.tables import quoted

# Features fetched for a trip, and the columns kept away from its model. Fixed values.
PICKUP_FEATURES = ("mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip")
DROPOFF_FEATURES = ("count_trips_window_30m_dropoff_zip", "dropoff_is_weekend")
ROUNDED_TIMES = ("rounded_pickup_datetime", "rounded_dropoff_datetime")
TRIP_LABEL = "fare_amount"
SENSOR_LABEL = "mean_temp_1h"
SENSOR_EXCLUDED = ("sensor_id", "event_time", "yyyy_mm")
PART_ROWS = 1_000_000  # rows that a task of a forest's fit holds at most


def rounded_trips(trips: DataFrame, direction: str = "up", view: str | None = None) -> DataFrame:
    """Replace pickup and dropoff times by their 15- and 30-minute grid times.

    Rounding up makes the newest matching pickup window contain the trip itself, so its own
    fare is part of a feature; ``direction="down"`` uses only windows closed before the trip.
    """
    rounded = trips.withColumns(
        {
            "rounded_pickup_datetime": round_to_minutes(F.col("tpep_pickup_datetime"), 15, direction),
            "rounded_dropoff_datetime": round_to_minutes(F.col("tpep_dropoff_datetime"), 30, direction),
        }
    ).drop("tpep_pickup_datetime", "tpep_dropoff_datetime")
    if view:
        rounded.createOrReplaceTempView(view)
    return rounded


def pickup_lookup(features: DataFrame, timestamp_key: str = "tpep_pickup_datetime") -> FeatureLookup:
    return FeatureLookup(
        features, PICKUP_FEATURES, ("pickup_zip",), "rounded_pickup_datetime", ("zip",), timestamp_key
    )


def dropoff_lookup(features: DataFrame, timestamp_key: str = "tpep_dropoff_datetime") -> FeatureLookup:
    return FeatureLookup(
        features, DROPOFF_FEATURES, ("dropoff_zip",), "rounded_dropoff_datetime", ("zip",), timestamp_key
    )


def trip_lookups(spark: SparkSession, pickup_table: str, dropoff_table: str) -> list[FeatureLookup]:
    """Lookups into the two stored trip feature tables."""
    pickup, dropoff = FeatureTable(spark, pickup_table), FeatureTable(spark, dropoff_table)
    return [
        pickup.lookup(PICKUP_FEATURES, ["pickup_zip"], "rounded_pickup_datetime"),
        dropoff.lookup(DROPOFF_FEATURES, ["dropoff_zip"], "rounded_dropoff_datetime"),
    ]


def trip_training_set(trips: DataFrame, lookups: Sequence[FeatureLookup], direction: str = "up") -> DataFrame:
    """Trips with rounded times looked up in both feature tables, ready for a model."""
    return training_set(rounded_trips(trips, direction), lookups, TRIP_LABEL, ROUNDED_TIMES)


@dataclass(frozen=True)
class ScoringModel:
    """A fitted model together with the lookups its inputs need."""

    fitted: PipelineModel
    inputs: Sequence[str]
    label: str
    lookups: Sequence[FeatureLookup] = ()

    def score(self, df: DataFrame) -> DataFrame:
        """Repeat the lookups of training on ``df`` and add a ``prediction`` column."""
        found = lookup_features(df, self.lookups) if self.lookups else df
        return self.fitted.transform(found).drop("features")

    def save(self, spark: SparkSession, path: str, lookup_tables: Sequence[str] = ()) -> None:
        """Store the model, and the names of the feature tables its lookups read."""
        if len(lookup_tables) != len(self.lookups):
            raise ValueError("name one feature table per lookup")
        self.fitted.write().overwrite().save(f"{path}/model")
        lookups = [
            {
                "table": table,
                "feature_names": list(lookup.feature_names),
                "lookup_key": list(lookup.lookup_key),
                "timestamp_lookup_key": lookup.timestamp_lookup_key,
                "rename": lookup.rename,
            }
            for table, lookup in zip(lookup_tables, self.lookups, strict=True)
        ]
        about = json.dumps({"inputs": list(self.inputs), "label": self.label, "lookups": lookups})
        spark.createDataFrame([(about,)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ScoringModel:
        about = json.loads(spark.read.text(f"{path}/about").first()[0])
        for saved in about["lookups"]:
            saved.pop("slot", None)  # models stored before lookups went without time slots
        lookups = [FeatureTable(spark, saved.pop("table")).lookup(**saved) for saved in about["lookups"]]
        return cls(PipelineModel.load(f"{path}/model"), about["inputs"], about["label"], lookups)


def _assembled(inputs: Sequence[str], missing: float) -> list:
    """Stages that turn input columns into a vector; an absent feature becomes ``missing``."""
    filled = ", ".join(f"coalesce(cast(`{c}` AS double), {missing}D) AS `__in_{c}`" for c in inputs)
    vector = VectorAssembler(inputCols=[f"__in_{c}" for c in inputs], outputCol="features")
    tidy = ", ".join(f"`__in_{c}`" for c in inputs)
    return [
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        vector,
        SQLTransformer(statement=f"SELECT * EXCEPT ({tidy}) FROM __THIS__"),
    ]


def fit_boosted(
    train: DataFrame,
    label: str,
    inputs: Sequence[str],
    rounds: int = 100,
    depth: int = 5,
    seed: int = 123,
    missing: float = -1.0,
    lookups: Sequence[FeatureLookup] = (),
) -> ScoringModel:
    """Gradient-boosted regression trees; depth 5 allows 32 leaves per tree."""
    use_checkpoints(train.sparkSession)
    trees = GBTRegressor(
        labelCol=label, featuresCol="features", maxIter=rounds, maxDepth=depth, seed=seed, checkpointInterval=10
    )
    fitted = Pipeline(stages=[*_assembled(inputs, missing), trees]).fit(train)
    return ScoringModel(fitted, list(inputs), label, lookups)


def fit_forest(
    train: DataFrame,
    label: str,
    inputs: Sequence[str],
    trees: int = 50,
    depth: int = 8,
    seed: int = 42,
    missing: float = -1.0,
    lookups: Sequence[FeatureLookup] = (),
) -> ScoringModel:
    """Random forest regression.

    Each level passes over all rows for all trees, so the rows are dealt out evenly first, as the files
    they come from are not. Rows of near labels lie together: they mostly walk through the same nodes.
    """
    cores = train.sparkSession.sparkContext.defaultParallelism
    parts = max(2 * cores, -(-train.count() // PART_ROWS))
    train = train.select(*[F.col(quoted(c)) for c in (*inputs, label)]).repartition(parts).sortWithinPartitions(quoted(label))
    forest = RandomForestRegressor(labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed)
    fitted = Pipeline(stages=[*_assembled(inputs, missing), forest]).fit(train)
    return ScoringModel(fitted, list(inputs), label, lookups)


def train_trip_model(
    trips: DataFrame,
    lookups: Sequence[FeatureLookup],
    key: str | None = None,
    rounds: int = 100,
    direction: str = "up",
) -> tuple[ScoringModel, DataFrame]:
    """Fit the fare model on 75 % of the trips; returns it with its metrics on the rest.

    Trips are told apart by ``key``, by default ``trip_id`` where they have one, else by the
    whole row.
    """
    require_utc(trips.sparkSession)
    key = key or ("trip_id" if "trip_id" in trips.columns else None)
    # Stored once: fitting and testing pass over the joined rows several times.
    rows = cut_lineage(trip_training_set(trips, lookups, direction), "training")
    train, test = hash_split(rows, key, 75, 123)
    inputs = features_of(rows, TRIP_LABEL, (key,) if key else ())
    # The looked-up features are part of the training rows here, so scoring `test` needs no lookup.
    fitted = fit_boosted(train, TRIP_LABEL, inputs, rounds)
    scored = fitted.score(test)
    return (
        ScoringModel(fitted.fitted, inputs, TRIP_LABEL, lookups),
        regression_metrics(scored, "prediction", TRIP_LABEL),
    )


def sensor_training_rows(gold_rows: DataFrame) -> DataFrame:
    """Complete gold rows, with the row identity kept as the split key.

    An hour with a single 5-minute row has no deviation and drops out.
    """
    whole = gold_rows.na.drop()
    return whole.withColumn("row_key", F.concat_ws("|", F.col("sensor_id"), F.col("event_time"))).drop(
        *SENSOR_EXCLUDED
    )


def train_sensor_model(
    gold_rows: DataFrame, label: str = SENSOR_LABEL, trees: int = 50
) -> tuple[ScoringModel, DataFrame, DataFrame]:
    """Fit the forest on 80 % of the gold rows; returns it, test metrics and an input example."""
    require_utc(gold_rows.sparkSession)
    # Stored once: the fit, the metrics and the example would else compute the gold rows again.
    rows = cut_lineage(sensor_training_rows(gold_rows), "sensor-training")
    train, test = hash_split(rows, "row_key", 80, 42)
    inputs = features_of(rows, label, ("row_key",))
    model = fit_forest(train, label, inputs, trees)
    return model, regression_metrics(model.score(test), "prediction", label), input_example(test, "row_key", inputs)


def input_example(rows: DataFrame, key: str, inputs: Sequence[str], count: int = 5) -> DataFrame:
    """The inputs of the first rows by key, to be kept beside a model."""
    return rows.orderBy(key).limit(count).select(*inputs)
