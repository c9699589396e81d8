"""Global demand model: one gradient-boosted tree ensemble for all zones.

``boosting`` grows the trees over the feature rows, leaf-wise for the absolute
error, with the settings of the single-machine trainer that this replaces; the zone
is a categorical feature, so trees split on sets of zones instead of a one-hot
explosion. Growing stops ``patience`` rounds after the best on the validation rows,
and the ensemble is cut there.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.columns import clip_nonneg
from tripflow.operators import boosting
from tripflow.operators.platinum import ZONE
from tripflow.session import ship_package

# The model's feature list (zone first, categorical) and target.
FEATURE_COLS = [
    "pu_location_id",
    "pickup_hour",
    "day_of_week",
    "month",
    "trip_year",
    "is_weekend",
    "is_rush_hour",
    "is_night",
    "lag_1h",
    "lag_24h",
    "lag_168h",
    "avg_fare",
    "avg_distance",
    "avg_passengers",
]
TARGET = "trip_count"
# Same-hour averages are only known after the hour; the leak-free list uses
# the previous hour's instead (see ``add_lagged_averages``).
AVG_FEATURES = ("avg_fare", "avg_distance", "avg_passengers")
LEAK_FREE_FEATURES = [f"{c}_lag_1h" if c in AVG_FEATURES else c for c in FEATURE_COLS]
ZONE_INDEX = "zone_index"


@dataclass
class ModelParams(boosting.Settings):
    """Boosting settings and the model's features."""

    features: list = field(default_factory=lambda: list(FEATURE_COLS))

    @classmethod
    def leak_free(cls, **kw) -> "ModelParams":
        """Features known before the predicted hour only."""
        return cls(features=list(LEAK_FREE_FEATURES), **kw)


def add_lagged_averages(series: DataFrame) -> DataFrame:
    """Previous-hour averages per zone (for the leak-free feature list).
    Apply to the whole series before splitting."""
    from tripflow.operators.platinum import series_window

    w = series_window()
    return series.withColumns({f"{c}_lag_1h": F.lag(c, 1).over(w) for c in AVG_FEATURES})


def validation_split(train: DataFrame, days: int) -> tuple[DataFrame, DataFrame]:
    """Carve the last ``days`` of the training rows off as validation, so
    early stopping never looks at the test set."""
    last = train.select(F.max("datetime")).scalar()
    cutoff = last - F.make_dt_interval(F.lit(days))
    return train.filter(F.col("datetime") <= cutoff), train.filter(F.col("datetime") > cutoff)


def assembled_inputs(features) -> list[str]:
    return [ZONE_INDEX if c == ZONE else c for c in features]


def feature_pipeline(features=None) -> list:
    """M2: zone -> categorical index (unseen zones kept as an extra
    category), then one feature vector."""
    features = list(FEATURE_COLS if features is None else features)
    indexer = StringIndexer(
        inputCol=ZONE, outputCol=ZONE_INDEX, handleInvalid="keep", stringOrderType="alphabetAsc"
    )
    assembler = VectorAssembler(
        inputCols=assembled_inputs(features), outputCol="features", handleInvalid="keep"
    )
    return [indexer, assembler]


def zone_number(labels: list[str]) -> Column:
    """A zone's place among ``labels``; their number for a zone not there."""
    place = F.array_position(F.array(*[F.lit(x) for x in labels]).cast("array<string>"), F.col(ZONE).cast("string"))
    return F.when(place > 0, place - 1).otherwise(len(labels)).cast("double")


def numbered(df: DataFrame, labels: list[str], features: list[str]) -> DataFrame:
    """The features as the model reads them, the zone as its number."""
    own = [zone_number(labels).alias(ZONE_INDEX) if c == ZONE else F.col(c).cast("double") for c in features]
    return df.select(*own, TARGET)


@dataclass
class TrainedModel:
    model: boosting.Ensemble
    best_iteration: int
    validation_loss: list
    features: list


def train_demand_model(
    train: DataFrame, valid: DataFrame | None = None, params: ModelParams | None = None
) -> TrainedModel:
    """M3: boosting on ``train`` until ``patience`` rounds after the best on
    ``valid``; the ensemble is cut at the best."""
    p = params or ModelParams()
    if p.features[0] != ZONE:
        raise ValueError("the zone is the first feature")
    zone = F.col(ZONE).cast("string")
    # One label a zone, not a trip.
    labels = sorted(r[0] for r in train.where(zone.isNotNull()).select(zone).distinct().collect())
    sides = [None if df is None else numbered(df, labels, p.features) for df in (train, valid)]
    names = assembled_inputs(p.features)
    model, losses = boosting.fit(sides[0], sides[1], names, TARGET, labels, p)
    model.features = list(p.features)
    return TrainedModel(model, model.rounds, losses, p.features)


def score(model: boosting.Ensemble, df: DataFrame) -> DataFrame:
    """M4: predictions clipped at zero, beside the input's columns."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def predict(*columns: pd.Series) -> pd.Series:
        x = pd.concat(columns, axis=1).to_numpy(dtype=float)
        return pd.Series(shared.value.predict(x))

    inputs = [zone_number(model.labels) if c == ZONE else F.col(c).cast("double") for c in model.features]
    return df.withColumn("prediction", clip_nonneg(predict(*inputs)))


def feature_importance(trained: TrainedModel, spark) -> DataFrame:
    """M5: each feature's share of the gain of all splits, descending."""
    imp = trained.model.importance().tolist()
    rows = list(zip(trained.features, [float(x) for x in imp]))
    return spark.createDataFrame(rows, "feature STRING, importance DOUBLE").orderBy(
        F.col("importance").desc(), "feature"
    )


def save_model(trained: TrainedModel, path: str) -> str:
    """M6: the trees with the feature list and the zones."""
    return trained.model.save(SparkSession.active(), path)


def load_model(path: str) -> boosting.Ensemble:
    return boosting.Ensemble.load(SparkSession.active(), path)


def model_features(model: boosting.Ensemble) -> list[str]:
    """The feature list stored with a saved model."""
    return list(model.features)
