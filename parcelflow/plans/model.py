"""Gradient-boosted delivery-risk classifier on Spark ML."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.plans.metrics import predicted_class
from parcelflow.schemas import CATEGORICAL_INPUTS, NUMERIC_INPUTS
from parcelflow.session import materialize

# Below every real value, so that one split can send the missing rows to a side.
_MISSING = -1.0e6
# Weight of the overall rate in the rate of a category, in rows.
_SMOOTHING = 20.0
# Training rows get the rates of the other folds.
_FOLDS = 5


@dataclass(frozen=True)
class BoostingConfig:
    """Spark's trees have no cap on a leaf's step, and a leaf's minimum weight is a
    number of rows."""

    learning_rate: float = 0.1
    n_estimators: int = 100
    max_depth: int = 3
    random_state: int = 42
    gamma: float = 0.0
    min_child_weight: int = 10
    ratio: float = 1.0
    threshold: float = 0.5
    max_bins: int = 64


def with_fold(train: DataFrame) -> DataFrame:
    """A fold for every row from its inputs; the target decides nothing."""
    inputs = [c for c in train.columns if c != "target"]
    return train.withColumn("fold", F.pmod(F.xxhash64(*inputs), F.lit(_FOLDS)).cast("int"))


def _rate(positives, n, overall):
    return (positives + F.lit(_SMOOTHING) * overall) / (n + F.lit(_SMOOTHING))


@dataclass(frozen=True)
class CategoryRates:
    """Share of positives per category, learned from training rows only.

    Trees split an ordered number, and ordering categories by their positive share is
    the best order for a two-class split; an unseen category gets the overall share.
    A training row gets the share in the other folds, so its own label is not in its input.
    """

    column: str
    rates: DataFrame
    overall: float
    other_folds: DataFrame | None = None

    @classmethod
    def fit(cls, train: DataFrame, column: str) -> CategoryRates:
        """``train`` may have a ``fold``; without one all rows count as one fold."""
        if "fold" not in train.columns:
            train = train.withColumn("fold", F.lit(0))
        name = f"{column}_rate"
        by_fold = materialize(
            train.groupBy(column, "fold").agg(
                F.count("*").alias("n"), F.sum("target").alias("positives")
            )
        )
        totals = by_fold.agg(F.sum("n").alias("n"), F.sum("positives").alias("positives")).first()
        overall = totals["positives"] / totals["n"]
        counted = by_fold.groupBy(column).agg(
            F.sum("n").alias("all_n"), F.sum("positives").alias("all_positives")
        )
        rates = counted.select(
            column, _rate(F.col("all_positives"), F.col("all_n"), F.lit(overall)).alias(name)
        )
        # The overall share without the fold; of a single fold, that of all rows.
        without = by_fold.groupBy("fold").agg(
            F.coalesce(
                F.try_divide(
                    F.lit(totals["positives"]) - F.sum("positives"),
                    F.lit(totals["n"]) - F.sum("n"),
                ),
                F.lit(overall),
            ).alias("without")
        )
        others = (
            by_fold.join(counted, column)
            .join(without, "fold")
            .select(
                column,
                "fold",
                _rate(
                    F.col("all_positives") - F.col("positives"),
                    F.col("all_n") - F.col("n"),
                    F.col("without"),
                ).alias(name),
            )
        )
        return cls(column, rates, overall, others)

    def apply(self, df: DataFrame, training: bool = False) -> DataFrame:
        if training:
            joined = df.join(self.other_folds, [self.column, "fold"], "left")
        else:
            joined = df.join(self.rates, self.column, "left")
        return joined.withColumn(
            f"{self.column}_rate", F.coalesce(f"{self.column}_rate", F.lit(self.overall))
        )


@dataclass(frozen=True)
class DeliveryRiskModel:
    config: BoostingConfig
    encoders: tuple[CategoryRates, ...]
    trees: GBTClassificationModel

    @classmethod
    def fit(
        cls,
        train: DataFrame,
        config: BoostingConfig = BoostingConfig(),
        validation: DataFrame | None = None,
    ) -> DeliveryRiskModel:
        """Train on rows with the 32 model inputs and ``target``.

        With ``validation`` rows the boosting stops when they no longer improve.
        """
        train = with_fold(train)
        encoders = tuple(CategoryRates.fit(train, c) for c in CATEGORICAL_INPUTS)

        def labelled(rows: DataFrame, held_out: bool) -> DataFrame:
            return _vectors(rows, encoders, training=not held_out).select(
                "features",
                F.col("target").cast("double").alias("label"),
                F.when(F.col("target") == 1, config.ratio).otherwise(1.0).alias("weight"),
                F.lit(held_out).alias("held_out"),
            )

        vectors = labelled(train, False)
        if validation is not None:
            vectors = vectors.unionByName(labelled(validation, True))
        booster = GBTClassifier(
            featuresCol="features",
            labelCol="label",
            weightCol="weight",
            maxIter=config.n_estimators,
            maxDepth=config.max_depth,
            stepSize=config.learning_rate,
            seed=config.random_state,
            minInfoGain=config.gamma,
            minInstancesPerNode=max(1, int(config.min_child_weight)),
            maxBins=config.max_bins,
        )
        if validation is not None:
            booster = booster.setValidationIndicatorCol("held_out")
        # Boosting reads its input once per tree level: cut the lineage first.
        return cls(config, encoders, booster.fit(materialize(vectors)))

    def save(self, path: str) -> None:
        """Store trees, category rates and configuration below ``path``."""
        spark = self.encoders[0].rates.sparkSession
        self.trees.write().overwrite().save(f"{path}/trees")
        for encoder in self.encoders:
            encoder.rates.write.mode("overwrite").parquet(f"{path}/rates/{encoder.column}")
        told = {"config": asdict(self.config), "overall": {e.column: e.overall for e in self.encoders}}
        about = spark.range(1).select(F.lit(json.dumps(told)).alias("about"))
        about.write.mode("overwrite").parquet(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> DeliveryRiskModel:
        """A stored model; it predicts as before."""
        told = json.loads(spark.read.parquet(f"{path}/about").first()["about"])
        encoders = tuple(
            CategoryRates(c, spark.read.parquet(f"{path}/rates/{c}"), told["overall"][c])
            for c in CATEGORICAL_INPUTS
        )
        trees = GBTClassificationModel.load(f"{path}/trees")
        return cls(BoostingConfig(**told["config"]), encoders, trees)

    def predict(self, rows: DataFrame, keep: tuple[str, ...] = ("order_id",)) -> DataFrame:
        """``keep`` columns with ``probability`` and the ``predicted`` class."""
        scored = self.trees.transform(_vectors(rows, self.encoders))
        return scored.select(
            *keep, vector_to_array("probability")[1].alias("probability")
        ).withColumn("predicted", predicted_class(self.config.threshold))


def _vectors(
    rows: DataFrame, encoders: tuple[CategoryRates, ...], training: bool = False
) -> DataFrame:
    for encoder in encoders:
        rows = encoder.apply(rows, training)
    rows = rows.withColumns({c: F.coalesce(c, F.lit(_MISSING)) for c in NUMERIC_INPUTS})
    inputs = [f"{e.column}_rate" for e in encoders] + NUMERIC_INPUTS
    return VectorAssembler(inputCols=inputs, outputCol="features").transform(rows)
