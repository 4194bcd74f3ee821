"""Stored splits: written once, never replaced, checked again when loaded."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.plans.split import SplitConfig, SplitError, split_sizes, validate_split


def _folder(root: str, split_id: str) -> str:
    return f"{root.rstrip('/')}/{split_id}"


def split_exists(spark: SparkSession, root: str, split_id: str) -> bool:
    try:
        # The metadata are written last: without them the split was never finished.
        spark.read.text(f"{_folder(root, split_id)}/metadata")
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def save_split(
    root: str, dataset: DataFrame, assignment: DataFrame, config: SplitConfig
) -> bool:
    """Validate, then store members and metadata; False when the id is already taken."""
    spark = dataset.sparkSession
    validate_split(dataset, assignment, config)
    if split_exists(spark, root, config.split_id):
        return False
    folder = _folder(root, config.split_id)
    members = assignment.select("order_id", "split")
    members.write.mode("overwrite").partitionBy("split").parquet(f"{folder}/members")
    sizes = split_sizes(dataset.count(), config)
    metadata = spark.range(1).select(
        F.lit(config.split_id).alias("split_id"),
        F.lit("chronological").alias("strategy"),
        F.lit(None).cast("int").alias("split_seed"),
        F.lit(config.test_fraction).cast("double").alias("test_fraction"),
        F.lit(config.validation_fraction).cast("double").alias("validation_fraction"),
        F.struct(*[F.lit(n).cast("bigint").alias(s) for s, n in sizes.items()]).alias(
            "sample_counts"
        ),
    )
    metadata.coalesce(1).write.mode("overwrite").json(f"{folder}/metadata")
    return True


def load_split(root: str, dataset: DataFrame, config: SplitConfig) -> DataFrame:
    """Members (order_id, split) of a stored split, valid for ``dataset``."""
    spark = dataset.sparkSession
    if not split_exists(spark, root, config.split_id):
        raise FileNotFoundError(f"The split '{config.split_id}' does not exist in {root}.")
    members = spark.read.parquet(f"{_folder(root, config.split_id)}/members").select(
        "order_id", "split"
    )
    stored = {r["split"] for r in members.select("split").distinct().collect()}
    missing = [n for n in config.names if n not in stored]
    if missing:
        raise SplitError(f"The stored split lacks the members: {missing}.")
    validate_split(dataset, members, config)
    return members


def load_split_metadata(spark: SparkSession, root: str, split_id: str) -> DataFrame:
    return spark.read.json(
        f"{_folder(root, split_id)}/metadata",
        schema=(
            "split_id string, strategy string, split_seed int, test_fraction double, "
            "validation_fraction double, "
            "sample_counts struct<train:bigint,validation:bigint,test:bigint>"
        ),
    )
