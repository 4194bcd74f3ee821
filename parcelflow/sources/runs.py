"""Append-only record of model runs: parameters, metrics, predictions and loss curves.

Every attempt to record a run writes rows of its own; the attempt whose commit file is created
first is the run. Readers see the rows of committed attempts only, so neither a crash nor two
writers of one id can leave a mixture.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.sources.commits import put_if_absent, records

_COMMIT = "run_id string, attempt string"
_INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"


def _path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def _commits(spark: SparkSession, root: str) -> DataFrame | None:
    return records(spark, _path(root, "commits"), _COMMIT)


def run_exists(spark: SparkSession, root: str, run_id: str) -> bool:
    rows = _commits(spark, root)
    return rows is not None and not rows.where(F.col("run_id") == run_id).isEmpty()


def _file_name(run_id: str) -> str:
    """A run id as a plain file name, different for different ids."""
    return run_id.encode().hex()


def refuse_recorded(spark: SparkSession, root: str, run_id: str) -> None:
    if run_exists(spark, root, run_id):
        raise ValueError(f"The run '{run_id}' is already recorded.")


def model_path(root: str, run_id: str) -> str:
    """Where the fitted model of a run is stored."""
    return _path(root, f"models/{quote(run_id, safe='')}")


def record_run(
    root: str,
    run_id: str,
    params: Mapping[str, object],
    metrics: DataFrame,
    predictions: DataFrame,
    input_types: Mapping[str, str],
    curve: DataFrame | None = None,
) -> None:
    """Add one run; an id that was used before is refused, so nothing is overwritten. Of two
    writers of one id the second fails, however close they are.

    Predictions stay one row per order, so equal probabilities never collapse.
    """
    spark = predictions.sparkSession
    refuse_recorded(spark, root, run_id)
    attempt = uuid.uuid4().hex
    named = F.lit(run_id).alias("run_id")

    def pairs(values: Mapping[str, object]) -> DataFrame:
        rows = [
            F.struct(F.lit(k).alias("name"), F.lit(str(v)).alias("value"))
            for k, v in values.items()
        ]
        return spark.range(1).select(named, F.inline(F.array(*rows)))

    def append(df: DataFrame, table: str) -> None:
        # A folder of its own: jobs that write to one folder disturb each other.
        df.write.parquet(_path(root, f"{table}/attempt={attempt}"))

    append(predictions.select(named, *predictions.columns), "predictions")
    append(metrics.select(named, "metric", "value"), "metrics")
    append(pairs(input_types), "input_types")
    append(pairs(params), "runs")
    if curve is not None:
        append(curve.select(named, *curve.columns), "curves")
    commit = {"run_id": run_id, "attempt": attempt}
    if not put_if_absent(spark, _path(root, "commits"), _file_name(run_id), commit):
        raise ValueError(f"The run '{run_id}' is already recorded.")


def read_runs(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of all committed runs; run ids stay text, whatever they look like."""
    before = spark.conf.get(_INFERENCE)
    spark.conf.set(_INFERENCE, "false")
    try:
        rows = spark.read.parquet(_path(root, table))
        commits = _commits(spark, root)
        if commits is None:
            return rows.limit(0).drop("attempt")
        return rows.join(commits, ["run_id", "attempt"], "left_semi").drop("attempt")
    finally:
        spark.conf.set(_INFERENCE, before)
