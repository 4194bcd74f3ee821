"""The whole load: raw text to published staging and curated layers."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.operators.quality import (
    layer_violations,
    require_clean,
    row_count_mismatches,
    table_row_counts,
    table_violations,
)
from parcelflow.plans.features import order_features
from parcelflow.plans.staging import stage
from parcelflow.plans.targets import model_dataset, order_targets
from parcelflow.schemas import CURATED, ORDER_FEATURES, ORDER_TARGETS, STAGING
from parcelflow.sources.lake import CURATED_LAYER, RAW, STAGING_LAYER, Lake, new_run_id
from parcelflow.sources.manifests import compare_manifests, manifest_entries, validate_files
from parcelflow.sources.raw_csv import raw_path, read_raw


class RowCountError(ValueError):
    """A raw table does not hold the rows its manifest promises."""


def _side_by_side(load: Callable[[str], DataFrame], names: Iterable[str]) -> dict[str, DataFrame]:
    """Load independent tables at the same time: the small ones ride along."""
    names = list(names)
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        return dict(zip(names, pool.map(load, names)))


def load_raw(
    lake: Lake,
    folder: str,
    run_id: str,
    expected: DataFrame | None = None,
    reader: Callable[[SparkSession, str, str], DataFrame] = read_raw,
) -> dict[str, DataFrame]:
    """Copy every CSV table; with ``expected`` (table_name, row_count) check the counts.
    ``read_raw_ranges`` as ``reader`` reads large files by many tasks."""

    def load(name: str) -> DataFrame:
        return lake.write(reader(lake.spark, raw_path(folder, name), name), run_id, RAW, name)

    tables = _side_by_side(load, STAGING)
    if expected is not None:
        wrong = row_count_mismatches(table_row_counts(tables), expected).first()
        if wrong:
            raise RowCountError(
                f"Table {wrong['table_name']} has {wrong['loaded_row_count']} rows, "
                f"expected {wrong['expected_row_count']}."
            )
    return tables


def load_staging(lake: Lake, raw: dict[str, DataFrame], run_id: str) -> dict[str, DataFrame]:
    """Type every raw table, then require all declared keys and references."""

    def load(name: str) -> DataFrame:
        return lake.write(stage(raw[name], name), run_id, STAGING_LAYER, name)

    tables = _side_by_side(load, raw)
    require_clean(layer_violations(tables, STAGING))
    return tables


def load_curated(lake: Lake, staging: dict[str, DataFrame], run_id: str) -> dict[str, DataFrame]:
    """Write features, then targets from the written features, and check both."""
    features = lake.write(
        order_features(
            staging["orders"],
            staging["customers"],
            staging["order_items"],
            staging["order_payments"],
            staging["sellers"],
            staging["products"],
            staging["geolocation"],
        ),
        run_id,
        CURATED_LAYER,
        ORDER_FEATURES.name,
    )
    targets = lake.write(
        order_targets(features, staging["orders"]), run_id, CURATED_LAYER, ORDER_TARGETS.name
    )
    tables = {ORDER_FEATURES.name: features, ORDER_TARGETS.name: targets}
    report = table_violations(features, ORDER_FEATURES, tables).unionByName(
        table_violations(targets, ORDER_TARGETS, tables)
    )
    require_clean(report)
    return tables


def run_ingestion(
    spark: SparkSession,
    folder: str,
    root: str,
    expected: DataFrame | None = None,
    run_id: str | None = None,
    reader: Callable[[SparkSession, str, str], DataFrame] = read_raw,
) -> str:
    """Load all layers and publish them together; on any failure the previously
    published run stays the visible one."""
    lake = Lake(spark, root)
    run_id = run_id or new_run_id()
    raw = load_raw(lake, folder, run_id, expected, reader)
    staging = load_staging(lake, raw, run_id)
    load_curated(lake, staging, run_id)
    lake.publish(run_id)
    return run_id


def validated_ingestion(
    spark: SparkSession,
    folder: str,
    root: str,
    benchmark: DataFrame | None,
    latest: DataFrame | None = None,
) -> str:
    """Check the files against the benchmark manifest, compare the latest manifest with
    it if there is one, then load. Manifests are typed rows."""
    validate_files(spark, folder, benchmark)
    if latest is not None:
        compare_manifests(manifest_entries(benchmark), manifest_entries(latest))
    return run_ingestion(spark, folder, root, expected_row_counts(benchmark))


def published_model_dataset(lake: Lake, task: str, run_id: str | None = None) -> DataFrame:
    """The model dataset of one task in the published (or given) run."""
    run_id = run_id or lake.current_run()
    tables = lake.read_layer(CURATED_LAYER, CURATED, run_id)
    return model_dataset(tables[ORDER_FEATURES.name], tables[ORDER_TARGETS.name], task)


def expected_row_counts(manifest: DataFrame) -> DataFrame:
    """(table_name, row_count) from typed manifest rows."""
    return manifest.select(F.col("file_id").alias("table_name"), "row_count")
