"""Named queries over a folder of test tables: name -> callable(spark, folder)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow import adapters as a
from parcelflow.operators import profiling, quality
from parcelflow.operators.prefix import global_rank
from parcelflow.plans import features as f
from parcelflow.plans import durations, history, metrics, staging, targets
from parcelflow.plans import split as s
from parcelflow.plans.boosting import NewtonConfig, NewtonModel, first_splits
from parcelflow.plans.model import BoostingConfig, DeliveryRiskModel
from parcelflow.schemas import ORDER_PAYMENTS, ORDER_TARGETS, STAGING
from parcelflow.session import checkpoint_folder, materialize
from parcelflow.sources import manifests
from parcelflow.sources.csv_ranges import read_raw_ranges
from parcelflow.sources.raw_csv import read_raw, write_raw, write_raw_files

Query = Callable[[SparkSession, str], DataFrame]

TABLES = tuple(a.TABLE_SCHEMAS)


def _doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles: the checking side reads both through one float type."""
    return df.select(
        *[
            F.col(c.name).cast("double").alias(c.name)
            if isinstance(c.dataType, T.DecimalType)
            else F.col(c.name)
            for c in df.schema.fields
        ]
    )


def _rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# --- composites ------------------------------------------------------------------


def _located(spark, d) -> tuple[DataFrame, DataFrame]:
    centroids = f.zip_centroids(a.geolocation(spark, d))
    return centroids, f.located_orders(a.orders(spark, d), a.customers(spark, d), centroids)


def order_features(spark: SparkSession, d: str, orders: DataFrame | None = None) -> DataFrame:
    return f.order_features(
        a.orders(spark, d) if orders is None else orders,
        a.customers(spark, d),
        a.order_items(spark, d),
        a.order_payments(spark, d),
        a.sellers(spark, d),
        a.products(spark, d),
        a.geolocation(spark, d),
    )


def _dataset(spark, d, task, orders: DataFrame | None = None) -> DataFrame:
    orders = a.orders(spark, d) if orders is None else orders
    return targets.model_dataset(order_features(spark, d, orders), targets.order_labels(orders), task)


def _labelled(spark, d, task="non_delivery") -> DataFrame:
    return targets.labelled_orders(a.orders(spark, d), task)


def _split(spark, d, config: s.SplitConfig, orders: DataFrame | None = None) -> DataFrame:
    # The split scans its input a few times: derive the narrow rows once, as the
    # published tables of a real run would be.
    labelled = _labelled(spark, d) if orders is None else targets.labelled_orders(orders, "non_delivery")
    return s.chronological_split(materialize(labelled), config)


OPTIMIZATION = s.optimization_split("non_delivery")
FINAL = s.final_evaluation_split("non_delivery")


# --- profiling -------------------------------------------------------------------


def profile_order_status(spark, d):
    return profiling.order_status_profile(a.orders(spark, d))


def profile_outcome_groups(spark, d):
    return profiling.outcome_profile(a.orders(spark, d))


def profile_late_target(spark, d):
    return profiling.late_target_profile(a.orders(spark, d))


def profile_timeline(spark, d):
    return profiling.timeline_profile(a.orders(spark, d))


def profile_fan_out(spark, d):
    return profiling.fan_out_profile(
        {
            "order_items": a.order_items(spark, d),
            "order_payments": a.order_payments(spark, d),
            "order_reviews": a.order_reviews(spark, d),
        }
    )


def profile_numeric_ranges(spark, d):
    return profiling.numeric_range_profile(
        a.order_items(spark, d), a.order_payments(spark, d), a.order_reviews(spark, d)
    )


def profile_zip_ambiguity(spark, d):
    return profiling.zip_ambiguity_profile(a.geolocation(spark, d))


# --- features and labels ---------------------------------------------------------


def zip_centroid_median(spark, d):
    return _rounded(f.zip_centroids(a.geolocation(spark, d)), 6, "latitude", "longitude")


def item_distance(spark, d):
    centroids, located = _located(spark, d)
    items = a.order_items(spark, d)
    details = f.item_details(
        items,
        located,
        a.sellers(spark, d),
        a.products(spark, d),
        centroids,
    )
    return _doubles(_rounded(details, 3, "seller_distance_km"))


def item_features(spark, d):
    centroids, located = _located(spark, d)
    return _doubles(
        f.order_item_features(
            a.order_items(spark, d), located, a.sellers(spark, d), a.products(spark, d), centroids
        )
    )


def payment_features(spark, d):
    return _doubles(f.payment_features(a.order_payments(spark, d)))


def order_features_query(spark, d):
    return _doubles(
        _rounded(order_features(spark, d), 6, "customer_latitude", "customer_longitude")
    )


def order_targets(spark, d):
    return targets.order_targets(order_features(spark, d), a.orders(spark, d))


def non_delivery_dataset(spark, d):
    return _doubles(
        _rounded(_dataset(spark, d, "non_delivery"), 6, "customer_latitude", "customer_longitude")
    )


def late_delivery_dataset(spark, d):
    return _doubles(
        _rounded(_dataset(spark, d, "late_delivery"), 6, "customer_latitude", "customer_longitude")
    )


def model_inputs(spark, d):
    dataset = targets.in_time_order(_dataset(spark, d, "non_delivery"))
    return _rounded(
        targets.model_inputs(dataset), 6, "customer_latitude", "customer_longitude"
    )


def calendar_parts(spark, d):
    return f.calendar_parts(a.orders(spark, d))


def approval_delay_hours(spark, d):
    return _doubles(f.lifecycle_durations(a.orders(spark, d)).drop("promised_delivery_days"))


def promised_delivery_days(spark, d):
    return _doubles(f.lifecycle_durations(a.orders(spark, d)).drop("approval_delay_hours"))


# --- staging and constraints -----------------------------------------------------


def _digested(reviews: DataFrame) -> DataFrame:
    """Whole messages compare by digest and length."""
    return reviews.withColumns(
        {
            "message_md5": F.md5("review_comment_message"),
            "message_length": F.length("review_comment_message"),
        }
    ).drop("review_comment_message")


def clean_blank_to_null(spark, d):
    return _digested(staging.stage(a.raw_order_reviews(spark, d), "order_reviews"))


def csv_round_trip(spark, d):
    path = f"{checkpoint_folder(spark)}/csv-{uuid.uuid4().hex}"
    write_raw(a.raw_order_reviews(spark, d), path)
    return _digested(staging.stage(read_raw(spark, path, "order_reviews"), "order_reviews"))


def csv_ranges(spark, d):
    """The same rows in large files, read in ranges that start inside quotes or not."""
    path = f"{checkpoint_folder(spark)}/csv-{uuid.uuid4().hex}"
    write_raw_files(a.raw_order_reviews(spark, d), path)
    return _digested(staging.stage(read_raw_ranges(spark, path, "order_reviews"), "order_reviews"))


def strict_cast_quarantine(spark, d):
    staged = staging.stage_or_quarantine(a.raw_order_payments(spark, d), "order_payments")
    return _doubles(
        staged.withColumn("quarantined_columns", F.concat_ws(",", "quarantined_columns"))
    )


def cast_violations(spark, d):
    return quality.cast_violations(a.raw_order_payments(spark, d), ORDER_PAYMENTS)


def _nullable_tables(spark, d) -> dict[str, DataFrame]:
    return {
        "orders": a.orders(spark, d),
        "products": a.products(spark, d),
        "order_payments": a.order_payments(spark, d),
    }


def not_null_violations(spark, d):
    checked = [
        quality.not_null_violations(df, name, df.columns)
        for name, df in _nullable_tables(spark, d).items()
    ]
    return checked[0].unionByName(checked[1]).unionByName(checked[2])


def _staging_tables(spark, d) -> dict[str, DataFrame]:
    return {
        "customers": a.customers(spark, d),
        "geolocation": a.geolocation(spark, d),
        "order_items": a.order_items(spark, d),
        "order_payments": a.order_payments(spark, d),
        "order_reviews": a.order_reviews(spark, d),
        "orders": a.orders(spark, d),
        "products": a.products(spark, d),
        "sellers": a.sellers(spark, d),
    }


def pk_violations(spark, d):
    parts = [
        quality.key_violations(df, name, STAGING[name].key)
        for name, df in _staging_tables(spark, d).items()
        if STAGING[name].key
    ]
    return _union(parts)


def fk_violations(spark, d):
    tables = _staging_tables(spark, d)
    # Only approved orders as parents: the other orders' children have no parent.
    tables["orders"] = tables["orders"].where(F.col("order_approved_at").isNotNull())
    parts = [
        quality.reference_violations(
            tables[name], name, ref.columns, tables[ref.parent], ref.parent_columns, ref.parent
        )
        for name, table in STAGING.items()
        if name in tables
        for ref in table.references
    ]
    return _union(parts)


def label_check_violations(spark, d):
    return _union(
        [
            quality.flag_violations(
                targets.order_labels(a.orders(spark, d)),
                ORDER_TARGETS.name,
                ORDER_TARGETS.binary_flags,
            ),
            quality.flag_violations(
                a.order_reviews(spark, d), "order_reviews", ["review_score"]
            ),
        ]
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def row_count_check(spark, d):
    """Tables whose rows outnumber their distinct keys, as a count check."""
    tables = _staging_tables(spark, d)
    keyed = {n: df for n, df in tables.items() if STAGING[n].key}
    distinct = {n: df.select(*STAGING[n].key).distinct() for n, df in keyed.items()}
    return quality.row_count_mismatches(
        quality.table_row_counts(keyed), quality.table_row_counts(distinct)
    )


# --- split -----------------------------------------------------------------------


def chronological_rank(spark, d):
    rows = _labelled(spark, d)
    return global_rank(rows, ["order_approved_at", "order_id"])


def chronological_split(spark, d):
    return _split(spark, d, OPTIMIZATION)


def final_eval_split(spark, d):
    return _split(spark, d, FINAL)


def _two_splits(spark, d) -> DataFrame:
    rows = materialize(_labelled(spark, d))
    final = s.chronological_split(rows, FINAL)
    final = final.withColumn("split", F.concat(F.lit("final_"), "split"))
    return s.chronological_split(rows, OPTIMIZATION).unionByName(final).select("order_id", "split")


def split_overlap(spark, d):
    names = ("train", "validation", "test", "final_train", "final_test")
    return s.split_overlap(_two_splits(spark, d), names)


def split_coverage(spark, d):
    """The non-delivery test rows counted twice, against the late-delivery orders."""
    both = _two_splits(spark, d).where(F.col("split") != "final_train")
    return s.split_coverage(_labelled(spark, d, "late_delivery"), both)


def split_class_coverage(spark, d):
    return s.split_class_coverage(_split(spark, d, OPTIMIZATION), OPTIMIZATION.names)


def split_members(spark, d):
    return s.split_members(_labelled(spark, d), _split(spark, d, OPTIMIZATION), OPTIMIZATION.names)


# --- model and metrics -----------------------------------------------------------


def threshold_confusion(spark, d):
    return metrics.threshold_metrics(a.scores(spark, d)).select(
        "tp",
        "fp",
        "fn",
        "tn",
        *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")],
    )


def log_loss_accuracy(spark, d):
    return metrics.threshold_metrics(a.scores(spark, d)).select(
        *[F.round(c, 9).alias(c) for c in ("loss", "accuracy", "positive_rate")]
    )


def average_precision(spark, d):
    return _rounded(metrics.ranking_metrics(a.scores(spark, d)), 9, "avg_precision").select(
        "avg_precision"
    )


def roc_auc(spark, d):
    return _rounded(metrics.ranking_metrics(a.scores(spark, d)), 9, "roc_auc").select("roc_auc")


def metric_report(spark, d):
    return _rounded(metrics.metric_report(a.scores(spark, d)), 9, "value")


def _learning_rows(spark, d) -> tuple[DataFrame, DataFrame]:
    """Model inputs of the train and the validation split, written once."""
    # Features, labels and split read the orders; their dates come from all items.
    orders = materialize(a.orders(spark, d))
    dataset = _dataset(spark, d, "non_delivery", orders)
    rows = _split(spark, d, OPTIMIZATION, orders).select("order_id", "split")
    inputs = targets.model_inputs(dataset, keep=("order_id", "target")).join(rows, "order_id")
    inputs = materialize(inputs.where(F.col("split") != s.TEST))
    return (
        inputs.where(F.col("split") == s.TRAIN),
        inputs.where(F.col("split") == s.VALIDATION),
    )


def gbt_predictions(spark, d, config: BoostingConfig = BoostingConfig()):
    """Train on the train split, score the validation split."""
    train, validation = _learning_rows(spark, d)
    model = DeliveryRiskModel.fit(train, config)
    return model.predict(validation, keep=("order_id", "target"))


def newton_first_splits(spark, d):
    """What the best first split by each model input gains on the train split."""
    orders = materialize(a.orders(spark, d))
    dataset = _rounded(
        _dataset(spark, d, "non_delivery", orders), 6, "customer_latitude", "customer_longitude"
    )
    rows = _split(spark, d, OPTIMIZATION, orders)
    rows = rows.where(F.col("split") == s.TRAIN).select("order_id")
    train = targets.model_inputs(dataset, keep=("order_id", "target")).join(rows, "order_id")
    return _rounded(first_splits(train), 5, "gain")


def newton_predictions(spark, d, config: NewtonConfig = NewtonConfig(n_estimators=10)):
    """Second-order trees from the train split score the validation split."""
    train, validation = _learning_rows(spark, d)
    model = NewtonModel.fit(train, config)
    return model.predict(validation, keep=("order_id", "target"))


def newton_curve(spark, d, config: NewtonConfig = NewtonConfig(n_estimators=5)):
    """Loss on the validation split after each tree."""
    train, validation = _learning_rows(spark, d)
    return NewtonModel.fit(train, config).evaluation_curve(validation)


# --- manifests -------------------------------------------------------------------


def _tables(spark, d) -> dict[str, DataFrame]:
    return {name: a.read_table(spark, d, name) for name in TABLES}


def manifest_row_counts(spark, d):
    return quality.table_row_counts(_tables(spark, d))


def manifest_compare(spark, d):
    """Row counts of the staging tables against counts of their distinct keys."""
    tables = _staging_tables(spark, d)

    def entries(frames: dict[str, DataFrame]) -> DataFrame:
        return quality.table_row_counts(frames).select(
            F.col("table_name").alias("file_id"),
            F.lit("row_count").alias("key"),
            F.col("row_count").cast("string").alias("value"),
        )

    distinct = {
        n: df.select(*STAGING[n].key).distinct() for n, df in tables.items() if STAGING[n].key
    }
    return manifests.manifest_differences(entries(tables), entries(distinct))


def file_hashes(spark, d):
    """SHA-256 and size of every table file."""
    files = manifests.list_files(spark, d)
    return files.join(manifests.file_hashes(spark, d), "path").select(
        "file_name", "size_byte", "sha256"
    )


def table_fingerprint(spark, d):
    return manifests.fingerprints(_tables(spark, d))


# --- history ---------------------------------------------------------------------


def delivery_history(spark, d):
    return history.delivery_history(a.orders(spark, d), a.customers(spark, d), "customer_state")


def review_history(spark, d):
    return history.review_history(
        a.orders(spark, d), a.customers(spark, d), a.order_reviews(spark, d), "customer_state"
    )


def step_durations(spark, d):
    return durations.step_durations(a.orders(spark, d))


QUERIES: dict[str, Query] = {
    "profile_order_status": profile_order_status,
    "profile_outcome_groups": profile_outcome_groups,
    "profile_late_target": profile_late_target,
    "profile_timeline": profile_timeline,
    "profile_fan_out": profile_fan_out,
    "profile_numeric_ranges": profile_numeric_ranges,
    "profile_zip_ambiguity": profile_zip_ambiguity,
    "zip_centroid_median": zip_centroid_median,
    "item_distance": item_distance,
    "item_features": item_features,
    "payment_features": payment_features,
    "order_features": order_features_query,
    "order_targets": order_targets,
    "non_delivery_dataset": non_delivery_dataset,
    "late_delivery_dataset": late_delivery_dataset,
    "model_inputs": model_inputs,
    "calendar_parts": calendar_parts,
    "approval_delay_hours": approval_delay_hours,
    "promised_delivery_days": promised_delivery_days,
    "clean_blank_to_null": clean_blank_to_null,
    "csv_round_trip": csv_round_trip,
    "csv_ranges": csv_ranges,
    "strict_cast_quarantine": strict_cast_quarantine,
    "cast_violations": cast_violations,
    "not_null_violations": not_null_violations,
    "pk_violations": pk_violations,
    "fk_violations": fk_violations,
    "label_check_violations": label_check_violations,
    "row_count_check": row_count_check,
    "chronological_rank": chronological_rank,
    "chronological_split": chronological_split,
    "final_eval_split": final_eval_split,
    "split_overlap": split_overlap,
    "split_coverage": split_coverage,
    "split_class_coverage": split_class_coverage,
    "split_members": split_members,
    "threshold_confusion": threshold_confusion,
    "log_loss_accuracy": log_loss_accuracy,
    "average_precision": average_precision,
    "roc_auc": roc_auc,
    "metric_report": metric_report,
    "gbt_predictions": gbt_predictions,
    "newton_first_splits": newton_first_splits,
    "newton_predictions": newton_predictions,
    "newton_curve": newton_curve,
    "manifest_row_counts": manifest_row_counts,
    "manifest_compare": manifest_compare,
    "file_hashes": file_hashes,
    "table_fingerprint": table_fingerprint,
    "delivery_history": delivery_history,
    "review_history": review_history,
    "step_durations": step_durations,
}
