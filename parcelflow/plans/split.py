"""Chronological train / validation / test split and its checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.operators.selection import rows_at_positions

TRAIN, VALIDATION, TEST = "train", "validation", "test"


@dataclass(frozen=True)
class SplitConfig:
    split_id: str = "fixed_split_v1"
    test_fraction: float = 0.10
    validation_fraction: float = 0.10

    @property
    def names(self) -> tuple[str, ...]:
        return (TRAIN, VALIDATION, TEST) if self.validation_fraction else (TRAIN, TEST)


def optimization_split(task: str) -> SplitConfig:
    return SplitConfig(f"{task}_chronological_v1", 0.1, 0.1)


def final_evaluation_split(task: str) -> SplitConfig:
    return SplitConfig(f"{task}_final_eval_split_v1", 0.1, 0)


def split_sizes(rows: int, config: SplitConfig) -> dict[str, int]:
    """Rows per split; halves round to even, and the test part takes the remainder."""
    held_out = config.validation_fraction + config.test_fraction
    train = round(rows * (1 - held_out))
    rest = rows - train
    validation = 0
    if config.validation_fraction:
        validation = round(rest * (1 / held_out * config.validation_fraction))
    return {TRAIN: train, VALIDATION: validation, TEST: rest - validation}


def chronological_split(dataset: DataFrame, config: SplitConfig) -> DataFrame:
    """Add ``split``: the oldest rows train, the newest test.

    Only the first row of each later split is looked up; every row then compares its
    own (approval time, order id) with those, so the dataset is not shuffled.
    """
    sizes = split_sizes(dataset.count(), config)
    starts: dict[str, int] = {}
    position = sizes[TRAIN]
    for name in (VALIDATION, TEST):
        if sizes[name]:
            starts[name] = position
        position += sizes[name]
    rows = rows_at_positions(
        dataset, "order_approved_at", "order_id", list(starts.values())
    )
    split: Column = F.lit(TRAIN)
    for name, start in starts.items():
        first = rows[start]
        split = F.when(_not_before(dataset, first), name).otherwise(split)
    return dataset.withColumn("split", split)


def _not_before(dataset: DataFrame, first) -> Column:
    kind = dataset.schema["order_id"].dataType
    instant = F.lit(first["order_approved_at"].isoformat(sep=" ")).cast("timestamp_ntz")
    tie = F.lit(first["order_id"]).cast(kind)
    approved = F.col("order_approved_at")
    return (approved > instant) | ((approved == instant) & (F.col("order_id") >= tie))


class SplitError(ValueError):
    """A split breaks the rules for train, validation and test sets."""


def split_overlap(assignment: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Orders that two splits share: rows (first_split, second_split, overlap_count)."""
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    per_order = assignment.groupBy("order_id").agg(
        *[F.bool_or(F.col("split") == n).alias(f"in_{n}") for n in names]
    )
    counted = per_order.agg(
        *[
            F.count_if(F.col(f"in_{a}") & F.col(f"in_{b}")).alias(f"c{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("first_split"),
                        F.lit(b).alias("second_split"),
                        F.col(f"c{i}").alias("overlap_count"),
                    )
                    for i, (a, b) in enumerate(pairs)
                ]
            )
        )
    )


def split_coverage(dataset: DataFrame, assignment: DataFrame) -> DataFrame:
    """One row: orders missing from the split, unknown to the dataset, repeated in it."""
    both = dataset.select("order_id", F.lit(1).alias("known"), F.lit(0).alias("assigned"))
    both = both.unionByName(
        assignment.select("order_id", F.lit(0).alias("known"), F.lit(1).alias("assigned"))
    )
    per_order = both.groupBy("order_id").agg(
        F.max("known").alias("known"), F.sum("assigned").alias("assigned")
    )
    return per_order.agg(
        F.count_if((F.col("known") == 1) & (F.col("assigned") == 0)).alias("missing_count"),
        F.count_if(F.col("known") == 0).alias("unknown_count"),
        F.count_if(F.col("assigned") > 1).alias("duplicate_count"),
    )


def split_class_coverage(
    labelled: DataFrame, names: tuple[str, ...], classes: tuple[int, ...] = (0, 1)
) -> DataFrame:
    """Rows per split and class; a class that a split lacks shows zero rows.

    ``labelled`` has ``split`` and ``target``.
    """
    counted = labelled.agg(
        *[
            F.count_if((F.col("split") == n) & (F.col("target") == c)).alias(f"{n}_{c}")
            for n in names
            for c in classes
        ]
    )
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("split"),
                        F.lit(c).alias("target"),
                        F.col(f"{n}_{c}").alias("row_count"),
                    )
                    for n in names
                    for c in classes
                ]
            )
        )
    )


def split_members(
    dataset: DataFrame, assignment: DataFrame, names: Sequence[str]
) -> DataFrame:
    """One row for each split, empty ones too: its orders, how many of them the assignment names
    more than once, and how many are not in the dataset."""
    spark = assignment.sparkSession
    times = assignment.groupBy("order_id").agg(F.count("*").alias("times"))
    known = dataset.select("order_id", F.lit(True).alias("known")).distinct()
    marked = assignment.join(times, "order_id").join(known, "order_id", "left")
    counts = marked.groupBy("split").agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("times") > 1).alias("repeated_count"),
        F.count_if(F.col("known").isNull()).alias("unknown_count"),
    )
    every = spark.createDataFrame([(n,) for n in names], "split string")
    return every.join(counts, "split", "left").na.fill(0)


def validate_split(dataset: DataFrame, assignment: DataFrame, config: SplitConfig) -> None:
    """Raise unless the splits are non-empty, disjoint, complete and hold every class.

    ``dataset`` has ``order_id`` and ``target``; ``assignment`` has ``order_id`` and
    ``split``.
    """
    names = config.names
    assignment = assignment.select("order_id", "split")
    others = assignment.where(~F.coalesce(F.col("split").isin(*names), F.lit(False))).first()
    if others is not None:
        raise SplitError(f"Orders are assigned to '{others['split']}', which is no split here.")
    present = {
        r["split"]: r["n"]
        for r in assignment.where(F.col("split").isin(*names))
        .groupBy("split")
        .agg(F.count("*").alias("n"))
        .collect()
    }
    for name in names:
        if not present.get(name):
            raise SplitError(f"The {name} split is empty.")
    for row in split_overlap(assignment, names).collect():
        if row["overlap_count"]:
            raise SplitError(
                f"The {row['first_split']} and {row['second_split']} splits share "
                f"{row['overlap_count']} orders."
            )
    covered = split_coverage(dataset, assignment).first()
    if covered["unknown_count"]:
        raise SplitError(f"{covered['unknown_count']} orders are not in the dataset.")
    if covered["duplicate_count"]:
        raise SplitError(f"{covered['duplicate_count']} orders occur more than once.")
    if covered["missing_count"]:
        raise SplitError(f"{covered['missing_count']} orders are missing from the splits.")
    labelled = dataset.select("order_id", "target").join(assignment, "order_id")
    coverage = split_class_coverage(labelled, names).collect()
    occurring = {r["target"] for r in coverage if r["row_count"]}
    for row in coverage:
        if row["target"] in occurring and not row["row_count"]:
            raise SplitError(f"The {row['split']} split lacks class {row['target']}.")
