from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parcelflow.plans.split import (
    SplitConfig,
    SplitError,
    chronological_split,
    final_evaluation_split,
    optimization_split,
    split_class_coverage,
    split_coverage,
    split_overlap,
    split_sizes,
    validate_split,
)
from parcelflow.sources.splits import load_split, load_split_metadata, save_split

CONFIG = optimization_split("non_delivery")


def test_sizes():
    assert CONFIG.split_id == "non_delivery_chronological_v1"
    assert split_sizes(97_549, CONFIG) == {"train": 78_039, "validation": 9_755, "test": 9_755}
    final = final_evaluation_split("non_delivery")
    assert final.names == ("train", "test")
    assert split_sizes(97_549, final) == {"train": 87_794, "validation": 0, "test": 9_755}
    # An odd remainder halves to the even side.
    assert split_sizes(25, CONFIG) == {"train": 20, "validation": 2, "test": 3}
    assert split_sizes(35, CONFIG) == {"train": 28, "validation": 4, "test": 3}


@pytest.fixture
def dataset(spark):
    start = datetime(2018, 1, 1)
    # Equal times: the id decides, and text ids compare as text.
    rows = [(f"o{i}", start + timedelta(hours=i // 3), i % 2) for i in range(40)]
    return spark.createDataFrame(
        rows, "order_id string, order_approved_at timestamp_ntz, target int"
    ).repartition(3)


def members(df):
    result = {}
    for r in df.collect():
        result.setdefault(r["split"], set()).add(r["order_id"])
    return result


def test_split_is_chronological(dataset):
    got = members(chronological_split(dataset, CONFIG))
    ordered = [
        r["order_id"]
        for r in sorted(dataset.collect(), key=lambda r: (r["order_approved_at"], r["order_id"]))
    ]
    assert got == {
        "train": set(ordered[:32]),
        "validation": set(ordered[32:36]),
        "test": set(ordered[36:]),
    }


def test_final_split_has_no_validation(dataset):
    got = members(chronological_split(dataset, final_evaluation_split("x")))
    assert {k: len(v) for k, v in got.items()} == {"train": 36, "test": 4}


def test_split_does_not_shuffle_the_dataset(dataset, capsys):
    split = chronological_split(dataset.coalesce(1), CONFIG)
    split.explain()
    assert "hashpartitioning" not in capsys.readouterr().out


def assignment(spark, pairs):
    return spark.createDataFrame(pairs, "order_id string, split string")


def test_overlap_and_coverage(spark):
    data = spark.createDataFrame([("a", 0), ("b", 1), ("c", 0)], "order_id string, target int")
    given = assignment(spark, [("a", "train"), ("a", "test"), ("b", "test"), ("x", "train")])
    overlap = split_overlap(given, ("train", "validation", "test")).collect()
    assert {(r[0], r[1]): r[2] for r in overlap} == {
        ("train", "validation"): 0,
        ("train", "test"): 1,
        ("validation", "test"): 0,
    }
    covered = split_coverage(data, given).first()
    assert tuple(covered) == (1, 1, 1)
    labelled = data.join(given, "order_id")
    rows = {(r[0], r[1]): r[2] for r in split_class_coverage(labelled, ("train", "test")).collect()}
    assert rows == {("train", 0): 1, ("train", 1): 0, ("test", 0): 1, ("test", 1): 1}


TWO = SplitConfig("two", 0.5, 0)


@pytest.mark.parametrize(
    "pairs, message",
    [
        ([("a", "train"), ("b", "train"), ("c", "train"), ("d", "train")], "test split is empty"),
        (
            [("a", "train"), ("b", "train"), ("c", "test"), ("d", "test"), ("a", "test")],
            "share 1 orders",
        ),
        ([("a", "train"), ("b", "train"), ("c", "test"), ("d", "test"), ("e", "test")], "not in"),
        ([("a", "train"), ("a", "train"), ("b", "train"), ("c", "test"), ("d", "test")], "once"),
        ([("a", "train"), ("b", "train"), ("c", "test")], "missing from the splits"),
        ([("a", "train"), ("c", "train"), ("b", "test"), ("d", "test")], "lacks class"),
    ],
)
def test_invalid_splits(spark, pairs, message):
    data = spark.createDataFrame(
        [("a", 0), ("b", 1), ("c", 0), ("d", 1)], "order_id string, target int"
    )
    with pytest.raises(SplitError, match=message):
        validate_split(data, assignment(spark, pairs), TWO)


def test_save_once_and_load(dataset, spark, tmp_path):
    root = str(tmp_path)
    split = chronological_split(dataset, CONFIG)
    assert save_split(root, dataset, split, CONFIG) is True
    other = split.withColumn(
        "split", F.when(F.col("split") == "train", "train").otherwise(F.lit("validation"))
    )
    with pytest.raises(SplitError):
        save_split(root, dataset, other, CONFIG)
    assert save_split(root, dataset, split, CONFIG) is False
    assert members(load_split(root, dataset, CONFIG)) == members(split)
    meta = load_split_metadata(spark, root, CONFIG.split_id).first()
    assert meta["strategy"] == "chronological" and meta["split_seed"] is None
    assert meta["sample_counts"].asDict() == {"train": 32, "validation": 4, "test": 4}


def test_load_needs_the_split_and_its_members(dataset, spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_split(str(tmp_path), dataset, CONFIG)
    final = SplitConfig(CONFIG.split_id, 0.1, 0)
    save_split(str(tmp_path), dataset, chronological_split(dataset, final), final)
    with pytest.raises(SplitError, match="validation"):
        load_split(str(tmp_path), dataset, CONFIG)


def test_splits_outside_the_config_are_refused(spark):
    from parcelflow.plans.split import SplitError, final_evaluation_split, validate_split

    rows = [(str(i), i % 2, s) for i, s in enumerate(["train", "train", "validation", "validation", "test", "test"])]
    df = spark.createDataFrame(rows, "order_id string, target int, split string")
    with pytest.raises(SplitError, match="validation"):
        validate_split(df, df, final_evaluation_split("non_delivery"))


def test_members_of_a_damaged_split(spark):
    from parcelflow.plans.split import split_members

    dataset = spark.createDataFrame([(i, 0) for i in range(6)], "order_id int, target int")
    rows = [(0, "train"), (1, "train"), (1, "test"), (2, "test"), (2, "test"), (99, "train")]
    assignment = spark.createDataFrame(rows, "order_id int, split string")
    found = split_members(dataset, assignment, ("train", "validation", "test")).collect()
    assert {r.split: tuple(r)[1:] for r in found} == {
        "train": (3, 1, 1), "validation": (0, 0, 0), "test": (3, 3, 0)
    }
