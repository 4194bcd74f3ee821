"""Prefix sums, positions, selection and medians against brute force."""

import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from parcelflow.operators.medians import exact_group_medians
from parcelflow.operators.prefix import global_rank, running_totals
from parcelflow.operators.selection import rows_at_positions


def test_global_rank_with_a_hot_timestamp(spark, many_slices):
    rng = random.Random(1)
    hot = datetime(2020, 1, 1)
    rows = [
        (hot if i % 3 == 0 else hot + timedelta(seconds=rng.randrange(50)), f"id{i:04d}")
        for i in range(900)
    ]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "ts timestamp_ntz, id string").repartition(5)
    ranked = global_rank(df, ["ts", "id"])
    got = {r["id"]: r["position"] for r in ranked.collect()}
    assert got == {id_: i for i, (_, id_) in enumerate(sorted(rows))}


def test_running_totals_of_a_key_that_spans_slices(spark, many_slices):
    rng = random.Random(2)
    rows = [
        (None if i % 10 == 0 else ("hot" if i % 3 else f"k{i % 7}"), i, rng.randrange(10))
        for i in range(1000)
    ]
    df = spark.createDataFrame(rows, "k string, o int, v int").repartition(4)
    got = {
        r["o"]: r["v_before"]
        for r in running_totals(df, ["o"], ["v"], keys=["k"]).collect()
    }
    sums, expected = {}, {}
    for k, o, v in sorted(rows, key=lambda r: r[1]):
        expected[o] = sums.get(k, 0)
        sums[k] = expected[o] + v
    assert got == expected


def test_running_totals_without_keys_descending(spark, many_slices):
    df = spark.range(100).select(F.col("id").alias("v"))
    got = running_totals(df, [F.desc("v")], ["v"])
    assert all(r["v_before"] == sum(range(r["v"] + 1, 100)) for r in got.collect())


def test_rows_at_positions(spark, many_slices):
    rng = random.Random(3)
    start = datetime(2019, 12, 30, 23, 59, 50)
    rows = [
        (
            start
            + timedelta(days=rng.randrange(4), seconds=rng.randrange(30), microseconds=i % 2),
            i,
        )
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, id bigint").repartition(3)
    positions = [0, 1, 57, 58, 199, 320, 399]
    got = rows_at_positions(df, "ts", "id", positions)
    ordered = sorted(rows)
    assert {p: (r["ts"], r["id"]) for p, r in got.items()} == {p: ordered[p] for p in positions}


def test_no_positions_need_no_rows(spark):
    assert rows_at_positions(spark.range(0), "ts", "id", []) == {}


@pytest.mark.parametrize("most", [None, 150, 0])
def test_group_medians(spark, many_slices, most):
    rng = random.Random(4)
    groups = {
        "one": [5.0],
        "two": [1.0, 4.0],
        "three": [3.0, 1.0, 2.0],
        "same": [7.25] * 50,
        "hot": [rng.gauss(0, 1) for _ in range(501)],
        "even": [rng.uniform(-180, 180) for _ in range(300)],
        "ties": [rng.choice([1.0, 2.0, 2.0, 3.0, 1e-9]) for _ in range(200)],
        None: [float(i % 13) for i in range(400)],
        "endless": [1.0, 2.0, 3.0, float("inf")],
        "wide": [10.0 ** rng.randrange(-8, 8) for _ in range(101)],
        "signs": [rng.choice([-0.0, 0.0, -1e-300, 1e-300, 5e-324]) for _ in range(160)],
    }
    rows = [(g, v, -v) for g, vs in groups.items() for v in vs] + [("hot", None, None)] * 3
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(4)
    got = {r["g"]: r for r in exact_group_medians(df, "g", ["x", "y"], most).collect()}
    assert got.keys() == groups.keys()
    for g, vs in groups.items():
        assert got[g]["x"] == pytest.approx(statistics.median(vs), rel=1e-12)
        assert got[g]["y"] == pytest.approx(-statistics.median(vs), rel=1e-12)


@pytest.mark.parametrize("most", [None, 0])
def test_medians_of_nulls_and_nan(spark, most):
    rows = [("n", None), ("n", None), ("m", float("nan")), ("m", 1.0), ("m", 2.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r["x"] for r in exact_group_medians(df, "g", ["x"], most).collect()}
    assert got == {"n": None, "m": 2.0}
    assert exact_group_medians(df.limit(0), "g", ["x"], most).collect() == []


def test_medians_of_a_hot_group_read_no_rows_twice(spark):
    """A million equal and a million different values, in the passes over digits."""
    df = spark.range(2_000_000).selectExpr("id % 2 AS g", "IF(id % 2 = 0, 7.5, id * 0.5) AS x")
    got = {r["g"]: r["x"] for r in exact_group_medians(df, "g", ["x"]).collect()}
    assert got == {0: 7.5, 1: 500_000.0}


def test_item_counts_of_small_and_hot_orders(spark, monkeypatch):
    from parcelflow.operators import hot_keys
    from parcelflow.plans.features import item_features

    rng = random.Random(3)
    rows = [
        (order, rng.choice([1, 2, 3, None]), rng.choice(["a", "b", None]), rng.randrange(40), "SP",
         rng.choice(["SP", "RJ", None]), 1.5, 2.25, 3.0, rng.choice([None, 1.0, 9.5]))
        for order, n in ((1, 1), (2, 30), (3, 400), (None, 60)) for _ in range(n)
    ]
    names = ["order_id", "product_id", "product_category_name", "seller_id", "customer_state",
             "seller_state", "price", "freight_value", "product_weight_g", "seller_distance_km"]
    kinds = "long long string long string string decimal(12,2) decimal(12,2) double double".split()
    df = spark.createDataFrame(rows, names).select(*[F.col(n).cast(k) for n, k in zip(names, kinds)])
    whole = item_features(df)
    assert "Expand" not in whole._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(hot_keys, "MOST_ROWS", 50)
    halves = item_features(df)
    key = lambda r: repr(r)
    assert sorted(whole.collect(), key=key) == sorted(halves.collect(), key=key)
    got = {r.order_id: r for r in whole.collect()}
    for order in (1, 2, 3, None):
        own = [r for r in rows if r[0] == order]
        assert got[order].item_count == len(own)
        for column, at in (("distinct_product_count", 1), ("distinct_category_count", 2),
                           ("seller_count", 3), ("distinct_seller_state_count", 5)):
            assert got[order][column] == len({r[at] for r in own} - {None})
