import math
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from parcelflow.functions import (
    blank_to_null,
    day_of_week,
    days_between,
    great_circle_km,
    hours_between,
    kilometres,
    late_delivery_label,
    non_delivery_label,
    outcome_group,
)


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, expected",
    [("  ", None), ("", None), (" a b ", "a b"), ("\t", "\t"), (None, None)],
)
def test_blank_to_null(spark, text, expected):
    assert one(spark, blank_to_null(F.lit(text).cast("string"))) == expected


def at(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "later, earlier, hours",
    [
        ("2024-01-01 00:00:18", "2024-01-01 00:00:00", "0.01"),
        ("2024-01-01 00:00:00", "2024-01-01 00:00:18", "-0.01"),
        ("2024-01-01 00:00:54", "2024-01-01 00:00:00", "0.02"),
        ("2024-01-01 00:00:17.999999", "2024-01-01 00:00:00", "0.00"),
        ("2024-03-31 12:00:00", "2024-03-30 12:00:00", "24.00"),
    ],
)
def test_hours_round_ties_away_from_zero(spark, later, earlier, hours):
    assert one(spark, hours_between(at(later), at(earlier))) == Decimal(hours)


def test_durations_do_not_depend_on_the_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = one(spark, hours_between(at("2024-03-10 12:00:00"), at("2024-03-10 00:00:00")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == Decimal("12.00")


def test_days_and_null(spark):
    assert one(spark, days_between(at("2018-01-04 10:00:00"), at("2018-01-01 10:00:00"))) == 3
    assert one(spark, days_between(at(None), at("2018-01-01 10:00:00"))) is None


def test_sunday_is_zero(spark):
    assert one(spark, day_of_week(at("2024-01-07 05:00:00"))) == 0
    assert one(spark, day_of_week(at("2024-01-06 05:00:00"))) == 6


def distance(spark, *point):
    columns = [F.lit(v).cast("double") for v in point]
    return one(spark, great_circle_km(*columns))


def test_distance_of_antipodes_has_no_nan(spark):
    assert distance(spark, 0, 0, 0, 180) == pytest.approx(math.pi * 6371.0088)
    assert distance(spark, 90, 10, -90, 70) == pytest.approx(math.pi * 6371.0088)


def test_distance_to_itself_is_zero(spark):
    assert distance(spark, -23.5, -46.6, -23.5, -46.6) == 0


@pytest.mark.parametrize("hole", range(4))
def test_distance_with_a_missing_coordinate_is_null(spark, hole):
    point = [1.0, 2.0, 3.0, 4.0]
    point[hole] = None
    assert distance(spark, *point) is None


def test_kilometres_round_half_up(spark):
    assert one(spark, kilometres(F.lit(12.345))) == Decimal("12.35")


APPROVED = datetime(2018, 1, 1)
DUE = datetime(2018, 1, 10)
LATE = datetime(2018, 1, 10, 0, 0, 1)


@pytest.mark.parametrize(
    "status, approved, delivered, group, non_delivery, late",
    [
        ("delivered", APPROVED, DUE, "delivered_observed", 0, 0),
        ("delivered", APPROVED, LATE, "delivered_observed", 0, 1),
        ("delivered", APPROVED, None, "censored_unresolved", None, None),
        ("canceled", APPROVED, DUE, "confirmed_non_delivery", 1, None),
        ("unavailable", APPROVED, None, "confirmed_non_delivery", 1, None),
        ("shipped", APPROVED, None, "censored_unresolved", None, None),
        ("delivered", None, DUE, "ineligible_not_approved", 0, 0),
        ("canceled", None, None, "ineligible_not_approved", 1, None),
    ],
)
def test_outcomes(spark, status, approved, delivered, group, non_delivery, late):
    schema = (
        "order_status string, order_approved_at timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
    )
    row = (
        spark.createDataFrame([(status, approved, delivered, DUE)], schema)
        .select(
            outcome_group().alias("g"),
            non_delivery_label().alias("n"),
            late_delivery_label().alias("l"),
        )
        .first()
    )
    assert (row["g"], row["n"], row["l"]) == (group, non_delivery, late)


def test_kilometres_round_once(spark):
    from parcelflow.functions.scalars import kilometres

    df = spark.createDataFrame([(0.124999999999999,), (0.125,)], "d double")
    assert [str(r[0]) for r in df.select(kilometres(F.col("d"))).collect()] == ["0.12", "0.13"]
