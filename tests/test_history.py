from datetime import datetime, timedelta

from parcelflow.plans.history import delivery_history, review_history

DAY = datetime(2018, 1, 1)


def orders(spark):
    def row(i, customer, approved, delivered, due):
        return (
            f"o{i}", customer, "delivered" if delivered else "shipped", DAY,
            approved, None, delivered, due,
        )

    d = lambda n: DAY + timedelta(days=n)
    rows = [
        row(1, "c1", d(1), d(5), d(4)),  # late, known on day 5
        row(2, "c2", d(5), d(6), d(9)),  # approved at that instant: not yet known
        row(3, "c1", d(7), None, d(9)),  # knows both
        row(4, "c3", d(8), d(9), d(9)),  # another state
        row(5, "c1", None, None, d(9)),  # never approved
    ]
    return spark.createDataFrame(
        rows,
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
        "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
        "order_estimated_delivery_date timestamp_ntz",
    )


def customers(spark):
    return spark.createDataFrame(
        [("c1", "A"), ("c2", "A"), ("c3", "B")], "customer_id string, customer_state string"
    )


def test_only_outcomes_known_before_the_approval_count(spark, many_slices):
    got = delivery_history(orders(spark), customers(spark), "customer_state").collect()
    assert {
        r["order_id"]: (r["known_deliveries_before"], r["known_late_deliveries_before"])
        for r in got
    } == {"o1": (0, 0), "o2": (0, 0), "o3": (2, 1), "o4": (0, 0)}


def test_reviews_written_before_the_approval(spark, many_slices):
    reviews = spark.createDataFrame(
        [("o1", 4, DAY + timedelta(days=6)), ("o2", 2, DAY + timedelta(days=7))],
        "order_id string, review_score int, review_creation_date timestamp_ntz",
    )
    got = review_history(orders(spark), customers(spark), reviews, "customer_state").collect()
    assert {r["order_id"]: (r["known_reviews_before"], r["known_score_sum_before"]) for r in got} == {
        "o1": (0, 0),
        "o2": (0, 0),
        "o3": (1, 4),
        "o4": (0, 0),
    }
