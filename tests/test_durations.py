from datetime import datetime, timedelta
from decimal import Decimal

from parcelflow.plans.durations import step_durations

START = datetime(2018, 1, 1)
SCHEMA = (
    "order_id string, order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
    "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
    "order_estimated_delivery_date timestamp_ntz"
)


def test_inconsistent_timestamps_feed_no_duration(spark):
    def row(i, *hours):
        return (i, START, *[None if h is None else START + timedelta(hours=h) for h in hours])

    rows = [
        row("fine", 1, 25, 49, 240),
        row("ties", 0, 0, 0, 0),
        row("carrier first", 10, 5, 48, 240),
        row("delivered first", 1, 25, 20, 240),
        row("approved first", -2, 25, 49, 240),
        row("due first", 1, 25, 49, -24),
        row("nothing but an early delivery", None, None, -5, 240),
        row("open", 1, None, None, 240),
        row("no approval", None, 24, 48, 240),
        ("empty", None, None, None, None, None),
    ]
    got = step_durations(spark.createDataFrame(rows, SCHEMA))
    wanted = {
        "fine": (1, 24, 24, Decimal("2.04"), 10),
        "ties": (0, 0, 0, 0, 0),
        "carrier first": (10, None, None, 2, 10),
        "delivered first": (1, 24, None, None, 10),
        "approved first": (None, None, 24, Decimal("2.04"), 10),
        "due first": (1, 24, 24, Decimal("2.04"), None),
        "nothing but an early delivery": (None, None, None, None, 10),
        "open": (1, None, None, None, 10),
        "no approval": (None, None, 24, 2, 10),
        "empty": (None,) * 5,
    }
    assert {r.order_id: tuple(r)[1:] for r in got.collect()} == wanted
    assert step_durations(spark.createDataFrame([], SCHEMA)).collect() == []
