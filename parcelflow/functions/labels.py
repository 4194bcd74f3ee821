"""Order outcome classes and the two nullable model labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FAILED_STATUSES = ("canceled", "unavailable")


def _status(prefix: str = "") -> Column:
    return F.col(f"{prefix}order_status")


def _delivered_with_date(prefix: str = "") -> Column:
    return (_status(prefix) == "delivered") & F.col(
        f"{prefix}order_delivered_customer_date"
    ).isNotNull()


def _arrived_late(prefix: str = "") -> Column:
    delivered = F.col(f"{prefix}order_delivered_customer_date")
    return delivered > F.col(f"{prefix}order_estimated_delivery_date")


def outcome_group(prefix: str = "") -> Column:
    """Four classes; an order that was never approved is ineligible whatever else holds."""
    return (
        F.when(F.col(f"{prefix}order_approved_at").isNull(), "ineligible_not_approved")
        .when(_delivered_with_date(prefix), "delivered_observed")
        .when(_status(prefix).isin(*FAILED_STATUSES), "confirmed_non_delivery")
        .otherwise("censored_unresolved")
    )


def non_delivery_label(prefix: str = "") -> Column:
    """1 canceled or unavailable, 0 delivered with a date, null while unresolved."""
    return (
        F.when(_status(prefix).isin(*FAILED_STATUSES), 1)
        .when(_delivered_with_date(prefix), 0)
        .cast("smallint")
    )


def observed_late_flag(prefix: str = "") -> Column:
    """1 only when delivered strictly after the estimate; the same instant is on time."""
    return F.when(_arrived_late(prefix), 1).otherwise(0)


def late_delivery_label(prefix: str = "") -> Column:
    """Late flag of orders with an observed delivery, null for every other order."""
    return F.when(_delivered_with_date(prefix), observed_late_flag(prefix)).cast("smallint")
