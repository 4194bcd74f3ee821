from parcelflow.functions.labels import (
    late_delivery_label,
    non_delivery_label,
    observed_late_flag,
    outcome_group,
)
from parcelflow.functions.scalars import (
    blank_to_null,
    day_of_week,
    days_between,
    great_circle_km,
    hours_between,
    kilometres,
    seconds_between,
)

__all__ = [
    "blank_to_null",
    "day_of_week",
    "days_between",
    "great_circle_km",
    "hours_between",
    "kilometres",
    "late_delivery_label",
    "non_delivery_label",
    "observed_late_flag",
    "outcome_group",
    "seconds_between",
]
