"""Raw text tables to typed staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import blank_to_null
from parcelflow.schemas import STAGING, Table


def stage(raw: DataFrame, table: Table | str) -> DataFrame:
    """Trim, null out blanks, rename and cast. Text that does not fit the type fails."""
    table = STAGING[table] if isinstance(table, str) else table
    if raw.sparkSession.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("Strict staging needs spark.sql.ansi.enabled=true.")
    return raw.select(
        *[
            blank_to_null(F.col(c.source)).cast(c.type).alias(c.name)
            for c in table.columns
        ]
    )


def stage_or_quarantine(raw: DataFrame, table: Table | str) -> DataFrame:
    """Like ``stage`` but bad text becomes null, named in ``quarantined_columns``."""
    table = STAGING[table] if isinstance(table, str) else table
    cleaned = {c.name: blank_to_null(F.col(c.source)) for c in table.columns}
    bad = [
        F.when(cleaned[c.name].isNotNull() & cleaned[c.name].try_cast(c.type).isNull(), c.name)
        for c in table.columns
    ]
    return raw.select(
        *[cleaned[c.name].try_cast(c.type).alias(c.name) for c in table.columns],
        F.array_compact(F.array(*bad)).alias("quarantined_columns"),
    )
