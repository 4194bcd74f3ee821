"""Constraint checks: each returns rows (table_name, check_name, invalid_row_count)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import blank_to_null
from parcelflow.schemas import Table


def one_pass_counts(
    df: DataFrame, checks: Mapping[str, Column], label: str = "check_name"
) -> DataFrame:
    """Rows (label, invalid_row_count) for all predicates from a single scan.

    A null predicate does not count, and an empty table counts zero.
    """
    names = list(checks)
    counted = df.agg(
        *[F.count_if(check).alias(f"_c{i}") for i, check in enumerate(checks.values())]
    )
    pairs = [F.struct(F.lit(n).alias(label), F.col(f"_c{i}").alias("invalid_row_count"))
             for i, n in enumerate(names)]
    return counted.select(F.inline(F.array(*pairs)))


def _labelled(df: DataFrame, table: str) -> DataFrame:
    return df.select(F.lit(table).alias("table_name"), "check_name", "invalid_row_count")


def _null_checks(columns: Sequence[str]) -> dict[str, Column]:
    return {f"not_null:{c}": F.col(c).isNull() for c in columns}


def _flag_checks(columns: Sequence[str]) -> dict[str, Column]:
    return {f"zero_or_one:{c}": ~F.col(c).isin(0, 1) for c in columns}


def not_null_violations(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    return _labelled(one_pass_counts(df, _null_checks(columns)), table)


def key_violations(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    counted = df.groupBy(*key).agg(F.count("*").alias("n"))
    name = f"primary_key:{','.join(key)}"
    return _labelled(one_pass_counts(counted, {name: F.col("n") > 1}), table)


def reference_violations(
    child: DataFrame,
    table: str,
    columns: Sequence[str],
    parent: DataFrame,
    parent_columns: Sequence[str],
    parent_name: str,
) -> DataFrame:
    """Child rows whose non-null reference has no parent.

    The child is counted per reference before the join, so a hot reference travels
    as one row per map task.
    """
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    counted = child.where(known).groupBy(*columns).agg(F.count("*").alias("n"))
    parents = parent.select(*[F.col(p).alias(c) for c, p in zip(columns, parent_columns)])
    orphans = counted.join(parents, list(columns), "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("invalid_row_count")).select(
        F.lit(table).alias("table_name"),
        F.lit(f"foreign_key:{','.join(columns)}->{parent_name}").alias("check_name"),
        "invalid_row_count",
    )


def flag_violations(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Values of nullable 0/1 columns that are neither; null passes."""
    return _labelled(one_pass_counts(df, _flag_checks(columns)), table)


def cast_violations(raw: DataFrame, table: Table) -> DataFrame:
    """Raw values that hold text which the staging type cannot represent."""
    checks = {}
    for column in table.columns:
        kind = column.type.simpleString()
        if kind == "string":
            continue
        cleaned = blank_to_null(F.col(column.source))
        checks[f"castable:{column.name}"] = (
            cleaned.isNotNull() & cleaned.try_cast(column.type).isNull()
        )
    if not checks:
        return _labelled(one_pass_counts(raw, {"castable": F.lit(False)}), table.name).limit(0)
    return _labelled(one_pass_counts(raw, checks), table.name)


def row_count_mismatches(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Tables whose loaded rows differ from the manifest; both (table_name, row_count)."""
    loaded = counts.withColumnRenamed("row_count", "loaded_row_count")
    wanted = expected.withColumnRenamed("row_count", "expected_row_count")
    both = loaded.join(wanted, "table_name", "full_outer")
    return both.where(
        ~F.col("loaded_row_count").eqNullSafe(F.col("expected_row_count"))
    ).select("table_name", "expected_row_count", "loaded_row_count")


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows (table_name, row_count), one count per table in a single job."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def table_violations(
    df: DataFrame, table: Table, tables: Mapping[str, DataFrame]
) -> DataFrame:
    """Every declared constraint of one table; references look up ``tables``."""
    row_checks = {**_null_checks(table.required_columns), **_flag_checks(table.binary_flags)}
    checks = [_labelled(one_pass_counts(df, row_checks), table.name)] if row_checks else []
    if table.key:
        checks.append(key_violations(df, table.name, table.key))
    for ref in table.references:
        checks.append(
            reference_violations(
                df, table.name, ref.columns, tables[ref.parent], ref.parent_columns, ref.parent
            )
        )
    return reduce(DataFrame.unionByName, checks)


def layer_violations(
    tables: Mapping[str, DataFrame],
    specs: Mapping[str, Table],
) -> DataFrame:
    """All constraint counts of a layer."""
    return reduce(
        DataFrame.unionByName,
        [table_violations(tables[name], spec, tables) for name, spec in specs.items()],
    )


class ConstraintError(ValueError):
    """A layer breaks its declared constraints."""


def require_clean(report: DataFrame) -> None:
    """Raise when any check counted a row. The report has one row per declared check."""
    broken = report.where(F.col("invalid_row_count") > 0).collect()
    if broken:
        lines = [
            f"{r['table_name']} {r['check_name']}: {r['invalid_row_count']}" for r in broken
        ]
        raise ConstraintError("Constraints are violated.\n" + "\n".join(lines))
