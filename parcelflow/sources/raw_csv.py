"""All-text CSV tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.schemas import DATASET_FILES, STAGING, Table

#: Text of a file that one task writes: several ranges of Spark's 128 MB.
FILE_BYTES = 320_000_000


def raw_path(folder: str, table: str) -> str:
    return f"{folder.rstrip('/')}/{DATASET_FILES[table]}"


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    table: Table | str,
    multi_line: bool = True,
) -> DataFrame:
    """Read one table as text: header checked, doubled quotes, malformed rows fail.

    ``path`` may be a file, a folder of part files or a list. Any table may hold line
    breaks inside quotes, and a file with such values cannot be cut into ranges: files are
    read in parallel, each by one task. Pass ``multi_line=False`` only for files known to
    have one record per line: they scan in ranges, but a quoted line break becomes two
    records there.
    """
    table = STAGING[table] if isinstance(table, str) else table
    return spark.read.csv(
        path,
        schema=table.raw_schema,
        header=True,
        enforceSchema=False,
        encoding="UTF-8",
        quote='"',
        escape='"',
        multiLine=multi_line,
        mode="FAILFAST",
    )


def write_raw(df: DataFrame, path: str) -> None:
    """Write text columns so that ``read_raw`` gets them back, line breaks and outer
    spaces included."""
    df.write.csv(
        path,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        mode="errorifexists",
    )


def write_raw_files(df: DataFrame, path: str, file_bytes: int | None = None) -> None:
    """``write_raw`` into files of about ``file_bytes`` of text, one where there is no more. Each
    is written by one task from its share of the rows, however many there are."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in df.columns), F.lit(0).cast("long"))
    total = df.agg(F.sum(size)).first()[0] or 0
    write_raw(df.repartition(total // (file_bytes or FILE_BYTES) + 1), path)
