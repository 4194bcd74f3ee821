"""Tables that an operator writes between its steps, in the session's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.session import checkpoint_folder

ROW = "row_key"
BODY = "body"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it, so that no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_table(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives
    lost executors. Spark's part files are compressed with zstd."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, column: str) -> int:
    """Bytes of all texts, which sizes partitions; one scan without a shuffle of rows."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def keyed_texts(
    df: DataFrame,
    column: str,
    id_column: str,
    partition_bytes: int = 12_000_000,
    whole: str | None = None,
) -> tuple[DataFrame, int]:
    """Row key, ``id`` and ``body`` of every row of ``df``, as a table bucketed by the key, and the
    bytes of its texts.

    With ``whole``, a column of that name holds the other columns of the row.
    The texts cross the network once. Joins on the row key read the buckets in place;
    only the other side of the join is shuffled. The key tells repeated ids apart.
    """
    spark = df.sparkSession
    total = text_bytes(df, column)
    buckets = max(shuffle_partitions(spark), total // partition_bytes + 1)
    rows = df.select(
        F.monotonically_increasing_id().alias(ROW),
        F.col(id_column).alias("id"),
        F.col(column).alias(BODY),
        *([F.struct(*[F.col(c) for c in df.columns if c != column]).alias(whole)] if whole else []),
    )
    name = f"texts_{uuid.uuid4().hex}"
    (
        rows.repartition(buckets, ROW)
        .write.bucketBy(buckets, ROW)
        .option("compression", "zstd")
        .option("path", f"{checkpoint_folder(spark)}/{name}")
        .saveAsTable(name)
    )
    return spark.table(name), total


def join_by_row(texts: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Join the bucketed texts with a table of one row per row key; the smaller side is
    hashed, so the texts are neither shuffled nor sorted."""
    return texts.join(other.hint("shuffle_hash"), ROW, how)
