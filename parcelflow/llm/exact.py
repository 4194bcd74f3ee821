"""Operator 8, exact dedup: group by a 128-bit content hash, compare bytes inside groups.

The key of the shuffle is the MD5 of the normalised text; the grouping key also holds the
normalised text itself, so Spark compares bytes and two texts with the same hash stay apart.
Copies are combined before the shuffle: a group of any size reaches a reducer as one row of
each map task. Sizes travel back to the documents by hash, where only a few bytes a row move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.storage import fresh

#: Characters that do not count: [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def exact_groups(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical without white space. Of a group, the row with the most
    code points in the original text stays, then the smallest id (null ids last). A null text
    counts as empty; all empty texts make one group. Rows that share the kept id and its
    length are all marked as kept: they cannot be told apart. Ids are of any type that has an
    order. Other columns are ignored.
    """
    body = normalised(F.col(text))
    rows = df.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.length(text), F.lit(0)).alias("size"),
        body.alias("norm"),
    )
    best = F.min(
        F.struct((-F.col("size")).alias("less"), F.isnull("id").alias("no_id"), F.col("id"))
    )
    classes = (
        rows.groupBy(F.md5("norm").alias("h"), "norm")
        .agg(F.count("*").alias("group_size"), best.alias("best"))
        .select(
            "h",
            F.sha2("norm", 256).alias("sha"),
            "group_size",
            (-F.col("best.less")).alias("keep_size"),
            F.col("best.id").alias("keep_id"),
        )
    )
    small = rows.select("id", "size", F.md5("norm").alias("h"), F.sha2("norm", 256).alias("sha"))
    return small.join(classes, ["h", "sha"]).select(
        F.col("id").alias(id_column),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("size") == F.col("keep_size"))).alias(
            "kept"
        ),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_copies(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns, whatever their names. Rows with the
    same id and equal texts of the same length come out once, rows with the same id and other
    texts all do."""
    kept_id, kept_sha, sha, size = (
        fresh(df, n) for n in ("_kept_id", "_kept_sha", "_sha", "_size")
    )
    kept = exact_groups(df, id_column, text).where("kept").select(
        F.col(id_column).alias(kept_id), F.col("text_sha256").alias(kept_sha)
    )
    marked = df.withColumn(sha, F.sha2(normalised(F.col(text)), 256)).withColumn(
        size, F.coalesce(F.length(text), F.lit(0))
    )
    match = F.col(id_column).eqNullSafe(F.col(kept_id)) & (F.col(sha) == F.col(kept_sha))
    stay = marked.join(kept, match, "left_semi")
    longest_first = stay.groupBy(id_column, sha).agg(
        *[F.max_by(c, size).alias(c) for c in df.columns if c != id_column]
    )
    return longest_first.select(*df.columns)
