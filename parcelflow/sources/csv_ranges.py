"""One large CSV file read by many tasks, line breaks in quotes included.

Spark's text reader cuts a file into ranges at line breaks. Whether a range begins inside quotes
follows from the number of quotes before it: they are counted per range and summed up over the
ranges of a file, one row a range. With that, each task knows where its first record begins,
and only the records that lie across ranges, at most two pieces a range, are put together in a
shuffle. Records are then parsed one by one, with the rules of ``read_raw``.

Files are UTF-8 with quotes doubled inside quotes. A quote inside a value without quotes is not
CSV; an odd number of quotes in a file fails. Files of one range (small or compressed ones) are
read by one task each. Lines that are empty outside quotes are skipped, an empty file has no rows. Line
breaks inside quotes stay as they are (``read_raw`` turns CRLF into LF in files that end their
lines with CRLF).
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from parcelflow.schemas import STAGING, Table

_PIECES = "path string, start long, kind int, first boolean, text string"


def read_raw_ranges(
    spark: SparkSession, path: str | list[str], table: Table | str
) -> DataFrame:
    """All-text columns of one table, as ``read_raw`` gives them."""
    table = STAGING[table] if isinstance(table, str) else table
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
        (quotes % 2 == 1).alias("odd"),
    )
    counted = lines.groupBy("path", "start").agg(F.count_if("odd").alias("odd_lines"))
    earlier = W.partitionBy("path").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd_lines").over(earlier), F.lit(0)) % 2 == 1
    # One row for each range of the input.
    ranges = F.broadcast(counted.select("path", "start", inside.alias("inside")))
    pieces = lines.join(ranges, ["path", "start"]).mapInArrow(_cutter(), _PIECES)
    whole = pieces.where("kind = 0").select("path", "first", "text")
    across = (
        pieces.where("kind > 0")
        .repartition("path")
        .sortWithinPartitions("path", "start", "kind")
        .mapInArrow(_joiner(), "path string, first boolean, text string")
    )
    records = whole.unionByName(across).mapInArrow(
        _without_header([f.name for f in table.raw_schema.fields]), "text string"
    )
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true"}
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.raw_schema.fields)
    return records.select(F.from_csv("text", schema, options).alias("row")).select("row.*")


# Kinds of pieces, in the order they have in a range.
_WHOLE, _END, _MIDDLE, _BEGIN = range(4)


def _cutter():
    """Lines of each range as whole records and pieces of records."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
        columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["path", "start", "kind", "first", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, begun_here, first, held, rows = None, False, True, False, [], []
        for batch in batches:
            names = ("path", "start", "value", "odd", "inside")
            for path, start, value, odd, starts_inside in zip(
                *[batch.column(c).to_pylist() for c in names]
            ):
                if (path, start) != at:
                    if held:
                        rows.append((*at, _BEGIN if begun_here else _MIDDLE, first, "\n".join(held)))
                    at, inside, held = (path, start), starts_inside, []
                    begun_here, first = not inside, start == 0
                held.append(value)
                if odd:
                    inside = not inside
                if not inside:
                    rows.append((*at, _WHOLE if begun_here else _END, first, "\n".join(held)))
                    begun_here, first, held = True, False, []
            if rows:
                yield batch_of(rows)
                rows = []
        if held:
            yield batch_of([(*at, _BEGIN if begun_here else _MIDDLE, first, "\n".join(held))])

    return run


def _joiner():
    """Pieces in the order of the file as records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held, head = None, [], False
        for batch in batches:
            rows = []
            for path, kind, first, text in zip(
                *[batch.column(c).to_pylist() for c in ("path", "kind", "first", "text")]
            ):
                if path != of:
                    if held:
                        raise ValueError(f"A quote is not closed in {of}.")
                    of = path
                if not held:
                    head = first
                held.append(text)
                if kind == _END:
                    rows.append((path, head, "\n".join(held)))
                    held = []
            if rows:
                columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.string(), pa.bool_(), pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "first", "text"])
        if held:
            raise ValueError(f"A quote is not closed in {of}.")

    return run


def _without_header(names: list[str]):
    """Records without the first of each file, which must name the columns, and without empty
    lines; the carriage return before a line break belongs to the break."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for path, first, text in zip(
                *[batch.column(c).to_pylist() for c in ("path", "first", "text")]
            ):
                text = text.removesuffix("\r")
                if first:
                    found = next(csv.reader([text.removeprefix("﻿")], strict=True), [])
                    if found != names:
                        raise ValueError(f"{path} has the columns {found}, expected {names}.")
                elif text:
                    texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])

    return run
