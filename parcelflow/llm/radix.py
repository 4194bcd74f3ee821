"""Operator 10, suffix dedup by a depth-limited radix sort, over UTF-8 bytes.

The suffixes of all texts are put into groups digit by digit, the most significant first, and
only as deep as the threshold of 400 bytes. A suffix alone in its group leaves; what is still
in a group of two or more at full depth is exactly a repeated window. A digit is a hash of the
bytes it covers, since groups are wanted and not their order.

* First digit: 32 bytes, looked at where the content itself picks a place: where the hash of
  the 32 bytes is 0 modulo 64, and for a window without such a place its smallest hash.
  Equal windows pick equal places, so a window with a place whose digit is unique is unique.
* Second digit: the windows between two places share it; it covers all bytes of all of them
  (two hashes, 128 bits). Where two runs of windows agree, all their windows are repeated and
  one run stands for the others from there on.
* Third digit, full depth: every window of the runs that are still alone or stand for others
  (two hashes, over 64 bits).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import blocks
from parcelflow.llm.arrays import (
    BASE_A,
    BASE_B,
    Substrings,
    byte_values,
    covered,
    flat,
    owners,
    slices,
    starts_inside,
)
from parcelflow.llm.storage import (
    BODY,
    ROW,
    join_by_row,
    keyed_texts,
    shuffle_partitions,
    write_table,
)

DIGIT = 32
EVERY = 64
PLACE_BYTES = 5
WINDOW_BYTES = 8
#: Text bytes for each reduce task.
PART_BYTES = 24_000_000
SLICE_BYTES = 1_500_000

RUNS = f"a long, b long, {ROW} long, begin int, end int"
ALONE, REPEATED, STANDS = 0, 1, 2


def _texts(batch: pa.RecordBatch):
    data, offsets = flat(batch.column(BODY))
    return data, offsets, batch.column(ROW).to_numpy().astype(np.int64)


def first_digits(
    data: np.ndarray, offsets: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where windows begin, the place that each one's first digit is taken at, the places
    picked by their own digit, and the digit at every byte."""
    windows = starts_inside(offsets, width)
    digits = Substrings(byte_values()[data]).all_of(DIGIT)
    if not len(windows):
        return windows, windows, windows, digits
    whole = np.zeros(len(digits) + 1, bool)
    whole[starts_inside(offsets, DIGIT)] = True
    long_text = np.diff(offsets) >= width
    picked = np.flatnonzero((digits % np.uint64(EVERY) == 0) & whole[:-1])
    picked = picked[long_text[owners(offsets, picked)]]
    # A place past every byte ends the search.
    following = np.append(picked, len(data) + width)
    place = following[np.searchsorted(picked, windows)]
    without = place > windows + (width - DIGIT)
    if without.any():
        lone = windows[without]
        reach = np.lib.stride_tricks.sliding_window_view(digits, width - DIGIT + 1)
        smallest = [
            reach[lone[i : i + 2048]].argmin(axis=1) for i in range(0, len(lone), 2048)
        ]
        place[without] = lone + np.concatenate(smallest)
    return windows, place, picked, digits


def _first_pass(width: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BODY, SLICE_BYTES):
            data, offsets, keys = _texts(batch)
            _, place, picked, digits = first_digits(data, offsets, width)
            places = np.union1d(picked, place)
            if len(places):
                own = owners(offsets, places)
                yield blocks.send(
                    digits[places], digits[places], PLACE_BYTES, parts, keys[own], places - offsets[own]
                )

    return run


def _second_pass(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BODY, SLICE_BYTES):
            data, offsets, keys = _texts(batch)
            windows, place, picked, _ = first_digits(data, offsets, width)
            shared = np.zeros(len(data) + 1, bool)
            shared[blocks.place_column(batch.column("found"), offsets)] = True
            # A window stays if its own place is shared, and every picked place in it.
            lone = np.zeros(len(data) + 2, np.int64)
            lone[picked + 1] = ~shared[picked]
            lone = np.cumsum(lone)
            stays = shared[place] & (lone[windows + width - DIGIT + 1] == lone[windows])
            windows, place = windows[stays], place[stays]
            if not len(windows):
                continue
            cut = np.flatnonzero((np.diff(windows) != 1) | (np.diff(place) != 0)) + 1
            begins = windows[np.append(0, cut)]
            ends = windows[np.append(cut, len(windows)) - 1] + width
            values = byte_values()[data]
            first, second = Substrings(values, BASE_A), Substrings(values, BASE_B)
            own = owners(offsets, begins)
            size = (ends - begins).astype(np.uint64) * np.uint64(BASE_A)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((first.between(begins, ends) ^ size).view(np.int64)),
                    pa.array(second.between(begins, ends).view(np.int64)),
                    pa.array(keys[own]),
                    pa.array((begins - offsets[own]).astype(np.int32)),
                    pa.array((ends - offsets[own]).astype(np.int32)),
                ],
                names=["a", "b", ROW, "begin", "end"],
            )

    return run


def _states(runs: DataFrame) -> DataFrame:
    """The runs of each text as three lists, with what became of them.

    Copies are counted before the shuffle, and of each group only the run that stands for it
    travels back, to its own text. Every run without such an answer is repeated, so no task
    gathers the runs of a group.
    """
    runs = write_table(runs)
    groups = runs.groupBy("a", "b").agg(
        F.count("*").alias("n"), F.min(F.struct(ROW, "begin", "end")).alias("head")
    )
    alone = F.when(F.col("n") == 1, ALONE).otherwise(STANDS)
    heads = groups.select("head.*", alone.alias("state"))
    every = runs.select(ROW, "begin", "end", F.lit(None).cast("int").alias("state"))
    # Dealt by text once; both groupings below work on that.
    dealt = every.unionByName(heads).repartition(ROW)
    told = dealt.groupBy(ROW, "begin", "end").agg(
        F.coalesce(F.max("state"), F.lit(REPEATED)).alias("state")
    )
    lists = told.groupBy(ROW).agg(F.collect_list(F.struct("begin", "end", "state")).alias("runs"))
    return lists.select(ROW, *[F.col(f"runs.{c}").alias(c) for c in ("begin", "end", "state")])


def _runs(batch: pa.RecordBatch, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and state of all runs of a slice, counted from the start of the slice."""
    columns = []
    for name in ("begin", "end", "state"):
        lists = batch.column(name)
        count = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], np.int64)
        values = lists.flatten().to_numpy().astype(np.int64)
        columns.append(values if name == "state" else values + np.repeat(offsets[:-1], count))
    return tuple(columns)


def _third_pass(width: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BODY, SLICE_BYTES):
            data, offsets, keys = _texts(batch)
            begins, ends, state = _runs(batch, offsets)
            open_runs = state != REPEATED
            begins, ends, state = begins[open_runs], ends[open_runs], state[open_runs]
            if not len(begins):
                continue
            count = ends - begins - width + 1
            before = np.cumsum(count) - count
            places = np.arange(count.sum()) + np.repeat(begins - before, count)
            asks = np.repeat(state == ALONE, count)
            own = owners(offsets, places)
            values = byte_values()[data]
            yield blocks.send(
                Substrings(values, BASE_A).between(places, places + width),
                Substrings(values, BASE_B).between(places, places + width),
                WINDOW_BYTES,
                parts,
                keys[own],
                places - offsets[own],
                asks,
            )

    return run


def _cut(width: int, id_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BODY, SLICE_BYTES):
            data, offsets, _ = _texts(batch)
            begins, ends, state = _runs(batch, offsets)
            known = state != ALONE
            at = blocks.place_column(batch.column("found"), offsets)
            gone = covered(
                len(data),
                np.concatenate([begins[known], at]),
                np.concatenate([ends[known], at + width]),
            )
            removed, spans, kept = [], [], []
            for a, b in zip(offsets[:-1], offsets[1:]):
                own = gone[a:b]
                removed.append(int(own.sum()))
                spans.append(int(np.count_nonzero(np.diff(own.astype(np.int8), prepend=0) == 1)))
                kept.append(data[a:b][~own].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in kept], pa.string()),
                    pa.array(kept, pa.binary()),
                ],
                names=[id_name, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"],
            )

    return run


def remove_repeats(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 400
) -> DataFrame:
    """One row per row of ``df``: id, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256``, ``kept_bytes``.

    Each byte goes that lies in a string of ``width`` bytes (at least 32) that also begins
    anywhere else, the same text included; overlaps count and strings are judged on the input.
    Matches never cross texts. A null or empty text has no bytes, a text shorter than
    ``width`` keeps all. Ids may be null or repeated: each row is a text of its own, so of two
    equal rows both lose their strings. What is left may not be valid UTF-8, so it is binary.
    Other columns are ignored.
    """
    if width < DIGIT:
        raise ValueError(f"width must be {DIGIT} bytes at least")
    texts, total = keyed_texts(df, text, id_column)
    parts = max(shuffle_partitions(df.sparkSession), total // PART_BYTES + 1)
    body = texts.select(ROW, BODY)
    first = blocks.answers(
        body.mapInArrow(_first_pass(width, parts), blocks.SCHEMA), PLACE_BYTES, parts
    )
    second = _states(join_by_row(body, first, "inner").mapInArrow(_second_pass(width), RUNS))
    second = write_table(second)
    third = blocks.answers(
        join_by_row(body, second, "inner").mapInArrow(_third_pass(width, parts), blocks.SCHEMA),
        WINDOW_BYTES,
        parts,
    )
    id_type = df.schema[id_column].dataType.simpleString()
    schema = (
        f"`{id_column}` {id_type}, n_bytes long, n_removed long, n_spans long, "
        "kept_sha256 string, kept_bytes binary"
    )
    told = join_by_row(join_by_row(texts, second, "left"), third, "left")
    return told.mapInArrow(_cut(width, id_column), schema)
