"""Operator 7, substring dedup with fixed-block anchors, over words.

1. Index: every text is cut into blocks of 18 words that do not overlap. Any 35 words of a
   text hold one whole block of it.
2. Probe: every rolling window of 18 words of every text is sent to the part of the hash
   space where the block with the same hash would be. A block that meets no second window
   is unique, and so is every longer window that holds it.
3. Extend: the windows of 35 words around the remaining blocks are hashed whole (two
   independent hashes, over 64 bits) and counted. Those that occur twice are exactly the
   repeated windows; their union is the set of maximal exact repeats.

Probes carry 40 bits besides the part, since a chance hit only makes a window more to count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from parcelflow.llm import blocks
from parcelflow.llm.arrays import (
    BASE_A,
    BASE_B,
    Substrings,
    covered,
    flat,
    owners,
    slices,
    starts_inside,
    word_hashes,
    word_spans,
)
from parcelflow.llm.storage import BODY, ROW, join_by_row, keyed_texts, shuffle_partitions

PROBE_BYTES = 5
WINDOW_BYTES = 8
#: Text bytes whose hashes one reduce task gathers, at most about 25 MB of hashes.
PART_BYTES = 24_000_000


def _words(batch: pa.RecordBatch):
    data, offsets = flat(batch.column(BODY))
    begins, ends, first = word_spans(data, offsets)
    return data, begins, ends, first, batch.column(ROW).to_numpy().astype(np.int64)


def _probe(block: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BODY):
            data, begins, ends, first, keys = _words(batch)
            places = starts_inside(first, block)
            if not len(places):
                continue
            own = owners(first, places)
            inside = places - first[own]
            hashes = Substrings(word_hashes(data, begins, ends)).all_of(block)[places]
            yield blocks.send(
                hashes, hashes, PROBE_BYTES, parts, keys[own], inside // block, inside % block == 0
            )

    return run


def _extend(block: int, width: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BODY):
            data, begins, ends, first, keys = _words(batch)
            places = starts_inside(first, width)
            own = owners(first, places)
            # A mark at the word where a repeated block begins.
            hits = np.zeros(int(first[-1]) + block + 1, bool)
            hits[blocks.place_column(batch.column("found"), first, block)] = True
            # The first block that begins in a window lies in it whole.
            kept = hits[places + (first[own] - places) % block]
            places, own = places[kept], own[kept]
            if not len(places):
                continue
            words = word_hashes(data, begins, ends)
            yield blocks.send(
                Substrings(words, BASE_A).between(places, places + width),
                Substrings(words, BASE_B).between(places, places + width),
                WINDOW_BYTES,
                parts,
                keys[own],
                places - first[own],
            )

    return run


def _cut(width: int, id_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BODY):
            data, begins, ends, first, _ = _words(batch)
            at = blocks.place_column(batch.column("found"), first)
            gone = covered(len(begins), at, at + width)
            removed = np.add.reduceat(np.append(gone, False), first[:-1]) if len(first) > 1 else []
            removed = np.where(np.diff(first) > 0, removed, 0)
            raw = data.tobytes()
            texts = []
            for i in range(batch.num_rows):
                own = np.flatnonzero(~gone[first[i] : first[i + 1]]) + first[i]
                texts.append(b" ".join([raw[a:b] for a, b in zip(begins[own], ends[own])]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(np.diff(first), pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                names=[id_name, "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return run


def remove_repeats(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 35
) -> DataFrame:
    """One row per row of ``df``: id, ``n_words``, ``n_removed``, ``kept_sha256``, ``kept_text``.

    A window is ``width`` consecutive words of one text. Each word goes that lies in a window
    whose word sequence also begins anywhere else, the same text included; windows are judged
    on the input. Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a null or empty text has none,
    a text shorter than a window keeps all. Ids may be null or repeated: each row is a text of
    its own, so of two equal rows both lose their windows. Other columns are ignored.
    """
    block = (width + 1) // 2
    texts, total = keyed_texts(df, text, id_column)
    parts = max(shuffle_partitions(df.sparkSession), total // PART_BYTES + 1)
    body = texts.select(ROW, BODY)
    hits = blocks.answers(body.mapInArrow(_probe(block, parts), blocks.SCHEMA), PROBE_BYTES, parts)
    windows = join_by_row(body, hits, "inner").mapInArrow(
        _extend(block, width, parts), blocks.SCHEMA
    )
    spans = blocks.answers(windows, WINDOW_BYTES, parts)
    id_type = df.schema[id_column].dataType.simpleString()
    schema = (
        f"`{id_column}` {id_type}, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
    return join_by_row(texts, spans, "left").mapInArrow(_cut(width, id_column), schema)
