"""Questions to the whole corpus: which of these hashes occur more than once?

Every hash belongs to one part of the hash space, and one task answers for a part. A map task
sends one row with many hashes for each part, not one row a hash. What it can tell from its
own slice of texts it settles there: a hash that occurs twice in a slice travels once, marked
as repeated, and the places that asked for it have their answer. So a hash shared by many
texts reaches its task once from each slice, however many rows hold it, and no group of
copies is gathered.

Marks: 0 hashes that only count, 1 hashes that also ask, 2 places that have their answer,
3 hashes known to be repeated.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from parcelflow.llm.arrays import is_in, mixed, packed, repeated, unpacked
from parcelflow.llm.storage import ROW

SCHEMA = "part int, mark int, hashes binary, row_keys binary, places binary"
ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("mark", pa.int32()),
        ("hashes", pa.binary()),
        ("row_keys", pa.binary()),
        ("places", pa.binary()),
    ]
)
REPLIES = "texts int, row_keys binary, places binary"
FOUND = f"{ROW} long, found binary"
COUNTS, ASKS, ANSWERED, KNOWN = range(4)


def _rows(mark: int, part, parts: int, width: int, low, keys=None, places=None) -> Iterator[tuple]:
    """One row a part, from arrays in the order of the parts."""
    cuts = np.searchsorted(part, np.arange(parts + 1))
    for k in np.flatnonzero(np.diff(cuts)):
        own = slice(cuts[k], cuts[k + 1])
        yield (
            int(k),
            mark,
            b"" if low is None else packed(low[own], width),
            b"" if keys is None else keys[own].astype("<i8").tobytes(),
            b"" if places is None else places[own].astype("<i4").tobytes(),
        )


def send(
    part_hash: np.ndarray,
    low_hash: np.ndarray,
    width: int,
    parts: int,
    keys: np.ndarray,
    places: np.ndarray,
    asks: np.ndarray | None = None,
) -> pa.RecordBatch:
    """The hashes of one slice of texts as rows for their parts.

    ``part_hash`` picks the part and the low ``width`` bytes of ``low_hash`` are sent; with
    ``asks`` only these hashes want an answer for their row key and place.
    """
    part = ((part_hash >> np.uint64(40)) % np.uint64(parts)).astype(
        np.int16 if parts < 1 << 15 else np.int64
    )
    low = low_hash & np.uint64((1 << 8 * width) - 1)
    order = np.argsort(low)
    order = order[np.argsort(part[order], kind="stable")]
    part, low, keys, places = part[order], low[order], keys[order], places[order]
    asks = np.ones(len(low), bool) if asks is None else asks[order]
    same = np.zeros(len(low) + 1, bool)
    same[1:-1] = (low[1:] == low[:-1]) & (part[1:] == part[:-1])
    several = same[1:] | same[:-1]
    head = several & ~same[:-1]
    rows: list[tuple] = []
    for mark, which in ((COUNTS, ~several & ~asks), (KNOWN, head)):
        rows += _rows(mark, part[which], parts, width, low[which])
    which = ~several & asks
    rows += _rows(ASKS, part[which], parts, width, low[which], keys[which], places[which])
    which = several & asks
    # Their hash has its answer; they are dealt by text.
    settled, keys, places = (keys[which] % parts).astype(np.int64), keys[which], places[which]
    order = np.argsort(settled, kind="stable")
    rows += _rows(ANSWERED, settled[order], parts, width, None, keys[order], places[order])
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], ARROW.field(i).type) for i in range(5)], schema=ARROW
    )


def _answer(width: int, groups: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        hashes = {m: [np.zeros(0, np.uint64)] for m in range(4)}
        keys = {m: [np.zeros(0, np.int64)] for m in range(4)}
        places = {m: [np.zeros(0, np.int32)] for m in range(4)}
        columns = [table.column(c).to_pylist() for c in ("mark", "hashes", "row_keys", "places")]
        for mark, low, key, place in zip(*columns):
            hashes[mark].append(unpacked(low, width))
            keys[mark].append(np.frombuffer(key, "<i8"))
            places[mark].append(np.frombuffer(place, "<i4"))
        asked = np.concatenate(hashes[ASKS])
        seen = repeated(np.concatenate([*hashes[COUNTS], asked]))
        # A hash known from one slice answers those who ask for it from another.
        seen = np.union1d(seen, np.concatenate(hashes[KNOWN]))
        hit = is_in(asked, seen)
        own_keys = np.concatenate([*keys[ANSWERED], np.concatenate(keys[ASKS])[hit]])
        own_places = np.concatenate([*places[ANSWERED], np.concatenate(places[ASKS])[hit]])
        texts = mixed(own_keys.astype(np.uint64)) % np.uint64(groups)
        order = np.lexsort((own_places, own_keys, texts))
        texts, own_keys, own_places = texts[order], own_keys[order], own_places[order]
        group, first = np.unique(texts, return_index=True)
        ends = np.append(first[1:], len(texts))
        return pa.table(
            [
                pa.array(group.astype(np.int32)),
                pa.array([own_keys[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
                pa.array([own_places[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
            ],
            names=["texts", "row_keys", "places"],
        )

    return run


def _per_text(table: pa.Table) -> pa.Table:
    keys = np.frombuffer(b"".join(table.column("row_keys").to_pylist()), "<i8")
    places = np.frombuffer(b"".join(table.column("places").to_pylist()), "<i4")
    order = np.argsort(keys, kind="stable")
    keys, places = keys[order], places[order]
    own, first = np.unique(keys, return_index=True)
    ends = np.append(first[1:], len(keys))
    blobs = [places[a:b].tobytes() for a, b in zip(first, ends)]
    return pa.table([pa.array(own, pa.int64()), pa.array(blobs, pa.binary())], names=[ROW, "found"])


def answers(sent: DataFrame, width: int, parts: int) -> DataFrame:
    """One row for each text with an answer: ``found`` holds the places whose hash occurs
    elsewhere too. A part's answers travel as one row for each group of texts."""
    groups = 2 * parts
    replies = sent.groupBy("part").applyInArrow(_answer(width, groups), REPLIES)
    return replies.groupBy("texts").applyInArrow(_per_text, FOUND)


def place_column(found: pa.Array, first: np.ndarray, step: int = 1) -> np.ndarray:
    """Places of every text of a slice, counted from the start of the slice."""
    moved = [
        np.frombuffer(b, "<i4").astype(np.int64) * step + first[i]
        for i, b in enumerate(found.to_pylist())
        if b
    ]
    return np.concatenate(moved) if moved else np.zeros(0, np.int64)
