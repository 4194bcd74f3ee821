"""Operator 4, benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

The benchmark is a stated query set: it is worked through in blocks of items of bounded size,
each held in memory by the tasks, against all rows.

1. Seeds: the runs of three words of the items. A run that at most ``RARE`` items of the block
   hold is rare and a seed by itself. Rarity is judged within the benchmark, so that the search
   does not depend on what else the corpus holds, nor on its size.
2. Seeds join: all runs of three words of all documents meet the seeds; hits of an item that
   lie close together make a passage. It counts with a rare run, or with two different common ones:
   what many items share, a stock phrase, is no sign of any of them by a single run.
   A passage that shares too few words with the item to reach the similarity is let go: no
   alignment can match more words than both have.
3. The passage, with two item lengths on both sides, is aligned with the whole item (match 2,
   mismatch -1, gap -1). The score over the highest possible one is the similarity.

Words are runs of ASCII letters and digits and of bytes above 127, with A-Z lower-cased, so
punctuation and markup do not hide a copy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.pandas.types import to_arrow_type

from parcelflow.llm.arrays import (
    Substrings,
    flat,
    is_in,
    lower_table,
    owners,
    slices,
    starts_inside,
    word_hashes,
    word_spans,
)
from parcelflow.llm.storage import fresh

RUN = 3
MATCH, MISMATCH, GAP = 2, -1, -1
SIMILAR = 0.5
#: A run is rare if at most so many items of a block hold it.
RARE = 16
#: Pairs of a hit and an item that a task holds at a time; more are dealt by ranges of items.
HELD_PAIRS = 1_000_000
#: Bytes of benchmark text that are held at a time.
BLOCK_BYTES = 4_000_000

LEAKS = "id {}, item_id {}, similarity double, first_word int, last_word int"


def _separators() -> np.ndarray:
    apart = np.ones(256, bool)
    apart[128:] = False
    for low, high in ((48, 58), (65, 91), (97, 123)):
        apart[low:high] = False
    return apart


def _hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(column)
    data = lower_table()[data]
    begins, ends, first = word_spans(data, offsets, _separators())
    return word_hashes(data, begins, ends), first


def _seeds(words: np.ndarray, first: np.ndarray):
    """Hashes of the items' runs in order, where the items of each begin, and those items in
    order; the last entry of the beginnings is their number."""
    places = starts_inside(first, RUN)
    hashes, item = Substrings(words).all_of(RUN)[places], owners(first, places)
    # A run that an item repeats is one seed.
    order = np.lexsort((item, hashes))
    hashes, item = hashes[order], item[order]
    new_run = np.ones(len(hashes), bool)
    new_run[1:] = hashes[1:] != hashes[:-1]
    new = new_run.copy()
    new[1:] |= item[1:] != item[:-1]
    item, new_run = item[new], new_run[new]
    return hashes[new][new_run], np.append(np.flatnonzero(new_run), len(item)), item


def _pairs(place: np.ndarray, run: np.ndarray, n_items: int) -> Iterator[tuple]:
    """For the hits of the runs ``run``: which hit, and an item that holds its run, in parts of
    at most ``HELD_PAIRS`` or of a single item. ``place`` is ``run * n_items + item`` of every
    seed in order, so the items of a run in any range lie side by side."""
    todo = [(0, n_items)]
    while todo:
        low, high = todo.pop()
        start = np.searchsorted(place, run * n_items + low)
        many = np.searchsorted(place, run * n_items + high) - start
        total = int(many.sum())
        if total > HELD_PAIRS and high - low > 1:
            todo += [((low + high) // 2, high), (low, (low + high) // 2)]
        elif total:
            hit = np.repeat(np.arange(len(run)), many)
            at = np.arange(total) + np.repeat(start - (np.cumsum(many) - many), many)
            yield hit, place[at] % n_items


def aligned(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """Smith-Waterman over words: similarity, and the words of the passage that it spans."""
    n = len(passage)
    ramp = -GAP * np.arange(1, n + 1)
    above, start_above = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, -1)
    for word in item:
        step = np.where(passage == word, MATCH, MISMATCH)
        over = above[:-1] + step
        down = above[1:] + GAP
        score = np.maximum(np.maximum(over, down), 0)
        start = np.where(over >= down, start_above[:-1], start_above[1:])
        start = np.where(score > 0, start, np.arange(1, n + 1))
        # A gap in the item: the best so far, less what the gap costs.
        climb = score + ramp
        high = np.maximum.accumulate(climb)
        source = np.maximum.accumulate(np.where(climb == high, np.arange(n), 0))
        score, start = high - ramp, start[source]
        above = np.append(0, score)
        start_above = np.append(0, start)
        top = int(score.argmax())
        if score[top] > best[0]:
            best = (int(score[top]), int(start[top]), top)
    return best[0] / (MATCH * max(len(item), 1)), best[1], best[2]


def _find(items: list[np.ndarray], names: list, seeds, similar: float, kinds: tuple):
    hashes, begin, item_of = seeds
    rare = np.diff(begin) <= RARE
    place = np.repeat(np.arange(len(hashes)), np.diff(begin)) * len(items) + item_of
    length = np.array([len(x) for x in items], np.int64)
    # The words of each item in order, and how often it has each.
    counted = [np.unique(x, return_counts=True) for x in items]

    def shared(i: int, passage: np.ndarray) -> int:
        """How many words of the item can have a match in the passage."""
        own, times = counted[i]
        at = np.minimum(np.searchsorted(own, passage), len(own) - 1)
        seen = np.bincount(at[own[at] == passage], minlength=len(own))
        return int(np.minimum(seen, times).sum())

    def passages(item, at, text, run):
        """Text, item, first and last word of the passages that count."""
        order = np.lexsort((at, item))
        item, at, text, run = item[order], at[order], text[order], run[order]
        new = np.ones(len(item), bool)
        new[1:] = (
            (item[1:] != item[:-1])
            | (text[1:] != text[:-1])
            | (np.diff(at) > 2 * length[item[1:]])
        )
        begins = np.flatnonzero(new)
        last = np.append(begins[1:], len(new)) - 1
        counts = np.logical_or.reduceat(rare[run], begins)
        counts |= np.minimum.reduceat(run, begins) != np.maximum.reduceat(run, begins)
        begins, last = begins[counts], last[counts]
        return text[begins], item[begins], at[begins], at[last]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body"):
            words, first = _hashed_words(batch.column("body"))
            places = starts_inside(first, RUN)
            places = places[is_in(Substrings(words).all_of(RUN)[places], hashes)]
            if not len(places):
                continue
            run_of = np.searchsorted(hashes, Substrings(words).between(places, places + RUN))
            text_of = owners(first, places)
            best: dict[tuple, tuple] = {}
            for hit, item in _pairs(place, run_of, len(items)):
                for t, i, a, b in zip(*passages(item, places[hit], text_of[hit], run_of[hit])):
                    # With a gap for each word more, no alignment of an item reaches further.
                    reach = 2 * len(items[i]) + RUN
                    a, b = max(int(first[t]), a - reach), min(int(first[t + 1]), b + reach + RUN)
                    if shared(i, words[a:b]) < similar * len(items[i]):
                        continue
                    value, start, stop = aligned(items[i], words[a:b])
                    if value >= similar and value > best.get((t, i), (0,))[0]:
                        best[t, i] = (value, int(a - first[t] + start), int(a - first[t] + stop))
            ids = batch.column("id").to_pylist()
            found = [(ids[t], names[i], *x) for (t, i), x in best.items()]
            if found:
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0], kinds[0]),
                        pa.array(columns[1], kinds[1]),
                        pa.array(columns[2], pa.float64()),
                        pa.array(columns[3], pa.int32()),
                        pa.array(columns[4], pa.int32()),
                    ],
                    names=["id", "item_id", "similarity", "first_word", "last_word"],
                )

    return run


def leaks(
    df: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    similar: float = SIMILAR,
) -> DataFrame:
    """One row for each document and benchmark item that it holds: id, ``item_id``,
    ``similarity`` (``similar`` to 1) and the first and last word of the best passage.

    Items shorter than three words have no run and are never found, nor are copies that keep no
    rare run and but one common one; null and empty texts on either side match nothing; repeated items are each reported, and so are repeated rows and
    null ids. Other columns are ignored. Nothing found, or an empty table: no rows.
    """
    id_type = df.schema[id_column].dataType.simpleString()
    item_type = benchmark.schema[item_column].dataType.simpleString()
    rows = df.select(F.col(id_column).alias("id"), F.col(text).alias("body"))
    items = benchmark.select(
        F.col(item_column).alias("item_id"), F.coalesce(item_text, F.lit("")).alias("body")
    )
    total = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = total // BLOCK_BYTES + 1
    schema = LEAKS.format(id_type, item_type)
    kinds = (
        to_arrow_type(df.schema[id_column].dataType),
        to_arrow_type(benchmark.schema[item_column].dataType),
    )
    results = None
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "body"), F.lit(blocks)) == k)
        held = block.orderBy("item_id", "body").collect()
        words, first = _hashed_words(pa.array([r.body for r in held], pa.string()))
        seeds = _seeds(words, first)
        each = [words[a:b] for a, b in zip(first[:-1], first[1:])]
        found = rows.mapInArrow(_find(each, [r.item_id for r in held], seeds, similar, kinds), schema)
        results = found if results is None else results.unionByName(found)
    return results.withColumnRenamed("id", id_column)


def without_leaks(
    df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``df`` that hold no benchmark item, with all their columns. A row with a
    null id stays unless a leaking row has a null id too."""
    leak = fresh(df, "_leak")
    found = leaks(df, benchmark, id_column, text).select(F.col(id_column).alias(leak)).distinct()
    return df.join(found, F.col(id_column).eqNullSafe(F.col(leak)), "left_anti")
