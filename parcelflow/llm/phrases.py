"""Collocations by stripes: every prefix of words keeps a counter of the words that follow it.

A task turns its texts into stripes, one for the empty prefix (all words), one for every word
and one for every longer prefix, and sends their elements, next word and count, in blocks. The
elements of one stripe are dealt by prefix and next word together, so the stripe of a frequent
prefix is spread over all tasks; equal elements are added up there. What comes out holds
everything that is asked for: the extensions of a prefix, its own total (the element that leads
to it), and for every phrase the largest extension that holds it.

Null texts count as empty, null groups as ``und``. Texts without words and empty tables give
no phrases. Repeated rows count each time; columns other than text and group are not looked
at. Ties are ordered by the phrase, so ranks are the same in every run. Memory of a task
follows ``BLOCK_BYTES``, or the longest run of text without a separator. Counts must stay below
10**16, so that products fit 38 digits; larger ones raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from parcelflow.llm.arrays import mixed, word_hashes
from parcelflow.llm.storage import shuffle_partitions, text_bytes, write_table

BLOCK_BYTES = 8_000_000
#: Bytes of text whose stripes one shuffle partition merges.
MERGE_BYTES = 8_000_000
SALTS = 32
CUT = 255  # a byte that UTF-8 never holds parts the pieces
SEPARATORS = b".,;:!?\n\x0b\x0c\r"


def _table() -> bytes:
    """A-Z in lower case, tabs as spaces, separators as ``CUT``."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[9] = 32
    table[list(SEPARATORS)] = CUT
    return table.tobytes()


def _blocks(texts: list[bytes]) -> Iterator[bytes]:
    """Texts after the other, in blocks that end where a piece ends."""
    whole = bytes([CUT]).join(texts).translate(_table())
    begin = 0
    while len(whole) - begin > BLOCK_BYTES:
        end = whole.rfind(bytes([CUT]), begin, begin + BLOCK_BYTES)
        if end < 0:
            end = whole.find(bytes([CUT]), begin + BLOCK_BYTES)
        if end < 0:
            break
        yield whole[begin:end]
        begin = end + 1
    yield whole[begin:]


def _words(block: bytes) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Number of every word in the list of distinct words, number of its piece, the distinct
    words, and a hash of each."""
    data = np.frombuffer(block, np.uint8)
    cut = data == CUT
    inside = ~(cut | (data == 32))
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.append(0, np.cumsum(ends - begins)).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside]))]
    coded = pa.Array.from_buffers(pa.string(), len(begins), buffers).dictionary_encode()
    pieces = np.cumsum(cut)[begins]
    distinct = coded.dictionary
    _, at, raw = distinct.buffers()
    at = np.frombuffer(at, np.int32)[distinct.offset : distinct.offset + len(distinct) + 1]
    raw = np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)
    hashes = word_hashes(raw, at[:-1].astype(np.int64), at[1:].astype(np.int64))
    return coded.indices.to_numpy().astype(np.int64), pieces, distinct, hashes


def _elements(
    block: bytes, longest: int
) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Stripes of a block by length of the phrase: prefix and next word together, the hash
    that deals them, and their counts."""
    codes, pieces, distinct, hashes = _words(block)
    n = len(codes)
    yield pa.array([""]), np.zeros(1, np.uint64), np.array([n])
    if not n:
        return
    yield distinct, hashes, np.bincount(codes, minlength=len(distinct))
    prefix, phrases, deal = codes, distinct, hashes
    for size in range(2, longest + 1):
        at = np.flatnonzero(pieces[: n - size + 1] == pieces[size - 1 :])
        if not len(at):
            return
        own = prefix[at] * len(distinct) + codes[at + size - 1]
        keys, same, counts = np.unique(own, return_inverse=True, return_counts=True)
        before, after = keys // len(distinct), keys % len(distinct)
        phrases = pc.binary_join_element_wise(
            phrases.take(pa.array(before)), distinct.take(pa.array(after)), " "
        )
        deal = mixed(deal[before] * np.uint64(31) + hashes[after])
        prefix = np.zeros(n, np.int64)
        prefix[at] = same
        yield phrases, deal, counts


def _stripes(text: str, group: str, longest: int, parts: int):
    def lines(name: str, block: bytes) -> pa.RecordBatch:
        phrases, deal, counts = zip(*_elements(block, longest))
        part = mixed(np.concatenate(deal)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        part = part[order].astype(np.int64)
        counted = pa.array(np.concatenate(counts)).cast(pa.string())
        column = pc.binary_join_element_wise(pa.concat_arrays(phrases), counted, "\t")
        column = pc.binary_join_element_wise(column.take(pa.array(order)), "", "\n")
        cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        _, at, raw = column.buffers()
        ends = np.frombuffer(at, np.int32)[np.append(cuts, len(part))]
        packed = pa.Array.from_buffers(
            pa.string(), len(cuts), [None, pa.py_buffer(ends.copy()), raw]
        )
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * len(cuts), pa.string()), pa.array(part[cuts], pa.int32()), packed],
            names=["lang", "part", "lines"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            texts = batch.column(text).cast(pa.large_binary())
            for name, own in zip(batch.column(group).to_pylist(), texts):
                own = own.as_py()
                held.setdefault(name, []).append(own)
                size += len(own) + 1
                if size >= BLOCK_BYTES:
                    for key in list(held):
                        for block in _blocks(held.pop(key)):
                            yield lines(key, block)
                    size = 0
        for key in list(held):
            for block in _blocks(held.pop(key)):
                yield lines(key, block)

    return run


def phrase_counts(
    docs: DataFrame, text: str = "text", group: str = "lang", longest: int = 3, least: int = 10
) -> DataFrame:
    """``lang, words, phrase, f``: phrases of up to ``longest`` words that occur ``least``
    times; the empty phrase has the number of all words, however few."""
    spark = docs.sparkSession
    size = text_bytes(docs, text)
    partitions = max(shuffle_partitions(spark), size // MERGE_BYTES + 1)
    parts = 8 * partitions
    rows = docs.select(
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.col(group).cast("string"), F.lit("und")).alias("lang"),
    )
    stripes = rows.mapInArrow(
        _stripes("text", "lang", longest, parts), "lang string, part int, lines string"
    )
    line = F.explode(F.split("lines", "\n")).alias("line")
    # All elements of a part are in one partition already, so adding up needs no second shuffle.
    elements = stripes.repartition(partitions, "part").select("lang", "part", line)
    counts = (
        elements.where("line != ''")
        .select(
            "lang",
            "part",
            F.substring_index("line", "\t", 1).alias("phrase"),
            F.substring_index("line", "\t", -1).cast("long").alias("f"),
        )
        .groupBy("part", "lang", "phrase")
        .agg(F.sum("f").alias("f"))
        .where((F.col("f") >= least) | (F.col("phrase") == ""))
    )
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return counts.select("lang", words.alias("words"), "phrase", "f")


def _cuts(longest: int) -> Column:
    """Both parts of a phrase for every place to cut it."""
    return F.explode(
        F.filter(
            F.array(*[
                F.struct(
                    F.lit(k).alias("k"),
                    F.substring_index("phrase", " ", k).alias("left"),
                    F.expr(f"substring(phrase, length(substring_index(phrase, ' ', {k})) + 2)")
                    .alias("right"),
                )
                for k in range(1, longest)
            ]),
            lambda cut: cut["k"] < F.col("words"),
        )
    ).alias("cut")


def scored(counts: DataFrame, longest: int = 3) -> DataFrame:
    """``lang, words, phrase, a, l, r, n, score`` of phrases of two words and more, at the cut
    with the lowest score (of several, the first)."""
    known = counts.where("words > 0").select("lang", "phrase", "f")
    left = known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    cuts = (
        counts.where("words > 1")
        .select("lang", "words", "phrase", F.col("f").alias("a"), _cuts(longest))
        .select("lang", "words", "phrase", "a", "cut.*")
        .join(left, ["lang", "left"])
        .join(right, ["lang", "right"])
    )
    score = F.expr(
        "(CAST(a AS DECIMAL(16,0)) * CAST(a AS DECIMAL(16,0)) * 1000000BD)"
        " div (CAST(l AS DECIMAL(16,0)) * CAST(r AS DECIMAL(16,0)))"
    )
    best = cuts.groupBy("lang", "words", "phrase", "a").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    )
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return best.select(
        "lang", "words", "phrase", "a", "best.l", "best.r", "best.score"
    ).join(totals, "lang")


def subsumed(counts: DataFrame, longest: int = 3, share: tuple[int, int] = (50, 100)) -> DataFrame:
    """``lang, phrase`` of phrases that lie inside a longer one which is at least ``share`` as
    frequent."""
    part, whole = share
    spans = [(i, k) for k in range(2, longest) for i in range(1, longest - k + 2)]
    words = F.split("phrase", " ")
    inner = F.explode(F.array_distinct(F.filter(F.array(*[
        F.when(F.size(words) >= i + k - 1, F.array_join(F.slice(words, i, k), " "))
        for i, k in spans
    ]), lambda p: p.isNotNull() & (p != F.col("phrase")))))
    largest = (
        counts.where("words > 2")
        .select("lang", inner.alias("inner"), "f")
        .groupBy("lang", "inner")
        .agg(F.max("f").alias("largest"))
        .withColumnRenamed("inner", "phrase")
    )
    return (
        counts.where("words > 1")
        .join(largest, ["lang", "phrase"])
        .where(F.col("largest") * whole >= F.col("f") * part)
        .select("lang", "phrase")
    )


def collocations(
    docs: DataFrame,
    text: str = "text",
    group: str = "lang",
    longest: int = 3,
    least: int = 10,
    share: tuple[int, int] = (50, 100),
    top: int = 2000,
) -> DataFrame:
    """The ``top`` phrases of every group: ``lang, rank, phrase, a, l, r, n, score``."""
    counts = write_table(phrase_counts(docs, text, group, longest, least))
    found = scored(counts, longest)
    if longest > 2:
        found = found.join(subsumed(counts, longest, share), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # No task orders all phrases of a group: the best of each salt meet in a second round.
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))
    best = salted.withColumn("rank", first).where(F.col("rank") <= top)
    rank = F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")
    return (
        best.withColumn("rank", rank)
        .where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
