"""Operator 1, near-duplicates by HyperMinHash.

1. Sketch: one hash of every shingle; its top 8 bits pick one of 256 buckets, and of the least
   hash of a bucket the sketch keeps the count of leading zeros and 26 mantissa bits.
2. Texts with the same shingle set become one class; from here on a class is one row.
3. Banding: 42 bands of 6 registers. Classes that share a band meet in its bucket. A bucket
   of more than 1,024 classes is cut into chunks, and pairs of chunks meet. The last 32 bands
   only compare classes that the first ten have not joined yet.
4. Estimate: where classes meet, the share of equal registers (8 bits of each: 4 for the zeros,
   4 of the mantissa) is corrected for chance collisions. Pairs that may reach the similarity,
   five standard errors given, join their classes to a family; only a spanning forest is
   written, never the pairs.
5. Verification: chunks of a family find the sizes of all their intersections from the full
   shingle sets as one matrix product. Of the parts that exact links make, only the heads go on
   to new chunks; parts that stay apart are compared in full at the end, so no link is lost.

A pair at the similarity misses all bands once in 100,000 at 0.8, in 100 million at 0.85.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.arrays import (
    BASE_A,
    Substrings,
    flat,
    lower_table,
    mixed,
    owners,
    slices,
    word_hashes,
    word_spans,
)
from parcelflow.llm.components import components
from parcelflow.llm.storage import (
    BODY,
    ROW,
    join_by_row,
    keyed_texts,
    shuffle_partitions,
    write_table,
)

REGISTERS = 256
BAND_ROWS = 6
MANTISSA = 26
COARSE_ZEROS = 15
ERRORS = 5.0
CHUNK = 1024
SET_CHUNK = 128
ROUNDS = ((0, 10), (10, REGISTERS // BAND_ROWS))

SKETCHES = f"{ROW} long, id {{}}, n long, a long, b long, sketch binary, bands binary"


def shingle_sets(
    column: pa.Array, words: int
) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the distinct shingles of all texts, in order, and where each text's begin.

    Texts with fewer words than a shingle have their whole word sequence as one shingle."""
    data, offsets = flat(column)
    begins, ends, first = word_spans(lower_table()[data], offsets)
    hashes = Substrings(word_hashes(lower_table()[data], begins, ends), BASE_A)
    count = np.diff(first)
    n = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    before = np.cumsum(n) - n
    at = np.arange(n.sum()) + np.repeat(first[:-1] - before, n)
    text = np.repeat(np.arange(len(n)), n)
    shingles = hashes.between(at, at + np.repeat(np.minimum(count, words), n))
    order = np.argsort(shingles)
    order = order[np.argsort(text[order], kind="stable")]
    shingles, text = shingles[order], text[order]
    new = np.ones(len(shingles), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (text[1:] != text[:-1])
    shingles, text = shingles[new], text[new]
    return shingles, np.searchsorted(text, np.arange(len(n) + 1))


def registers(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of the least hash of every bucket; 0 for an empty bucket."""
    text = owners(first, np.arange(len(shingles)))
    bucket = (shingles >> np.uint64(56)).astype(np.int64)
    place = text * REGISTERS + bucket
    least = np.ones(len(place), bool)
    least[1:] = place[1:] != place[:-1]
    value = shingles[least] & np.uint64((1 << 56) - 1)
    top = np.frexp(np.maximum(value, 1).astype(np.float64))[1] - 1
    top = np.minimum(top, 55)
    zeros = 55 - top
    rest = (value << (56 - top).astype(np.uint64)) & np.uint64((1 << 56) - 1)
    mantissa = (rest >> np.uint64(56 - MANTISSA)).astype(np.int64)
    out = np.zeros((len(first) - 1) * REGISTERS, np.int64)
    out[place[least]] = 1 + (zeros.astype(np.int64) << MANTISSA | mantissa)
    return out.reshape(-1, REGISTERS)


def coarse(full: np.ndarray) -> np.ndarray:
    """Registers of 8 bits; 0 stays the empty one."""
    zeros = np.minimum((full - 1) >> MANTISSA, COARSE_ZEROS - 1)
    mantissa = ((full - 1) >> (MANTISSA - 4)) & 15
    return np.where(full > 0, 1 + zeros * 16 + mantissa, 0).astype(np.uint8)


def chance(n: np.ndarray) -> np.ndarray:
    """How likely the coarse registers of two unrelated sets of about ``n`` are equal."""
    # Every real cell has its own bounds; from the last level on, cells of a mantissa are one.
    zeros, mantissa = np.divmod(np.arange(56 * 16), 16)
    low = 2.0 ** -(zeros + 1) * (1 + mantissa / 16)
    high = 2.0 ** -(zeros + 1) * (1 + (mantissa + 1) / 16)
    # One size for each quarter of an octave is close enough.
    step, back = np.unique(np.round(4 * np.log2(np.maximum(n, 1))), return_inverse=True)
    rate = 2.0 ** (step / 4)[:, None] / REGISTERS
    share = np.exp(-rate * low) * -np.expm1(-rate * (high - low))
    share = share / np.maximum(-np.expm1(-rate), 1e-12)
    last = (COARSE_ZEROS - 1) * 16
    told = share[:, : last + 16].copy()
    told[:, last:] = share[:, last:].reshape(len(step), -1, 16).sum(1)
    return (told**2).sum(1)[back]


def _sketch(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BODY):
            shingles, first = shingle_sets(batch.column(BODY), words)
            full = registers(shingles, first)
            bands = REGISTERS // BAND_ROWS
            rows = full[:, : bands * BAND_ROWS].reshape(-1, bands, BAND_ROWS).astype(np.uint64)
            key = np.zeros(rows.shape[:2], np.uint64)
            for k in range(BAND_ROWS):
                key = mixed(key * np.uint64(31) + rows[:, :, k] + np.arange(bands, dtype=np.uint64))
            key[~rows.any(axis=2)] = 0
            totals = [np.zeros(len(shingles) + 1, np.uint64) for _ in range(2)]
            np.cumsum(shingles, out=totals[0][1:])
            np.cumsum(mixed(shingles ^ np.uint64(BASE_A)), out=totals[1][1:])
            sums = [t[first[1:]] - t[first[:-1]] for t in totals]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(ROW),
                    batch.column("id"),
                    pa.array(np.diff(first)),
                    pa.array(sums[0].view(np.int64)),
                    pa.array(sums[1].view(np.int64)),
                    pa.array([r.tobytes() for r in coarse(full)], pa.binary()),
                    pa.array([k.tobytes() for k in key], pa.binary()),
                ],
                names=[ROW, "id", "n", "a", "b", "sketch", "bands"],
            )

    return run


def _each_band(low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blob = b"".join(batch.column("bands").to_pylist())
            keys = np.frombuffer(blob, np.int64).reshape(batch.num_rows, -1)[:, low:high]
            rows, bands = np.nonzero(keys)
            nodes = batch.column(ROW).to_numpy()[rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[rows, bands]), pa.array(nodes)], names=["meet", ROW]
            )

    return run


def cells(members: DataFrame, size: Column, most: int) -> DataFrame:
    """Cut the members of every meeting into chunks of about ``most`` and let every pair of
    chunks meet in a cell of its own: columns ``meet``, ``i``, ``j``, ``chunk`` are added."""
    chunks = F.ceil(size / most).cast("int")
    chunk = F.pmod(F.xxhash64(ROW), chunks).cast("int")
    placed = members.withColumn("chunks", chunks).withColumn("chunk", chunk)
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    return (
        placed.select("*", other)
        .withColumn("i", F.least("chunk", "other"))
        .withColumn("j", F.greatest("chunk", "other"))
        .drop("other", "chunks")
    )


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole cells from batches sorted by cell: the last cell of a batch waits for
    the next one."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = _cell_starts(batch)
        last = int(ends[-1])
        same = bool(kept) and all(
            kept[-1].column(c)[-1] == batch.column(c)[0] for c in ("meet", "i", "j")
        )
        if same and last == 0:
            kept.append(batch)
            continue
        if kept and not same:
            yield pa.Table.from_batches(kept)
            kept = []
        if last:
            yield pa.Table.from_batches([*kept, batch.slice(0, last)])
        kept = [batch.slice(last)]
    if kept:
        yield pa.Table.from_batches(kept)


def _cell_starts(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for c in ("meet", "i", "j"):
        values = rows.column(c).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _forest(nodes: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For links between rows: each linked row's node and the least node it is joined to."""
    label = nodes.copy()
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        if (new == label).all():
            break
        label = new
    moved = label != nodes
    return nodes[moved], label[moved]


def _may_link(share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_cells(batches):
            blob = b"".join(table.column("sketch").to_pylist())
            sketch = np.frombuffer(blob, np.uint8).reshape(-1, REGISTERS)
            nodes, size = table.column(ROW).to_numpy(), table.column("n").to_numpy()
            root = table.column("root").to_numpy()
            chunk, i, j = (table.column(c).to_numpy() for c in ("chunk", "i", "j"))
            starts = _cell_starts(table)
            cell = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(nodes))))
            left, right = [], []
            step = 1
            while True:
                k = np.flatnonzero(cell[step:] == cell[:-step])
                if not len(k):
                    break
                a, b = k, k + step
                # In a cell of two chunks, only pairs across them; sizes must allow the share;
                # what one family holds already needs no second look.
                fits = ((i[a] == j[a]) | (chunk[a] != chunk[b])) & (root[a] != root[b])
                fits &= np.minimum(size[a], size[b]) >= share * np.maximum(size[a], size[b])
                a, b = a[fits], b[fits]
                for at in range(0, len(a), 20_000):
                    x, y = a[at : at + 20_000], b[at : at + 20_000]
                    p, q = sketch[x], sketch[y]
                    used = ((p | q) > 0).sum(1)
                    equal = ((p == q) & (p > 0)).sum(1) / np.maximum(used, 1)
                    by_chance = chance((size[x] + size[y]) / 2)
                    estimate = (equal - by_chance) / (1 - by_chance)
                    close = estimate >= share - ERRORS * np.sqrt(
                        share * (1 - share) / np.maximum(used, 1)
                    )
                    left.append(x[close])
                    right.append(y[close])
                step += 1
            if left:
                u, v = _forest(nodes, np.concatenate(left), np.concatenate(right))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BODY):
            shingles, first = shingle_sets(batch.column(BODY), words)
            sets = [shingles[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), pa.array(sets, pa.binary())], names=[ROW, "shingles"]
            )

    return run


def _links(sets: list[np.ndarray], across: np.ndarray, share: tuple[int, int]):
    """Pairs of sets with ``100 * |A & B| >= 85 * |A | B|`` (for a share of 85 of 100)."""
    size = np.array([len(s) for s in sets])
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), size)
    common = np.bincount(code)
    code_of = np.cumsum(common > 1) - 1
    shared = common[code] > 1
    row, code = row[shared], code_of[code[shared]]
    width = int(code.max()) + 1 if len(code) else 0
    both = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    step = max(1, 8_000_000 // max(1, len(sets)))
    for low in range(0, width, step):
        a, b = np.searchsorted(code, [low, low + step])
        held = np.zeros((len(sets), min(step, width - low)), np.float32)
        held[row[a:b], code[a:b] - low] = 1
        both += held @ held.T
    both = both.astype(np.int64)
    union = size[:, None] + size[None, :] - both
    linked = share[1] * both >= share[0] * union
    linked &= across
    return np.nonzero(np.triu(linked, 1))


def _do_link(share: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_cells(batches):
            nodes = table.column(ROW).to_numpy()
            chunk, i, j = (table.column(c).to_numpy() for c in ("chunk", "i", "j"))
            blobs = table.column("shingles").to_pylist()
            starts = _cell_starts(table)
            us, vs = [], []
            for a, b in zip(starts, np.append(starts[1:], len(nodes))):
                if b - a < 2:
                    continue
                sets = [np.frombuffer(x, np.uint64) for x in blobs[a:b]]
                own = chunk[a:b]
                across = (own[:, None] != own[None, :]) | bool(i[a] == j[a])
                u, v = _forest(nodes[a:b], *_links(sets, across, share))
                us.append(u)
                vs.append(v)
            if us:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"]
                )

    return run


def _exact_components(
    texts: DataFrame, families: DataFrame, words: int, share: tuple[int, int]
) -> DataFrame:
    """``node`` and ``root`` of the exact links inside ``families``.

    No pair inside one component needs a look, so large families get there by halves: chunks
    compare their own members; the heads of the parts that come out meet in new chunks as long
    as that halves them; at last, members of parts still apart are compared across the parts.
    """
    partitions = shuffle_partitions(texts.sparkSession)
    members = families.select(F.col("node").alias(ROW), F.col("root").alias("meet"))
    sets = write_table(
        join_by_row(texts.select(ROW, BODY), members.select(ROW), "inner").mapInArrow(
            _sets(words), f"{ROW} long, shingles binary"
        )
    )

    def links(placed: DataFrame) -> DataFrame:
        """Forests of the exact links of cells: ``ROW``, ``meet``, ``i``, ``j``, ``chunk``."""
        seen = (
            placed.join(sets, ROW)
            .select("meet", "i", "j", "chunk", ROW, "shingles")
            .repartition(partitions, "meet", "i", "j")
            .sortWithinPartitions("meet", "i", "j")
        )
        return write_table(seen.mapInArrow(_do_link(share), "u long, v long"))

    def in_chunks(rows: DataFrame, sizes: DataFrame, salt: int) -> DataFrame:
        chunk = F.pmod(F.xxhash64(ROW, F.lit(salt)), F.ceil(F.col("size") / SET_CHUNK)).cast("int")
        placed = rows.join(sizes, "meet").withColumn("chunk", chunk)
        return placed.withColumn("i", F.col("chunk")).withColumn("j", F.col("chunk"))

    count = F.count("*").alias("size")
    sizes = members.groupBy("meet").agg(count)
    found = links(in_chunks(members, sizes, 0))
    large = members.join(sizes.where(F.col("size") > SET_CHUNK).select("meet"), "meet")
    large = write_table(large)
    salt, before, met = 0, None, False
    while True:
        known = write_table(components(found))
        part = F.coalesce("root", ROW).alias("part")
        parts = large.join(known.withColumnRenamed("node", ROW), ROW, "left").select(ROW, "meet", part)
        parts = write_table(parts)
        heads = parts.where(F.col(ROW) == F.col("part"))
        apart = heads.groupBy("meet").agg(count).where("size > 1")
        now, most = apart.agg(F.sum("size"), F.max("size")).first()
        if not now:
            return known
        # Heads that have all met in one chunk have nothing more to find.
        if before is not None and (2 * now > before or met):
            break
        salt, before, met = salt + 1, now, most <= SET_CHUNK
        found = found.union(links(in_chunks(heads, apart, salt)))
    found = found.union(links(_across(parts.join(apart.select("meet"), "meet"))))
    return components(found)


def _across(parts: DataFrame) -> DataFrame:
    """Cells for the members (``ROW``, ``meet``, ``part``) of families of several parts. Chunks
    of the largest part of a family meet those of all others, never one another."""
    sizes = parts.groupBy("meet", "part").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("meet").agg(
        F.max(F.struct("size", "part")).alias("largest"), F.sum("size").alias("all")
    )
    most = F.ceil(F.col("largest.size") / SET_CHUNK).cast("int")
    rest = F.ceil((F.col("all") - F.col("largest.size")) / SET_CHUNK).cast("int")
    placed = parts.join(
        largest.select(
            "meet", F.col("largest.part").alias("base"), most.alias("most"), rest.alias("rest")
        ),
        "meet",
    )
    in_base = F.col("part") == F.col("base")
    hashed = F.xxhash64(ROW)
    chunk = F.when(in_base, F.col("rest") + F.pmod(hashed, "most")).otherwise(F.pmod(hashed, "rest"))
    last = F.when(in_base, F.col("rest")).otherwise(F.col("rest") + F.col("most")) - 1
    return (
        placed.select(ROW, "meet", chunk.cast("int").alias("chunk"), last.alias("last"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
        .withColumn("i", F.least("chunk", "other"))
        .withColumn("j", F.greatest("chunk", "other"))
    )


def near_groups(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    words: int = 5,
    share: tuple[int, int] = (80, 100),
) -> DataFrame:
    """One row per row of ``df``: id, ``n_shingles``, ``component_id``, ``kept``.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. Two rows are linked when
    ``share[1] * |A & B| >= share[0] * |A | B|`` for their sets of distinct shingles; a text with
    fewer words than a shingle has its whole sequence as one. ``component_id`` is the least id
    that links reach, itself included. A null or empty text, or one without words, has an empty
    set and no links. Equal rows are one class and get one component; rows with a null id take
    part, and a component of null ids only has a null id. ``kept`` marks the rows whose id is
    the component's (for a null component: its first row). Other columns are ignored.
    """
    texts, _ = keyed_texts(df, text, id_column)
    told = _groups_of(texts, words, share)
    kept = F.col("alone") | (F.col("id") == F.col("component_id"))
    return told.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(kept, F.col("stays")).alias("kept"),
    )


def drop_near_copies(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    words: int = 5,
    share: tuple[int, int] = (80, 100),
) -> DataFrame:
    """``df`` with one row of each group of ``near_groups``: the one with the least id (null ids
    last), of several the first. All rows without words stay."""
    texts, _ = keyed_texts(df, text, id_column, whole="whole")
    stay = _groups_of(texts, words, share).where("stays").select(ROW)
    rest = [F.col(f"whole.`{c}`").alias(c) if c != text else F.col(BODY).alias(c) for c in df.columns]
    return join_by_row(texts, stay, "inner").select(*rest)


def _groups_of(texts: DataFrame, words: int, share: tuple[int, int]) -> DataFrame:
    """Row key, ``id``, ``n``, ``alone``, ``component_id``, ``stays`` of every row of a keyed table."""
    partitions = shuffle_partitions(texts.sparkSession)
    id_type = texts.schema["id"].dataType.simpleString()
    sketches = write_table(texts.select(ROW, "id", BODY).mapInArrow(_sketch(words), SKETCHES.format(id_type)))

    classes = sketches.where("n > 0").groupBy("a", "b", "n").agg(
        F.min(ROW).alias("node"),
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", ROW)).alias("least"),
    )
    of_class = write_table(
        sketches.where("n > 0")
        .select(ROW, "a", "b", "n", "sketch", "bands")
        .join(classes.select("a", "b", "n", "node"), ["a", "b", "n"])
        .where(F.col(ROW) == F.col("node"))
        .select(ROW, "n", "sketch", "bands")
    )
    families = links = None
    for low, high in ROUNDS:
        met = of_class.select(ROW, "bands").mapInArrow(_each_band(low, high), f"meet long, {ROW} long")
        if families is None:
            met = met.withColumn("root", F.col(ROW))
        else:
            known = families.withColumnRenamed("node", ROW)
            met = met.join(known, ROW, "left").withColumn("root", F.coalesce("root", ROW))
        met = write_table(met)
        sizes = met.groupBy("meet").agg(
            F.count("*").alias("size"), F.min("root").alias("least"), F.max("root").alias("most")
        )
        sizes = sizes.where(F.col("least") != F.col("most")).select("meet", "size")
        seen = (
            cells(met.join(sizes, "meet"), F.col("size"), CHUNK)
            .join(of_class.select(ROW, "n", "sketch"), ROW)
            .select("meet", "i", "j", "chunk", ROW, "root", "n", "sketch")
            .repartition(partitions, "meet", "i", "j")
            .sortWithinPartitions("meet", "i", "j")
        )
        close = write_table(seen.mapInArrow(_may_link(share[0] / share[1]), "u long, v long"))
        links = close if links is None else links.union(close)
        families = write_table(components(links))

    linked = _exact_components(texts, families, words, share)

    rooted = classes.join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = write_table(rooted)
    least = rooted.groupBy("root").agg(F.min("least").alias("least"))
    told = sketches.select(ROW, "id", "n", "a", "b").join(
        rooted.select("a", "b", "n", "root").join(least, "root"), ["a", "b", "n"], "left"
    )
    alone = F.col("root").isNull()
    return told.select(
        ROW,
        "id",
        "n",
        alone.alias("alone"),
        F.when(alone, F.col("id")).otherwise(F.col("least.id")).alias("component_id"),
        (alone | (F.col(ROW) == F.col(f"least.{ROW}"))).alias("stays"),
    )
