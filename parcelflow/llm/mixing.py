"""Operator 5, mixing sources to target weights by a min-cost flow.

Documents are counted by membership pattern (the set of sources they belong to). A small flow
problem over patterns and sources, with one node for each, decides how many words each pattern
gives: the first use of a pattern's words is free, the second and the third cost more and more,
so repetition is a last resort. Then documents are chosen in a seeded order: whole rounds for
all, and one more for those that still fit, in hash order, until no document left out fits in
what is open. Histograms of 65,536 bins find where the next one does not fit; only the bins
around that place come to the driver, which picks the largest sum that fits.

Only one row for each pattern comes to the driver; ``MOST_PATTERNS`` guards that, and more
patterns raise an error and are never dropped.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from parcelflow.llm.storage import fresh, write_table

#: Weights of the sources in order, repeating; fixed by the task.
WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
MOST_PATTERNS = 20_000
#: Places in hash order are numbers of 63 bits; a histogram tells 16 bits more than the one above.
PLACE_BITS, BIN_BITS = 63, 16
#: Up to so many open words, so many documents at a time are looked through for the best sum.
EXACT_WORDS, EXACT_ROWS = 50_000, 2_000
#: Documents that come to the driver at a time, of all patterns together, and of each at least.
MOST_ROWS, LEAST_ROWS = 100_000, 20


def source_targets(sizes: dict, weights: dict | None = None) -> dict:
    """Target of every source: its weight's share of all sizes, at most ``MOST_TIMES`` its
    own; what is over is shared again by weight until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = weights or {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(names)}
    targets, open_names, left = {}, list(names), sum(sizes.values())
    while open_names:
        total = sum(weights[s] for s in open_names)
        full = [
            s
            for s in open_names
            if Fraction(left * weights[s], total) > MOST_TIMES * sizes[s]
        ]
        if not full:
            targets |= {s: Fraction(left * weights[s], total) for s in open_names}
            break
        for s in full:
            targets[s] = Fraction(MOST_TIMES * sizes[s])
            left -= MOST_TIMES * sizes[s]
        open_names = [s for s in open_names if s not in targets]
    return {s: targets[s] for s in names}


def routed(patterns: dict[tuple, int], quotas: dict) -> dict[tuple, int]:
    """Words that each pattern gives: a min-cost flow from patterns to their sources' quotas.

    Successive shortest paths. A pattern's words can be used ``MOST_TIMES`` times at cost
    0, 1, 3, ...: convex, so a unit goes round again only where no fresh one can be routed."""
    names = list(quotas)
    keys = list(patterns)
    end = len(keys) + len(names) + 1
    place = {s: len(keys) + 1 + i for i, s in enumerate(names)}
    edges: list[list] = []  # to, capacity, cost; the next entry is the way back
    graph: list[list[int]] = [[] for _ in range(end + 1)]

    def connect(a: int, b: int, room: int, cost: int) -> None:
        graph[a].append(len(edges))
        edges.append([b, room, cost])
        graph[b].append(len(edges))
        edges.append([a, 0, -cost])

    for i, key in enumerate(keys):
        for times in range(MOST_TIMES):
            connect(0, i + 1, patterns[key], times * (times + 1) // 2)
        for s in key:
            connect(i + 1, place[s], MOST_TIMES * patterns[key], 0)
    for s in names:
        connect(place[s], end, quotas[s], 0)
    while True:
        cost: list[float] = [float("inf")] * (end + 1)
        came = [-1] * (end + 1)
        cost[0], queue, waiting = 0, [0], {0}
        while queue:
            a = queue.pop(0)
            waiting.discard(a)
            for k in graph[a]:
                b, room, c = edges[k]
                if room and cost[a] + c < cost[b]:
                    cost[b], came[b] = cost[a] + c, k
                    if b not in waiting:
                        queue.append(b)
                        waiting.add(b)
        if came[end] < 0:
            break
        room, at = None, end
        while at:
            k = came[at]
            room = edges[k][1] if room is None else min(room, edges[k][1])
            at = edges[k ^ 1][0]
        at = end
        while at:
            edges[came[at]][1] -= room
            edges[came[at] ^ 1][1] += room
            at = edges[came[at] ^ 1][0]
    given = dict.fromkeys(keys, 0)
    for i, key in enumerate(keys):
        given[key] = sum(edges[k ^ 1][1] for k in graph[i + 1] if not k % 2)
    return given


def _text_of(source: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("pattern", T.ArrayType(source)),
            T.StructField("rounds", T.LongType()),
            T.StructField("rest", T.LongType()),
        ]
    )


def _best_fill(docs: list[tuple[int, int]], gap: int) -> list[tuple[int, int]]:
    """Documents (row, size) that fill a gap so that no other one fits: in order while more than
    ``EXACT_WORDS`` are open, then by the largest sum of sizes that the gap holds."""
    taken, at = [], 0
    while at < len(docs) and gap > EXACT_WORDS:
        if docs[at][1] <= gap:
            taken.append(docs[at])
            gap -= docs[at][1]
        at += 1
    while at < len(docs) and gap:
        # Bit k of the last number says that some of the documents so far have k words together.
        fit = [d for d in docs[at : at + EXACT_ROWS] if d[1] <= gap]
        sums, mask = [1], (1 << gap + 1) - 1
        for _, size in fit:
            sums.append((sums[-1] | sums[-1] << size) & mask)
            if sums[-1] >> gap:
                break
        best = sums[-1].bit_length() - 1
        gap -= best
        for i in range(len(sums) - 2, -1, -1):
            if not sums[i] >> best & 1:
                taken.append(fit[i])
                best -= fit[i][1]
        at += EXACT_ROWS
    return taken


def _filled(rows: DataFrame, rests: dict[str, int]) -> tuple[dict[str, list[tuple]], list[int]]:
    """Documents that fill the rest of every pattern, in the order of their places. As
    spans ``(low, last, most)`` of places whose documents of at most ``most`` words are taken, and
    rows that are taken besides; no document left out fits in what is open.

    A round sums up, for every open pattern, the documents that fit by bins of their places. All
    before the first bin that does not fit are a span. That bin, with those behind it as far as
    they are few, is gone through on the driver, or cut into finer bins if it holds too many."""
    spark, end, top = rows.sparkSession, 1 << PLACE_BITS, PLACE_BITS - BIN_BITS
    gaps = {n: g for n, g in rests.items() if g > 0}
    # From where on, up to where, and by which bins a pattern is looked at.
    looks = {n: (0, end - 1, top) for n in gaps}
    spans: dict[str, list[tuple]] = {n: [] for n in gaps}
    picked: list[int] = []
    while looks:
        few = max(LEAST_ROWS, MOST_ROWS // len(looks))
        wanted = spark.createDataFrame(
            [(n, gaps[n], *look) for n, look in looks.items()],
            "name string, gap long, low long, last long, shift int",
        )
        fits = rows.join(F.broadcast(wanted), "name").where(
            (F.col("size") > 0) & (F.col("size") <= F.col("gap")) & F.col("place").between(F.col("low"), F.col("last"))
        )
        bins = fits.groupBy("name", "gap", F.expr("shiftrightunsigned(place, shift)").alias("bin")).agg(
            F.sum("size").alias("size"), F.count("*").alias("n")
        )
        upto = W.partitionBy("name").orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
        summed = bins.withColumn("upto", F.sum("size").over(upto)).withColumn("rows", F.sum("n").over(upto))
        full = F.col("upto") <= F.col("gap")
        before = F.coalesce(F.max(F.when(full, F.col("rows"))).over(W.partitionBy("name")), F.lit(0))
        near = (~full) & (F.col("rows") - F.col("before") <= few)
        found = {
            r.name: r
            for r in summed.withColumn("before", before)
            .groupBy("name")
            .agg(
                F.max(F.when(full, F.col("upto"))).alias("filled"),
                F.min(F.when(~full, F.col("bin"))).alias("stop"),
                F.max(F.when(near, F.col("bin"))).alias("few_to"),
            )
            .collect()
        }
        reads = []
        for n, (low, last, shift) in list(looks.items()):
            r = found.get(n)
            stop = None if r is None else r.stop
            # A bin holds places below ``low`` too when an earlier round ended inside it.
            at = last + 1 if stop is None else max(low, stop << shift)
            if at > low and r is not None:
                spans[n].append((low, at - 1, gaps[n]))
                gaps[n] -= r.filled or 0
            if stop is not None and r.few_to is None and shift:
                looks[n] = (at, min(last, ((stop + 1) << shift) - 1), max(0, shift - BIN_BITS))
                continue
            if stop is not None:
                far = stop if r.few_to is None else r.few_to
                upper = min(last, ((far + 1) << shift) - 1)
                reads.append((n, gaps[n], at, upper))
                at = upper + 1
            looks[n] = (at, end - 1, top)
        if reads:
            ranges = spark.createDataFrame(reads, "name string, gap long, low long, last long")
            near_rows = rows.join(F.broadcast(ranges), "name").where(
                (F.col("size") > 0) & (F.col("size") <= F.col("gap")) & F.col("place").between(F.col("low"), F.col("last"))
            )
            of_pattern: dict[str, list] = {}
            for r in sorted(near_rows.select("place", "row", "size", "name").collect()):
                of_pattern.setdefault(r.name, []).append((r.row, r.size))
            for n, docs in of_pattern.items():
                for row, size in _best_fill(docs, gaps[n]):
                    picked.append(row)
                    gaps[n] -= size
        looks = {n: look for n, look in looks.items() if gaps[n] > 0 and look[0] < end}
    return spans, picked


def mixed(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    sources: str = "source",
    weights: dict | None = None,
    seed: int = 42,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``df``: id, ``size``, ``source_size``, ``target``, ``taken``.

    ``sources`` is a column with one source, or with an array of sources that the document
    belongs to. Sizes are words ``[^\\x20\\x09-\\x0D]+`` (null text: 0). Without ``weights`` the
    sources in order of code points, null last, weigh 5, 2, 1, repeating. ``taken`` is a
    multiple of the size, 0 to 3 times; the columns in ``keep`` follow. ``source_size`` and ``target`` are of the document's
    source (of the first in order, if several). Rows repeated or with null ids count on their
    own; equal seeds give equal results. An empty table gives no rows.
    """
    spark = df.sparkSession
    kind = df.schema[sources].dataType
    several = isinstance(kind, T.ArrayType)
    source = kind.elementType if several else kind
    members = F.coalesce(F.col(sources), F.array().cast(kind)) if several else F.array(sources)
    pattern = F.array_sort(F.array_distinct(members))
    rows = df.withColumn("_mixed_row", F.monotonically_increasing_id())
    # The id's hash leads; where ids are null or repeated, the text's and the row's decide.
    place = (
        F.shiftleft(F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_column)), 48), 47)
        .bitwiseOR(F.shiftleft(F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), F.col(id_column), F.col(text)), 33), 16))
        .bitwiseOR(F.shiftrightunsigned(F.xxhash64(F.lit(seed + 2), "_mixed_row"), 48))
    )
    rows = rows.select(
        F.col("_mixed_row").alias("row"),
        F.col(id_column).alias("id"),
        F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
        pattern.alias("pattern"),
        place.alias("place"),
        F.struct(F.lit(0), *[F.col(c) for c in keep]).alias("kept"),
    )
    rows = write_table(rows)
    totals = rows.groupBy("pattern").agg(F.sum("size").alias("size"))
    found = totals.limit(MOST_PATTERNS + 1).collect()
    if len(found) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns")
    patterns = {tuple(r.pattern): r.size for r in found}
    sizes: dict = {}
    for key, size in patterns.items():
        for s in key:
            sizes[s] = sizes.get(s, 0) + size
    targets = source_targets(sizes, weights)
    given = routed(patterns, {s: round(t) for s, t in targets.items()})
    plan = []
    for key, size in patterns.items():
        rounds = min(MOST_TIMES, given[key] // size) if size else 0
        plan.append((list(key), rounds, given[key] - rounds * size))
    plans = spark.createDataFrame(plan, _text_of(source))

    # The pattern as text is a join key that also holds nulls.
    name = F.to_json(F.struct("pattern")).alias("name")
    rows = rows.withColumn("name", name)
    plans = plans.withColumn("name", name).select("name", "rounds", "rest")
    told_plans = plans.collect()
    spans, single = _filled(rows.select("row", "name", "size", "place"), {r.name: r.rest for r in told_plans})
    cuts = spark.createDataFrame(
        [(r.name, r.rounds, spans.get(r.name, [])) for r in told_plans],
        "name string, rounds long, spans array<struct<low:long,last:long,most:long>>",
    )
    later = rows.join(F.broadcast(cuts), "name")
    extra = spark.createDataFrame([(r, 1) for r in single], "row long, extra int")

    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    told = {s: (sizes[s], float(targets[s])) for s in order}
    own = []
    for key in patterns:
        lead = next((s for s in order if s in key), None)
        own.append((list(key), *told.get(lead, (0, 0.0))))
    own_schema = T.StructType(
        [
            T.StructField("pattern", T.ArrayType(source)),
            T.StructField("source_size", T.LongType()),
            T.StructField("target", T.DoubleType()),
        ]
    )
    owns = spark.createDataFrame(own, own_schema).withColumn("name", name).drop("pattern")
    # One row a pattern is sent to all tasks; Spark decides by size on the documents picked one
    # by one.
    chosen = later.join(F.broadcast(owns), "name").join(extra, "row", "left")
    inside = F.exists(
        "spans",
        lambda x: F.col("place").between(x["low"], x["last"]) & (F.col("size") <= x["most"]),
    )
    once_more = (inside & (F.col("size") > 0)).cast("int") + F.coalesce("extra", F.lit(0))
    return chosen.select(
        F.col("id").alias(id_column),
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("rounds") + once_more)).alias("taken"),
        *[F.col(f"kept.{c}").alias(c) for c in keep],
    )


def mix(df: DataFrame, id_column: str = "doc_id", text: str = "text", sources: str = "source") -> DataFrame:
    """The rows of ``df`` that the mix takes, with all their columns, ``mix_times`` (1 to 3) and
    ``mix_words``; columns that have these two names are replaced."""
    row = fresh(df, "_mix_row")
    rows = write_table(df.drop("mix_times", "mix_words").withColumn(row, F.monotonically_increasing_id()))
    taken = mixed(rows, id_column, text, sources, keep=(row,)).where("taken > 0")
    taken = taken.select(
        row,
        (F.col("taken") / F.col("size")).cast("int").alias("mix_times"),
        F.col("taken").alias("mix_words"),
    )
    return rows.join(taken, row).drop(row)
