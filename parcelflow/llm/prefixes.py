"""The trie of rebuilt conversations, without building any of them.

A conversation is rebuilt from the first turns of its base (the head) and its own later turns
(the suffix). The fingerprint of a run of turns is a sum of turn values times powers of a base,
modulo a prime, in four independent lanes. Runs compose: the fingerprint of head and suffix
together is that of the head plus that of the suffix times a power, and a suffix is a
difference of two prefixes. So running totals over the stored turns give the fingerprint of
every prefix of every rebuilt conversation; its texts stay where they are.

Prefixes are grouped by depth and fingerprint. Every member of a group refers to a stored turn
(its last) and to the group it extends; a group whose members differ in either, or two stored
turns that differ under one digest, stop the attempt, and it is made again with other bases.
By induction over depth a group that passes holds one sequence of turns.

Subtree sums need no walk over levels. The smallest member of a node owns it, and a
conversation owns a run of nodes that ends with its last, so the sum over a subtree is the sum
of what its members own, less what the node's owner owns above the node. Long conversations and
nodes with many members, children or ends are spread over tasks throughout.

Turns are ordered by turn (null first), equal ones by the digest of role and text; repeated rows
count each time. Null role or text becomes empty. Rows without ``conv_id`` belong to no
conversation and are left out; an empty table has no nodes. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.storage import write_table
from parcelflow.operators.prefix import running_totals

#: At most so many turns of the base go before a conversation's own.
MOST_HEAD = 5
BASE_STEP = 100
PRIME = 2**31 - 1
LANES = range(4)
#: Rows of one conversation that meet in one join key.
BLOCK = 100_000
PACK = 500
HEAVY = 1000
ATTEMPTS = 3
NODE = ["depth", "high", "low"]


def head_turns(conv_id: str | Column) -> Column:
    """How many turns a conversation takes from its base: its CRC-32 modulo 6."""
    name = F.col(conv_id) if isinstance(conv_id, str) else conv_id
    return F.crc32(name.cast("string")) % (MOST_HEAD + 1)


def _power(base: int, exponent: Column) -> Column:
    """``base ** exponent`` modulo the prime, by the bytes of the exponent."""
    out = None
    for byte in range(4):
        step = pow(base, 256**byte, PRIME)
        table = F.lit([pow(step, i, PRIME) for i in range(256)])
        digit = F.shiftright(exponent, 8 * byte).bitwiseAND(255).cast("int")
        factor = F.get(table, digit).cast("long")
        out = factor if out is None else out * factor % PRIME
    return out


def stored_turns(conversations: DataFrame, bases: list[int]) -> DataFrame:
    """``conv_id, place`` (from 1), the digest of role and text, the code points of the text,
    and the fingerprints up to the turn and up to the one before it."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        digest.alias("digest"),
        F.length(text).cast("long").alias("size"),
        F.lit(1).cast("long").alias("one"),
        # Parts rows that are repeated very often; which of them comes first makes no difference.
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.asc_nulls_first("turn"), "digest", "row"]
    placed = running_totals(rows, order, ["one"], ["conv_id"])
    placed = placed.select(
        "conv_id", (F.col("one_before") + 1).alias("place"), "digest", "size"
    )
    terms = placed.withColumns({
        f"term{k}": (F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long") % PRIME)
        * _power(bases[k], F.col("place")) % PRIME
        for k in LANES
    })
    names = [f"term{k}" for k in LANES]
    summed = running_totals(terms, ["place"], names, ["conv_id"])
    return summed.select(
        "conv_id",
        "place",
        "digest",
        "size",
        *[(F.col(f"term{k}_before") % PRIME).alias(f"until{k}") for k in LANES],
        *[((F.col(f"term{k}_before") + F.col(f"term{k}")) % PRIME).alias(f"sum{k}") for k in LANES],
    )


def _check_digests(conversations: DataFrame) -> bool:
    """Whether equal digests of stored turns always mean equal role and text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    return (
        conversations.where("conv_id IS NOT NULL")
        .select(
            F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("g"),
            F.octet_length(role).alias("n"),
            F.sha2(F.concat(role, text), 256).alias("other"),
        )
        .groupBy("g")
        .agg(
            (F.min("n") == F.max("n")).alias("same"), (F.min("other") == F.max("other")).alias("too")
        )
        .where("NOT (same AND too)")
        .isEmpty()
    )


def _plans(turns: DataFrame, bases: list[int]) -> DataFrame:
    """One row a conversation: where its head comes from, how long head and whole are, the
    turns of the head, and what composes the fingerprints of head and suffix."""
    def kept(i: int) -> Column:
        return F.max(F.when(F.col("place") == i, F.struct(
            "digest", "size", *[f"until{k}" for k in LANES], *[f"sum{k}" for k in LANES]
        )))

    own = turns.groupBy("conv_id").agg(
        F.max("place").alias("turns"),
        F.filter(
            F.array(*[kept(i) for i in range(1, MOST_HEAD + 1)]), lambda t: t.isNotNull()
        ).alias("first"),
    )
    base = own.select(F.col("conv_id").alias("base"), F.col("first").alias("of_base"))
    joined = (
        own.withColumn("base", F.col("conv_id") - F.col("conv_id") % BASE_STEP)
        .withColumn("skip", head_turns("conv_id").cast("int"))
        .join(base, "base", "left")
    )
    nothing = F.array().cast(own.schema["first"].dataType)
    head = F.slice(F.coalesce("of_base", nothing), F.lit(1), F.col("skip"))
    rows = joined.withColumn("head", head).withColumn("heads", F.size("head")).withColumn(
        "length", F.col("heads") + F.greatest(F.col("turns") - F.col("skip"), F.lit(0).cast("long"))
    )
    last = F.get(F.col("head"), F.col("heads") - 1)
    skipped = F.get(F.col("first"), F.least(F.col("skip"), F.size("first")) - 1)
    missing = (F.col("skip") - F.col("heads")).cast("int")
    inverses = [[pow(b, -i, PRIME) for i in range(MOST_HEAD + 1)] for b in bases]
    return rows.select(
        "conv_id", "skip", "heads", "length", "head",
        *[F.coalesce(last[f"sum{k}"], F.lit(0)).alias(f"head{k}") for k in LANES],
        *[
            F.when(F.col("skip") > 0, F.coalesce(skipped[f"sum{k}"], F.lit(0))).otherwise(F.lit(0))
            .alias(f"skipped{k}")
            for k in LANES
        ],
        *[F.get(F.lit(inverses[k]), missing).cast("long").alias(f"shift{k}") for k in LANES],
    )


def _packed(values: list[Column]) -> list[Column]:
    """Four lanes of 31 bits as two numbers."""
    pairs = (values[:2], values[2:])
    return [F.shiftleft(left, 31).bitwiseOR(right) for left, right in pairs]


def _blocks_of(length: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"{length} div {BLOCK}"))).alias("block")


def _members(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """One row for each prefix of each rebuilt conversation: node, node above, the stored turn
    it ends with, and whether the conversation ends there."""
    none = F.lit(0).cast("long")
    root = plans.select(
        "conv_id", none.alias("depth"), none.alias("high"), none.alias("low"),
        none.alias("high_above"), none.alias("low_above"), F.lit("").alias("digest"),
        none.alias("size"), (F.col("length") == 0).alias("ends"),
    )

    def node(rows: DataFrame, depth: Column, sums, until) -> DataFrame:
        names = ["high", "low", "high_above", "low_above"]
        cells = [c.alias(n) for c, n in zip([*_packed(sums), *_packed(until)], names)]
        return rows.select(
            "conv_id", depth.cast("long").alias("depth"), *cells, "digest", "size",
            (depth == F.col("length")).alias("ends"),
        )

    heads = plans.select("conv_id", "length", F.posexplode("head").alias("i", "t")).select(
        "conv_id", "length", "i", "t.*"
    )
    head = node(
        heads, F.col("i") + 1, [F.col(f"sum{k}") for k in LANES], [F.col(f"until{k}") for k in LANES]
    )

    def composed(k: int, name: str) -> Column:
        suffix = (F.col(f"{name}{k}") - F.col(f"skipped{k}") + PRIME) % PRIME
        return (F.col(f"head{k}") + suffix * F.col(f"shift{k}")) % PRIME

    # A long conversation meets its plan in blocks of rows, not under one key.
    spread = plans.drop("head").withColumn("turns", F.col("length") - F.col("heads") + F.col("skip"))
    spread = spread.select("*", _blocks_of("turns"))
    own = (
        turns.withColumn("block", F.expr(f"place div {BLOCK}"))
        .join(spread, ["conv_id", "block"])
        .where("place > skip")
    )
    suffix = node(
        own, F.col("heads") + F.col("place") - F.col("skip"),
        [composed(k, "sum") for k in LANES], [composed(k, "until") for k in LANES],
    )
    return root.unionByName(head).unionByName(suffix)


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ends as rows of up to ``PACK`` ids of one node."""
    names = [*NODE, "first", "ids"]
    key, ids, rows = None, [], []

    def close():
        if ids:
            rows.append((*key, ids[0], ",".join(map(str, ids))))

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in [*NODE, "conv_id"]]
        for *own, conv_id in zip(*columns):
            if own != key or len(ids) == PACK:
                close()
                key, ids = own, []
            ids.append(conv_id)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], names=names)
            rows.clear()
    close()
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], names=names)


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash a node from its rows of ids, which arrive in order and pass one by one."""
    names = [*NODE, "ends_sha256"]
    key, state, rows = None, None, []
    for batch in batches:
        for *own, ids in zip(*[batch.column(c).to_pylist() for c in [*NODE, "ids"]]):
            if own == key:
                state.update(b"," + ids.encode())
                continue
            if key is not None:
                rows.append((*key, state.hexdigest()))
            key, state = own, hashlib.sha256(ids.encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], names=names)
            rows.clear()
    if key is not None:
        rows = [(*key, state.hexdigest())]
        yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], names=names)


def _end_hashes(members: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at a node. Sorted slices join neighbouring ids, so a node
    where very many end reaches its task as few rows."""
    kind = "depth long, high long, low long"
    ends = members.where("ends").select(*NODE, "conv_id").orderBy(*NODE, "conv_id")
    packs = ends.mapInArrow(_joined_ids, f"{kind}, first long, ids string")
    packs = packs.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return packs.mapInArrow(_hashed_ids, f"{kind}, ends_sha256 string")


def _grouped(members: DataFrame) -> DataFrame:
    last = F.struct("high_above", "low_above", "digest", "size")
    return members.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.min("high_above").alias("high_above"),
        F.min("low_above").alias("low_above"),
        F.max("size").alias("size"),
        (F.min(last) == F.max(last)).alias("verified"),
    )


def prefix_trie(conversations: DataFrame, seed: int = 13) -> DataFrame:
    """One row a node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``."""
    if not _check_digests(conversations):
        raise RuntimeError("Two stored turns that differ have one MD5 digest.")
    for attempt in range(ATTEMPTS):
        chance = random.Random(seed + attempt)
        bases = [chance.randrange(2**20, PRIME - 1) for _ in LANES]
        turns = write_table(stored_turns(conversations, bases))
        plans = write_table(_plans(turns, bases))
        members = write_table(_members(turns, plans))
        groups = write_table(_grouped(members))
        if groups.where("NOT verified").isEmpty():
            return _described(members, groups, plans)
    raise RuntimeError("Prefixes that differ share a fingerprint in every attempt.")


def _described(members: DataFrame, groups: DataFrame, plans: DataFrame) -> DataFrame:
    above = [
        (F.col("depth") - 1).alias("depth"),
        F.col("high_above").alias("high"),
        F.col("low_above").alias("low"),
    ]
    children = (
        groups.where("depth > 0").select(*above).groupBy(*NODE).agg(F.count("*").alias("n_children"))
    )
    nodes = write_table(
        groups.join(children, NODE, "left").select(
            *NODE, "conv_id", "n_convs", "high_above", "low_above",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            ((F.col("n_convs") - 1) * F.col("size")).alias("weight"),
        )
    )
    owned = nodes.groupBy("conv_id").agg(
        F.sum("weight").alias("owned"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")
    )
    spread = owned.join(plans.select("conv_id", "length"), "conv_id").select("*", _blocks_of("length"))
    sums = (
        members.select("conv_id", *NODE, F.expr(f"depth div {BLOCK}").alias("block"))
        .join(spread, ["conv_id", "block"])
        .groupBy(*NODE)
        .agg(F.sum("owned").alias("owned"), F.sum("leaf").alias("n_leaves"))
    )
    placed = running_totals(nodes, ["depth"], ["weight"], ["conv_id"])
    rows = placed.join(sums, NODE).join(_end_hashes(members), NODE, "left")
    # At most a thousand nodes have a thousandth of all nodes as children; their rows are sent
    # to all tasks. The children of the others meet their parent in a shuffle.
    total = nodes.count()
    parents = nodes.where("n_children > 0").select(
        F.col("depth").alias("above"), F.col("high").alias("high_above"),
        F.col("low").alias("low_above"), F.col("conv_id").alias("parent"),
        (F.col("n_children") * HEAVY >= total).alias("heavy"),
    )
    key = ["above", "high_above", "low_above"]
    rows = rows.withColumn("above", F.col("depth") - 1)
    heavy = F.broadcast(parents.where("heavy").drop("heavy").withColumnRenamed("parent", "of_heavy"))
    rows = rows.join(heavy, key, "left")
    known = rows.where("of_heavy IS NOT NULL OR depth = 0").withColumn("parent", F.col("of_heavy"))
    asked = rows.where("of_heavy IS NULL AND depth > 0").join(
        parents.where("NOT heavy").drop("heavy"), key
    )
    nothing = hashlib.sha256(b"").hexdigest()
    return known.unionByName(asked).select(
        "conv_id",
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("owned") - F.col("weight_before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
