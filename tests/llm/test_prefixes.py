"""The trie of rebuilt conversations against building them."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from checker import compare, connect
from parcelflow.llm import oracles, prefixes, queries

SCHEMA = "conv_id long, turn int, role string, text string, depth int, high string, place long"


def digest(turn):
    role, text = turn
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def by_hand(data):
    own = {}
    for conv_id, turn, role, text, *_ in data:
        if conv_id is not None:
            own.setdefault(conv_id, []).append((turn is not None, turn or 0, (role or "", text or "")))
    turns = {c: [t for *_, t in sorted(x, key=lambda r: (r[0], r[1], digest(r[2])))] for c, x in own.items()}
    nodes = {}
    for c in turns:
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        h = zlib.crc32(str(c).encode()) % 6
        built = turns.get(base, [])[:h] + turns[c][h:]
        for d in range(len(built) + 1):
            members, ends = nodes.setdefault(tuple(built[:d]), ([], []))
            members.append(c)
            if d == len(built):
                ends.append(c)
    children = {}
    for key in nodes:
        if key:
            children.setdefault(key[:-1], []).append(key)
    rows, below = [], {}
    for key in sorted(nodes, key=len, reverse=True):
        members, ends = nodes[key]
        under = [below[k] for k in children.get(key, [])]
        size = len(key[-1][1]) if key else 0
        leaves = sum(n for n, _ in under) or 1
        saved = sum(s for _, s in under) + (len(members) - 1) * size
        below[key] = leaves, saved
        text = ",".join(map(str, sorted(ends)))
        rows.append((min(members), len(key), min(nodes[key[:-1]][0]) if key else None, len(members),
                     len(under), leaves, saved, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(rows, key=repr)


def table(seed, ids, longest):
    chance = random.Random(seed)
    texts = ["", "a", "bb", "é漢", None, "hello there", "1:", ":1"]
    rows = []
    for c in ids:
        for turn in range(chance.randint(1, longest)):
            number = chance.choice([turn, turn, turn, None, 2])
            rows.append((c, number, chance.choice(["user", "assistant", None, "u1"][:2 + seed % 3]),
                         chance.choice(texts[: 2 + seed]), 7, "x", 8))
    return rows + chance.sample(rows, min(9, len(rows))) + [(None, 1, "user", "a", 7, "x", 8)]


@pytest.mark.parametrize("seed, ids, longest", [
    (1, range(0, 350), 9), (2, range(-150, 220, 3), 12), (3, [5, 7, 105, 2**60, -7], 4),
    (4, [*range(101, 190), 100], 2), (5, [300], 40),
])
def test_equals_building_them(spark, monkeypatch, seed, ids, longest):
    for name, value in (("BLOCK", 3), ("PACK", 4), ("HEAVY", 20)):
        monkeypatch.setattr(prefixes, name, value)
    data = table(seed, ids, longest)
    found = prefixes.prefix_trie(spark.createDataFrame(data, SCHEMA).repartition(3))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == by_hand(data)


def test_a_long_conversation_and_a_common_start(spark, many_slices):
    data = [(7, i, "user", f"t{i % 3}", 0, "", 0) for i in range(3000)]
    data += [(1000 + i, 0, "user", "hi", 0, "", 0) for i in range(2000)]
    data += [(1000 + i, j, "user", f"own {i % 5}", 0, "", 0) for i in range(2000) for j in range(1, 7)]
    found = prefixes.prefix_trie(spark.createDataFrame(data, SCHEMA))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == by_hand(data)


def test_a_group_of_different_prefixes_is_seen(spark):
    data = [(1, 0, 5, 6, 0, 0, "aa", 1), (2, 0, 5, 6, 0, 0, "bb", 1)]
    df = spark.createDataFrame(data, "conv_id long, depth long, high long, low long,"
                               " high_above long, low_above long, digest string, size long")
    assert not prefixes._grouped(df).first().verified
    assert prefixes._grouped(df.withColumn("digest", F.lit("aa"))).first().verified


def test_empty_table(spark):
    assert prefixes.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    sql = oracles.ORACLES["op13_conversation_trie"]
    found = queries.op13_conversation_trie(spark, folder)
    assert compare(found, connect(folder), sql) is None
