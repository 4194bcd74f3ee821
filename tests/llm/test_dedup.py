"""Exact, near and substring dedup against plain Python, with awkward rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from checker import compare, connect
from parcelflow.llm import anchors, exact, near, radix
from parcelflow.llm.oracles import ORACLES
from parcelflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None


def cut_windows(items, width, join):
    """Brute force: what each row loses when windows that begin twice go."""
    count = Counter(tuple(x[p : p + width]) for x in items for p in range(len(x) - width + 1))
    for x in items:
        gone = [False] * len(x)
        for p in range(len(x) - width + 1):
            if count[tuple(x[p : p + width])] > 1:
                gone[p : p + width] = [True] * width
        yield gone, join([a for a, g in zip(x, gone) if not g])


@pytest.mark.parametrize("which", ["test data", "awkward"])
def test_words_equal_brute_force(spark, rows, which):
    df = documents(spark) if which == "test data" else rows
    data = [(r.doc_id, WORD.findall(r.text or "")) for r in df.collect()]
    wanted = []
    for (i, x), (gone, kept) in zip(data, cut_windows([x for _, x in data], 35, " ".join)):
        wanted.append((i, len(x), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    assert ordered(anchors.remove_repeats(df).collect()) == ordered(wanted)


@pytest.mark.parametrize("which", ["test data", "awkward"])
def test_bytes_equal_brute_force(spark, rows, which):
    df = documents(spark).limit(120) if which == "test data" else rows
    data = [(r.doc_id, (r.text or "").encode()) for r in df.collect()]
    width = 400 if which == "test data" else 64
    count = Counter(x[p : p + width] for _, x in data for p in range(len(x) - width + 1))
    wanted = []
    for i, x in data:
        gone = bytearray(len(x))
        for p in range(len(x) - width + 1):
            if count[x[p : p + width]] > 1:
                gone[p : p + width] = b"\1" * width
        kept = bytes(a for a, g in zip(x, gone) if not g)
        spans = sum(b > a for a, b in zip(b"\0" + bytes(gone), gone))
        wanted.append((i, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    got = radix.remove_repeats(spark.createDataFrame(df.collect(), df.schema), width=width)
    assert ordered(got.drop("kept_bytes").collect()) == ordered(wanted)


def linked(data, words, share):
    """Brute force: component of every row of (id, text), and its set's size."""
    sets = []
    for _, text in data:
        w = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set())
    parent = list(range(len(data)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    at = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            at[x].append(k)
    for k, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in at[x] if j < k).items():
            if share[1] * n >= share[0] * len(s | sets[j]):
                parent[max(find(j), find(k))] = min(find(j), find(k))
    least = defaultdict(list)
    for k, (i, _) in enumerate(data):
        if i is not None:
            least[find(k)].append(i)
    return [
        (i, len(s), min(least[find(k)], default=None)) for k, ((i, _), s) in enumerate(zip(data, sets))
    ]


@pytest.mark.parametrize("which", ["test data", "awkward"])
def test_near_groups_equal_brute_force(spark, rows, which):
    df = documents(spark) if which == "test data" else rows
    words, share = (3, (85, 100)) if which == "test data" else (5, (80, 100))
    data = [(r.doc_id, r.text) for r in df.collect()]
    got = near.near_groups(df, words=words, share=share)
    assert ordered(r[:3] for r in got.collect()) == ordered(linked(data, words, share))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect() if r.doc_id)


def test_large_families_equal_brute_force(spark, monkeypatch):
    """Chains, a group of copies and two groups just apart, in families of many small chunks."""
    draw = random.Random(5)
    texts = []

    def chain(x, steps, changes):
        for _ in range(steps):
            texts.append(" ".join(x))
            x = x.copy()
            for _ in range(changes):
                x[draw.randrange(len(x))] = f"v{draw.randrange(10**6)}"
        return x

    base = [f"w{i}" for i in range(300)]
    chain(base, 90, 2)
    for _ in range(60):
        chain(base, 1, 0)
        texts[-1] += f" end{len(texts)}"
    far = base.copy()
    far[::23] = ["far"] * len(far[::23])
    for _ in range(50):
        texts.append(" ".join(far) + f" far{len(texts)}")
    chain([f"u{i}" for i in range(80)], 40, 3)
    data = list(enumerate(draw.sample(texts, len(texts))))
    df = spark.createDataFrame(data, "doc_id long, text string")
    calls = []
    across = near._across
    monkeypatch.setattr(near, "SET_CHUNK", 4)
    monkeypatch.setattr(near, "_across", lambda parts: calls.append(1) or across(parts))
    got = near.near_groups(df, words=3, share=(85, 100))
    assert ordered(r[:3] for r in got.collect()) == ordered(linked(data, 3, (85, 100)))
    assert calls


def test_cells_across_parts(spark):
    """Every pair of members of different parts meets; two chunks of the largest part never do."""
    rows = [(k, 7, 0 if k < 1500 else 1500 if k < 1800 else k) for k in range(2100)]
    cells = near._across(spark.createDataFrame(rows, f"{near.ROW} long, meet long, part long")).collect()
    chunk = {r[near.ROW]: r.chunk for r in cells}
    seats = {(r[near.ROW], r.i, r.j) for r in cells}
    assert len(seats) == len(cells)
    base = {chunk[k] for k in range(1500)}
    assert not base & {chunk[k] for k in range(1500, 2100)}
    assert not any(i in base and j in base for _, i, j in seats)
    draw = random.Random(3)
    for _ in range(20_000):
        a, b = draw.randrange(2100), draw.randrange(1500, 2100)
        i, j = sorted((chunk[a], chunk[b]))
        assert (a, i, j) in seats and (b, i, j) in seats


def test_near_copies_leave_one_row_a_group(spark, rows):
    left = near.drop_near_copies(rows)
    assert left.columns == rows.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 4, 5, 6, 7, 8, 9, 10]


def test_exact_copies_leave_one_row(spark, rows):
    left = exact.drop_exact_copies(rows)
    assert left.columns == rows.columns
    texts = [re.sub(r"[\x20\x09-\x0d]", "", r.text or "") for r in left.collect()]
    every = {re.sub(r"[\x20\x09-\x0d]", "", r.text or "") for r in rows.collect()}
    assert len(texts) == len(set(texts)) and set(texts) == every


@pytest.mark.parametrize(
    "operator",
    [anchors.remove_repeats, radix.remove_repeats, near.near_groups, near.drop_near_copies,
     exact.exact_groups, exact.drop_exact_copies],
)
def test_empty_tables(rows, operator):
    assert operator(rows.limit(0)).collect() == []
