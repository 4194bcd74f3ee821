"""Every stage of the pipeline against plain Python on what the stage before it kept, and the
network and the alignment against loops over single bytes and words."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parcelflow.llm import leaks, mixing, quality
from test_dedup import WORD, linked

FOLDER = "/root/testdata/sf0.001"
SPACE = re.compile(r"[\x20\x09-\x0d]")
TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+")


def score_by_loops(network, text):
    """The network's probability of one text, byte after byte."""
    p, data = network.p, (text or "").encode()
    width, blocks = quality.WIDTH, -(-(len(data) + quality.WIDTH - 1) // quality.BLOCK)
    data = bytes(width - 1) + data
    data += bytes(blocks * quality.BLOCK + width - 1 - len(data))
    vector = [p["embed"][b] if b else np.zeros(quality.EMBED) for b in data]
    places = [
        np.concatenate(vector[i : i + width]) @ p["filters"] for i in range(blocks * quality.BLOCK)
    ]
    pooled, block = [], 0
    while True:
        stop = min(block + quality.BLOCKS, blocks)
        own = places[block * quality.BLOCK : stop * quality.BLOCK]
        pooled.append(np.maximum(np.max(own, axis=0) + p["shift"], 0))
        if stop == blocks:
            break
        block += quality.STRIDE
    x = np.concatenate([np.mean(pooled, axis=0), np.max(pooled, axis=0)])
    h = np.maximum(x @ p["w1"] + p["b1"], 0)
    return float(1 / (1 + np.exp(-(h @ p["w2"] + p["b2"])[0])))


def best_alignment(item, words):
    """Smith-Waterman of two word lists, cell after cell, over the highest possible score."""
    best, above = 0, [0] * (len(words) + 1)
    for a in item:
        row = [0]
        for j, b in enumerate(words):
            step = leaks.MATCH if a == b else leaks.MISMATCH
            row.append(max(0, above[j] + step, above[j + 1] + leaks.GAP, row[j] + leaks.GAP))
        best, above = max(best, max(row)), row
    return best / (leaks.MATCH * len(item))


def leaks_by_loops(docs, items):
    """Similarity of every pair of document and item that reaches the threshold."""
    found = {}
    for d, text in docs:
        words = TOKEN.findall((text or "").encode().lower())
        known = set(words)
        for i, item in items:
            # No alignment can match more words of the item than occur in the document.
            if sum(w in known for w in item) >= leaks.SIMILAR * len(item):
                value = best_alignment(item, words)
                if value >= leaks.SIMILAR:
                    found[d, i] = value
    return found


def items_of(spark):
    rows = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    items = [(r.item_id, TOKEN.findall((r.text or "").encode().lower())) for r in rows]
    return [(i, x) for i, x in items if len(x) >= leaks.RUN]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before and after each stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        left = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs.collect(), left.collect()
        docs = left
    return out


def check_whole_rows(before, after):
    """What stays is a row of the input, column for column."""
    known = {tuple(r) for r in before}
    assert all(tuple(r) in known for r in after)
    return {r.doc_id for r in after}


def test_quality_stage(spark, stages):
    before, after = stages["quality"]
    network = quality.fit(
        spark.read.parquet(f"{FOLDER}/documents.parquet"),
        spark.read.parquet(f"{FOLDER}/labels.parquet"),
    )
    left = check_whole_rows(before, after)
    short = [r for r in before if len(r.text or "") < 3000][:150]
    assert {r.doc_id in left for r in short} == {True, False}
    for r in short:
        score = score_by_loops(network, r.text)
        if abs(score - quality.THRESHOLD) > 1e-4:
            assert (r.doc_id in left) == (score > quality.THRESHOLD)


def test_scores_equal_loops(spark, rows):
    network = quality.Network(3)
    wanted = sorted((r.doc_id or 0, score_by_loops(network, r.text)) for r in rows.collect())
    got = sorted((r.doc_id or 0, r.score) for r in quality.score(rows, network).collect())
    assert [d for d, _ in got] == [d for d, _ in wanted]
    assert [s for _, s in got] == pytest.approx([s for _, s in wanted], abs=1e-4)


def test_repeated_ids_do_not_grow_the_sample(spark, monkeypatch):
    monkeypatch.setattr(quality, "MOST_ROWS", 20)
    labels = spark.range(50).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    docs = spark.range(500).select((F.col("id") % 50).alias("doc_id"), F.lit("a b").alias("text"))
    assert quality.training_rows(docs, labels, "doc_id", "text").count() == 20


def test_gradients_equal_differences():
    network = quality.Network(5)
    data, offsets = quality._flat_texts([b"some bytes of text " * 30, b"x", b"more of it here " * 9])
    label = np.array([1, 0, 0], np.float32)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}

    def loss():
        score = network.forward(data, offsets)
        return np.mean(np.logaddexp(0, score) - label * score)

    gradients = network.gradients(data, offsets, label)
    for name, at in (("w2", (1, 0)), ("w1", (2, 3)), ("b1", (4,)), ("shift", (5,)), ("filters", (7, 2)), ("embed", (101, 1))):
        value = network.p[name][at]
        network.p[name][at] = value + 1e-6
        high = loss()
        network.p[name][at] = value - 1e-6
        slope = (high - loss()) / 2e-6
        network.p[name][at] = value
        assert gradients[name][at] == pytest.approx(slope, abs=1e-5)


def test_exact_stage(stages):
    before, after = stages["exact_dedup"]
    best = {}
    for r in before:
        key = SPACE.sub("", r.text or "")
        best[key] = min(best.get(key, (1, 0)), (-len(r.text or ""), r.doc_id))
    assert check_whole_rows(before, after) == {d for _, d in best.values()}
    assert len(after) == len(best) < len(before)


def test_near_stage(stages):
    before, after = stages["near_dedup"]
    data = [(r.doc_id, r.text) for r in before]
    stay = {d for d, _, component in linked(data, 5, (80, 100)) if d == component}
    assert check_whole_rows(before, after) == stay and len(stay) < len(before)


def test_decontaminate_stage(spark, stages):
    before, after = stages["decontaminate"]
    found = leaks_by_loops([(r.doc_id, r.text) for r in before], items_of(spark))
    leaking = {d for d, _ in found}
    assert leaking and check_whole_rows(before, after) == {r.doc_id for r in before} - leaking


def test_mix_stage(stages):
    before, after = stages["mix"]
    size = {r.doc_id: len(WORD.findall(r.text or "")) for r in before}
    sizes, taken = {}, {}
    for r in before:
        sizes[r.source] = sizes.get(r.source, 0) + size[r.doc_id]
    for r in after:
        assert 1 <= r.mix_times <= 3 and r.mix_words == r.mix_times * size[r.doc_id]
        taken[r.source] = taken.get(r.source, 0) + r.mix_words
    for source, target in mixing.source_targets(sizes).items():
        assert abs(taken[source] - target) <= max(size.values())
    known = {tuple(r) for r in before}
    assert all(tuple(r)[: len(before[0])] in known for r in after)


def test_all_leaks_equal_loops(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = leaks.leaks(docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()
    wanted = leaks_by_loops([(r.doc_id, r.text) for r in docs.collect()], items_of(spark))
    assert {(r.doc_id, r.item_id): r.similarity for r in got} == pytest.approx(wanted)


def test_torn_copies_equal_loops(spark):
    """Items with words put in, left out and changed, rare words at one end only."""
    rng = np.random.default_rng(4)
    common = [f"c{k}" for k in range(12)]
    items, docs = [], []
    for i in range(12):
        tail = [common[k] for k in rng.integers(0, 12, 24)]
        items.append((i, " ".join([f"rare{i}x{k}" for k in range(6)] + tail)))
    for d in range(120):
        words = items[d % 12][1].split()
        at, more = int(rng.integers(3, 28)), int(rng.integers(0, 32))
        words[at:at] = [common[k] if d % 2 else f"z{d}y{k}" for k in rng.integers(0, 12, more)]
        words = [w for w in words if rng.random() > 0.05]
        docs.append((d, " ".join([*rng.choice(common, 40), *words, *rng.choice(common, 40)])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = leaks.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    wanted = leaks_by_loops(docs, [(i, x.encode().split()) for i, x in items])
    # Another item's common words alone may align by chance without a run of three.
    own = {k: v for k, v in wanted.items() if k[0] % 12 == k[1]}
    found = {(r.doc_id, r.item_id): r.similarity for r in got}
    assert len(own) > 60 and {k: found.get(k) for k in own} == pytest.approx(own)
    assert all(wanted[k] == pytest.approx(v) for k, v in found.items())


def targets_by_loops(sizes, weights):
    """Shares of all sizes, found by letting one source at a time run into its limit."""
    limit, fixed = {s: 3.0 * n for s, n in sizes.items()}, {}
    while True:
        left = sum(sizes.values()) - sum(fixed.values())
        weight = sum(weights[s] for s in sizes if s not in fixed)
        told = {s: fixed[s] if s in fixed else left * weights[s] / weight for s in sizes}
        over = [s for s in sizes if s not in fixed and told[s] > limit[s]]
        if not over:
            return told
        worst = max(over, key=lambda s: told[s] / max(limit[s], 1e-9))
        fixed[worst] = limit[worst]


def test_targets_equal_loops():
    rng = np.random.default_rng(1)
    for _ in range(50):
        sizes = {f"s{i}": int(n) for i, n in enumerate(rng.integers(0, 500, rng.integers(1, 9)) ** 2)}
        weights = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(sorted(sizes))}
        got = {s: float(t) for s, t in mixing.source_targets(sizes).items()}
        assert got == pytest.approx(targets_by_loops(sizes, weights))
