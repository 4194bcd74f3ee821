"""Cases that one-sided shortcuts of the operators would lose."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import html, language, leaks, mixing, near


@pytest.mark.parametrize("n", [1_000_000, 1_500_000, 4_000_000])
@pytest.mark.parametrize("share", [0.85, 0.95])
def test_very_long_near_copies_meet(n, share):
    rng = np.random.default_rng(n)
    both = round(2 * n * share / (1 + share))
    common = rng.integers(0, 2**64, both, np.uint64)
    sets = [np.unique(np.append(common, rng.integers(0, 2**64, n - both, np.uint64))) for _ in range(2)]
    first = np.cumsum([0, *map(len, sets)])
    sketch = near.coarse(near.registers(np.concatenate(sets), first))
    cell = {"meet": [7, 7], "i": [0, 0], "j": [0, 0], "chunk": [0, 0], near.ROW: [1, 2], "root": [1, 2]}
    cell |= {"n": [len(s) for s in sets], "sketch": [r.tobytes() for r in sketch]}
    found = list(near._may_link(0.85)([pa.RecordBatch.from_pydict(cell)]))
    assert [b.to_pydict() for b in found] == [{"u": [2], "v": [1]}]


def test_chance_of_unrelated_sets():
    rng = np.random.default_rng(2)
    for n in (300, 30_000, 4_000_000):
        equal = []
        for _ in range(max(1, 20_000 // n)):
            sets = [np.sort(rng.integers(0, 2**64, n, np.uint64)) for _ in range(2)]
            p, q = near.coarse(near.registers(np.concatenate(sets), np.array([0, n, 2 * n])))
            equal.append(((p == q) & (p > 0)).sum() / ((p | q) > 0).sum())
        assert near.chance(np.array([n]))[0] == pytest.approx(np.mean(equal), abs=0.05)


def test_language_declared_late_in_a_page(spark):
    said = "words of a page that say little about it"
    pages = [
        (1, f"<!--{'x' * 6000}-->{' ' * 3000}<html class=a lang='FR'><p>{said}</p></html>"),
        (2, f"<!--[if IE]><html lang=de><![endif]--><!--[if !IE]><!--><html lang=fr><!--<![endif]--><p>{said}"),
        (3, f"<html><script>'<html lang=de>'</script><p>{said}</p>"),
        (4, None),
    ]
    df = spark.createDataFrame(pages, "page_id long, html string")
    docs = spark.createDataFrame([("some words in here", "en"), ("quelques mots ici", "fr")], "text string, lang string")
    told = language.identified(df, language.fit_text_model(docs), "page_id", "html", F.lit("h"), True)
    assert {r.page_id: r.declared for r in told.collect()} == {1: "fr", 2: "fr", 3: None, 4: None}


@pytest.mark.parametrize("few", [(100_000, 20), (1, 1)])
@pytest.mark.parametrize("ids", ["own", "null"])
def test_mix_leaves_no_document_that_fits(spark, monkeypatch, ids, few):
    monkeypatch.setattr(mixing, "MOST_ROWS", few[0], raising=False)
    monkeypatch.setattr(mixing, "LEAST_ROWS", few[1], raising=False)
    rows = [(i, "w " * (20_000 if i % 201 == 0 else 300 + i % 7), f"s{i // 201}") for i in range(603)]
    df = spark.createDataFrame([(i if ids == "own" else None, *r) for i, *r in rows], "doc_id long, text string, source string")
    for seed in (range(3) if few[0] > 1 else [0]):
        told = {}
        got = mixing.mixed(df, seed=seed, keep=("source",))
        for r in got.collect():
            told.setdefault(r.source, []).append(r)
        for own in told.values():
            left = round(own[0].target) - sum(r.taken for r in own)
            rounds = min(r.taken // r.size for r in own)
            assert left >= 0
            if rounds < mixing.MOST_TIMES:
                assert all(r.size > left for r in own if r.taken == rounds * r.size)


def test_copies_without_their_rare_words(spark):
    """However large the corpus is: the other documents make all words that are left common."""
    rng = np.random.default_rng(3)
    common = [f"c{k}" for k in range(9)]
    items = []
    for i in range(8):
        words = [common[k] for k in rng.integers(0, 9, 60)]
        words[::4] = [f"rare{i}x{k}" for k in range(15)]
        items.append((i, " ".join(words)))
    docs = [(i, " ".join("other" if w.startswith("rare") else w for w in t.split())) for i, t in items]
    docs += [(100 + d, " ".join(rng.choice(common, 20_000))) for d in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = leaks.leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(i, i) for i, _ in items} <= {(r.doc_id, r.item_id) for r in got}


def test_stock_phrases_of_many_items(spark):
    """A run that all items share finds none of them alone; two near each other do, as loops say."""
    stock, tail = "which of the following is", "mark one letter and go on"
    items = [(i, f"{stock} " + " ".join(f"w{i}x{k}" for k in range(4)) + f" {tail}") for i in range(40)]
    items += [(100 + i, f"{stock} n{i} the of is") for i in range(3)]
    docs = [(0, f"he asked {stock[13:]} " * 50), (1, items[3][1]), (2, f"so {stock} a b c d {tail} end")]
    docs += [(3, "x " + items[5][1].replace("w5x2", "other")), (4, None), (5, f"{stock} n1 n2 the of is")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = leaks.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    wanted = {}
    for d, text in docs:
        for i, item in items:
            value = leaks.aligned(np.array(item.split()), np.array(text.split()))[0] if text else 0
            if value >= leaks.SIMILAR:
                wanted[d, i] = value
    assert {(r.doc_id, r.item_id): r.similarity for r in got} == pytest.approx(wanted)
    assert {(1, 3), (3, 5), (2, 0), (2, 39)} <= set(wanted) and not any(d == 0 for d, _ in wanted)


def test_hits_meet_items_in_bounded_parts(monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(leaks, "HELD_PAIRS", 50)
    held = np.unique(rng.integers(0, 2, (9, 30)) * np.arange(1, 271).reshape(9, 30)) - 1
    place = held[held >= 0]
    run = rng.integers(0, 9, 25)
    parts = list(leaks._pairs(place, run, 30))
    got = sorted((int(h), int(i)) for hit, item in parts for h, i in zip(hit, item))
    assert got == sorted((h, int(p) % 30) for h, r in enumerate(run) for p in place if p // 30 == r)
    assert len(parts) > 5 and all(len(hit) <= 50 or len(set(item)) == 1 for hit, item in parts)


def test_bare_text_around_a_quotation():
    lines = [" ".join(f"line{k}word{j}" for j in range(8)) for k in range(12)]
    quote = ["A quoted paragraph that says something at length. " * 9, "Another one that goes on for a while. " * 9]
    quoted = "<blockquote>" + "".join(f"<p>{q}</p>" for q in quote) + "</blockquote>"
    wanted = " ".join(" ".join([*lines[:6], *quote, *lines[6:]]).split())
    for parted in ("<br>", "<br><br>\n"):
        bare = f"{parted.join(lines[:6])}{quoted}{parted.join(lines[6:])}"
        assert html.main_text(f"<html><body>{bare}</body></html>") == wanted
        assert html.main_text(f"<body><nav>menu</nav><div><span>{bare}</span></div></body>") == wanted
        apart = f"<div>{parted.join(lines[:6])}</div>{quoted}<div>{parted.join(lines[6:])}</div>"
        assert html.main_text(f"<body>{apart}</body>") == wanted


@pytest.mark.parametrize(
    "wrapper",
    ["div class='overflow-hidden'", "div class='has-sidebar'", "div id='content-with-sidebar'", "div class='no-comments'",
     "form action=x", "form role=form", "div class='social'", "div class='hidden'"],
)
def test_wrappers_of_the_page_stay(wrapper):
    body = [f"Paragraph {k} of the article with enough words to be read as running text." for k in range(6)]
    inner = "".join(f"<p>{x}</p>" for x in body)
    side = "<div class='sidebar'><p>Side stuff here</p></div><div class='comments'>" + "<p>A reader says so.</p>" * 40 + "</div>"
    tag = wrapper.split()[0]
    page = "<body><nav>menu</nav><{w}>{x}</{t}><div class=footer>All rights reserved</div></body>"
    for x in (inner, f"<div>{inner}</div>{side}", f"<article>{inner}</article>{side}"):
        assert html.main_text(page.format(w=wrapper, x=x, t=tag)) == " ".join(body)
    small = f"<body><div>{inner}</div><form><p>Your name</p></form><div class='comments'>{'<p>So it is.</p>' * 30}</div></body>"
    assert html.main_text(small) == " ".join(body)
