"""Collocations against counting by hand."""

import random
import re
from collections import Counter

import pytest

from checker import compare, connect
from parcelflow.llm import oracles, phrases, queries

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(data, longest, least, share, top):
    counts, totals = {}, Counter()
    for lang, text in data:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                own.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    rows = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {}
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside.get(p[i : i + k], 0), a)
        found = []
        for p, a in candidates.items():
            if share[1] * inside.get(p, -1) >= share[0] * a:
                continue
            score, _, left, right = min(
                (10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                for k in range(1, len(p))
            )
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(rows)


def corpus(seed, docs=300):
    chance = random.Random(seed)
    words = ["a", "B", "c", "É", "the", "of", "x\x00y", "漢字", "new", "York", "City", "\xa0z"]
    gaps = [" ", "\t", "  ", ", ", ".", "\n", " ", " ", " ", " ", "\r\n", "?!"]
    langs = ["en", "en", "en", "de", None, "und", ""]
    rows = [(chance.choice(langs), "".join(
        chance.choice(words) + chance.choice(gaps) for _ in range(chance.randint(0, 40))
    )) for _ in range(docs)]
    return rows + [("en", None), (None, None), ("fr", ""), ("fr", " \t.,"), ("en", "new York City " * 500)]


@pytest.mark.parametrize("longest, least, top", [(3, 10, 2000), (3, 2, 7), (2, 1, 40), (4, 3, 2000)])
def test_equals_counting_by_hand(spark, monkeypatch, longest, least, top):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 2000)
    data = corpus(longest)
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in data],
                               "lang string, text string, part int, phrase string, f string")
    found = phrases.collocations(df.repartition(3), longest=longest, least=least, top=top)
    rows = sorted(tuple(r) for r in found.collect())
    assert rows == by_hand(data, longest, least, (50, 100), top)


def test_products_beyond_64_bits(spark):
    big = 10**15
    rows = [("en", 0, "", 3 * big), ("en", 1, "a", 2 * big), ("en", 1, "b", big),
            ("en", 2, "a b", big - 1)]
    df = spark.createDataFrame(rows, "lang string, words int, phrase string, f long")
    found = phrases.scored(df).first()
    assert found.score == 10**6 * (big - 1) ** 2 // (2 * big * big) and found.n == 3 * big


def test_empty_tables_and_texts(spark, rows):
    assert phrases.collocations(rows.limit(0)).collect() == []
    blank = spark.createDataFrame([(None, None), ("en", "")], "lang string, text string")
    assert phrases.collocations(blank, least=1).collect() == []


def test_a_piece_without_separators_is_kept_whole(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 100)
    df = spark.createDataFrame([("en", "one two three " * 400 + ". one two")], "lang string, text string")
    counts = {r.phrase: r.f for r in phrases.phrase_counts(df).collect()}
    assert counts["one two"] == 401 and counts["three one two"] == 399 and counts[""] == 1202


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    sql = oracles.ORACLES["op12_phrase_collocations"]
    found = queries.op12_phrase_collocations(spark, folder)
    assert compare(found, connect(folder), sql) is None
