"""Language and URL operators against plain Python over whole small tables."""

import math
import re
from collections import Counter, defaultdict

import pytest

from parcelflow.llm import html, language, urls
from parcelflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def cells_of(text):
    data = [b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()]
    return [
        ((a * 0x9E3779B1 + b * 0x85EBCA6B + c * 0xC2B2AE35) % 2**32) >> 17
        for a, b, c in zip(data, data[1:], data[2:])
    ]


def languages_by_loops(docs, rows):
    """Language and probability of every (host, declared, text), from counts of all ``docs``."""
    names = sorted({lang for lang, _ in docs})
    counts = {x: Counter() for x in names}
    for lang, text in docs:
        counts[lang].update(cells_of(text))
    size = {x: sum(counts[x].values()) + 0.5 * language.CELLS for x in names}
    prior = language.PRIOR
    shares = []
    for _, _, text in rows:
        own = cells_of(text)
        weight = min(1, language.WEIGHT / max(len(own), 1))
        logs = [weight * sum(math.log((counts[x][c] + 0.5) / size[x]) for c in own) for x in names]
        odds = [math.exp(v - max(logs)) for v in logs]
        shares.append([v / sum(odds) for v in odds])
    zero = lambda: [0.0] * len(names)
    whole, suffixes, hosts, tags, tagged = zero(), defaultdict(zero), defaultdict(zero), defaultdict(zero), zero()
    for (host, declared, _), share in zip(rows, shares):
        for k, v in enumerate(share):
            whole[k] += v
            suffixes[host.split(".")[-1]][k] += v
            hosts[host][k] += v
            if declared:
                tags[declared][k] += v
                tagged[k] += v

    def on_top(sums, below):
        return [(s + prior * p) / (sum(sums) + prior) for s, p in zip(sums, below)]

    root = on_top(whole, [1 / len(names)] * len(names))
    for (host, declared, _), share in zip(rows, shares):
        others = [max(s - v, 0) for s, v in zip(hosts[host], share)]
        odds = on_top(others, on_top(suffixes[host.split(".")[-1]], root))
        odds = [v * o for v, o in zip(share, odds)]
        if declared:
            n = sum(tags[declared]) / sum(tagged)
            odds = [o * (s + prior * n) / (t + prior) for o, s, t in zip(odds, tags[declared], tagged)]
        best = max(range(len(names)), key=lambda k: odds[k])
        yield names[best], odds[best] / sum(odds)


def test_languages_equal_loops(spark):
    docs, pages = table(spark, "documents").collect(), table(spark, "pages").collect()
    model = [(r.lang, r.text) for r in docs if r.lang is not None]
    got = QUERIES["op3_language_id"](spark, FOLDER).collect()
    for key, rows in (
        ("doc_id", [(r.doc_id, (r.source or "", None, r.text)) for r in docs]),
        ("page_id", [(r.page_id, seen_page(r)) for r in pages]),
    ):
        told = dict(zip([k for k, _ in rows], languages_by_loops(model, [x for _, x in rows])))
        found = {r[key]: r for r in got if r[key] is not None}
        assert set(found) == set(told)
        assert {k: r.probability for k, r in found.items()} == pytest.approx(
            {k: p for k, (_, p) in told.items()}, abs=1e-4
        )
        assert all(found[k].language == x for k, (x, p) in told.items() if p > 0.51)


def seen_page(r):
    host = re.match(r".*?://([^/?#]*)", r.url or "", re.S)
    declared = language.DECLARED.search((r.html or "")[:4096])
    return (host[1].lower() if host else "", declared and declared[1].lower(), html.main_text(r.html))


def judged_by_loops(rows, rules):
    """Rule and verdict of every URL: its template's purity where no rule fits."""
    ways, said = [], []
    for _, url in rows:
        host, path = "", ""
        if "://" in (url or ""):
            rest = url.split("://", 1)[1]
            host = re.split("[/?#]", rest, maxsplit=1)[0]
            path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
            host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [
            r
            for r in rules
            if (host == r[0].split("/", 1)[0] or host.endswith("." + r[0].split("/", 1)[0]))
            and path.startswith("/" + r[0].split("/", 1)[1])
        ]
        said.append(max(fits, key=lambda r: len(r[0]), default=(None, None)))
        parts = re.sub("^/|/$", "", path).split("/")
        shaped = ["*" if re.search("[0-9]", x) else x for x in parts]
        ways.append((host.split(".")[-1], host, *shaped))
    counts = defaultdict(lambda: [0, 0, 0])
    for way, (_, verdict) in zip(ways, said):
        for k, add in enumerate((1, verdict is not None, verdict == "block")):
            counts[way][k] += add
    total = [sum(c[k] for c in counts.values()) for k in range(3)]
    purity = {}

    def grow(members, prior, level):
        """Purity of every way of ``members``, which share a node of purity ``prior``."""
        own = defaultdict(list)
        for way in members:
            own[way[level] if level < len(way) else ""].append(way)
        branches = defaultdict(list)
        names = labels_by_loops(own, counts, prior) if level > 1 else {x: x for x in own}
        for child, inside in own.items():
            branches[names[child]] += inside
        for name, inside in branches.items():
            k, b = (sum(counts[w][x] for w in inside) for x in (1, 2))
            value = prior
            if len(branches) > 1 and k and abs(b / k - prior) > 2 * math.sqrt(prior * (1 - prior) / k):
                value = (b + urls.PRIOR * prior) / (k + urls.PRIOR)
            if level > 1 and (len(inside) == 1 or name == ""):
                purity.update({w: value for w in inside})
            else:
                grow(inside, value, level + 1)

    if rows:
        grow(list(counts), (total[2] + urls.PRIOR / 2) / (total[1] + urls.PRIOR), 0)
    for way, (rule, verdict) in zip(ways, said):
        yield rule, verdict or ("block" if purity[way] >= urls.REJECT else "allow"), purity[way]


def labels_by_loops(own, counts, prior):
    """The branch that each child of a node becomes."""
    n, known, blocked = ({x: sum(counts[w][k] for w in ws) for x, ws in own.items()} for k in range(3))
    inner = [x for x in own if x != ""]
    names = {x: x for x in own}
    if len(inner) >= urls.VARIABLE_CHILDREN and len(inner) > urls.VARIABLE_SHARE * sum(n[x] for x in inner):
        return {x: "*" if x else "" for x in own}
    told = [x for x in inner if known[x]]
    if len(told) < 2:
        return names
    k, b = sum(known[x] for x in told), sum(blocked[x] for x in told)
    scatter = sum(known[x] * (blocked[x] / known[x] - b / k) ** 2 for x in told)
    free = len(told) - 1
    if scatter <= b / k * (1 - b / k) * (free + 2 * math.sqrt(2 * free)) + 1e-9:
        return {**names, **{x: "*0" for x in told}}
    pools = defaultdict(list)
    for x in told:
        smoothed = (blocked[x] + urls.PRIOR * prior) / (known[x] + urls.PRIOR)
        pools[min(int(math.asin(math.sqrt(smoothed)) * 2 * urls.POOLS / math.pi), urls.POOLS - 1)].append(x)
    sums = sorted((sum(blocked[x] for x in xs) / sum(known[x] for x in xs), p, xs) for p, xs in pools.items())
    groups = []
    for share, _, xs in sums:
        k1 = sum(known[x] for x in xs)
        if groups:
            share0, k0 = last
            both = (share0 * k0 + share * k1) / (k0 + k1)
            near = abs(share - share0) <= 2 * math.sqrt(max(both * (1 - both), 0) * (1 / k0 + 1 / k1))
        if groups and near:
            groups[-1] += xs
        else:
            groups.append(list(xs))
        last = (share, k1)
    for g, xs in enumerate(groups):
        names.update({x: x if len(xs) == 1 else f"*{g + 1}" for x in xs})
    return names


@pytest.mark.parametrize("rules", [urls.RULES, (("net/", "block"), ("org/en/", "block"), ("com/", "allow"))])
def test_verdicts_equal_loops(spark, rules):
    pages = table(spark, "pages")
    rows = [(r.page_id, r.url) for r in pages.collect()]
    wanted = dict(zip([k for k, _ in rows], judged_by_loops(rows, rules)))
    got = {r.page_id: r for r in urls.judged(pages, rules=rules).collect()}
    assert {k: r[:2] for k, r in wanted.items()} == {k: (r.rule, r.verdict) for k, r in got.items()}
    assert {k: r.purity for k, r in got.items()} == pytest.approx({k: r[2] for k, r in wanted.items()})


def made_urls(spark, counts):
    """URLs of one host from (start of a path, how many); a page number ends each."""
    rows = [f"http://h.net/{way}/{k}" for way, n in counts for k in range(n)]
    return spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")


def thin_siblings():
    """Twenty folders of three blocked URLs, twenty of three allowed ones, none telling alone."""
    bad, good = [f"bad{chr(97 + k)}/x" for k in range(20)], [f"good{chr(97 + k)}/x" for k in range(20)]
    rules = [(f"h.net/{x}", "block") for x in bad] + [(f"h.net/{x}", "allow") for x in good]
    return bad, good, tuple(rules)


def test_thin_siblings_are_rejected_together(spark):
    bad, good, rules = thin_siblings()
    unknown = [(x[:-1] + "new", 2) for x in bad] + [(x[:-1] + "new", 2) for x in good]
    df = made_urls(spark, [(x, 3) for x in bad + good] + unknown)
    got = urls.judged(df, rules=rules).where("rule is null").collect()
    assert len(got) == 80
    assert {r.path.split("/")[1][:3] for r in got if r.verdict == "block"} == {"bad"}
    assert all((r.verdict == "block") == r.path.startswith("/bad") for r in got)
    wanted = judged_by_loops([(r.page_id, r.url) for r in df.collect()], rules)
    told = {r.page_id: r.purity for r in urls.judged(df, rules=rules).collect()}
    assert told == pytest.approx({k: w[2] for k, w in enumerate(wanted)})


def test_chance_alone_merges_into_one_branch(spark):
    """Folders with three URLs each, blocked by a coin: those of all heads are no group."""
    ways = [f"{chr(97 + a)}{chr(97 + b)}" for a in range(12) for b in range(12)]
    rows = [("h.net", f"/{x}/p{c}", ("allow", "block")[hash_bit(x, c)]) for x in ways for c in "xyz"]
    rows += [("h.net", f"/{x}/new", None) for x in ways]
    df = spark.createDataFrame(rows, "host string, path string, verdict string")
    got = [r for r in urls.template_purity(df).collect() if r.way[1] == "new"]
    assert len(got) == 144 and max(r.purity for r in got) < urls.REJECT
    assert {r.template.split("/")[1] for r in got} == {"*0"}


def hash_bit(text, k):
    import zlib

    return zlib.crc32(f"{text}{k}".encode()) >> 7 & 1


def test_templates_differ_at_any_depth(spark):
    deep = "/".join("abcdefgh")
    rules = ((f"h.net/{deep}/bad", "block"), (f"h.net/{deep}/good", "allow"))
    df = made_urls(spark, [(f"{deep}/bad", 40), (f"{deep}/good", 40), (f"{deep}/other", 3)])
    got = urls.judged(df, rules=rules).collect()
    purity = {r.template.split("/")[9]: r.purity for r in got}
    assert purity["bad"] > 0.8 > 0.6 > purity["other"] > 0.4 > 0.2 > purity["good"]


def test_urls_of_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "http://h//a//b/"), (5, "http://h//a//b/"),
            (None, "http://H.org/?q"), (6, "http://h/" + "a/" * 300 + "1"), (7, "://x/%20/\n")]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr(
        "*", "1 as host", "2 as way", "3 as node", "4 as seg", "5 as purity", "6 as id"
    )
    got = urls.judged(df).collect()
    assert sorted(r.page_id or 0 for r in got) == sorted(k or 0 for k, _ in rows)
    assert {r.verdict for r in got} == {"allow"}
    assert urls.judged(df.limit(0)).collect() == []
