"""HTML, language, leaks, mixing, quality and URL operators."""

import pytest
from pyspark.sql import functions as F

from parcelflow.llm import html, language, leaks, mixing, quality, urls

FOLDER = "/root/testdata/sf0.01"

PAGE = """<html><body class="home"><div id="cookie-notice">We use cookies</div><header><h1>Site</h1>
</header><nav><a href=x>Menu</a></nav><div class="wrap"><div class="sidebar"><p>Side stuff</p></div>
<div><h2>Title</h2><p>First long paragraph with many words to read, &quot;quotes&quot; &amp; more.
<p>Second long <b>para</b>graph with <a href=x>many</a> words<br>to read.<script>var a="</p>"</script>
<div class="comments"><p>Reader says hello.</p></div></div></div><footer>foot</footer></body></html>"""


def test_article_without_chrome():
    assert html.main_text(PAGE) == (
        'Title First long paragraph with many words to read, "quotes" & more. '
        "Second long paragraph with many words to read."
    )


@pytest.mark.parametrize("page", [None, "", "<div", "<!--", "<p></p>", "</b></i>"])
def test_pages_without_text(page):
    assert html.main_text(page) == ""


def test_a_lone_bracket_is_text():
    assert html.main_text("<") == "<" and html.main_text("<p>1 < 2") == "1 < 2"


def test_pages_are_read_whole_and_deep():
    assert len(html.main_text("<article>" + "<p>word word</p>" * 50_000)) == 10 * 50_000 - 1
    assert html.main_text("<div>" * 5000 + "deep") == "deep"


def test_page_rows(spark):
    rows = [(1, None, None), (None, "u", "<p>a&nbsp; b"), (1, "u", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = sorted(map(tuple, html.main_texts(df).collect()), key=repr)
    assert got == sorted([(1, None, "", 0), (None, "u", "a b", 3), (1, "u", "x", 1)], key=repr)
    assert html.main_texts(df.limit(0)).collect() == []


def test_rules_and_templates(spark):
    data = [
        (1, "http://www.EXAMPLE.org/es/9?x#y", "www.example.org", "/es/9", "example.org/es/", "block"),
        (2, "http://example.org/en/17", "example.org", "/en/17", "example.org/en/1", "block"),
        (3, "http://example.org/en/7", "example.org", "/en/7", "org/", "allow"),
        (4, "x://org/", "org", "/", "org/", "allow"),
        (5, "x://notorg", "notorg", "", None, "allow"),
        (6, "http://a.com/de/", "a.com", "/de/", "com/de/", "block"),
        (7, None, "", "", None, "allow"),
        (7, "no scheme", "", "", None, "allow"),
        (None, "s://h?q/en", "h", "", None, "allow"),
    ]
    df = spark.createDataFrame([r[:2] for r in data], "page_id long, url string").withColumn("host", F.lit(1))
    got = urls.judged(df).select("page_id", "host", "path", "rule", "verdict").collect()
    wanted = [(r[0], *r[2:]) for r in data]
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)
    assert urls.judged(df.limit(0)).collect() == []


def test_impure_templates_are_rejected(spark):
    blocked = [(i, f"http://bad.net/buy/now-{i}") for i in range(200)]
    fine = [(i, f"http://good.net/read/{i}") for i in range(200)]
    rules = (("bad.net/buy/now-1", "block"), ("good.net/", "allow"))
    df = spark.createDataFrame(blocked + fine, "page_id long, url string")
    got = urls.judged(df, rules=rules)
    assert got.where("rule IS NULL").select("verdict").distinct().collect() == [("block",)]
    assert got.where("host = 'good.net' AND verdict = 'block'").count() == 0


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_language_of_held_out_documents(spark, rows):
    docs = documents(spark)
    fifth = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = language.fit_text_model(docs.where(~fifth))
    told = language.identified(docs.where(fifth), model, "doc_id", "text", F.col("source"), False)
    right = told.join(docs, "doc_id").select(F.avg((F.col("language") == F.col("lang")).cast("int")))
    assert right.first()[0] >= 0.97
    awkward = language.identified(rows, model, "doc_id", "text", F.col("source"), False)
    assert awkward.count() == rows.count()
    empty = language.fit_text_model(rows.limit(0))
    assert language.identified(rows, empty, "doc_id", "text", F.col("source"), False).count() == rows.count()


def test_quality_of_held_out_documents(spark, rows):
    docs, labels = documents(spark), spark.read.parquet(f"{FOLDER}/labels.parquet")
    network = quality.fit(docs, labels)
    got = quality.score(docs, network).where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in got) / len(got) >= 0.93
    assert sum(r.predicted for r in got if r.quality) == sum(1 for r in got if r.quality)
    awkward = quality.score(rows, network)
    assert awkward.count() == rows.count() and awkward.where("score IS NULL").count() == 0
    assert quality.keep_good(rows, network).columns == rows.columns
    untrained = quality.fit(rows.limit(0), labels)
    assert quality.score(rows, untrained).count() == rows.count()


def test_leaks_and_edited_copies(spark, rows):
    item = "the quick brown fox jumps over a lazy dog while seven wizards quietly brew strong potions"
    words = item.split()
    edited = " ".join("changed" if i % 6 == 5 else w for i, w in enumerate(words))
    data = [(1, f"before {item} after"), (2, f"x {edited.upper()} y"), (3, "a lazy dog sat"), (4, None),
            (None, item)]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("item_id", F.lit(1))
    bench = spark.createDataFrame([(9, item), (10, None), (11, "two words")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in leaks.leaks(docs, bench).collect()}
    assert set(got) == {(1, 9), (2, 9), (None, 9)} and got[1, 9] == 1.0 and 0.5 <= got[2, 9] < 1
    left = leaks.without_leaks(docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [3, 4]
    assert leaks.leaks(docs, bench.limit(0)).count() == leaks.leaks(docs.limit(0), bench).count() == 0
    assert leaks.leaks(rows, bench).count() == 0


def test_targets_and_quotas():
    assert [float(x) for x in mixing.source_targets({"a": 10, "b": 100, None: 0}).values()] == [30.0, 80.0, 0.0]
    # Each source could fill its quota alone; only sharing the common pattern avoids a second use.
    given = mixing.routed({("a",): 5, ("b",): 5, ("a", "b"): 10}, {"a": 10, "b": 10})
    assert given == {("a",): 5, ("b",): 5, ("a", "b"): 10}
    assert mixing.routed({("a",): 5}, {"a": 12}) == {("a",): 12}


def test_mix_comes_near_its_targets(spark, rows):
    got = mixing.mixed(documents(spark)).join(documents(spark).select("doc_id", "source"), "doc_id")
    for r in got.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("target")).collect():
        assert abs(r.t - r.target) <= 0.02 * r.target
    assert got.where("taken > 3 * size OR taken < 0").count() == 0
    again = mixing.mixed(documents(spark).repartition(5))
    assert sorted(again.collect()) == sorted(mixing.mixed(documents(spark)).collect())
    assert mixing.mixed(rows).count() == rows.count()
    assert mixing.mix(rows.limit(0)).collect() == []
    assert mixing.mix(rows).columns == [*rows.columns, "mix_times", "mix_words"]


def test_sources_may_overlap(spark):
    rows = [(1, "a b c", ["x", "y"]), (2, "d e", ["x"]), (3, "f", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    assert mixing.mixed(df).count() == 3


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        left = stage(spark, docs, "/root/testdata/sf0.001")
        assert left.columns[: len(docs.columns)] == docs.columns
        assert 0 < left.count() <= docs.count()
