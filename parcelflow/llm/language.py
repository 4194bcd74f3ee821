"""Operator 3, language identification by Bayesian fusion of evidence.

* Text: a naive Bayes model of byte trigrams (hashed to 32,768 cells), counted over all labelled
  documents by grouped aggregation. Neighbouring trigrams are not independent, so a text weighs
  as ``WEIGHT`` trigrams at most.
* Declared markup language: how often pages of each language declare each tag, counted over all
  pages from what their text says.
* Address suffix and host: shares of languages for each suffix, and for each host on top of its
  suffix as a prior; a page's own share is left out of its host's.

The posterior is the product of the text's likelihood, the declared tag's and the host prior.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.arrays import flat, lower_table, slices
from parcelflow.llm.html import RAW, TOKEN, main_text
from parcelflow.llm.storage import write_table

CELLS = 1 << 15
WEIGHT = 60.0
PRIOR = 5.0
MOST_LANGUAGES = 200
SLICE_BYTES = 500_000
DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,8})", re.I)


def declared_language(page: str | None) -> str | None:
    """The language of the first ``<html>`` tag that declares one, wherever it stands in the page;
    comments, scripts and the like are not looked into."""
    if not page or not DECLARED.search(page):
        return None
    at = 0
    while m := TOKEN.search(page, at):
        at = m.end()
        tag = (m["tag"] or "").lower()
        if tag == "html" and (found := DECLARED.match(m[0])):
            return found[1].lower()
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
    return None


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell of every run of three bytes, A-Z lower-cased, and where each text's begin."""
    data = lower_table()[data].astype(np.uint32)
    cells = data[:-2] * np.uint32(0x9E3779B1) + data[1:-1] * np.uint32(0x85EBCA6B) + data[2:] * np.uint32(0xC2B2AE35)
    cells = (cells >> np.uint32(17)).astype(np.int64)
    inside = np.ones(len(cells) + 2, bool)
    ends = offsets[1:]
    for back in (1, 2):
        inside[ends[ends >= back] - back] = False
    keep = np.flatnonzero(inside[: len(cells)])
    return cells[keep], np.searchsorted(keep, offsets)


def _count(languages: list[str]):
    place = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), CELLS), np.int64)
        for batch in slices(batches, "body", SLICE_BYTES):
            data, offsets = flat(batch.column("body"))
            if len(data) < 3:
                continue
            cells, first = trigrams(data, offsets)
            own = np.array([place[x] for x in batch.column("lang").to_pylist()])
            key = np.repeat(own, np.diff(first)) * CELLS + cells
            counts += np.bincount(key, minlength=counts.size).reshape(counts.shape)
        held = np.flatnonzero(counts.ravel())
        yield pa.RecordBatch.from_arrays(
            [pa.array(held), pa.array(counts.ravel()[held])], names=["cell", "n"]
        )

    return run


class TextModel:
    """Log-likelihood of a text for each language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts + 0.5
        self.table = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32)

    def likelihoods(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        if len(data) < 3:
            return out
        cells, first = trigrams(data, offsets)
        rows = np.append(np.take(self.table, cells, axis=0), np.zeros((1, out.shape[1]), np.float32), 0)
        total = np.add.reduceat(rows, np.minimum(first[:-1], len(cells)), axis=0, dtype=np.float64)
        size = np.diff(first)[:, None]
        total = np.where(size > 0, total, 0.0)
        return total * np.minimum(1.0, WEIGHT / np.maximum(size, 1))


def fit_text_model(df: DataFrame, text: str = "text", language: str = "lang") -> TextModel:
    """Counts over all rows with a language; bounded by languages times cells."""
    rows = df.select(F.col(text).alias("body"), F.col(language).alias("lang")).where("lang IS NOT NULL")
    languages = sorted(r.lang for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = np.zeros(len(languages) * CELLS)
    counted = rows.mapInArrow(_count(languages), "cell long, n long")
    for r in counted.groupBy("cell").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r.cell] = r.n
    return TextModel(languages, counts.reshape(len(languages), CELLS))


def _evidence(model: TextModel, markup: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body", SLICE_BYTES):
            raw = batch.column("body")
            declared = pa.nulls(batch.num_rows, pa.string())
            if markup:
                pages = raw.to_pylist()
                declared = pa.array([declared_language(p) for p in pages], pa.string())
                raw = pa.array([main_text(p) for p in pages], pa.string())
            score = model.likelihoods(*flat(raw))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("host"), declared, pa.array(list(score))],
                names=["id", "host", "declared", "score"],
            )

    return run


def identified(
    df: DataFrame,
    model: TextModel,
    id_column: str,
    text: str,
    host,
    markup: bool,
) -> DataFrame:
    """One row per row of ``df``: id, ``host``, ``declared``, ``language``, ``probability``.

    ``host`` is a column; the suffix is what follows its last dot. With ``markup`` the text is a
    page: its language is declared by ``<html lang>`` and its main text is judged. Null and empty
    texts have no likelihood of their own and follow their host; a null host counts as one of its
    own, an undeclared language says nothing. Without any language in the model the language is
    null. Ids may be null or repeated; other columns are ignored.
    """
    id_type = df.schema[id_column].dataType.simpleString()
    if not model.languages:
        return df.select(
            F.col(id_column), F.coalesce(host, F.lit("")).alias("host"),
            F.lit(None).cast("string").alias("declared"),
            F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("probability"),
        )
    rows = df.select(
        F.col(id_column).alias("id"), F.col(text).alias("body"), F.coalesce(host, F.lit("")).alias("host")
    )
    seen = write_table(
        rows.mapInArrow(
            _evidence(model, markup), f"id {id_type}, host string, declared string, score array<double>"
        )
    )
    n = len(model.languages)
    each = lambda f: F.array(*[f(k) for k in range(n)])
    # From the text alone: shares that add up to 1.
    top = F.array_max("score")
    weight = F.transform("score", lambda s: F.exp(s - top))
    total = F.aggregate(weight, F.lit(0.0), lambda a, x: a + x)
    seen = seen.withColumn("share", F.transform(weight, lambda w: w / total)).withColumn(
        "suffix", F.element_at(F.split("host", r"\."), -1)
    )

    def sums(*keys: str) -> DataFrame:
        return seen.groupBy(*keys).agg(each(lambda k: F.sum(F.get("share", F.lit(k)))).alias("sums"))

    def known(row: list | None) -> list[float]:
        return [x or 0.0 for x in row or [None] * n]

    # One number a language: the shares of all rows.
    of_all = known(sums().first()["sums"])
    root = F.array(*[F.lit((s + PRIOR / n) / (sum(of_all) + PRIOR)) for s in of_all])
    whole = F.aggregate("sums", F.lit(0.0), lambda a, x: a + x)
    suffixes = sums("suffix").select(
        "suffix",
        F.zip_with("sums", root, lambda s, p: (s + PRIOR * p) / (whole + PRIOR)).alias("prior"),
    )
    hosts = sums("suffix", "host").join(suffixes, "suffix").select(
        "host", F.col("sums").alias("host_sums"), F.col("prior").alias("suffix_prior")
    )
    # How often each language declares each tag, smoothed towards all pages.
    tags = sums("declared").where("declared IS NOT NULL").withColumn(
        "n_tag", F.aggregate("sums", F.lit(0.0), lambda a, x: a + x)
    )
    tagged = seen.where("declared IS NOT NULL")
    tagged = tagged.agg(each(lambda k: F.sum(F.get("share", F.lit(k)))).alias("sums")).first()
    of_language = known(tagged["sums"])
    by_chance = F.lit(PRIOR) * F.col("n_tag") / F.lit(sum(of_language) or 1.0)
    declared = tags.select(
        F.col("declared").alias("tag"),
        F.zip_with(
            "sums",
            F.array(*[F.lit(x) for x in of_language]),
            lambda s, l: (s + by_chance) / (l + PRIOR),
        ).alias("by_tag"),
    )
    joined = (
        seen.join(hosts, "host").join(declared, F.col("declared") == F.col("tag"), "left")
    )
    others = F.zip_with("host_sums", "share", lambda s, x: F.greatest(s - x, F.lit(0.0)))
    left = F.aggregate("others", F.lit(0.0), lambda a, x: a + x)
    host_prior = F.zip_with("others", "suffix_prior", lambda s, p: (s + PRIOR * p) / (left + PRIOR))
    likely = F.zip_with("share", "host_prior", lambda s, p: s * p)
    fused = F.when(F.col("by_tag").isNull(), likely).otherwise(
        F.zip_with(likely, "by_tag", lambda a, b: a * b)
    )
    told = (
        joined.withColumn("others", others)
        .withColumn("host_prior", host_prior)
        .withColumn("fused", fused)
        .withColumn("best", F.array_max("fused"))
        .withColumn("all", F.aggregate("fused", F.lit(0.0), lambda a, x: a + x))
    )
    names = F.array(*[F.lit(x) for x in model.languages])
    return told.select(
        F.col("id").alias(id_column),
        "host",
        "declared",
        F.element_at(names, F.array_position("fused", F.col("best")).cast("int")).alias("language"),
        (F.col("best") / F.col("all")).alias("probability"),
    )
