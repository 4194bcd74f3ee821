"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import (
    anchors,
    exact,
    html,
    language,
    leaks,
    mixing,
    near,
    phrases,
    pieces,
    prefixes,
    quality,
    radix,
    urls,
)
from parcelflow.llm.storage import read


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return near.near_groups(docs, words=3, share=(85, 100))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_texts(read(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page and every document; a document's source stands for its host."""
    docs, pages = read(spark, sf_dir, "documents"), read(spark, sf_dir, "pages")
    model = language.fit_text_model(docs)
    host, _ = urls.host_and_path(F.col("url"))
    of_pages = language.identified(pages, model, "page_id", "html", host, True)
    of_docs = language.identified(docs, model, "doc_id", "text", F.col("source"), False)
    return of_docs.unionByName(of_pages, allowMissingColumns=True)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(read(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return anchors.remove_repeats(docs).drop("kept_text")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(read(spark, sf_dir, "documents"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(read(spark, sf_dir, "pages"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix.remove_repeats(read(spark, sf_dir, "documents")).drop("kept_bytes")


def op11_sentencepiece(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """``path`` names the model file; the public 32,000-piece one unless given."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as file:
        model = pieces.PieceModel(file.read())
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    texts = pieces.with_text(pieces.with_ids(docs, model, end=True).drop("text"), model)
    return texts.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(read(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_html_extraction": op2_html_extraction,
    "op3_language_id": op3_language_id,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_source_mixing": op5_source_mixing,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_url_filters": op9_url_filters,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_conversation_trie": op13_conversation_trie,
}
