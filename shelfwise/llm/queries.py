"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (
    html_text, language, lexical, mixing, near, nearest, oracles, packing, quality, secret_scan, shards, substrings, urls,
    whitening,
)
from shelfwise.llm.common import table

# The url rules and hosts in use.
URL_RULES = (
    urls.Rule("net", "/", "block"),
    urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"),
    urls.Rule("org", "/fr/", "allow"),
)
BLOCKED_HOSTS = tuple(f"{name}.example.{top}" for name in (
    "spam-farm", "casino-win", "adult-x", "cheap-pills", "free-bets", "ads-track") for top in ("com", "net", "org"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, URL_RULES, BLOCKED_HOSTS).select("page_id", "host", "path", "rule", "verdict")


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = nearest.Index(table(spark, sf_dir, "embeddings"))
    return index.search(F.col("id") % 100 == 0, k=10)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality.fails(quality.BASE).alias("base_failed"), quality.passes("v2").alias("kept"), "failed")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    return found.select(
        "doc_id", *[secret_scan.count_of("base", kind).alias(f"n_{kind}") for kind in secret_scan.KINDS[:3]],
        F.sha2(secret_scan.joined_spans(F.col("base")), 256).alias("base_sha256"),
        secret_scan.joined_spans(F.col("spans")).alias("spans"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_components(table(spark, sf_dir, "documents"), k=3, percent=90)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", language.split_by_id(docs))
    return language.identify(docs, ~F.col("held_out")).select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_url_filters": op2_url_filters,
    "op3_substrings": op3_substrings,
    "op4_nearest": op4_nearest,
    "op5_html_text": op5_html_text,
    "op6_sharding": op6_sharding,
    "op7_quality": op7_quality,
    "op8_packing": op8_packing,
    "op9_secrets": op9_secrets,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_whitening": op11_whitening,
    "op12_lexical": op12_lexical,
    "op13_language": op13_language,
}
ORACLES = {
    "op1_mixing": oracles.OP1,
    "op2_url_filters": oracles.op2(BLOCKED_HOSTS),
    "op3_substrings": oracles.OP3,
    "op7_quality": oracles.OP7,
    "op10_jaccard_join": oracles.OP10,
    "op12_lexical": oracles.OP12,
    "op13_language": oracles.OP13,
}
