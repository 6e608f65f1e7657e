"""The training-data pipeline: quality rules, near-duplicates, secrets, mixing, packing.

Each stage takes the documents its predecessor kept, written as Parquet and read again, and does its whole work on
them. All but the last return the columns of ``documents``. ``run`` applies them in order to the table ``documents``.

Null or empty texts have no words, so the first stage drops them with all documents of under 20 words; ties, repeated
rows and null ids are handled as the operators state; an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import mixing, near, packing, quality, secret_scan
from shelfwise.operators.materialise import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go; the others stay unchanged."""
    judged = quality.ledger(docs.select("*", F.struct(*docs.columns).alias("__row")))
    return judged.filter(quality.passes("v2")).select("__row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word Jaccard similarity of 0.8 or more stays: the smallest id."""
    return near.keep_one(docs, k=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays, and n_chars counts the new text."""
    # The other columns travel in one struct, so none of them can clash with those of the scan.
    rest = F.struct(F.lit(1).alias("__one"), *[f"`{c}`" for c in docs.columns if c != "text"])
    cleaned = secret_scan.redact(secret_scan.scan(docs.select("text", rest.alias("__rest"))))
    found = {c: F.col("__rest")[c] for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in found:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        found["n_chars"] = F.when(F.col("text").isNull(), found["n_chars"]).otherwise(length)
    return cleaned.select(*[value.alias(c) for c, value in found.items()])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh 5, 2, 1 in turn; a document taken more than once is there as often."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens: one row per piece, as in the packing operator."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]

# SQL expresses neither the tokenizer nor the components; tests/llm holds the stages against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-")).frame
    return STAGES[-1][1](spark, docs, sf_dir)
