"""Word counts for a language."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def word_frequency(entries: DataFrame, lang: str = "French", lang_column: str = "lang", word_column: str = "word",
                   ) -> DataFrame:
    """(word, freq): lower-cased entries of one language, entries of several words left out."""
    word = F.lower(F.col(word_column))
    return (
        entries.filter((F.col(lang_column) == lang) & (F.col(word_column) != "")).select(word.alias("word"))
        .filter(~F.col("word").contains(" ")).groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
    )
