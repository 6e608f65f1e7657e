"""Quality rules: a ledger of failure bits and measurements, judged by versioned policies.

Every rule is evaluated once per document, in one pass without a shuffle. The ledger stores one bit per failed rule
and the measurements behind them. A policy is a mask of the rules that reject; policies are applied and compared on
the ledger alone, so a change of policy reads no text.

Defined cases: a null or empty text has no words and fails ``few_words``; a column of the input that has the name of
a ledger column is replaced; equal rows are judged alike; an empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import WORD_CHAR, let, others, words

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Rule:
    """A document fails where ``fails`` (SQL over the measurements) is true."""

    name: str
    fails: str


# Bits in this order. Never reorder or remove: ledgers that were written keep their meaning. Append only.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("repeated_lines", "n_lines >= 4 and 100 * n_dup_lines > 30 * n_lines"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
)
BASE = ("few_words", "repeated_windows")

# Versioned policies: the rules that reject a document.
POLICIES: Mapping[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": (*BASE, "repeated_lines", "symbols", "short_words", "long_words"),
}


def bit(name: str) -> int:
    return 1 << [rule.name for rule in RULES].index(name)


def mask(names: tuple[str, ...]) -> int:
    return sum(bit(name) for name in names)


def _repeat_words(w: Column) -> Column:
    """How many words lie in windows of 8 words that occur twice or more in the text."""
    hashes = F.transform(w, lambda x: F.xxhash64(x))
    windows = let(hashes, lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)),
                                                lambda i: F.xxhash64(F.slice(h, i, WINDOW))))

    def starts(win: Column) -> Column:
        placed = F.sort_array(F.transform(win, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = let(placed, lambda s: F.transform(
            F.filter(s, lambda e, j: (F.get(s, j - 1)["h"] == e["h"]).eqNullSafe(F.lit(True))
                     | (F.get(s, j + 1)["h"] == e["h"]).eqNullSafe(F.lit(True))),
            lambda e: e["i"]))
        return F.sort_array(same)

    def covered(at: Column) -> Column:
        first = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(at, first, lambda acc, p: F.struct(
            p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n")), lambda acc: acc["n"])

    repeated = let(windows, lambda win: F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0))
                   .otherwise(covered(starts(win))))
    return F.when(F.size(w) <= WINDOW, F.lit(0)).otherwise(repeated)


def measured(text: Column) -> Column:
    """All measurements of a text, as one struct of longs."""
    plain = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(plain, "\n"), lambda x: x.rlike(WORD_CHAR))

    def line_counts(found: Column) -> Column:
        return F.struct(F.size(found).alias("all"), (F.size(found) - F.size(F.array_distinct(found))).alias("dup"))

    def fields(w: Column) -> Column:
        return let(let(lines, line_counts), lambda n: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.length(plain) - F.length(F.regexp_replace(plain, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            n["dup"].cast("long").alias("n_dup_lines"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
            n["all"].cast("long").alias("n_lines")))

    return let(words(text), fields)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measurements and ``failed``, the bits of the failed rules (long)."""
    staged = docs.select(*others(docs, [*MEASURES, "failed", "__m"]), measured(F.col(f"`{text}`")).alias("__m"))
    wide = staged.select("*", *[F.col("__m")[m].alias(m) for m in MEASURES]).drop("__m")
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(bit(rule.name))).otherwise(F.lit(0)).cast("long"))
    return wide.withColumn("failed", bits)


def passes(policy: str = "v2") -> Column:
    """Whether a ledger row is kept by a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0


def fails(names: tuple[str, ...]) -> Column:
    return F.col("failed").bitwiseAND(F.lit(mask(names)).cast("long")) != 0


def ablation(rows: DataFrame, policy: str = "v2") -> DataFrame:
    """What each rule of a policy does: documents it fails, those it alone rejects, and words they hold.

    One aggregation with map-side sums over the bits; the result has one row per rule.
    """
    names = POLICIES[policy]
    own = F.col("failed").bitwiseAND(F.lit(mask(names)).cast("long"))
    sums = []
    for name in names:
        hit, alone = own.bitwiseAND(F.lit(bit(name)).cast("long")) != 0, own == bit(name)
        sums.append(F.struct(
            F.lit(name).alias("rule"),
            F.count_if(hit).alias("n_failed"), F.count_if(alone).alias("n_only"),
            F.coalesce(F.sum(F.when(alone, F.col("n_words"))), F.lit(0)).alias("words_only")))
    return rows.agg(F.array(*sums).alias("__r")).select(F.inline("__r"))
