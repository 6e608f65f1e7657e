"""URL filters: exact membership of url keys through a cascade of Bloom filters, without a join.

A key is a host followed by the start of a path, like ``example.net/en/``. The listed keys are encoded in the first
filter. Of the complete key universe of the corpus (every host suffix of a url with every start of its path that has
the length of a listed one) the keys that pass although they are not listed are encoded in the second filter; the
listed keys that pass that one in the third; and so on until no key passes wrongly. A key is listed exactly if the
first filter that refuses it is one of an even number. This holds for every key of the universe it was built over, so
pages outside that corpus need a new cascade.

The filters are sized by the number of their keys; they are written into the plan as constants. The universe is read
once, to find the wrong keys of the first filter; all later levels work on those few. A list whose filters would be
larger than ``MAX_FILTER_BYTES`` is cut by key hash into several cascades, each within the bound.

Defined cases: a null url or one without ``://`` has an empty host and path and matches nothing; equal urls are
judged alike; a column of the input that has the name of an output column is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import ascii_lower, let, others
from shelfwise.operators.materialise import settle

MAX_FILTER_BYTES = 8 * 1024 * 1024
# Wrong passes of the first filter per listed key, and of the later ones per key they refuse.
FIRST_SHARE = 0.7
LATER_RATE = 0.5
PROBES = 4


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def candidate_keys(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The keys of a url that could be listed, the longest first (ties: the longer host)."""
    labels = sorted({rule.host.count(".") + 1 for rule in rules}, reverse=True)
    lengths = sorted({len(rule.path) for rule in rules}, reverse=True)

    def keys(parts: Column) -> Column:
        pairs = []
        for n in labels:
            suffix = F.array_join(F.slice(parts, F.size(parts) - (n - 1), n), ".")
            for length in lengths:
                pairs.append(F.when((F.size(parts) >= n) & (F.length(path) >= length), F.struct(
                    (F.length(suffix) + length).alias("n"), F.lit(n).alias("labels"),
                    F.concat(suffix, F.substring(path, 1, length)).alias("key"))))
        found = F.filter(F.array(*pairs), lambda p: p.isNotNull())
        return F.transform(F.sort_array(found, asc=False), lambda p: p["key"])

    none = F.array().cast("array<string>")
    return none if not rules else F.when(host == "", none).otherwise(let(F.split(host, r"\."), keys))


@dataclass(frozen=True)
class Level:
    """One Bloom filter, and the salt of its hashes."""

    bits: bytes
    salt: int

    def may_hold(self, key: Column) -> Column:
        n_bits = len(self.bits) * 8
        table = F.lit(bytearray(self.bits))

        def hit(i: int) -> Column:
            at = _probe(key, self.salt, i, n_bits)
            byte = F.conv(F.hex(F.substr(table, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
            return F.getbit(byte, (7 - at % 8).cast("int")) == 1

        found = hit(0)
        for i in range(1, PROBES):
            found = found & hit(i)
        return found


def _probe(key: Column, salt: int, i: int, n_bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt * PROBES + i), key), F.lit(n_bits))


def _filter(keys: DataFrame, n_keys: int, rate: float, salt: int) -> Level:
    """Encode the ``key`` column; the bytes that come to the driver are bounded by the number of listed keys."""
    n_bits = 8 * max(8, math.ceil(-n_keys * math.log(rate) / math.log(2) ** 2 / 8 * 1.1))
    spots = keys.select(F.explode(F.array(*[_probe(F.col("key"), salt, i, n_bits) for i in range(PROBES)])).alias("at"))
    marks = spots.groupBy(F.floor(F.col("at") / 8).alias("byte")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1), (7 - F.col("at") % 8).cast("int"))).alias("mark"))
    bits = bytearray(n_bits // 8)
    for row in marks.collect():
        bits[row["byte"]] = row["mark"]
    return Level(bytes(bits), salt)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Exact for every key of the universe: the level that first refuses decides, by its number."""
        verdict = F.lit(len(self.levels) % 2 == 1)
        for number in range(len(self.levels), 0, -1):
            verdict = F.when(self.levels[number - 1].may_hold(key), verdict).otherwise(F.lit(number % 2 == 0))
        return verdict


def build_cascade(listed: DataFrame, universe: DataFrame, n_listed: int, n_universe: int) -> Cascade:
    """``listed`` and ``universe`` have a column ``key``; the universe may repeat keys."""
    if n_listed == 0:
        return Cascade(())
    members = settle(listed.select("key").distinct(), "listed").frame
    rate = min(0.5, max(FIRST_SHARE * n_listed / max(n_universe, 1), 1e-9))
    levels = [_filter(members, n_listed, rate, 0)]
    passing = universe.filter(levels[0].may_hold(F.col("key"))).select("key").distinct()
    wrong = settle(passing.join(members, "key", "left_anti"), "wrong").frame
    right = members
    while (n_wrong := wrong.count()) > 0:
        level = _filter(wrong, n_wrong, LATER_RATE, len(levels))
        levels.append(level)
        # The keys the new filter must refuse but lets pass are the wrong ones of the next level.
        right, wrong = wrong, settle(right.filter(level.may_hold(F.col("key"))), "wrong").frame
    return Cascade(tuple(levels))


def judge(pages: DataFrame, rules: Iterable[Rule], blocked_hosts: Iterable[str] = (), url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the longest that fits, or null) and ``verdict``.

    Where no rule fits, the verdict is ``block`` for a host or subdomain of ``blocked_hosts`` and ``allow`` otherwise.
    """
    rules = tuple(dict.fromkeys(rules))
    spark = pages.sparkSession
    bans = tuple(Rule(host, "", "block") for host in dict.fromkeys(blocked_hosts))
    out = ["host", "path", "rule", "verdict", "__rule_keys", "__ban_keys"]
    staged = pages.select(*others(pages, out), F.col(f"`{url}`").alias("__url")).withColumns(
        {"host": host_of(F.col("__url")), "path": path_of(F.col("__url"))})
    staged = staged.select("*", candidate_keys(F.col("host"), F.col("path"), rules).alias("__rule_keys"),
                           candidate_keys(F.col("host"), F.col("path"), bans).alias("__ban_keys")).drop("__url")

    def cascades(listed: Sequence[Rule], column: str) -> list[Cascade]:
        """One cascade over the listed keys, or several, each for a share of the key hashes."""
        if not listed:
            return []
        keys = spark.createDataFrame([(rule.key,) for rule in listed], "key string").distinct()
        seen = staged.select(F.explode(column).alias("key"))
        n_seen = seen.select(F.approx_count_distinct("key")).first()[0]
        parts = math.ceil(len(listed) * 8 / MAX_FILTER_BYTES)
        share = F.pmod(F.xxhash64(F.lit("part"), F.col("key")), F.lit(parts))
        return [build_cascade(keys.filter(share == p), seen.filter(share == p), math.ceil(len(listed) / parts),
                              math.ceil(n_seen / parts)) for p in range(parts)]

    def member(chain: list[Cascade], key: Column) -> Column:
        if not chain:
            return F.lit(False)
        share = F.pmod(F.xxhash64(F.lit("part"), key), F.lit(len(chain)))
        found = chain[0].holds(key)
        for p in range(1, len(chain)):
            found = F.when(share == p, chain[p].holds(key)).otherwise(found)
        return found

    known, banned = cascades(rules, "__rule_keys"), cascades(bans, "__ban_keys")
    # Which of the listed rules block: a second cascade, whose universe is the rules themselves.
    rule_keys = spark.createDataFrame([(r.key, r.verdict) for r in rules], "key string, verdict string")
    blocking = rule_keys.filter("verdict = 'block'")
    blocks = build_cascade(blocking, rule_keys, blocking.count(), len(rules)) if rules else Cascade(())
    judged = staged.withColumn("rule", F.get(F.filter("__rule_keys", lambda k: member(known, k)), F.lit(0)))
    by_method = F.when(F.exists("__ban_keys", lambda k: member(banned, k)), F.lit("block")).otherwise(F.lit("allow"))
    by_rule = F.when(blocks.holds(F.col("rule")) if blocks.levels else F.lit(False), F.lit("block"))
    verdict = F.when(F.col("rule").isNull(), by_method).otherwise(by_rule.otherwise(F.lit("allow")))
    return judged.withColumn("verdict", verdict).drop("__rule_keys", "__ban_keys")
