"""Attach a lookup table to rows without a hot key landing in one task.

A lookup (unique per key) is written and measured first. Within the broadcast bounds it is broadcast and the rows
never move. Beyond them the join shuffles, and the hottest keys are split: their rows are spread over numbered
salts and their single lookup row is repeated once per salt.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from shelfwise.operators.materialise import Settled, settle


@dataclass(frozen=True)
class JoinTuning:
    """When to broadcast and how to split. ``None`` means the package default."""

    max_rows: int | None = None
    max_bytes: int | None = None
    # Every key with so many rows is split, so there are at most rows / hot_floor of them.
    hot_floor: int = 1_000_000
    rows_per_salt: int = 250_000


DEFAULT_TUNING = JoinTuning()


def null_safe(pairs: Sequence[tuple[Column, Column]]) -> Column:
    return reduce(and_, [left.eqNullSafe(right) for left, right in pairs])


def hot_keys(rows: DataFrame, keys: Sequence[str], tuning: JoinTuning) -> DataFrame:
    """The keys worth splitting, as ``__h0.. , __salts``; counted with map-side partial sums."""
    named = [F.col(f"`{key}`").alias(f"__h{i}") for i, key in enumerate(keys)]
    counts = rows.select(*named).groupBy(*[f"__h{i}" for i in range(len(keys))]).agg(F.count(F.lit(1)).alias("__n"))
    hottest = counts.filter(F.col("__n") >= tuning.hot_floor)
    return hottest.withColumn("__salts", F.ceil(F.col("__n") / tuning.rows_per_salt)).drop("__n")


def _with_salts(side: DataFrame, keys: Sequence[str], hot: Settled) -> DataFrame:
    match = null_safe([(F.col(f"`{key}`"), F.col(f"__h{i}")) for i, key in enumerate(keys)])
    marked = side.join(F.broadcast(hot.frame) if hot.fits() else hot.frame, match, "left").drop(*[f"__h{i}" for i in range(len(keys))])
    return marked.withColumn("__salts", F.coalesce("__salts", F.lit(1)))


def salted_join(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], on: Sequence[str], how: str,
                tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """Null-safe shuffle join of rows to a lookup keyed by ``on``, with the rows of hot keys spread.

    ``rows`` is read twice, so it should be a written table.
    """
    hot = settle(hot_keys(rows, keys, tuning), "hot")
    # The salt depends only on the row and the input partition, so a retried task gives the same one; equal copies
    # of a row still spread, because they come from many partitions.
    plain = [f"`{f.name}`" for f in rows.schema.fields if isinstance(f.dataType, AtomicType)]
    spread = F.pmod(F.xxhash64(*plain, F.spark_partition_id()), F.col("__salts"))
    left = _with_salts(rows, keys, hot).withColumn("__salt", spread).drop("__salts")
    right = (
        _with_salts(lookup, on, hot)
        .withColumn("__to", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)))
        .drop("__salts")
    )
    match = null_safe([(F.col(f"`{k}`"), F.col(f"`{o}`")) for k, o in zip(keys, on)])
    return left.join(right, match & (F.col("__salt") == F.col("__to")), how).drop("__salt", "__to")


def attach(rows: DataFrame, lookup: DataFrame | Settled, on: Mapping[str, str], how: str = "left",
           tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """Join ``rows`` to ``lookup`` (unique on its key columns); nulls match nulls.

    ``on`` maps row columns to lookup columns. The lookup's key columns are not kept. ``how`` is left, inner,
    left_semi or left_anti. Columns added by the lookup must be new names.
    """
    keys = list(on)
    frame = lookup.frame if isinstance(lookup, Settled) else lookup
    marks = [f"__k{i}" for i in range(len(keys))]
    extra = [c for c in frame.columns if c not in on.values()]
    right = frame.select(*[F.col(f"`{o}`").alias(m) for o, m in zip(on.values(), marks)], *[f"`{c}`" for c in extra])
    known = lookup.narrowed(right) if isinstance(lookup, Settled) else settle(right, "lookup")
    right = known.frame
    if known.fits(tuning.max_rows, tuning.max_bytes):
        match = null_safe([(F.col(f"`{k}`"), F.col(m)) for k, m in zip(keys, marks)])
        joined = rows.join(F.broadcast(right), match, how)
    else:
        # Written first, so that what stands before it is computed once, also in a chain of such joins.
        joined = salted_join(settle(rows, "base").frame, right, keys, marks, how, tuning)
    return joined.drop(*marks)
