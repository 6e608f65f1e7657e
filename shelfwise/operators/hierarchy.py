"""Category levels: which child values hang under several parents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.constants import GLOBAL_LEVELS, LOCAL_LEVELS
from shelfwise.operators.joins import DEFAULT_TUNING, JoinTuning, attach
from shelfwise.operators.materialise import settle


def adjacent(levels: Sequence[str]) -> list[tuple[str, str]]:
    return list(zip(levels[:-1], levels[1:]))


DEFAULT_PAIRS = tuple(adjacent(GLOBAL_LEVELS) + adjacent(LOCAL_LEVELS))


def level_links(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Distinct (child_level, parent_level, child_value, parent_value) of all level pairs, in one pass."""
    links = F.array(*[
        F.struct(F.lit(down).alias("child_level"), F.lit(up).alias("parent_level"),
                 F.col(down).alias("child_value"), F.col(up).alias("parent_value"))
        for up, down in pairs
    ])
    return df.select(F.explode(links).alias("link")).select("link.*").distinct()


KEY = ["child_level", "parent_level", "child_value"]


def hierarchy_conflicts(df: DataFrame, pairs: Sequence[tuple[str, str]] | None = None,
                        tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """(child_level, parent_level, child_value, parent_value, parents): one row per parent of a child value that has
    more than one, with their number. No group is gathered, so a catch-all child with very many parents is no
    single row. Level pairs whose columns are absent are skipped. Missing parents are not counted and not listed.
    """
    if pairs is None:
        pairs = [(up, down) for up, down in DEFAULT_PAIRS if up in df.columns and down in df.columns]
    # The links are distinct already, so a child holds each parent value once, whatever the row counts.
    links = settle(level_links(df, pairs).filter(F.col("parent_value").isNotNull()), "level-links").frame
    several = links.groupBy(*KEY).agg(F.count(F.lit(1)).alias("parents")).filter("parents > 1")
    return attach(links, several, {k: k for k in KEY}, "inner", tuning)


def hierarchy_warnings(df: DataFrame, pairs: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """The conflicts as a report: (child_level, parent_level, child_value, parents), the parents in one array."""
    return hierarchy_conflicts(df, pairs).groupBy(*KEY).agg(
        F.array_sort(F.collect_list("parent_value")).alias("parents"))


def hierarchy_summary(df: DataFrame, pairs: Sequence[tuple[str, str]] | None = None, listed: int = 10) -> DataFrame:
    """The report in bounded rows: (child_level, parent_level, child_value, n_parents, first_parents).

    ``first_parents`` holds the first ``listed`` parents in order, ``n_parents`` counts all of them; the rest stay in
    ``hierarchy_conflicts``. Each task keeps its first ones of a child before anything is shuffled, so a child with a
    million parents costs ``listed`` rows a task.
    """
    conflicts = hierarchy_conflicts(df, pairs)
    first = Window.partitionBy(*KEY).orderBy("parent_value")
    kept = conflicts.withColumn("__at", F.row_number().over(first)).filter(F.col("__at") <= listed)
    return kept.groupBy(*KEY).agg(
        F.max("parents").alias("n_parents"), F.array_sort(F.collect_list("parent_value")).alias("first_parents"))


def inconsistent_children(df: DataFrame, up: str, down: str) -> DataFrame:
    """(child, Corresponding_parent): one level pair, columns named after the levels."""
    return hierarchy_warnings(df, [(up, down)]).select(
        F.col("child_value").alias(down), F.col("parents").alias(f"Corresponding_{up}"))
