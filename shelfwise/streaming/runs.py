"""Continuous detection of parameter runs."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfwise.operators.materialise import run_folder
from shelfwise.plans.runs import Triggers, lines_of

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# State lies on disk; forgotten ids are cleared when runs come, not in batches of their own, which would never end.
SETTINGS = {STATE_STORE: ROCKSDB, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
# Lines pass the state as JSON; times keep their microseconds.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def first_sights(runs: DataFrame, run_id: str = "id", remember_ms: int | None = None) -> DataFrame:
    """The runs of a stream whose id was not seen before, each id once.

    Of several lines of an id in one micro-batch the smallest as JSON stays, so a batch that is replayed gives the same
    lines. What was seen is keyed state, spread over the state partitions and looked up by key, never scanned. With
    ``remember_ms`` an id that did not come for so long is forgotten and would be new again; without, ids are
    remembered as long as the checkpoint lives. Runs without an id are never remembered: each micro-batch reports one
    of them.

    Lines of one id are reduced in their input tasks first, so an id with most of the lines does not burden one task.
    """
    line = F.to_json(F.struct(*[f"`{c}`" for c in runs.columns]), JSON)
    keyed = runs.select(F.col(f"`{run_id}`").cast("string").alias("id"), line.alias("line"))
    found = _new_lines(keyed) if remember_ms is None else _new_or_forgotten(keyed, remember_ms)
    return found.select(F.from_json("line", runs.schema, JSON).alias("line")).select("line.*")


def _new_lines(keyed: DataFrame) -> DataFrame:
    """The smallest line of each id that no earlier micro-batch had: an aggregation in the JVM, no call per id.

    The time of a micro-batch is one constant, and the same one when the batch is replayed. An id is new where all its
    lines have it; comparing both ends keeps a known id known when the clock is set back.
    """
    now = F.current_timestamp()
    sights = keyed.select("id", F.when(F.col("id").isNull(), now).alias("alone"), now.alias("at"), "line").groupBy(
        "id", "alone").agg(F.min(F.struct("at", "line")).alias("first"), F.max("at").alias("last"))
    return sights.filter((F.col("first.at") == now) & (F.col("last") == now)).select("first.line")


def _new_or_forgotten(keyed: DataFrame, remember_ms: int) -> DataFrame:
    """The same where ids are forgotten in time: one number per id, with a time limit, in a Python call per id."""

    def least(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.groupby("id", dropna=False, sort=False, as_index=False)["line"].min()

    def unseen(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        line = min(batch["line"].min() for batch in batches)
        if key[0] is None:
            yield pd.DataFrame({"line": [line]})
            return
        now = state.getCurrentProcessingTimeMs()
        # A forgotten id may come back before its state is cleared, so its age is compared too.
        known = state.exists and now - state.get[0] < remember_ms
        state.update((now,))
        state.setTimeoutDuration(remember_ms)
        if not known:
            yield pd.DataFrame({"line": [line]})

    return keyed.mapInPandas(least, "id string, line string").groupBy("id").applyInPandasWithState(
        unseen, "line string", "seen_at long", "update", GroupStateTimeout.ProcessingTimeTimeout)


@contextmanager
def _settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """Queries started inside have these settings, unless the session has its own."""
    unset = [name for name in wanted if spark.conf.get(name, None) is None]
    for name in unset:
        spark.conf.set(name, wanted[name])
    try:
        yield
    finally:
        for name in unset:
            spark.conf.unset(name)


def watch_runs(runs: DataFrame, parameter_log: str, trigger_log: str, checkpoint: str, triggers: Triggers,
               stamp: Column | None = None, available_now: bool = True, remember_ms: int | None = None,
               ) -> StreamingQuery:
    """Start the stream ``runs`` into the two log folders.

    What was seen is keyed state of the stream (see ``first_sights``), so no batch reads the logs. Each micro-batch owns
    one partition ``batch_id=n`` of both logs; a batch that is replayed after a failure starts from the state before it
    and replaces its own lines. Logs and checkpoint belong together: keep both or neither.
    """
    stamp = F.current_timestamp() if stamp is None else stamp

    def handle(batch: DataFrame, batch_id: int) -> None:
        with run_folder(batch.sparkSession):
            lines, requests = lines_of(batch, triggers, stamp)
            requests.write.mode("overwrite").parquet(f"{trigger_log}/batch_id={batch_id}")
            lines.write.mode("overwrite").parquet(f"{parameter_log}/batch_id={batch_id}")

    unseen = first_sights(runs, remember_ms=remember_ms)
    writer = unseen.writeStream.outputMode("update").foreachBatch(handle).option("checkpointLocation", checkpoint)
    with _settings(runs.sparkSession, SETTINGS):
        return (writer.trigger(availableNow=True) if available_now else writer).start()
