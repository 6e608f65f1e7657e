from __future__ import annotations

import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from shelfwise.operators import triggers as T
from shelfwise.operators.joins import JoinTuning
from shelfwise.plans import runs as plan
from shelfwise.plans.runs import Triggers, run_triggers
from shelfwise.sources import runlog
from shelfwise.sources.tables import read_table
from shelfwise.streaming import runs as streaming
from shelfwise.streaming.runs import watch_runs

SCHEMA = "id string, name string, parameters map<string,string>, status string, runMessage string"
RUNS = [("r1", "one", {"MONTHS": "3"}, "DONE", "m"), ("r2", "two", {}, "DONE", "m"),
        ("r3", "three", {"MONTHS": "6", "X": "1"}, "DONE", "m"), ("r4", "four", None, "DONE", "m")]
TRIGGERS = Triggers(["MONTHS"], [{"id": "t1", "name": "plain", "trigger": None},
                                 {"id": "t2", "name": "mapped", "trigger": {"Months": "MONTHS"}}])


def stamp():
    return F.lit("2025-08-12 06:30:05").cast("timestamp")


@pytest.fixture
def runs(spark):
    return spark.createDataFrame(RUNS, SCHEMA)


@pytest.mark.parametrize("tuning", [JoinTuning(), JoinTuning(max_rows=0, hot_floor=1)])
def test_new_runs(spark, runs, tuning):
    log = spark.createDataFrame([("r1",), ("r1",), ("r9",)], "id string")
    assert sorted(r.id for r in T.new_runs(runs, log, tuning=tuning).collect()) == ["r2", "r3", "r4"]


def test_parameters(runs):
    checked = {r.id: r for r in T.check_parameters(runs, ["MONTHS", "X"]).collect()}
    assert (checked["r1"].missing, checked["r1"].status_infos) == (["X"], "Missing parameter: X")
    assert (checked["r2"].missing, checked["r2"].status) == (["MONTHS", "X"], "error")
    assert (checked["r3"].missing, checked["r3"].status, checked["r3"].status_infos) == ([], "detected", "")
    assert checked["r4"].missing == ["MONTHS", "X"]


def test_report_and_page(runs):
    assert T.notification_report(runs).columns == ["id", "name", "parameters"]
    assert [r.id for r in T.page(runs, ["id"], 2, 1).collect()] == ["r2", "r3"]
    assert T.page(runs, ["id"]).count() == 4
    assert sorted(r.id for r in T.page(runs, ["id"], offset=3).collect()) == ["r4"]


def test_fan_out(runs):
    asked = {(r.id, r.target_id): r for r in T.fan_out(runs.filter("id = 'r3'"), TRIGGERS.targets, stamp(),
                                                       TRIGGERS.required).collect()}
    assert asked["r3", "t1"].request_parameters == {}
    assert asked["r3", "t2"].request_parameters == {"Months": "6"}
    assert asked["r3", "t2"].request_name == "three_2025_08_12_06:30:05"
    with pytest.raises(ValueError):
        T.fan_out(runs, [{"id": "t", "name": "t", "trigger": {"a": "UNDECLARED"}}], stamp(), ["MONTHS"])


def test_batch_rounds(spark, runs, tmp_path):
    logs = str(tmp_path / "parameters"), str(tmp_path / "triggers")
    run_triggers(runs.filter("id < 'r3'"), *logs, TRIGGERS, stamp())
    run_triggers(runs, *logs, TRIGGERS, stamp())
    lines = {r.id: r for r in read_table(spark, logs[0]).collect()}
    assert read_table(spark, logs[0]).count() == 4
    assert {k: r.status for k, r in lines.items()} == {"r1": "detected", "r2": "error", "r3": "detected", "r4": "error"}
    assert lines["r1"].parameters == '{"MONTHS":"3"}'
    requests = read_table(spark, logs[1])
    assert sorted((r.id, r.trigger_job_name) for r in requests.collect()) == [
        (i, f"{n}_2025_08_12_06:30:05") for i, n in [("r1", "one"), ("r1", "one"), ("r3", "three"), ("r3", "three")]]
    assert requests.select("trigger_job_id").distinct().count() == 4


def test_a_round_after_a_crash_adds_nothing_twice(spark, runs, tmp_path, monkeypatch):
    logs = str(tmp_path / "parameters"), str(tmp_path / "triggers")
    run_triggers(runs.filter("id = 'r1'"), *logs, TRIGGERS, stamp())

    def crash(rows, table, append=plan.append_log):
        if table == logs[0]:
            raise OSError("lost between the two logs")
        append(rows, table)

    with monkeypatch.context() as broken:
        broken.setattr(plan, "append_log", crash)
        with pytest.raises(OSError):
            run_triggers(runs, *logs, TRIGGERS, stamp())
    assert sorted(r.id for r in read_table(spark, logs[0]).collect()) == ["r1"]
    assert read_table(spark, logs[1]).count() == 4
    for _ in range(2):
        run_triggers(runs, *logs, TRIGGERS, F.lit("2025-08-13 06:30:05").cast("timestamp"))
        assert sorted(r.id for r in read_table(spark, logs[0]).collect()) == ["r1", "r2", "r3", "r4"]
        requests = read_table(spark, logs[1])
        assert requests.count() == requests.select("trigger_job_id").distinct().count() == 4


def test_stream_sees_each_run_once_and_replays_safely(spark, runs, tmp_path):
    landing, log, requests = (str(tmp_path / n) for n in ("landing", "log", "requests"))
    checkpoint = str(tmp_path / "checkpoint")

    def round_trip():
        stream = spark.readStream.schema(SCHEMA).json(landing)
        watch_runs(stream, log, requests, checkpoint, TRIGGERS, stamp()).awaitTermination()
        return sorted(r.id for r in spark.read.parquet(log).collect())

    runs.filter("id < 'r3'").coalesce(1).write.json(landing)
    assert round_trip() == ["r1", "r2"]
    runs.coalesce(1).write.mode("append").json(landing)
    assert round_trip() == ["r1", "r2", "r3", "r4"]
    # Forget that the second batch was committed: it runs again and replaces its own lines.
    for name in ("1", ".1.crc"):
        path = tmp_path / "checkpoint" / "commits" / name
        if path.exists():
            shutil.move(path, tmp_path / f"taken-{name}")
    assert round_trip() == ["r1", "r2", "r3", "r4"]
    assert spark.read.parquet(requests).count() == 4


def _files_read(frame):
    """Files that the scan of this frame read."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.head().metrics().apply("numFiles").value()


def test_a_round_reads_only_its_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runlog, "LOG_BUCKETS", 24)
    path, schema = str(tmp_path / "log"), "id string, n long"
    runlog.open_log(spark, path, schema)
    assert runlog.read_log(spark, path, schema).count() == 0
    lines = spark.range(4000).selectExpr("cast(id as string) as id", "id as n")
    for part in range(2):
        runlog.append_log(lines.filter(F.col("n") % 2 == part), path)

    def asked(*ids):
        return runlog.log_of(spark.createDataFrame([(i,) for i in ids], "id string"), path, schema)

    whole = _files_read(runlog.read_log(spark, path, schema))
    assert whole >= 48
    assert _files_read(asked("7")) <= 2 and [r.n for r in asked("7").collect()] == [7]
    twelve = asked(*map(str, range(12)))
    assert _files_read(twelve) <= 24 < whole
    assert {str(i) for i in range(12)} <= {r.id for r in twelve.collect()}
    assert asked("unknown").count() == asked(None).count() == asked().count() == 0
    runlog.compact_log(spark, path, schema)
    assert _files_read(runlog.read_log(spark, path, schema)) <= runlog.LOG_BUCKETS
    assert _files_read(asked("7")) == 1 and [r.n for r in asked("7").collect()] == [7]
    runlog.append_log(lines.limit(1).withColumn("id", F.lit("")), path)
    assert runlog.read_log(spark, path, schema).count() == 4001
    assert asked(None).count() == 1


def test_logs_in_the_catalogue_and_logs_without_buckets(spark, runs, tmp_path):
    names = "shelfwise_parameters", "shelfwise_triggers"
    plain = str(tmp_path / "parameters"), str(tmp_path / "triggers")
    for name, schema in zip(plain, (T.PARAMETER_LOG, T.TRIGGER_LOG)):
        spark.createDataFrame([], schema).write.parquet(name)
    try:
        for logs in (names, plain):
            run_triggers(runs.filter("id < 'r3'"), *logs, TRIGGERS, stamp())
            run_triggers(runs, *logs, TRIGGERS, stamp())
            assert sorted(r.id for r in read_table(spark, logs[0]).collect()) == ["r1", "r2", "r3", "r4"]
            assert read_table(spark, logs[1]).count() == 4
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _landing(spark, tmp_path, **options):
    """A folder to land lines in, and a function that runs the stream on what landed and returns the logged ids."""
    landing, log, requests, checkpoint = (str(tmp_path / n) for n in ("landing", "log", "requests", "checkpoint"))

    def land(rows):
        spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("append").json(landing)

    def watch():
        stream = spark.readStream.schema(SCHEMA).json(landing)
        watch_runs(stream, log, requests, checkpoint, TRIGGERS, stamp(), **options).awaitTermination()
        return sorted((r.batch_id, r.id, r.run_name) for r in spark.read.parquet(log).collect())

    return land, watch


def test_stream_state_knows_what_was_seen_without_the_log(spark, tmp_path):
    land, watch = _landing(spark, tmp_path)
    land([RUNS[0], ("r2", "two", {}, "DONE", "m"), ("r2", "three", {}, "DONE", "m"), (None, "n", {}, "DONE", "m")])
    assert watch() == [(0, "", "n"), (0, "r1", "one"), (0, "r2", "three")]
    # The log is taken away; the state alone tells which runs are new.
    (tmp_path / "log").rename(tmp_path / "log-of-the-first-batch")
    land(RUNS + [(None, "n", {}, "DONE", "m")])
    assert watch() == [(1, "", "n"), (1, "r3", "three"), (1, "r4", "four")]
    assert spark.conf.get(streaming.STATE_STORE, None) is None
    state = list((tmp_path / "checkpoint" / "state").rglob("*.zip"))
    assert state, "the state is kept in RocksDB"


def test_stream_killed_between_the_two_logs(spark, tmp_path, monkeypatch):
    land, watch = _landing(spark, tmp_path)
    land(RUNS[:2])
    first = watch()
    land([*RUNS, ("r3", "other", {"MONTHS": "1"}, "DONE", "m")])
    with monkeypatch.context() as broken:
        broken.setattr(streaming, "lines_of", _crash_after_requests(streaming.lines_of))
        with pytest.raises(StreamingQueryException):
            watch()
    assert {r.id for r in spark.read.parquet(str(tmp_path / "log")).collect()} == {"r1", "r2"}
    after = watch()
    assert after == [*first, (1, "r3", "other"), (1, "r4", "four")]
    requests = spark.read.parquet(str(tmp_path / "requests"))
    assert requests.count() == requests.select("trigger_job_id").distinct().count() == 4
    assert watch() == after


def _crash_after_requests(lines_of):
    def broken(*args):
        lines, requests = lines_of(*args)
        return lines.withColumn("id", F.raise_error(F.lit("lost between the two logs"))), requests
    return broken


def test_stream_calls_no_python_per_id(spark, tmp_path):
    rows = spark.range(30000).selectExpr("concat('r', id % 20000) as id", "id as n")
    rows.write.parquet(str(tmp_path / "in" / "0"))
    found = []
    for part in range(2):
        if part:
            spark.range(10000, 25000).selectExpr("concat('r', id) as id", "-id as n").write.parquet(str(tmp_path / "in" / "1"))
        stream = streaming.first_sights(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in" / "*")))
        assert "InPandas" not in stream._jdf.queryExecution().analyzed().toString()
        stream.writeStream.outputMode("update").foreachBatch(lambda batch, _: found.append(
            batch.agg(F.count("id"), F.countDistinct("id"), F.min("n"), F.max("n")).first())).option(
            "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert [tuple(f)[:2] for f in found] == [(20000, 20000), (5000, 5000)]
    assert tuple(found[1])[2:] == (-24999, -20000)


def test_stream_forgets_in_time(spark, tmp_path):
    land, watch = _landing(spark, tmp_path, remember_ms=1)
    land(RUNS[:1])
    watch()
    land(RUNS[:1])
    assert watch() == [(0, "r1", "one"), (1, "r1", "one")]


def test_stream_lines_keep_their_values(spark, tmp_path):
    schema = "id string, n long, t timestamp, d decimal(20,3), f double, m map<string,string>"
    rows = spark.sql("select 'a' id, 9007199254740993L n, timestamp'2025-01-02 03:04:05.678901' t, 1.5BD d, "
                     "double('NaN') f, map('k', cast(null as string)) m union all "
                     "select 'b', null, null, null, null, null").select(
        "id", "n", "t", F.col("d").cast("decimal(20,3)").alias("d"), "f", "m")
    rows.write.parquet(str(tmp_path / "in"))
    found = {}

    def keep(batch, _):
        found.update({r["id"]: r for r in batch.collect()})

    stream = streaming.first_sights(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    stream.writeStream.outputMode("update").foreachBatch(keep).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    for wanted in rows.collect():
        assert str(found[wanted["id"]]) == str(wanted)


def test_a_run_occurs_once(spark):
    runs = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "z"), ("b", "y"), ("c", "x"), (None, "n")],
                                 "id string, name string")
    log = spark.createDataFrame([("c",)], "id string")
    found = sorted(((r["id"] or ""), r["name"]) for r in T.new_runs(runs, log).collect())
    assert found == [("", "n"), ("a", "x"), ("b", "y")]
