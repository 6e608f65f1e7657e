"""Parameter-run queries: batch and stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import triggers as T
from shelfwise.operators.materialise import fresh_path
from shelfwise.plans.runs import Triggers, run_log_lines
from shelfwise.streaming.runs import watch_runs
from workload.base import table

STAMP = "2025-08-12 06:30:05"
REQUIRED = ["k", "month"]
TRIGGERS = Triggers(REQUIRED, [
    {"id": "job-overview", "name": "overview", "trigger": None},
    {"id": "job-segments", "name": "segments", "trigger": {"size": "k"}},
    {"id": "job-overlap", "name": "overlap", "trigger": {"history": "month", "width": "k"}},
])

# A run per event: the id is the event's, one event type comes without the month, another without any parameter.
RUNS = """select cast(event_id as string) as id, concat(event_type, '-', cast(user_id as string)) as name,
    case when event_type = 'error' then 'COMPLETED' else 'QUEUED' end as status, cast(ts as string) as completedAt,
    case event_type when 'signup' then '{}' when 'click' then props
      else concat(substr(props, 1, length(props) - 1), ', "month": ', cast(user_id % 12 as string), '}') end as json"""
FIELDS = "id, name, status, completedAt"


def _as_runs(events):
    shaped = events.selectExpr(*_select_list(RUNS))
    return shaped.withColumn("parameters", F.from_json("json", "map<string,string>")).drop("json")


def _select_list(sql):
    """The projection of RUNS as separate expressions, for batch frames and streams alike."""
    return [
        "cast(event_id as string) as id", "concat(event_type, '-', cast(user_id as string)) as name",
        "case when event_type = 'error' then 'COMPLETED' else 'QUEUED' end as status",
        "cast(ts as string) as completedAt", sql[sql.index("case event_type"):],
    ]


def _runs(spark, sf):
    """Every event, and every 50th a second time: a landing folder can hold the same run twice."""
    events = table(spark, sf, "events")
    return _as_runs(events.unionByName(events.filter("event_id % 50 = 0")))


def _logged(spark, sf):
    """Ids seen earlier: the keys of finished orders, many of them several times."""
    orders = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    ids = orders.select(F.col("o_orderkey").cast("string").alias("id"))
    return ids.unionByName(ids)


def _unseen(spark, sf):
    return T.new_runs(_runs(spark, sf), _logged(spark, sf))


def _stamp():
    return F.lit(STAMP).cast("timestamp")


def _checked(spark, sf):
    return T.check_parameters(_unseen(spark, sf), REQUIRED)


def _requests(spark, sf):
    return T.fan_out(_checked(spark, sf).filter("status = 'detected'"), TRIGGERS.targets, _stamp(), REQUIRED)


def _log_lines(part):
    return lambda s, d: run_log_lines(_runs(s, d), _logged(s, d), TRIGGERS, _stamp())[part]


def _stream(spark, sf, log="parameter_log"):
    """Three landings, one micro-batch each; some runs occur twice in a landing and again in the next one."""
    events = table(spark, sf, "events")
    base = fresh_path(spark, "stream")
    stream = None
    for part in range(3):
        own = events.filter(F.col("event_id") % 3 == part)
        again = events.filter((F.col("event_id") % 3 != (part + 1) % 3) & (F.col("event_id") % 50 == 0))
        own.unionByName(again).write.parquet(f"{base}/landed/{part}")
        stream = stream or spark.readStream.schema(events.schema).parquet(f"{base}/landed/*")
        # Each start goes on from the checkpoint of the one before.
        watch_runs(_as_runs(stream), f"{base}/parameter_log", f"{base}/trigger_log", f"{base}/checkpoint", TRIGGERS,
                   _stamp()).awaitTermination()
    return spark.read.parquet(f"{base}/{log}").drop("batch_id")


QUERIES = {
    "new_runs": lambda s, d: _unseen(s, d).select("id", "name", "status"),
    "known_ids": lambda s, d: _logged(s, d).distinct(),
    "run_report": lambda s, d: T.notification_report(_unseen(s, d)).withColumn(
        "parameters", F.to_json("parameters")),
    "run_page": lambda s, d: T.page(
        _as_runs(table(s, d, "events")).select("id", "name"), ["id"], limit=500, offset=500),
    "run_params": lambda s, d: _checked(s, d).select(
        "id", F.array_join("missing", "|").alias("missing"), "status", "status_infos"),
    "fan_out": lambda s, d: _requests(s, d).select(
        "id", "target_id", "target_name", "request_name", F.to_json("request_parameters").alias("request_parameters")),
    "parameter_log": _log_lines(0),
    "trigger_log": _log_lines(1),
    "stream_new_runs": _stream,
    "stream_requests": lambda s, d: _stream(s, d, "trigger_log"),
}

# ---- oracles ----------------------------------------------------------------------------------------------------

_RUNS_SQL = ("with runs as (select *, replace(json, ': ', ':') as spaced from ("
             + RUNS.replace("cast(ts as string) as completedAt", "ts::varchar as completedAt") + " from events)), "
             "pars as (select *, json_extract_string(json, '$.k') as p_k, json_extract_string(json, '$.month') as "
             "p_month from runs), "
             "known as (select distinct o_orderkey::varchar as id from orders where o_orderstatus = 'F'), "
             "unseen as (select * from pars where id not in (select id from known)), checked as (select *, "
             "array_to_string(list_filter([case when p_k is null then 'k' end, case when p_month is null then 'month' "
             "end], lambda m: m is not null), '|') as missing from unseen), "
             "told as (select *, case when missing = '' then 'detected' else 'error' end as state, case when "
             "p_month is null then 'Missing parameter: month' when p_k is null then 'Missing parameter: k' else '' "
             "end as infos from checked), targets as (select unnest(['job-overview', 'job-segments', 'job-overlap']) "
             "as target_id), asked as (select t.id, g.target_id, split_part(g.target_id, '-', 2) as target_name, "
             "t.name || '_2025_08_12_06:30:05' as request_name, case g.target_id when 'job-overview' then '{}' when "
             "'job-segments' then '{\"size\":\"' || p_k || '\"}' else '{\"history\":\"' || p_month || "
             "'\",\"width\":\"' || p_k || '\"}' end as request_parameters from told t cross join targets g "
             "where t.state = 'detected')")
_PAR_TEXT = ("case when p_k is null then '{}' when p_month is null then '{\"k\":\"' || p_k || '\"}' else '{\"k\":\"' "
             "|| p_k || '\",\"month\":\"' || p_month || '\"}' end")
_WHEN = f"timestamp '{STAMP}'"

_PARAMETER_LOG = (f"{_RUNS_SQL} select id, name as run_name, {_WHEN} as detect_time, {_PAR_TEXT} as parameters, "
                  "'{\"id\":\"' || id || '\",\"name\":\"' || name || '\",\"parameters\":' || " + _PAR_TEXT
                  + " || '}' as raw, state as status, infos as status_infos from {source}")

_TRIGGER_LOG = (f"{_RUNS_SQL} select id, {_WHEN} as trigger_time, sha256(id || '|' || target_id) as "
                "trigger_job_id, request_name as trigger_job_name, request_parameters as parameters, "
                "'{\"target_id\":\"' || target_id || '\",\"target_name\":\"' || target_name || "
                "'\",\"request_name\":\"' || request_name || '\",\"request_parameters\":' || request_parameters "
                "|| '}' as raw, 'trigger' as status from asked")

ORACLES = {
    "new_runs": f"{_RUNS_SQL} select id, name, status from unseen",
    "known_ids": f"{_RUNS_SQL} select id from known",
    "run_report": f"{_RUNS_SQL} select id, name, {_PAR_TEXT} as parameters from unseen",
    "run_page": f"{_RUNS_SQL} select id, name from runs order by id limit 500 offset 500",
    "run_params": f"{_RUNS_SQL} select id, missing, state as status, infos as status_infos from told",
    "fan_out": f"{_RUNS_SQL} select * from asked",
    "parameter_log": _PARAMETER_LOG.replace("{source}", "told"),
    "trigger_log": _TRIGGER_LOG,
    "stream_new_runs": _PARAMETER_LOG.replace(
        "{source}", "(select *, case when missing = '' then 'detected' else 'error' end as state, case when p_month "
        "is null then 'Missing parameter: month' when p_k is null then 'Missing parameter: k' else '' end as infos "
        "from (select *, array_to_string(list_filter([case when p_k is null then 'k' end, case when p_month is null "
        "then 'month' end], lambda m: m is not null), '|') as missing from pars))"),
    # The stream starts with empty logs, so every run is new.
    "stream_requests": _TRIGGER_LOG.replace("where id not in (select id from known)", ""),
}
