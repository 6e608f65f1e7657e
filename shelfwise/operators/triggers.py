"""Detect unseen parameter runs, check their parameters, fan them out to target jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.config import check_declared_parameters
from shelfwise.operators.joins import DEFAULT_TUNING, JoinTuning, attach
from shelfwise.operators.numbering import number_in_order

# Fields of a run that the notification report leaves out.
RUN_METADATA = ("status", "completedAt", "partitionParameters", "runMetadata", "failureReason", "isRetryable",
                "runMessage")

PARAMETER_LOG = ("id string not null, run_name string not null, detect_time timestamp not null, "
                 "parameters string not null, raw string not null, status string not null, "
                 "status_infos string not null")
TRIGGER_LOG = ("id string not null, trigger_time timestamp not null, trigger_job_id string not null, "
               "trigger_job_name string not null, parameters string not null, raw string not null, "
               "status string not null")


# A first page of up to so many rows is gathered in one task.
FIRST_PAGE = 10_000


def page(runs: DataFrame, order: Sequence[str], limit: int | None = None, offset: int = 0) -> DataFrame:
    """One page of a run listing; without a limit everything from the offset on."""
    if limit is None and offset == 0:
        return runs
    if offset == 0 and limit <= FIRST_PAGE:
        return runs.orderBy(*order).limit(limit)
    # A deep page must not gather all the rows before it: rows are numbered in ranges, and the page cut out.
    numbered = number_in_order(runs.withColumn("__all", F.lit(0)), "__all", order, "__at")
    wanted = F.col("__at") > offset
    if limit is not None:
        wanted = wanted & (F.col("__at") <= offset + limit)
    return numbered.filter(wanted).drop("__all", "__at")


def new_runs(runs: DataFrame, log: DataFrame, run_id: str = "id", tuning: JoinTuning = DEFAULT_TUNING) -> DataFrame:
    """Runs whose id the log does not hold, each id once.

    An id that occurs several times in the round is one run: its line that is smallest as JSON stays. The log grows
    for ever and a round of runs is small, so the log is first reduced to the ids of this round.
    """
    line = F.struct(*[f"`{c}`" for c in runs.columns])
    runs = runs.groupBy(F.col(run_id).alias("__id")).agg(F.min_by(line, F.to_json(line)).alias("__line")).select(
        "__line.*")
    asked = runs.select(F.col(run_id).alias("asked")).distinct()
    known = attach(log.select(F.col(run_id).alias("seen")), asked, {"seen": "asked"}, "left_semi", tuning).distinct()
    return attach(runs, known, {run_id: "seen"}, "left_anti", tuning)


def notification_report(runs: DataFrame) -> DataFrame:
    return runs.drop(*RUN_METADATA)


def check_parameters(runs: DataFrame, required: Sequence[str], parameters: str = "parameters") -> DataFrame:
    """Add ``missing`` (all absent parameters), ``status`` and ``status_infos`` (the last absent one)."""
    held = F.coalesce(F.map_keys(parameters), F.array().cast("array<string>"))
    missing = F.filter(F.array(*[F.lit(p) for p in required]).cast("array<string>"),
                       lambda p: ~F.array_contains(held, p))
    wrong = F.size("missing") > 0
    return runs.withColumn("missing", missing).withColumns({
        "status": F.when(wrong, "error").otherwise("detected"),
        "status_infos": F.when(wrong, F.concat(F.lit("Missing parameter: "), F.element_at("missing", -1)))
        .otherwise(""),
    })


def _renamed(trigger: Mapping[str, str] | None, parameters: str) -> Column:
    if not trigger:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[part for name, source in trigger.items()
                          for part in (F.lit(name), F.col(parameters)[source])])


def fan_out(runs: DataFrame, targets: Sequence[Mapping], stamp: Column, declared: Sequence[str],
            parameters: str = "parameters") -> DataFrame:
    """One request per run and target: ``target_id, target_name, request_name, request_parameters``.

    The targets are a short configured list, so each run is multiplied in place; nothing is joined.
    """
    check_declared_parameters(declared, targets)
    lines = F.array(*[
        F.struct(F.lit(t["id"]).alias("target_id"), F.lit(t["name"]).alias("target_name"),
                 _renamed(t.get("trigger"), parameters).alias("request_parameters"))
        for t in targets
    ])
    name = F.concat(F.col("name"), F.lit("_"), F.date_format(stamp, "yyyy_MM_dd_HH:mm:ss"))
    return runs.withColumn("__target", F.explode(lines)).select("*", "__target.*", name.alias("request_name")).drop(
        "__target")


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def parameter_log(checked: DataFrame, stamp: Column, raw: Sequence[str] = ("id", "name", "parameters")) -> DataFrame:
    return checked.select(
        _text(F.col("id")).alias("id"), _text(F.col("name")).alias("run_name"), stamp.alias("detect_time"),
        _text(F.to_json("parameters")).alias("parameters"),
        _text(F.to_json(F.struct(*[c for c in raw if c in checked.columns]))).alias("raw"),
        "status", "status_infos",
    )


def trigger_log(requests: DataFrame, stamp: Column) -> DataFrame:
    """Log lines of the requests to submit; the job id is derived from run and target, so a retry repeats it."""
    return requests.select(
        _text(F.col("id")).alias("id"), stamp.alias("trigger_time"),
        F.sha2(F.concat_ws("|", "id", "target_id"), 256).alias("trigger_job_id"),
        _text(F.col("request_name")).alias("trigger_job_name"),
        _text(F.to_json("request_parameters")).alias("parameters"),
        _text(F.to_json(F.struct("target_id", "target_name", "request_name", "request_parameters"))).alias("raw"),
        F.lit("trigger").alias("status"),
    )
