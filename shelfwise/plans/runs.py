"""From landed parameter runs to log lines and requests for the target jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.joins import DEFAULT_TUNING, JoinTuning
from shelfwise.operators.materialise import run_folder, settle
from shelfwise.operators.triggers import (
    PARAMETER_LOG, TRIGGER_LOG, check_parameters, fan_out, new_runs, parameter_log, trigger_log,
)
from shelfwise.sources.runlog import append_log, log_of, open_log


@dataclass(frozen=True)
class Triggers:
    """Required parameters of a run and the target jobs: mappings with id, name and trigger (renames or None)."""

    required: Sequence[str]
    targets: Sequence[Mapping]


def run_log_lines(runs: DataFrame, log: DataFrame, triggers: Triggers, stamp: Column,
                  tuning: JoinTuning = DEFAULT_TUNING) -> tuple[DataFrame, DataFrame]:
    """(parameter log lines, trigger log lines) of the runs the log has not seen."""
    return lines_of(new_runs(runs, log, tuning=tuning), triggers, stamp)


def lines_of(unseen: DataFrame, triggers: Triggers, stamp: Column) -> tuple[DataFrame, DataFrame]:
    """(parameter log lines, trigger log lines) of runs that are all new. ``unseen`` is computed once."""
    checked = settle(check_parameters(unseen, triggers.required), "checked-runs").frame
    requests = fan_out(checked.filter(F.col("status") == "detected"), triggers.targets, stamp, triggers.required)
    return parameter_log(checked, stamp), trigger_log(requests, stamp)


def run_triggers(runs: DataFrame, parameter_table: str, trigger_table: str, triggers: Triggers, stamp: Column,
                 tuning: JoinTuning = DEFAULT_TUNING) -> None:
    """One round: create the logs if absent, append what is new. A round repeated after a crash adds nothing twice."""
    spark = runs.sparkSession
    open_log(spark, parameter_table, PARAMETER_LOG)
    open_log(spark, trigger_table, TRIGGER_LOG)
    with run_folder(spark):
        # Both logs are partitioned by run id, so a round reads only the buckets of its own ids.
        landed = settle(runs, "landed-runs").frame
        seen = log_of(landed.select("id"), parameter_table, PARAMETER_LOG).select("id")
        lines, requests = run_log_lines(landed, seen, triggers, stamp, tuning)
        # Requests first, so that a crash in between loses none. The round that follows finds their runs unseen and
        # asks again; requests whose job the log already holds are not appended a second time.
        asked = log_of(landed.select("id"), trigger_table, TRIGGER_LOG).select("trigger_job_id")
        append_log(new_runs(requests, asked, "trigger_job_id", tuning), trigger_table)
        append_log(lines, parameter_table)
