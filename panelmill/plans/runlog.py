"""Run log as appended events; the state of a run is its last accepted event.

Events are never updated.  A run starts as running; the first terminal event after that decides,
later ones are ignored, so a failure cannot be recorded over a success.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill import fixed
from panelmill.sources.commits import append_note, read_notes

EVENTS = (
    "run_id string, pipeline_name string, status string, at_ns bigint, "
    "staging_rows bigint, typed_rows bigint, error_message string"
)


class RunLog:
    """Events of all runs in one folder, a small file each, so that runs may log at the same time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _append(self, run_id: str, name: str, status: str, staging=None, typed=None, message=None) -> None:
        values = (run_id, name, status, time.time_ns(), staging, typed, message)
        names = [field.split(" ")[0] for field in EVENTS.split(", ")]
        append_note(self.spark, self.path, dict(zip(names, values, strict=True)))

    def start(self, pipeline_name: str) -> str:
        run_id = uuid.uuid4().hex
        self._append(run_id, pipeline_name, fixed.RUNNING)
        return run_id

    def succeed(self, run_id: str, pipeline_name: str, staging_rows: int, typed_rows: int) -> None:
        self._append(run_id, pipeline_name, fixed.SUCCEEDED, staging_rows, typed_rows)

    def fail(self, run_id: str, pipeline_name: str, message: str) -> None:
        self._append(run_id, pipeline_name, fixed.FAILED, message=message)

    def events(self) -> DataFrame:
        return read_notes(self.spark, self.path, EVENTS)

    def runs(self) -> DataFrame:
        """One row per run with start, end, state, counts and message."""
        return run_states(self.events())


def run_states(events: DataFrame) -> DataFrame:
    """State of every run: its first terminal event at or after its start decides.

    Terminal events before the start are ignored, runs without a start are left out.  Two
    aggregations with partial sums and a join on the run, which AQE splits if one run is hot.
    Events at the same time are taken in the order of their status and counts.
    """
    running = F.col("status") == fixed.RUNNING
    starts = events.where(running).groupBy("run_id").agg(
        F.min("pipeline_name").alias("pipeline_name"), F.min("at_ns").alias("started_ns")
    )
    later = events.where(~running).drop("pipeline_name").join(starts.drop("pipeline_name"), "run_id")
    outcome = ["status", "staging_rows", "typed_rows", "error_message"]
    first = (
        later.where("at_ns >= started_ns")
        .groupBy("run_id")
        .agg(F.min(F.struct(F.col("at_ns").alias("finished_ns"), *outcome)).alias("end"))
        .select("run_id", "end.*")
    )
    return (
        starts.join(first, "run_id", "left")
        .withColumn("status", F.coalesce("status", F.lit(fixed.RUNNING)))
        .withColumn("duration_seconds", (F.col("finished_ns") - F.col("started_ns")) / 1e9)
    )


def last_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """The n latest runs."""
    return runs.orderBy(F.desc("started_ns"), F.desc("run_id")).limit(n)
