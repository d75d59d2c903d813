"""The run log: append-only events, reduced to one row per run when read."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import round_half_up
from tallyloom.schemas import RUN_EVENTS
from tallyloom.sinks import files


class RunLog:
    """Run records of one warehouse. Each event is a small file of its own."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = f"{root.rstrip('/')}/runs"

    def _append(self, **event) -> None:
        row = {name: event.get(name) for name in RUN_EVENTS.fieldNames()}
        row["at"] = datetime.now(timezone.utc)
        self.spark.createDataFrame([row], RUN_EVENTS).coalesce(1).write.parquet(
            f"{self.root}/events/event={uuid.uuid4().hex}"
        )

    def start(self, mode: str = "full") -> int:
        """Record a running run; returns its id.

        Ids count up from 1. An id is claimed by creating a file that must not exist,
        so two runs that start together get different ids.
        """
        taken = [int(name) for name, _ in files.children(self.spark, f"{self.root}/ids")
                 if name.isdigit()]
        run_id = max(taken, default=0) + 1
        while not files.claim(self.spark, f"{self.root}/ids/{run_id}"):
            run_id += 1
        self._append(run_id=run_id, event="start", mode=mode, status="running")
        return run_id

    def finish(
        self,
        run_id: int,
        status: str,
        error_message: str | None = None,
        quality_score: float | None = None,
        phase_timings: dict[str, float] | None = None,
        row_counts: dict[str, int] | None = None,
    ) -> None:
        """Record the end of a run; an unknown run is ignored."""
        if not files.exists(self.spark, f"{self.root}/ids/{run_id}"):
            return
        self._append(
            run_id=run_id,
            event="finish",
            status=status,
            error_message=error_message,
            quality_score=quality_score,
            phase_timings=phase_timings,
            row_counts=row_counts,
        )

    def _events(self) -> DataFrame:
        if not files.children(self.spark, f"{self.root}/events"):
            return self.spark.createDataFrame([], RUN_EVENTS)
        return self.spark.read.schema(RUN_EVENTS).parquet(f"{self.root}/events/*")

    def runs(self) -> DataFrame:
        """One row per run in its latest state."""
        finish = F.col("event") == "finish"

        def last(column: str):
            return F.max_by(column, F.when(finish, F.col("at"))).alias(column)

        started = F.min(F.when(F.col("event") == "start", F.col("at")))
        finished = F.max(F.when(finish, F.col("at")))
        return (
            self._events()
            .groupBy("run_id")
            .agg(
                started.alias("started_at"),
                finished.alias("finished_at"),
                (finished.cast("double") - started.cast("double")).alias("duration_seconds"),
                F.max_by("mode", F.when(~finish, F.col("at"))).alias("mode"),
                F.max_by("status", F.struct("at", finish)).alias("status"),
                last("error_message"),
                last("quality_score"),
                F.coalesce(last("phase_timings"), F.create_map().cast("map<string,double>")).alias(
                    "phase_timings"
                ),
                F.coalesce(last("row_counts"), F.create_map().cast("map<string,bigint>")).alias(
                    "row_counts"
                ),
            )
        )

    def recent(self, limit: int = 50) -> DataFrame:
        """The newest runs first."""
        return self.runs().orderBy(F.desc("run_id")).limit(limit)


def run_statistics(runs: DataFrame) -> DataFrame:
    """Totals, success rate and mean duration; unfinished runs have no duration."""
    total = F.count(F.lit(1))
    success = F.count_if(F.col("status") == "success")
    return runs.agg(
        total.alias("total_runs"),
        success.alias("success_runs"),
        F.count_if(F.col("status") == "failed").alias("failed_runs"),
        F.coalesce(F.try_divide(success * 100.0, total), F.lit(0.0)).alias("success_rate"),
        F.avg("duration_seconds").alias("avg_duration"),
    )


def duration_trend(runs: DataFrame) -> DataFrame:
    """Durations by start time; no rows if fewer than two runs have ended."""
    ended = runs.filter("duration_seconds IS NOT NULL")
    enough = ended.agg((F.count(F.lit(1)) >= 2).alias("_enough"))
    return (
        runs.crossJoin(F.broadcast(enough))
        .filter("_enough")
        .select("started_at", "duration_seconds")
        .orderBy("started_at")
    )


def phase_breakdown(runs: DataFrame) -> DataFrame:
    """Seconds per phase of the latest run."""
    latest = runs.orderBy(F.desc("run_id")).limit(1)
    return latest.select(
        "run_id", F.explode("phase_timings").alias("phase", "seconds")
    ).withColumn("seconds", round_half_up(F.col("seconds"), 3))
