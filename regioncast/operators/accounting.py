"""What a piece of work took: jobs and tasks by job group, and their task time from Spark's event log (M7)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP = "spark.jobGroup.id"
#: The parts of an event log line that `task_times` needs.
EVENTS = ("`Event` string, `Stage ID` int, `Stage IDs` array<int>, `Properties` map<string,string>, "
          "`Task Metrics` struct<`Executor Run Time`:bigint,`Executor CPU Time`:bigint>")


@contextmanager
def job_group(spark: SparkSession, name: str, description: str = "") -> Iterator[None]:
    """Jobs started inside (by this thread) belong to the group ``name``; the thread's former group comes back after it."""
    sc = spark.sparkContext
    kept = {p: sc.getLocalProperty(p) for p in (GROUP, "spark.job.description", "spark.job.interruptOnCancel")}
    sc.setJobGroup(name, description or name)
    try:
        yield
    finally:
        for prop, value in kept.items():
            sc.setLocalProperty(prop, value)


def group_counts(spark: SparkSession, name: str) -> tuple[int, int]:
    """(jobs, tasks) of a group, by the status tracker; stages that were skipped have no tasks."""
    tracker = spark.sparkContext.statusTracker()
    jobs = [j for j in map(tracker.getJobInfo, tracker.getJobIdsForGroup(name)) if j is not None]
    stages = [s for s in map(tracker.getStageInfo, {i for j in jobs for i in j.stageIds}) if s is not None]
    return len(jobs), sum(s.numCompletedTasks for s in stages)


def task_times(spark: SparkSession, log: str) -> DataFrame:
    """Rows (group, tasks, task_ms, cpu_ms) from an event log (one JSON object a line): the work of each job group.

    A stage belongs to the group of the first job that names it.  Jobs without a group are left out.
    """
    events = spark.read.schema(EVENTS).json(log)
    stages = events.where("Event = 'SparkListenerStageSubmitted' OR Event = 'SparkListenerJobStart'")
    named = stages.where("Event = 'SparkListenerJobStart'").select(
        F.col("Properties").getItem(GROUP).alias("group"), F.explode("Stage IDs").alias("stage"), F.monotonically_increasing_id().alias("line"))
    owner = named.groupBy("stage").agg(F.min_by("group", "line").alias("group")).where("group IS NOT NULL")
    tasks = events.where("Event = 'SparkListenerTaskEnd'").select(
        F.col("Stage ID").alias("stage"), F.col("Task Metrics.Executor Run Time").alias("ms"), F.col("Task Metrics.Executor CPU Time").alias("ns"))
    return tasks.join(owner, "stage").groupBy("group").agg(
        F.count("*").alias("tasks"), F.sum("ms").alias("task_ms"), F.round(F.sum("ns") / 1e6).cast("long").alias("cpu_ms"))


def with_task_time(accounts: DataFrame, times: DataFrame) -> DataFrame:
    """``accounts`` of a sweep with ``task_ms``: task time of a fit's job groups, a common step's divided among its fits."""
    steps = accounts.select("modello", "k", F.explode("groups").alias("group"))
    shared = steps.groupBy("group").agg(F.count("*").alias("fits"))
    spent = steps.join(shared, "group").join(times, "group", "left").groupBy("modello", "k").agg(
        F.round(F.sum(F.coalesce("task_ms", F.lit(0)) / F.col("fits"))).cast("long").alias("task_ms"))
    return accounts.join(spent, ["modello", "k"]).select(*accounts.columns[:6], "task_ms", "groups")
