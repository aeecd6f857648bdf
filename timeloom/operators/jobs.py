"""The work queue as state transitions over a snapshot of jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom import schema
from timeloom.functions.ids import stable_id
from timeloom.operators.upsert import set_where

TERMINAL = ["done", "canceled", "failed"]


def queue(jobs: DataFrame, states: list[str], limit: int | None = None, processor: str | None = None) -> DataFrame:
    """Jobs in the given states, most urgent and oldest first."""
    rows = jobs.where(F.col("state").isin(states))
    if processor:
        rows = rows.where(F.col("processor_name") == processor)
    rows = rows.orderBy(F.col("priority").desc(), F.col("queued_at"), F.col("id"))
    return rows.limit(limit) if limit else rows


def start(jobs: DataFrame, ids: DataFrame, worker: str, at, host: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The jobs with the named ones running one attempt more, and the runs that begin."""
    now = F.lit(at).cast("timestamp")
    mine = ids.select("id").distinct().withColumn("_mine", F.lit(True))
    marked = jobs.join(mine, "id", "left").select(*jobs.columns, "_mine")
    after = set_where(marked, F.col("_mine"), state="running", attempt_count=F.col("attempt_count") + 1, started_at=F.coalesce("started_at", now))
    runs = after.where("_mine").select(
        stable_id("tl-processor-run", F.col("id"), F.col("attempt_count")).alias("id"), F.col("id").alias("job_id"), F.col("attempt_count").alias("run_number"), F.lit(worker).alias("worker_name"), F.lit(host).alias("worker_host"),
        now.alias("started_at"), F.lit("running").alias("status"), F.lit("{}").alias("metrics_json"),
    )
    return after.drop("_mine"), schema.shaped(runs, "processor_run")


def finish_runs(runs: DataFrame, where: Column, status: str, at, metrics_json: str = "{}", logs_uri: str | None = None) -> DataFrame:
    return set_where(runs, where, status=status, finished_at=F.lit(at).cast("timestamp"), metrics_json=metrics_json, logs_uri=logs_uri)


def done(jobs: DataFrame, where: Column, at, output_json: str | None = None) -> DataFrame:
    return set_where(jobs, where, state="done", finished_at=F.lit(at).cast("timestamp"), output_json=F.coalesce(F.lit(output_json), F.col("output_json")), error_code=None, error_message=None)


def after_failure(attempts: Column, allowed: Column) -> Column:
    return F.when(attempts < allowed, "retrying").otherwise("failed")


def failed(jobs: DataFrame, where: Column, at, code: str, message: str) -> DataFrame:
    state = after_failure(F.col("attempt_count"), F.col("max_attempts"))
    return set_where(jobs, where, state=state, finished_at=F.when(state == "failed", F.lit(at).cast("timestamp")).otherwise(F.col("finished_at")), error_code=code, error_message=message)


def set_state(jobs: DataFrame, where: Column, state: str, started_at=None, finished_at=None, error_code=None, error_message=None, output_json=None) -> DataFrame:
    """Times and output are set only if given; errors always."""
    return set_where(
        jobs, where, state=state, started_at=F.coalesce(F.lit(started_at).cast("timestamp"), F.col("started_at")), finished_at=F.coalesce(F.lit(finished_at).cast("timestamp"), F.col("finished_at")),
        output_json=F.coalesce(F.lit(output_json), F.col("output_json")), error_code=error_code, error_message=error_message,
    )


def parent_states(children: DataFrame, parent: str, state: str) -> DataFrame:
    """By parent: how many children remain and have failed, and the state that follows."""
    out = children.groupBy(parent).agg(F.count("*").alias("children"), F.count_if(~F.col(state).isin(TERMINAL)).alias("remaining"), F.count_if(F.col(state) == "failed").alias("failed"))
    return out.withColumn("parent_state", F.when(F.col("remaining") > 0, "running").when(F.col("failed") > 0, "failed").otherwise("done"))


def complete_parents(jobs: DataFrame, at) -> DataFrame:
    """Parents whose children are all at an end end too, as failed if one of them failed."""
    states = parent_states(jobs.where("parent_job_id IS NOT NULL"), "parent_job_id", "state").where("remaining = 0")
    marked = jobs.join(states.select(F.col("parent_job_id").alias("id"), "parent_state"), "id", "left").select(*jobs.columns, "parent_state")
    ready = F.col("parent_state").isNotNull() & ~F.col("state").isin(TERMINAL)
    return set_where(marked, ready, state=F.col("parent_state"), finished_at=F.lit(at).cast("timestamp")).drop("parent_state")
