"""Cursor and execution logs: append-only tables, written only after a batch has succeeded."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def observed_write(df: DataFrame, path: str, id_col: str = "id") -> tuple[int, int]:
    """Write df; return its number of rows and largest id (0 if none), measured while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n"), F.max(id_col).alias("max_id")).write.mode("overwrite").parquet(path)
    return seen.get["n"], seen.get["max_id"] or 0


def append_offset(spark: SparkSession, path: str, job: str, channel: str, target: str | None, last: int) -> bool:
    """Append one cursor row; False, and nothing written, where ``last`` is 0 or less."""
    if last <= 0:
        return False
    offset_row(spark, job, channel, target, last).write.mode("append").parquet(path)
    return True


def offset_row(spark: SparkSession, job: str, channel: str, target: str | None, last: int) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(
        F.lit(job).alias("job_name"), F.lit(channel).alias("channel"), F.lit(target).cast("string").alias("source_target"), F.lit(last).cast("long").alias("last_offset"),
        F.current_timestamp().alias("last_event_time"), F.current_timestamp().alias("updated_at"),
    )


def list_offsets(offsets: DataFrame) -> DataFrame:
    """All cursor rows, the newest update first."""
    return offsets.orderBy(F.desc("updated_at"), F.desc("last_offset"))


def run_recorded(spark: SparkSession, path: str, execution: str, job: str, work) -> None:
    """Run work() -> (rows in, rows out, cursor) and append a row about it; one that raises is recorded as failed, and raises on."""
    started = datetime.datetime.now(datetime.UTC)
    try:
        done = work()
    except Exception as e:
        append_execution(spark, path, execution, job, started, 0, 0, 0, f"{type(e).__name__}: {e}")
        raise
    append_execution(spark, path, execution, job, started, *done)


def append_execution(
    spark: SparkSession, path: str, execution: str, job: str, started: datetime.datetime, records_in: int, records_out: int, last: int, error: str | None = None
) -> None:
    """Append one row about a run."""
    run_row(spark, execution, job, started, records_in, records_out, last, error).write.mode("append").parquet(path)


def run_row(spark: SparkSession, execution: str, job: str, started: datetime.datetime, records_in: int, records_out: int, last: int, error: str | None = None) -> DataFrame:
    """One row about a run: status, times, real counts, cursor, JSON summary and error."""
    start = F.lit(started)
    return spark.range(0, 1, 1, 1).select(
        F.lit(execution).alias("execution_id"), F.lit(job).alias("job_name"), F.lit("FAILED" if error else "SUCCESS").alias("status"), start.alias("start_time"),
        F.current_timestamp().alias("end_time"), (F.unix_millis(F.current_timestamp()) - F.unix_millis(start)).alias("net_runtime_ms"),
        F.lit(records_in).cast("long").alias("records_in"), F.lit(records_out).cast("long").alias("records_out"), F.lit(last).cast("long").alias("last_offset"),
        F.to_json(F.struct(F.lit(records_in).alias("in"), F.lit(records_out).alias("out"))).alias("workers_summary"), F.lit(error).cast("string").alias("error_message"),
        F.current_timestamp().alias("created_at"),
    )
