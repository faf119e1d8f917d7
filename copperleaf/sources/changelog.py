"""Append-only tables with keyed upserts: rows carry ``_commit_seq``, ``_commit_ts`` and ``_writer``; readers take the latest of each key.

Each writer has folders of its own, so no writer replaces another's commits. A writer's first
commit comes after all that the table holds then; writers at work at once share numbers, and
their commits of one number are ordered by the writers' names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: What a commit may do: add rows beside all others, put rows in the place of those with equal keys, take rows away.
APPEND, UPSERT, DELETE = "APPEND", "UPSERT", "DELETE"


def newest_first(log: DataFrame, tie: Column) -> list[Column]:
    """The order of versions: by commit, then writer, then ``tie``, the newest first."""
    return [F.desc("_commit_seq"), *([F.desc("_writer")] if "_writer" in log.columns else []), tie.desc()]


def latest_by_key(log: DataFrame, keys: list[str], tie: Column) -> DataFrame:
    """The newest version of each key; within a commit the largest ``tie`` wins (two versions with equal ties must be equal). Keys whose newest version takes them away are left out."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first(log, tie)))
    newest = log.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")  # each task hands on one version of a key
    return newest.filter(F.col("_op") != DELETE) if "_op" in log.columns else newest


def live_rows(log: DataFrame, keys: list[str], tie: Column) -> DataFrame:
    """All rows that hold in a log of mixed commits: appended rows stay beside each other until a later upsert or delete of their key."""
    order = Window.partitionBy(*keys).orderBy(*newest_first(log, tie)).rowsBetween(Window.unboundedPreceding, -1)
    later = F.coalesce(F.sum((F.col("_op") != APPEND).cast("int")).over(order), F.lit(0))
    return log.withColumn("_later", later).filter((F.col("_later") == 0) & (F.col("_op") != DELETE)).drop("_later")


def append(df: DataFrame, path: str, seq: int, writer: str = "main", at: Column | None = None, op: str = UPSERT) -> None:
    """Write one commit of a writer; writing the same commit again replaces it, so a replay changes nothing.

    The rows of a DELETE carry the keys; their other columns are not looked at but must be there.
    """
    if op not in (APPEND, UPSERT, DELETE):
        raise ValueError(f"no such operation: {op}")
    rows = df.withColumn("_commit_ts", at if at is not None else F.current_timestamp()).withColumn("_op", F.lit(op))
    rows.write.mode("overwrite").parquet(f"{path}/_writer={writer}/_commit_seq={seq}")


def append_commits(df: DataFrame, path: str) -> None:
    """Write many commits in one pass: rows carry ``_writer``, ``_commit_seq``, ``_commit_ts`` and ``_op``. Commits of which there are rows are replaced, others stay."""
    rows = df.withColumn("_commit_ts", F.col("_commit_ts").cast("timestamp"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_writer", "_commit_seq").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("_commit_seq", F.col("_commit_seq").cast("long")).withColumn("_writer", F.col("_writer").cast("string"))


def first_seq(spark: SparkSession, path: str, writer: str) -> int:
    """The number of a writer's first commit: the one it has, else the next after all others."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return 0
    own = F.col("_writer") == writer
    row = read(spark, path).agg(F.min(F.when(own, F.col("_commit_seq"))).alias("own"), F.max("_commit_seq").alias("last")).first()  # reads no data column
    return row.own if row.own is not None else (row.last if row.last is not None else -1) + 1


def as_of(log: DataFrame, keys: list[str], at: Column, tie: Column) -> DataFrame:
    return latest_by_key(log.filter(F.col("_commit_ts") <= at), keys, tie)


def compact(log: DataFrame, out: str, keys: list[str], tie: Column, time: str, months: list[str] | None = None) -> None:
    """Write the latest versions of a log by month; with ``months``, only those are rewritten and the others of ``out`` stay."""
    rows = latest_by_key(log, keys, tie).withColumn("month", F.date_format(time, "yyyy-MM"))
    rows = rows.filter(F.col("month").isin(months)) if months is not None else rows
    _by_month(rows, time).option("partitionOverwriteMode", "static" if months is None else "dynamic").parquet(out)


def between_commits(log: DataFrame, after: int, until: int) -> DataFrame:
    return log.filter((F.col("_commit_seq") > after) & (F.col("_commit_seq") <= until))


def history(log: DataFrame) -> DataFrame:
    """Rows of each commit, and the running total."""
    each = log.groupBy("_commit_seq").agg(F.count("*").alias("n_rows"))  # a row a commit
    return each.withColumn("total_rows", F.sum("n_rows").over(Window.orderBy("_commit_seq").rowsBetween(Window.unboundedPreceding, 0)))


def _by_month(rows: DataFrame, time: str):
    # ranges of time, so that a large month is dealt to several tasks
    return rows.repartitionByRange("month", time).sortWithinPartitions("month", time).write.mode("overwrite").partitionBy("month")


def write_by_month(df: DataFrame, path: str, time: str) -> None:
    """Month partitions of files that are each sorted and don't overlap in time."""
    _by_month(df.withColumn("month", F.date_format(time, "yyyy-MM")), time).parquet(path)


def batch_mode(text: str | None) -> str:
    """LATEST_FIRST for one of its names, whatever the case and space around; EARLIEST_FIRST for anything else."""
    return "LATEST_FIRST" if (text or "").strip().upper() in ("LATEST", "LATEST_FIRST", "LATEST_WINDOW") else "EARLIEST_FIRST"


def next_batch(df: DataFrame, after: int | None, size: int, mode: str | None = None) -> DataFrame:
    """Up to ``size`` rows above a cursor, the oldest or the newest ones by mode; without cursor, of all rows."""
    rows = df if after is None else df.filter(F.col("id") > after)
    return rows.orderBy(F.desc("id") if batch_mode(mode) == "LATEST_FIRST" else F.asc("id")).limit(size)


def advanced(df: DataFrame, after: int | None, batch: DataFrame) -> int | None:
    """The cursor after a batch: its largest id. Raises where rows above the old cursor and below the batch would be passed over unread."""
    low, high = batch.agg(F.min("id"), F.max("id")).first()
    if high is None:
        return after
    unread = df.filter(F.col("id") < low) if after is None else df.filter((F.col("id") > after) & (F.col("id") < low))
    if unread.take(1):
        raise ValueError(f"rows below {low} are unread; take them first")
    return high


def id_range(df: DataFrame, low: int, size: int) -> DataFrame:
    """low < id <= low + size; only the lower bound when size is 0 or less. Both reach the Parquet scan."""
    rows = df.filter(F.col("id") > low)
    return rows.filter(F.col("id") <= low + size) if size > 0 else rows


def latest_offset(offsets: DataFrame, job: str, channel: str, target: str | None = None) -> DataFrame:
    rows = offsets.filter((F.col("job_name") == job) & (F.col("channel") == channel))
    if target is not None:
        rows = rows.filter(F.col("source_target") == target)
    return rows.agg(F.coalesce(F.max("last_offset"), F.lit(0)).alias("last_offset"))
