"""Changes between states of a versioned table, its list of commits, and bases: compacted months that later commits are laid over.

A state is a set of commits, so a commit that comes late, under a number that others have
passed, is a change like any other. Keys contain the row's time, so a key's versions lie in
one month.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from copperleaf.sources.changelog import APPEND, DELETE, newest_first

COMMIT = ["_writer", "_commit_seq"]
SYSTEM = [*COMMIT, "_commit_ts", "_op"]


def commits(log: DataFrame) -> DataFrame:
    """A row for each commit: writer, number, time, operation, rows."""
    return log.groupBy(*COMMIT).agg(F.max("_commit_ts").alias("_commit_ts"), F.max("_op").alias("_op"), F.count("*").alias("n_rows"))


def net_changes(log: DataFrame, keys: list[str], seen: Column, tie: Column, only: Column | None = None) -> DataFrame:
    """What changed from the state of the commits that ``seen`` holds for to the state of all: keys, change (insert, update, delete) and both images as structs old and new.

    A key that ends as it began has no row, whatever happened between. Only keys with a
    version that is not seen are looked at (and, with ``only``, versions for which it holds);
    of each at most two versions are shuffled by a task.
    """
    values = [c for c in log.columns if c not in (*keys, *SYSTEM)]
    fresh = log.filter(~seen).select(*keys).distinct()
    rows = log if only is None else log.filter(only)
    rows = rows.withColumn("_seen", seen).join(fresh, keys, "left_semi")
    rank = F.row_number().over(Window.partitionBy(*keys, "_seen").orderBy(*newest_first(log, tie)))
    best = rows.withColumn("_rank", rank).filter("_rank = 1")
    # of the newest seen and the newest unseen version, the newer one is the state at the end
    order = F.struct("_commit_seq", "_writer", tie.alias("tie"))
    image = F.when(F.col("_op") != DELETE, F.struct(*values))
    sides = best.groupBy(*keys).agg(F.max_by(image, F.when(F.col("_seen"), order)).alias("old"), F.max_by(image, order).alias("new"))
    kind = F.when(F.col("old").isNull() & F.col("new").isNotNull(), "insert").when(F.col("old").isNotNull() & F.col("new").isNull(), "delete").when(~F.col("old").eqNullSafe(F.col("new")), "update")
    return sides.withColumn("change", kind).filter("change is not null").select(*keys, "change", "old", "new")


def between(low: int, high: int) -> tuple[Column, Column]:
    """For ``net_changes``: the seen and the looked-at versions of the changes in (low, high] by commit number."""
    return F.col("_commit_seq") <= low, F.col("_commit_seq") <= high


def commit_list(log: DataFrame, keys: list[str], tie: Column) -> DataFrame:
    """The table's commits in their order: operation, time, rows written, and how many rows the table has after it (total_records).

    A row counts from its commit until the next upsert or delete of its key.
    """
    place = F.struct("_commit_seq", "_writer")
    ranked = log.select(*keys, *COMMIT, "_op", place.alias("place"), tie.alias("tie"))
    later = Window.partitionBy(*keys).orderBy("place", "tie")
    # within a commit only the last version of a key counts, but for appended rows, which all do
    last = F.coalesce(F.lead("place").over(later) != F.col("place"), F.lit(True)) | (F.col("_op") == APPEND)
    kept = ranked.withColumn("_last", last).filter("_last")
    begun = F.sum((F.col("_op") != APPEND).cast("int")).over(Window.partitionBy(*keys).orderBy("place", "tie").rowsBetween(Window.unboundedPreceding, 0))
    # rows of the key that an upsert or delete takes away: what the run before it had left
    runs = kept.withColumn("_run", begun).withColumn("_add", F.when(F.col("_op") == DELETE, 0).otherwise(1))
    ends = runs.groupBy(*keys, "_run").agg(F.sum("_add").alias("_held"))
    taken = runs.filter(F.col("_op") != APPEND).join(ends.select(*keys, (F.col("_run") + 1).alias("_run"), "_held"), [*keys, "_run"], "left")
    delta = runs.select(*COMMIT, F.col("_add").alias("d")).unionByName(taken.select(*COMMIT, (-F.coalesce("_held", F.lit(0))).alias("d")))
    per = delta.groupBy(*COMMIT).agg(F.sum("d").alias("delta"))
    listed = commits(log).join(per, COMMIT, "left")
    order = Window.orderBy("_commit_seq", "_writer").rowsBetween(Window.unboundedPreceding, 0)  # a row a commit
    return listed.select(*COMMIT, F.col("_op").alias("operation"), F.col("_commit_ts").alias("committed_at"), "n_rows", F.sum(F.coalesce("delta", F.lit(0))).over(order).alias("total_records"))


def month_of(time: str) -> Column:
    return F.date_format(time, "yyyy-MM")


def make_base(log: DataFrame, bases: str, number: int, keys: list[str], tie: Column, time: str) -> None:
    """Write the newest version of each key by month, with the commits that it holds; what was taken away stays as a mark, for commits that come late."""
    # dealt by time, which is in the keys and orders months: versions of a key meet by the same shuffle and sort that lay out the files
    rows = log.repartitionByRange(time).withColumn("month", month_of(time))
    rank = F.row_number().over(Window.partitionBy("month", time, *[k for k in keys if k != time]).orderBy(*newest_first(log, tie)))
    newest = rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
    newest.sortWithinPartitions("month", time).write.mode("overwrite").partitionBy("month").parquet(f"{bases}/rows/base={number}")
    # written last: a base without its commits is not there
    commits(log).withColumn("base", F.lit(number)).write.mode("overwrite").parquet(f"{bases}/commits/number={number}")


def newest_base(spark: SparkSession, bases: str, at: Column | None = None) -> int | None:
    """The number of the last base all of whose commits were there at a time; None where there is none."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{bases}/commits")
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return None
    each = spark.read.parquet(f"{bases}/commits").groupBy("base").agg(F.max("_commit_ts").alias("last"))
    return (each if at is None else each.filter(F.col("last") <= at)).agg(F.max("base").alias("b")).first().b


def current(log: DataFrame, bases: str, keys: list[str], tie: Column, time: str, at: Column | None = None) -> DataFrame:
    """The table's rows (with ``SYSTEM``), now or at a time: the newest base that fits and the commits that it lacks.

    Only folders of commits that the base lacks are read; months of the base in which they
    have no row pass through without a shuffle, and the others meet them in one.
    """
    spark = log.sparkSession
    log = log if at is None else log.filter(F.col("_commit_ts") <= at)
    number = newest_base(spark, bases, at)
    if number is None:
        tail, base = log, None
    else:
        held = spark.read.parquet(f"{bases}/commits/number={number}").select(*COMMIT)
        lacking: dict[str, list[int]] = {}
        for r in log.select(*COMMIT).distinct().join(held, COMMIT, "left_anti").collect():  # a row a commit since the base
            lacking.setdefault(r._writer, []).append(r._commit_seq)
        base = spark.read.parquet(f"{bases}/rows/base={number}").withColumn("month", F.col("month").cast("string"))
        if not lacking:
            return base.filter(F.col("_op") != DELETE).select(*log.columns)
        tail = log.filter(reduce(or_, [(F.col("_writer") == w) & F.col("_commit_seq").isin(s) for w, s in lacking.items()]))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first(log, tie)))
    newest = lambda rows: rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
    if base is None:
        return newest(tail).filter(F.col("_op") != DELETE)
    months = [r.m for r in tail.select(month_of(time).alias("m")).distinct().collect()]  # months, however many rows
    touched, rest = base.filter(F.col("month").isin(months)), base.filter(~F.col("month").isin(months))
    meeting = newest(touched.select(*log.columns).unionByName(tail))
    return rest.select(*log.columns).unionByName(meeting).filter(F.col("_op") != DELETE)
