"""A cursor as a set of ranges: rows may be taken newest first, and what lies between is taken later instead of being passed over.

A range (low, high] says that all rows with low < id <= high have been taken. Ranges are rows
of an append-only table, a row a batch; those that touch are merged when they are read.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from copperleaf.sources.changelog import batch_mode

RANGES = "reader string, low long, high long"
LOWEST = -(2**63)


def merged(ranges: DataFrame) -> DataFrame:
    """reader, low, high: ranges that touch or overlap as one."""
    order = Window.partitionBy("reader").orderBy("low", "high")  # a row a batch
    before = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum((F.coalesce(F.col("low") > F.col("before"), F.lit(True))).cast("int")).over(order)
    rows = ranges.filter("low < high").withColumn("before", before).withColumn("island", island)
    return rows.groupBy("reader", "island").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("island")


def gaps(ranges: DataFrame, top: int, bottom: int = LOWEST) -> DataFrame:
    """reader, low, high: what no range holds between ``bottom`` and ``top``, for each reader that has a range."""
    ends = ranges.select("reader").distinct().select("reader", F.lit(top).alias("low"), F.lit(top + 1).alias("high"))
    rows = merged(ranges.unionByName(ends))
    before = F.coalesce(F.lag("high").over(Window.partitionBy("reader").orderBy("low")), F.lit(bottom))
    return rows.select("reader", before.alias("low"), F.least("low", F.lit(top)).alias("high")).filter("low < high")


def read(spark: SparkSession, path: str) -> DataFrame:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(RANGES).parquet(path) if there else spark.createDataFrame([], RANGES)


def take(df: DataFrame, path: str, reader: str, size: int, mode: str | None = None) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Up to ``size`` rows that the reader has not taken, the oldest or the newest of them by mode, and the ranges that are done once they are written.

    Only ranges that are not done are read; ``finish`` records them.
    """
    spark = df.sparkSession
    top = df.agg(F.max("id").alias("t")).first().t
    if top is None:
        return df.limit(0), []
    own = read(spark, path).filter(F.col("reader") == reader)
    open_ = [(r.low, r.high) for r in gaps(own, top).collect()] if own.take(1) else [(LOWEST, top)]  # a row a gap
    if not open_:
        return df.limit(0), []
    rows = df.filter(reduce(or_, [(F.col("id") > low) & (F.col("id") <= high) for low, high in open_]))
    newest = batch_mode(mode) == "LATEST_FIRST"
    batch = rows.orderBy(F.desc("id") if newest else F.asc("id")).limit(size)
    edge = batch.agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n")).first()
    if edge.n < size:
        return batch, open_  # nothing is left
    if newest:
        return batch, [(max(low, edge.low - 1), high) for low, high in open_ if high >= edge.low]
    return batch, [(low, min(high, edge.high)) for low, high in open_ if low < edge.high]


def finish(spark: SparkSession, path: str, reader: str, done: list[tuple[int, int]]) -> None:
    """Record ranges whose rows have been written. Recording them twice changes nothing."""
    if done:
        spark.createDataFrame([(reader, low, high) for low, high in done], RANGES).coalesce(1).write.mode("append").parquet(path)
