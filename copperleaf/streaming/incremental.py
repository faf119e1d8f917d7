"""Take what is new, upsert it, then advance: a file stream whose checkpoint is the cursor, with a log of cursors and of runs beside it."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from copperleaf.sources import changelog, offsets


def run_available(
    spark: SparkSession, source: str, schema: StructType, sink: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], logs: str | None = None, job: str = "stream", id_col: str = "id"
) -> None:
    """Process all files that the checkpoint has not seen.

    The writer is the query's id, which the checkpoint keeps, and each micro-batch is a commit of
    it: a replay of a batch is harmless, and another stream or a new checkpoint adds commits
    after those that the sink has.

    With ``logs``, each batch has one row of cursors (its largest id) and one of runs there,
    kept under the query's id and the batch's number, so a replay replaces them. They are
    written after the batch's data, with counts measured while these were written; a batch
    that fails leaves a row of runs that says so, and no cursor.
    """
    stream = spark.readStream.schema(schema).parquet(source)

    def commit(batch: DataFrame, number: int) -> None:
        writer = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        seq = changelog.first_seq(spark, sink, writer) + number
        if logs is None:
            changelog.append(transform(batch), sink, seq, writer)
            return
        started, taken, made = datetime.datetime.now(datetime.UTC), Observation(), Observation()
        place = lambda kind: f"{logs}/{kind}/query={writer}/batch={number}"
        try:
            rows = transform(batch.observe(taken, F.count(F.lit(1)).alias("n"), F.max(id_col).alias("last")))
            changelog.append(rows.observe(made, F.count(F.lit(1)).alias("n")), sink, seq, writer)
        except Exception as e:
            offsets.run_row(spark, f"{writer}-{number}", job, started, 0, 0, 0, f"{type(e).__name__}: {e}").write.mode("overwrite").parquet(place("runs"))
            raise
        last = taken.get["last"] or 0
        if last > 0:
            offsets.offset_row(spark, job, writer, None, last).write.mode("overwrite").parquet(place("offsets"))
        offsets.run_row(spark, f"{writer}-{number}", job, started, taken.get["n"], made.get["n"], last).write.mode("overwrite").parquet(place("runs"))

    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(commit).start().awaitTermination()
