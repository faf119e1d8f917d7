"""Summaries kept up to date: stored states of days, to which each refresh adds what commits have changed since.

A refresh takes the net changes of the commits that the cursor lacks, takes old images away
from their days' states and adds new ones. Sums and counts follow; a smallest or largest
value is looked for anew only in days from which it was taken away (and nulls in days that
are left without an amount). Details are read only
for days that a new commit touches, and nothing is done while the cursor stands still. A
commit that comes late is like any other.
"""

from __future__ import annotations

import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from copperleaf.plans import rollup as U
from copperleaf.plans import summaries as S
from copperleaf.sources import changelog as C
from copperleaf.sources import versions as V


def version(spark: SparkSession, folder: str) -> int | None:
    """The last finished version of the states; None before the first."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/cursor")
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return None
    return spark.read.parquet(f"{folder}/cursor").agg(F.max("version").alias("v")).first().v


def states(spark: SparkSession, folder: str, number: int | None = None) -> DataFrame:
    return spark.read.parquet(f"{folder}/states/version={version(spark, folder) if number is None else number}")


def among(day: Column, days: list[datetime.date | None]) -> Column:
    """Whether a day is one of some, null being one like the others."""
    return F.coalesce(day.isin([d for d in days if d is not None]), F.lit(None in days))


#: Ranges of days by which a scan is filtered; those that lie closest are joined beyond it.
RANGES = 64


def within(days: list[datetime.date | None], time: str = S.T) -> Column:
    """Rows of these days, and of some between them, by their time: as a few ranges, which reach the scan."""
    spans: list[list[datetime.date]] = []
    for d in sorted(d for d in days if d is not None):
        if spans and d - spans[-1][1] <= datetime.timedelta(1):
            spans[-1][1] = d
        else:
            spans.append([d, d])
    if len(spans) > RANGES:
        gaps = sorted(range(1, len(spans)), key=lambda i: spans[i][0] - spans[i - 1][1], reverse=True)
        edges = [0, *sorted(gaps[: RANGES - 1]), len(spans)]
        spans = [[spans[a][0], spans[b - 1][1]] for a, b in zip(edges, edges[1:])]  # noqa: B905
    moment = lambda d: F.lit(d.isoformat()).cast("date").cast("timestamp_ntz")
    parts = [(F.col(time) >= moment(a)) & (F.col(time) < moment(b + datetime.timedelta(1))) for a, b in spans]
    return reduce(or_, parts + [F.col(time).isNull()] * (None in days))


def _days(rows: DataFrame) -> list[datetime.date | None]:
    return [r.d for r in rows.select(S.day().alias("d")).distinct().collect()]  # days, however many rows


def refresh(log: DataFrame, folder: str, keys: list[str], tie: Column, foreign: str = "USD", tail: str | None = None) -> int | None:
    """Bring the states in ``folder`` up to the log's commits; the new version's number, or None where there is nothing new.

    Keys have one row (upserts and deletes) and hold the row's time.

    A run that was stopped leaves the version before it in place; the next one does its work again.
    """
    spark, done = log.sparkSession, version(log.sparkSession, folder)
    commits = V.commits(log).select(*V.COMMIT)
    held = spark.read.parquet(f"{folder}/cursor").filter(F.col("version") == done).select(*V.COMMIT) if done is not None else commits.limit(0)
    new = commits.join(held, V.COMMIT, "left_anti").collect()  # a row a commit
    if not new:
        return None
    number = 0 if done is None else done + 1
    make = lambda rows, **of: U.day_states(rows, foreign, tail, **of)
    if done is None:
        result = make(C.latest_by_key(log, keys, tie))
    else:
        by_writer: dict[str, list[int]] = {}
        for r in new:
            by_writer.setdefault(r._writer, []).append(r._commit_seq)
        fresh = reduce(or_, [(F.col("_writer") == w) & F.col("_commit_seq").isin(s) for w, s in by_writer.items()])
        days = _days(log.filter(fresh))
        old_states = states(spark, folder, done)
        # stored, as three sums come from it; whoever follows the table can read it too
        V.net_changes(log, keys, ~fresh, tie, within(days)).write.mode("overwrite").parquet(path := f"{folder}/changes/version={number}")
        changes = spark.read.parquet(path)
        image = lambda side: changes.filter(F.col(side).isNotNull()).select(*keys, f"{side}.*")
        added, gone = image("new"), image("old")
        delta = make(added.withColumn("_sign", F.lit(1)).unionByName(gone.withColumn("_sign", F.lit(-1))), sign="_sign")
        ends = lambda rows: U.ends(rows, foreign, tail)
        parts = old_states.filter(among(F.col(U.DAY), days)).unionByName(delta, True).unionByName(ends(added), True)
        after = U.merged(parts, U.DAY).filter("n_details > 0")
        # where no amount is left, which sums are null is only known from the rows
        bare = [r.d for r in after.filter("n_amounts <= 0").select(F.col(U.DAY).alias("d")).collect()]
        lost = [*{*_lost(old_states, ends(gone), ends(added)), *bare}]
        result = old_states.filter(~among(F.col(U.DAY), days)).unionByName(after.filter(~among(F.col(U.DAY), lost)))
        if lost:
            result = result.unionByName(make(C.latest_by_key(log.filter(within(lost)), keys, tie).filter(among(S.day(), lost))))
    result.write.mode("overwrite").parquet(f"{folder}/states/version={number}")
    commits.withColumn("version", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/cursor/number={number}")  # last, so that what is there is whole
    return number


def _lost(before: DataFrame, gone: DataFrame, added: DataFrame) -> list[datetime.date | None]:
    """Days whose smallest or largest value was taken away and not put back."""
    side = lambda rows, mark: rows.select(F.col(U.DAY).alias(f"day{mark}"), *[F.col(n).alias(n + mark) for n in U.EXTREMES])
    rows = side(gone, "_g").join(side(before, "_b"), F.col("day_g").eqNullSafe(F.col("day_b"))).join(side(added, "_a"), F.col("day_g").eqNullSafe(F.col("day_a")), "left")

    def left(name: str) -> Column:
        largest = U.EXTREMES[name][0] == "max"
        reach = (lambda x, y: x >= y) if largest else (lambda x, y: x <= y)
        return F.coalesce(reach(F.col(f"{name}_g"), F.col(f"{name}_b")), F.lit(False)) & ~F.coalesce(reach(F.col(f"{name}_a"), F.col(f"{name}_b")), F.lit(False))

    return [r.d for r in rows.filter(reduce(or_, [left(n) for n in U.EXTREMES])).select(F.col("day_g").alias("d")).collect()]
