"""Queries of cursors as ranges, logged streams, time zones, sketches, rule tables and named summaries, with DuckDB SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copperleaf import registry as R
from copperleaf.functions import extract as X
from copperleaf.plans import named, rules, sketches
from copperleaf.plans import summaries as S
from copperleaf.plans import zones as Z
from copperleaf.sources import ranges
from copperleaf.sources.shared import new_folder
from copperleaf.streaming import incremental

QUERIES, SQL = R.QUERIES, R.SQL

# a reader that takes newest and oldest rows in turn, and what it has not taken then
STEPS = [(300, "LATEST"), (200, None), (300, "LATEST"), (200, "EARLIEST_FIRST")]


def taken(messages: DataFrame) -> tuple[DataFrame, str]:
    spark, path, out = messages.sparkSession, f"{new_folder(messages.sparkSession)}/ranges", []
    for number, (size, mode) in enumerate(STEPS):
        batch, done = ranges.take(messages, path, "reports", size, mode)
        out.append(batch.select("id", F.lit(number).alias("batch")))
        ranges.finish(spark, path, "reports", done)
    return reduce(DataFrame.unionByName, out), path


def open_gaps(messages: DataFrame) -> DataFrame:
    _, path = taken(messages)
    top = messages.agg(F.max("id")).first()[0]
    return ranges.gaps(ranges.read(messages.sparkSession, path), top)


R.query("cursor_ranges", lambda m: taken(m)[0], """SELECT id, cast(CASE WHEN d <= 300 THEN 0 WHEN a <= 200 THEN 1 WHEN d <= 600 THEN 2 ELSE 3 END AS int) AS batch
  FROM (SELECT id, row_number() OVER (ORDER BY id) AS a, row_number() OVER (ORDER BY id DESC) AS d FROM msg) WHERE d <= 600 OR a <= 400""", source=R.messages)
R.query("cursor_gaps", open_gaps, """SELECT * FROM (SELECT 'reports' AS reader, max(id) FILTER (a = 400) AS low, max(id) FILTER (d = 600) - 1 AS high
  FROM (SELECT id, row_number() OVER (ORDER BY id) AS a, row_number() OVER (ORDER BY id DESC) AS d FROM msg)) WHERE low < high""", source=R.messages)


def stream_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of a stream over events that drops some rows, run twice: the second run has no batch."""
    folder, source = new_folder(spark), f"{sf_dir}/events.parque[t]"
    schema = spark.read.parquet(source).schema
    for _ in range(2):
        incremental.run_available(spark, source, schema, f"{folder}/log", f"{folder}/cursor", lambda rows: rows.filter("value > 10").select("event_id", "user_id", "value"), f"{folder}/logs", "events", "event_id")
    runs, cursors = spark.read.parquet(f"{folder}/logs/runs"), spark.read.parquet(f"{folder}/logs/offsets")
    written = spark.read.parquet(f"{folder}/log").agg(F.count("*").alias("n_written"))
    return runs.join(cursors.select("query", "batch", F.col("last_offset").alias("cursor")), ["query", "batch"]).join(F.broadcast(written), F.col("records_out") == F.col("n_written")).select("job_name", "status", "records_in", "records_out", "n_written", "last_offset", "cursor", "error_message")


QUERIES["stream_runs"] = stream_runs
SQL["stream_runs"] = """SELECT 'events' AS job_name, 'SUCCESS' AS status, count(*) AS records_in, count(*) FILTER (value > 10) AS records_out, count(*) FILTER (value > 10) AS n_written, max(event_id) AS last_offset, max(event_id) AS cursor,
  cast(NULL AS varchar) AS error_message FROM events"""

# time zones
ZONES = ("Asia/Shanghai", "America/New_York")


def in_zones(rows: DataFrame, run) -> DataFrame:
    return reduce(DataFrame.unionByName, [run(rows, z).withColumn("zone", F.lit(z)) for z in ZONES])


def zoned_sql(time: str, sql: str) -> str:
    return " UNION ALL ".join(f"SELECT *, '{z}' AS zone FROM ({sql.format(local=f"({time} AT TIME ZONE 'UTC' AT TIME ZONE '{z}')")})" for z in ZONES)


QUERIES["zoned_daily"] = lambda spark, d: in_zones(R.transactions(spark, d), lambda tx, z: S.daily_summary(Z.localized(tx, z)))
SQL["zoned_daily"] = " UNION ALL ".join(
    f"SELECT *, '{z}' AS zone FROM (WITH base AS ({R.DUCK_TX}), tx AS (SELECT * REPLACE (tx_time::timestamp AT TIME ZONE 'UTC' AT TIME ZONE '{z}' AS tx_time) FROM base) {R.DAILY})" for z in ZONES
)
PARTS = {"day": S.day, "week": S.week, "month": S.month}
QUERIES["zoned_periods"] = lambda spark, d: in_zones(R.messages(spark, d), lambda m, z: Z.localized(m.select(F.col("received_at").alias(S.T)), z).groupBy(S.day().cast("string").alias("day"), S.week().alias("week"), S.month().alias("month")).agg(F.count("*").alias("n")))
SQL["zoned_periods"] = f"WITH msg AS ({R.DUCK_MSG}) " + zoned_sql("received_at", "SELECT cast(cast({local} AS date) AS varchar) AS day, concat(isoyear({local}), '-W', lpad(cast(week({local}) AS varchar), 2, '0')) AS week, strftime({local}, '%Y-%m') AS month, count(*) AS n FROM msg GROUP BY ALL")
ASKED = {"day": "2024-01-05", "week": "2024-W02", "month": "2024-01"}
LOCAL = {"day": "cast({local} AS date) = date '2024-01-05'", "week": "concat(isoyear({local}), '-W', lpad(cast(week({local}) AS varchar), 2, '0')) = '2024-W02'", "month": "strftime({local}, '%Y-%m') = '2024-01'"}
QUERIES["zoned_details"] = lambda spark, d: reduce(DataFrame.unionByName, [in_zones(R.messages(spark, d), lambda m, z, k=k, v=v: Z.in_local_period(m, k, v, z, "received_at").select("id", F.lit(k).alias("kind"))) for k, v in ASKED.items()])
SQL["zoned_details"] = f"WITH msg AS ({R.DUCK_MSG}) " + " UNION ALL ".join(zoned_sql("received_at", f"SELECT id, '{k}' AS kind FROM msg WHERE {w}") for k, w in LOCAL.items())

# distinct merchants, exactly and from sketches
EXACT = f"SELECT '{{0}}' AS period_type, {{1}} AS period_value, count(*) AS n_rows, count(DISTINCT {R.MERCHANT}) AS n_merchants FROM tx GROUP BY 2"
LABELS = {"DAILY": "cast(cast(tx_time AS date) AS varchar)", "WEEKLY": R.WEEK, "MONTHLY": R.MONTH}
EXACT = " UNION ALL ".join(EXACT.format(k, v) for k, v in LABELS.items())
R.query("distinct_merchants", sketches.exact_merchants, EXACT)


def sketched(tx: DataFrame) -> DataFrame:
    """Estimates from stored sketches of days beside exact numbers: whether each lies within four standard errors (and one)."""
    sketches.day_sketches(tx).write.parquet(path := f"{new_folder(tx.sparkSession)}/sketches")
    near = sketches.distinct_merchants(tx.sparkSession.read.parquet(path)).withColumnRenamed("n_merchants", "estimate").drop("n_rows")
    rows = sketches.exact_merchants(tx).join(near, ["period_type", "period_value"])
    return rows.withColumn("within", F.abs(F.col("estimate") - F.col("n_merchants")) <= 1 + 4 * sketches.ERROR * F.col("n_merchants")).drop("estimate")


R.query("sketched_merchants", sketched, f"SELECT *, true AS within FROM ({EXACT})")

# categories by a table of rule words
RULES = [(w, label, i) for i, (label, words) in enumerate(X.CATEGORIES) for w in words]


def by_rules(messages: DataFrame) -> DataFrame:
    texts = X.assemble_raw(messages).select("id", "raw_body")
    table = messages.sparkSession.createDataFrame(RULES, "word string, label string, priority int")
    found = rules.labelled(texts, table, text_col="raw_body")
    return texts.select("id").hint("merge").join(found, "id", "left").select("id", F.coalesce("label", F.lit("OTHER")).alias("category"))


QUERIES["category_by_rules"] = lambda spark, d: by_rules(R.messages(spark, d))
SQL["category_by_rules"] = SQL["category"]


# summaries by name
def by_name(sql: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        named.register(spark, R.transactions(spark, sf_dir), tail="0025", prefix="copperleaf_")
        return spark.sql(sql)

    return run


for kind, (view, column, _, label) in R.SUMMARIES.items():
    QUERIES[f"named_{kind}s"] = by_name(f"SELECT * FROM copperleaf_{view}_summary")
    QUERIES[f"named_{kind}"] = by_name(f"SELECT * FROM copperleaf_{view}_summary_of({'date ' if kind == 'day' else ''}'{label}')")
    for name, where in ((f"named_{kind}s", "true"), (f"named_{kind}", f"cast({column} AS varchar) = '{label}'")):
        SQL[name] = f"WITH tx AS ({R.DUCK_TX}) {R.WITH} SELECT * FROM {view} WHERE {where}"
