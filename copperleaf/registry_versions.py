"""Queries over a log that writers have committed: two writers, an appending and a deleting commit, one that comes late and one written twice."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copperleaf import registry as R
from copperleaf.plans import maintained as M
from copperleaf.plans import rollup as U
from copperleaf.sources import changelog as C
from copperleaf.sources import versions as V
from copperleaf.sources.shared import new_folder

QUERIES, SQL = R.QUERIES, R.SQL
KEYS = ["l_orderkey", "l_linenumber", "t"]
TIE = lambda: F.struct("part", "qty")
#: Versions with their commits; one text for both engines. Lines repeat their key.
VERSIONS = """SELECT l_orderkey, l_linenumber, cast(o_orderdate AS timestamp) AS t, l_partkey AS part, cast(l_quantity AS int) AS qty, cast(l_suppkey % 5 AS int) AS seq, CASE WHEN l_partkey % 3 = 0 THEN 'b' ELSE 'a' END AS writer
  FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""
WRITERS, NUMBERS = ("a", "b"), range(5)
OPERATIONS = {("a", 3): C.DELETE, ("b", 2): C.APPEND}
LATE = ("b", 1)


def committed_at(writer: str, seq: int) -> datetime.datetime:
    return datetime.datetime(2024, 1, 20 if (writer, seq) == LATE else 1 + seq, 1 if writer == "b" else 0)


def operation(writer: str, seq: int) -> str:
    return OPERATIONS.get((writer, seq), C.UPSERT)


def written_log(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a log of ten commits; the last of them is written twice."""
    versions = spark.sql(VERSIONS, lineitem=R.table(spark, sf_dir, "lineitem"), orders=R.table(spark, sf_dir, "orders"))
    path = f"{new_folder(spark)}/log"
    of = lambda value: F.expr("CASE " + " ".join(f"WHEN writer = '{w}' AND seq = {s} THEN '{value(w, s)}'" for w in WRITERS for s in NUMBERS) + " END")
    # one pass over the tables, however many commits
    C.append_commits(versions.select("*", of(committed_at).alias("_commit_ts"), of(operation).alias("_op")).withColumnsRenamed({"writer": "_writer", "seq": "_commit_seq"}), path)
    last = versions.filter("writer = 'b' AND seq = 4").drop("writer", "seq")
    C.append(last, path, 4, "b", F.lit(str(committed_at("b", 4))).cast("timestamp"), operation("b", 4))
    return path


def over_log(name: str, run, sql: str) -> None:
    """Register run(log, path); ``sql`` may use v: the versions with seq, writer, op and done (the commit's time)."""
    QUERIES[name] = lambda spark, d: (lambda path: run(C.read(spark, path), path))(written_log(spark, d))
    cases = lambda of, other: "CASE " + " ".join(f"WHEN writer = '{w}' AND seq = {s} THEN {of(w, s)}" for w in WRITERS for s in NUMBERS) + f" ELSE {other} END"
    op, at = cases(lambda w, s: f"'{operation(w, s)}'", "NULL"), cases(lambda w, s: f"timestamp '{committed_at(w, s)}'", "NULL")
    SQL[name] = f"WITH v AS (SELECT *, {op} AS op, {at} AS done FROM ({VERSIONS.format(lineitem='lineitem', orders='orders')})) {sql}"


KEY = ", ".join(KEYS)
ORDER = "seq DESC, writer DESC, part DESC, qty DESC"
moment = lambda text: F.lit(text).cast("timestamp")


def newest_sql(where: str = "true") -> str:
    return f"SELECT {KEY}, part, qty FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY {ORDER}) AS r FROM v WHERE {where}) WHERE r = 1 AND op <> 'DELETE'"


pick = lambda df: df.select(*KEYS, "part", "qty")
NOON = "2024-01-03 12:00:00"
over_log("as_of", lambda log, _: pick(C.as_of(log, KEYS, moment(NOON), TIE())), newest_sql(f"done <= timestamp '{NOON}'"))
over_log(
    "scan_incremental_commit", lambda log, _: C.between_commits(log, 1, 3).select(*KEYS, "part", "qty", F.col("_writer").alias("writer"), F.col("_commit_seq").alias("seq"), F.col("_op").alias("operation")),
    f"SELECT {KEY}, part, qty, writer, cast(seq AS bigint) AS seq, op AS operation FROM v WHERE seq > 1 AND seq <= 3",
)
over_log("live_rows", lambda log, _: pick(C.live_rows(log, KEYS, TIE())), f"SELECT {KEY}, part, qty FROM (SELECT *, coalesce(sum(CASE WHEN op <> 'APPEND' THEN 1 ELSE 0 END) OVER (PARTITION BY {KEY} ORDER BY {ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS later FROM v) WHERE later = 0 AND op <> 'DELETE'")
over_log(
    "commit_history",
    lambda log, _: V.commit_list(log, KEYS, TIE()).select(F.col("_writer").alias("writer"), F.col("_commit_seq").alias("seq"), "operation", F.col("committed_at").cast("timestamp_ntz").alias("committed_at"), "n_rows", "total_records"),
    f"""SELECT c.writer, cast(c.seq AS bigint) AS seq, c.op AS operation, c.done AS committed_at, c.n_rows, cast(count(*) FILTER (later = 0 AND s.op <> 'DELETE') AS bigint) AS total_records
      FROM (SELECT writer, seq, op, done, count(*) AS n_rows FROM v GROUP BY ALL) AS c JOIN
        (SELECT c.writer AS cw, c.seq AS cs, v.op, coalesce(sum(CASE WHEN v.op <> 'APPEND' THEN 1 ELSE 0 END) OVER (PARTITION BY c.writer, c.seq, {KEY} ORDER BY {", ".join("v." + x for x in ORDER.split(", "))} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS later
          FROM v JOIN (SELECT DISTINCT writer, seq FROM v) AS c ON (v.seq, v.writer) <= (c.seq, c.writer)) AS s ON s.cw = c.writer AND s.cs = c.seq GROUP BY ALL""",
)


def changes_sql(seen: str, until: str, name: str) -> str:
    side = lambda where: f"SELECT {KEY}, part, qty, op FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY {ORDER}) AS r FROM v WHERE {where}) WHERE r = 1"
    kept = lambda where: f"(SELECT {KEY}, part, qty FROM ({side(where)}) WHERE op <> 'DELETE')"
    return f"""SELECT '{name}' AS from_state, {KEY}, CASE WHEN o.part IS NULL THEN 'insert' WHEN n.part IS NULL THEN 'delete' ELSE 'update' END AS change, o.part AS old_part, o.qty AS old_qty, n.part AS new_part, n.qty AS new_qty
      FROM {kept(seen)} AS o FULL JOIN {kept(until)} AS n USING ({KEY}) WHERE o.part IS DISTINCT FROM n.part OR o.qty IS DISTINCT FROM n.qty"""


def net_changes(log: DataFrame, _: str) -> DataFrame:
    """Between two numbers, and from what was there before the late commit."""
    seen, only = V.between(1, 3)
    each = {"numbers": V.net_changes(log, KEYS, seen, TIE(), only), "late": V.net_changes(log, KEYS, F.col("_commit_ts") < moment("2024-01-10"), TIE())}
    images = lambda df: df.select(*KEYS, "change", *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("old", "new") for c in ("part", "qty")])
    first, second = [images(df).withColumn("from_state", F.lit(name)) for name, df in each.items()]
    return first.unionByName(second)


over_log("net_changes", net_changes, changes_sql("seq <= 1", "seq <= 3", "numbers") + " UNION ALL " + changes_sql("done < timestamp '2024-01-10'", "true", "late"))


def over_base(log: DataFrame, path: str) -> DataFrame:
    """The newest rows, from a base of the first commits and the ones that came after it, late or not; and those at a time between two bases."""
    bases = f"{path}-bases"
    V.make_base(log.filter(F.col("_commit_ts") < moment("2024-01-03")), bases, 1, KEYS, TIE(), "t")
    V.make_base(log.filter(F.col("_commit_ts") < moment("2024-01-10")), bases, 2, KEYS, TIE(), "t")
    now = pick(V.current(log, bases, KEYS, TIE(), "t")).withColumn("state", F.lit("now"))
    return now.unionByName(pick(V.current(log, bases, KEYS, TIE(), "t", moment(NOON))).withColumn("state", F.lit("noon")))


over_log("current_rows", over_base, f"SELECT *, 'now' AS state FROM ({newest_sql()}) UNION ALL SELECT *, 'noon' FROM ({newest_sql(f"done <= timestamp '{NOON}'")})")


# summaries over a log of transactions with corrections, brought up to date after each of its commits
TX_KEYS = ["id", "tx_time"]
#: Commits: (rows, columns that they change, operation). The last rows that hold are those of ``FINAL``.
CORRECTIONS = [
    ("true", {}, C.UPSERT), ("id % 10 = 1", {"amount": "amount * 2"}, C.UPSERT), ("id % 10 = 2", {}, C.DELETE), ("id % 20 = 3", {"category": "'TRAVEL'", "is_valid_tx": "true"}, C.UPSERT),
    ("id % 10 = 2 AND id % 3 = 0", {"amount": "1"}, C.UPSERT), ("id % 10 = 1", {"amount": "NULL"}, C.UPSERT),
]
FINAL = """SELECT id, tx_time, CASE WHEN id % 10 = 1 THEN NULL WHEN id % 10 = 2 THEN cast(1 AS decimal(12,2)) ELSE amount END AS amount, currency, direction, tx_type, card_tail,
  CASE WHEN id % 20 = 3 THEN 'TRAVEL' ELSE category END AS category, CASE WHEN id % 20 = 3 THEN true ELSE is_valid_tx END AS is_valid_tx FROM {tx} WHERE NOT (id % 10 = 2 AND id % 3 <> 0)"""


def corrected(tx: DataFrame) -> DataFrame:
    """The daily summary from states that were refreshed after each commit, and twice after the last."""
    spark, folder = tx.sparkSession, new_folder(tx.sparkSession)
    # written once, as each commit takes some of them
    tx.select("id", "tx_time", "amount", "currency", "direction", "tx_type", "card_tail", "category", "is_valid_tx").write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    for seq, (where, changed, op) in enumerate([*CORRECTIONS, (None, {}, "")]):
        if where:
            values = {c: F.expr(x).cast("decimal(12,2)") if c == "amount" else F.expr(x) for c, x in changed.items()}
            C.append(rows.filter(where).withColumns(values) if values else rows.filter(where), f"{folder}/log", seq, op=op)
        M.refresh(C.read(spark, f"{folder}/log"), f"{folder}/summary", TX_KEYS, F.col("amount"))
    return U.daily(M.states(spark, f"{folder}/summary"))


QUERIES["maintained_summary"] = lambda spark, d: corrected(R.transactions(spark, d))
SQL["maintained_summary"] = f"WITH base AS ({R.DUCK_TX}), tx AS ({FINAL.format(tx='base')}) {R.DAILY}"
