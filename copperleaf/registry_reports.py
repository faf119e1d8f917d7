"""Queries of periods, rankings and reports, and of the cursors and parts of messages, with DuckDB SQL for all their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copperleaf import registry as R
from copperleaf.registry_tables import upserted
from copperleaf.functions import extract as X
from copperleaf.plans import lookups as L
from copperleaf.plans import reports as P
from copperleaf.plans import rollup as U
from copperleaf.plans import summaries as S
from copperleaf.sources import changelog as C
from copperleaf.sources.shared import new_folder

QUERIES, SQL = R.QUERIES, R.SQL

# SQL of a transaction's three periods, and of the figures of each
LABELS = {"DAILY": "cast(cast(tx_time AS date) AS varchar)", "WEEKLY": R.WEEK, "MONTHLY": R.MONTH}
BY_PERIOD = " UNION ALL ".join(f"SELECT '{k}' AS period_type, {v} AS period_value, * FROM tx" for k, v in LABELS.items())
MACRO = f"SELECT period_type, period_value, {R.MEASURES}, {R.money(f"CASE WHEN period_type = 'WEEKLY' THEN 0 ELSE {R.summed(R.kind('OUTFLOW', 'TRANSFER'))} END", 'total_transfer')} FROM by_period GROUP BY 1, 2"
KIND, NAME = "upper(coalesce(tx_type, 'EXPENSE'))", "upper(coalesce(category, 'OTHER'))"
sums = lambda c: f"coalesce(sum(CASE WHEN {c} THEN amount END), 0)"
SPENT, BACK = sums(f"{KIND} NOT IN ('REFUND', 'INCOME', 'TRANSFER')"), sums(f"{KIND} = 'REFUND'")
NAMED = ", ".join(f"'{c}'" for c in P.APART)
FALLBACK = "SELECT period_type, period_value, count(*) AS tx_count, " + ", ".join([
    R.money(SPENT, "total_expense"), R.money(BACK, "total_refund"), R.money(f"{SPENT} - {BACK}", "net_expense"), R.money(sums(f"{KIND} = 'INCOME'"), "total_income"), R.money(sums(f"{KIND} = 'TRANSFER'"), "total_transfer"),
    *[R.money(sums(f"{KIND} = 'EXPENSE' AND {NAME} = '{c}'"), f"{S.CATEGORY_COLUMNS[c]}_expense") for c in P.APART], R.money(sums(f"{KIND} = 'EXPENSE' AND {NAME} NOT IN ({NAMED})"), "other_expense"),
]) + " FROM by_period GROUP BY 1, 2"
VIEWS = f", by_period AS ({BY_PERIOD}), macro AS ({MACRO}), fallback AS ({FALLBACK})"
#: SQL: first and last day and anchor of a labelled period (columns period_type, period_value).
LABEL_YEAR, LABEL_WEEK = "try_cast(regexp_extract(period_value, '^([0-9]{4})-W([0-9]{2})$', 1) AS int)", "try_cast(regexp_extract(period_value, '^([0-9]{4})-W([0-9]{2})$', 2) AS int)"
MONDAY = f"cast(date_trunc('week', make_date({LABEL_YEAR}, 1, 4)) + to_days(7 * ({LABEL_WEEK} - 1)) AS date)"
FIRST = f"""CASE WHEN period_type = 'DAILY' AND regexp_matches(period_value, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN try_cast(period_value AS date)
  WHEN period_type = 'MONTHLY' AND regexp_matches(period_value, '^[0-9]{{4}}-[0-9]{{2}}$') THEN try_cast(concat(period_value, '-01') AS date)
  WHEN period_type = 'WEEKLY' AND concat(isoyear({MONDAY}), '-W', lpad(cast(week({MONDAY}) AS varchar), 2, '0')) = period_value THEN {MONDAY} END"""
LAST = "CASE period_type WHEN 'DAILY' THEN first WHEN 'WEEKLY' THEN cast(first + interval 6 day AS date) WHEN 'MONTHLY' THEN last_day(first) END"
TODAY = "2001-02-03"
#: Periods that are asked for besides those of the transactions: without rows, and labels that are none.
ASKED = """SELECT 'DAILY' AS period_type, '2030-01-05' AS period_value UNION ALL SELECT 'WEEKLY', '2030-W02' UNION ALL SELECT 'MONTHLY', '2030-02' UNION ALL SELECT 'DAILY', '2030-02-30' UNION ALL SELECT 'WEEKLY', '2030-W53'
  UNION ALL SELECT 'WEEKLY', '2026-W53' UNION ALL SELECT 'MONTHLY', 'March' UNION ALL SELECT 'DAILY', '' """
BOUNDS = f"SELECT period_type, period_value, coalesce(first, date '{TODAY}') AS report_date, first, {LAST} AS last FROM (SELECT *, {FIRST} AS first FROM (SELECT DISTINCT period_type, period_value FROM by_period UNION ALL {ASKED}))"
#: Texts of the reports of some periods by their numbers of details, one SQL text for both engines.
TEXTS = "SELECT period_type, period_value, concat('Figures of ', period_value, CASE WHEN n % 3 = 0 THEN concat(' ![a](https://quickchart.io/chart/render/zf-', cast(n AS varchar(20)), ') twice https://quickchart.io/chart/render/zf-', cast(n AS varchar(20))) ELSE '' END) AS summary_text FROM {counts} WHERE n % 5 < 4"

today = lambda: F.lit(TODAY).cast("date")


def rolled(tx: DataFrame) -> DataFrame:
    """The stored states of all periods, rolled up from those of days: a row a period, however often it is read."""
    states = U.roll_up(U.day_states(tx))
    states.write.parquet(path := f"{new_folder(tx.sparkSession)}/periods")
    return tx.sparkSession.read.schema(states.schema).parquet(path)


def with_asked(periods: DataFrame) -> DataFrame:
    return periods.select(*P.KEY).unionByName(periods.sparkSession.sql(ASKED))


def made(tx: DataFrame) -> DataFrame:
    """Reports of all periods: macro figures are there for most, the rest takes its details' figures or zeros."""
    periods = rolled(tx)
    figures = U.macro_figures(periods, P.FIGURES).filter("tx_count % 7 <> 3")
    texts = tx.sparkSession.sql(TEXTS, counts=periods.select(*P.KEY, F.col("n_details").alias("n")))
    return P.reports(U.spare_figures(periods, P.FIGURES), figures, with_asked(periods), texts, today())


def picked(c: str) -> str:
    return f"CASE WHEN m.period_type IS NOT NULL THEN m.{c} ELSE coalesce(f.{c}, 0) END AS {c}"


FIGURES_SQL = ", ".join(f"'\"{k}\":', cast(coalesce({c}, 0) AS varchar), ','" for k, c in P.METRICS.items())[:-5]
JSON = f"""concat('{{"periodType":"', period_type, '","periodValue":"', period_value, '","startDate":"', coalesce(cast(first AS varchar), ''), '","endDate":"', coalesce(cast(last AS varchar), ''), '",', {FIGURES_SQL}, '}}')"""
LINKS = "regexp_extract_all(summary_text, '" + P.RENDER_LINK + "', 1)"
REPORTS = f"""SELECT concat('report_', lower(period_type), '_', period_value) AS report_id, period_type, period_value, report_date, total_expense, total_refund, net_expense, total_income, total_transfer, tx_count,
  {JSON} AS metrics_json, summary_text, CASE WHEN len({LINKS}) > 0 THEN cast(to_json(list_filter({LINKS}, lambda u, i: list_position({LINKS}, u) = i)) AS varchar) END AS chart_url, 'SKIPPED' AS slack_status
  FROM (SELECT b.*, summary_text, {", ".join(map(picked, P.FIGURES))} FROM ({BOUNDS}) AS b LEFT JOIN (SELECT * FROM macro WHERE tx_count % 7 <> 3) AS m ON b.period_type = m.period_type AND b.period_value = m.period_value
    LEFT JOIN fallback AS f ON b.period_type = f.period_type AND b.period_value = f.period_value LEFT JOIN ({TEXTS.format(counts="(SELECT period_type, period_value, count(*) AS n FROM by_period GROUP BY period_type, period_value)")}) AS t ON b.period_type = t.period_type AND b.period_value = t.period_value)"""
VIEWS_AND_REPORTS = f"{VIEWS}, reports AS ({REPORTS})"

R.query("assemble_report", lambda tx: made(tx).drop("created_at"), "SELECT * FROM reports", with_=VIEWS_AND_REPORTS)
R.query("metrics_json", lambda tx: made(tx).select("report_id", "metrics_json"), "SELECT report_id, metrics_json FROM reports", with_=VIEWS_AND_REPORTS)
R.query("report_id", lambda tx: made(tx).select("report_id"), "SELECT report_id FROM reports", with_=VIEWS_AND_REPORTS)
R.query("fallback_summary", P.fallback, "SELECT * FROM fallback", with_=VIEWS)
R.query(
    "report_probe", lambda tx: made(tx).select("report_id", "metrics_json", F.coalesce(F.length("summary_text"), F.lit(0)).alias("n_chars"), F.substring("summary_text", 1, 20).alias("preview")),
    "SELECT report_id, metrics_json, cast(coalesce(length(summary_text), 0) AS int) AS n_chars, substr(summary_text, 1, 20) AS preview FROM reports", with_=VIEWS_AND_REPORTS,
)
R.query(
    "period_bounds", lambda tx: with_asked(rolled(tx)).withColumn("b", P.period_bounds(F.col("period_type"), F.col("period_value"), today())).select(*P.KEY, F.col("b.anchor").alias("report_date"), "b.first", "b.last"),
    BOUNDS, with_=VIEWS,
)


def ads_row_count(tx: DataFrame) -> DataFrame:
    """Rows of a stored table of reports."""
    made(tx).write.parquet(path := f"{new_folder(tx.sparkSession)}/reports")
    return tx.sparkSession.read.parquet(path).agg(F.count("*").alias("n"))


R.query("ads_row_count", ads_row_count, "SELECT count(*) AS n FROM reports", with_=VIEWS_AND_REPORTS)


def upsert_reports(tx: DataFrame) -> DataFrame:
    """Whole report rows, and again those that were delivered meanwhile."""
    rows = made(tx).drop("created_at")
    rows.write.parquet(path := f"{new_folder(tx.sparkSession)}/first")
    rows = tx.sparkSession.read.schema(rows.schema).parquet(path)
    return upserted(rows, rows.filter("total_refund > 0").withColumn("slack_status", F.lit("SENT")), ["report_id", "report_date"], "slack_status")


# labels that are no period share a date, but their ids differ
R.query("upsert_reports", upsert_reports, "SELECT * REPLACE (CASE WHEN total_refund > 0 THEN 'SENT' ELSE slack_status END AS slack_status) FROM reports", with_=VIEWS_AND_REPORTS)
R.query(
    "macro_micro_join", lambda tx: L.with_figures(tx, P.macro(tx)).select("id", *P.KEY, "tx_count", "total_expense", "net_expense"),
    "SELECT id, period_type, period_value, m.tx_count, m.total_expense, m.net_expense FROM by_period AS b JOIN macro AS m USING (period_type, period_value)", with_=VIEWS,
)
#: Requests: a period asked for, none, and none where nothing is active.
REQUESTS = "SELECT * FROM VALUES ('DAILY', '1996-03-05'), ('WEEKLY', '1996-W10'), ('MONTHLY', '1996-03') AS t(period_type, explicit)"


def resolved(tx: DataFrame) -> DataFrame:
    """Each period type: asked for, the latest active one, and the default where nothing is active."""
    requests, figures = tx.sparkSession.sql(REQUESTS).withColumn("default", F.lit("none yet")), P.macro(tx)
    none = requests.withColumn("explicit", F.lit(None).cast("string"))
    cases = requests.withColumn("asked", F.lit("explicit")).unionByName(none.withColumn("asked", F.lit("latest")))
    return P.resolve_periods(figures, cases).unionByName(P.resolve_periods(figures.filter("tx_count < 0"), none.withColumn("asked", F.lit("default"))))


R.query("resolve_period", resolved, "SELECT period_type, 'latest' AS asked, max(period_value) AS period_value FROM macro WHERE tx_count > 0 GROUP BY 1 " + " ".join(
    f"UNION ALL SELECT '{k}', 'explicit', '{v}' UNION ALL SELECT '{k}', 'default', 'none yet'" for k, v in (("DAILY", "1996-03-05"), ("WEEKLY", "1996-W10"), ("MONTHLY", "1996-03"))), with_=VIEWS)
LARGEST = f"SELECT *, row_number() OVER (PARTITION BY period_type, period_value, category ORDER BY amount DESC NULLS LAST, id) AS r FROM by_period WHERE {R.EXPENSE}"
R.query(
    "report_context",
    lambda tx: P.report_context(tx, P.period_figures(tx)).select(*P.KEY, "figures.*", "n_details", F.array_join(F.transform("details", lambda x: F.concat_ws(":", x["id"], x["amount"], x["category"], x["merchant"])), ",").alias("details")),
    f"SELECT m.period_type, m.period_value, {', '.join('m.' + c for c in P.FIGURES)}, n_details, details FROM macro AS m JOIN (SELECT period_type, period_value, count(*) AS n_details FROM by_period GROUP BY 1, 2) AS n USING (period_type, period_value) "
    f"LEFT JOIN (SELECT period_type, period_value, string_agg(concat_ws(':', cast(id AS varchar), cast(amount AS varchar), category, {R.MERCHANT}), ',' ORDER BY amount DESC NULLS FIRST, id) AS details FROM ({LARGEST}) WHERE r <= 5 GROUP BY 1, 2) AS d USING (period_type, period_value)",
    with_=VIEWS,
)

# rankings, shares and changes
TOTALS = f"SELECT period_type, period_value, {R.MERCHANT} AS merchant_name, {R.money('sum(amount)', 'total_amount')}, count(*) AS tx_count, count(amount) AS n FROM by_period WHERE {R.EXPENSE} AND currency = 'CNY' GROUP BY 1, 2, 3"
RANKED = f", totals AS ({TOTALS}), ranked AS (SELECT *, row_number() OVER (PARTITION BY period_type, period_value ORDER BY total_amount DESC NULLS LAST, merchant_name) AS rank FROM totals)"
R.query("top_n_merchants", P.top_merchants, "SELECT period_type, period_value, merchant_name, total_amount, tx_count, rank FROM ranked WHERE rank <= 3", with_=VIEWS + RANKED)
R.query(
    "top_merchants_json",
    L.top_merchants_json,
    "SELECT period_value, concat('[', string_agg(concat('{\"rank\":', rank, ',\"merchant_name\":\"', merchant_name, '\",\"total_amount\":', cast(coalesce(total_amount, 0) AS varchar), '}'), ',' ORDER BY rank), ']') AS top FROM ranked WHERE rank <= 3 AND period_type = 'WEEKLY' GROUP BY 1",
    with_=VIEWS + RANKED,
)
R.query(
    "merchant_penetration", P.merchant_penetration,
    f"SELECT period_type, period_value, merchant_name, tx_count, total_amount, {R.money('(2 * cast(total_amount * 100 AS bigint) + n) // (2 * n) / 100.0', 'avg_amount')}, round(total_amount::double / (sum(total_amount) OVER (PARTITION BY period_type, period_value))::double, 6) AS share FROM totals WHERE period_type <> 'DAILY'",
    with_=VIEWS + RANKED,
)
GROUPED = f"SELECT stat_month, grouped_by, name, {R.money('sum(amount)', 'total')}, count(*) AS n FROM (SELECT {R.MONTH} AS stat_month, 'payment_channel' AS grouped_by, payment_channel AS name, amount FROM tx WHERE {R.EXPENSE} UNION ALL SELECT {R.MONTH}, 'card_tail', card_tail, amount FROM tx WHERE {R.EXPENSE}) GROUP BY 1, 2, 3"
R.query("account_channel_summary", P.account_channel_summary, f"SELECT *, round(total::double / (sum(total) OVER (PARTITION BY stat_month, grouped_by))::double, 6) AS share FROM ({GROUPED})")


def changes(tx: DataFrame) -> DataFrame:
    """Month against month of each category and of each merchant."""
    rows = tx.filter(S.is_expense()).withColumn("stat_month", S.month())
    each = lambda kind, name: rows.filter(name.isNotNull()).groupBy("stat_month", name.alias("name")).agg(F.coalesce(F.sum("amount"), F.lit(0)).cast(S.MONEY).alias("amount")).transform(P.change_by_month, "name").withColumn("compared", F.lit(kind))
    return each("category", F.col("category")).unionByName(each("merchant", S.merchant()))


def change_sql(kind: str, name: str) -> str:
    own = f"SELECT {R.MONTH} AS stat_month, {name} AS name, coalesce(sum(amount), 0) AS amount FROM tx WHERE {R.EXPENSE} AND {name} IS NOT NULL GROUP BY 1, 2"
    after = f"SELECT strftime(cast(concat(stat_month, '-01') AS date) + interval 1 month, '%Y-%m') AS stat_month, name, amount FROM ({own})"
    return f"SELECT stat_month, name, {R.money('coalesce(a.amount, 0)', 'amount')}, {R.money('coalesce(b.amount, 0)', 'before')}, {R.money('coalesce(a.amount, 0) - coalesce(b.amount, 0)', 'change')}, '{kind}' AS compared FROM ({own}) AS a FULL JOIN ({after}) AS b USING (stat_month, name) WHERE stat_month <= (SELECT max(stat_month) FROM ({own}))"


R.query("period_over_period", changes, change_sql("category", "category") + " UNION ALL " + change_sql("merchant", R.MERCHANT))

# windows of rows, batches, parts of messages
R.query("week_range_lookup", lambda tx: R.detail(S.in_week_range(tx, "1998-W10")), f"SELECT {R.DETAIL} FROM tx WHERE {R.WEEK} = '1998-W10'")


def newest_half(tx: DataFrame) -> DataFrame:
    current = tx.agg(F.max("id")).first()[0] or 0
    rows = S.id_window(tx, current // 2, current)
    return R.detail(rows if rows is not None else tx.limit(0))


R.query("row_id_window", newest_half, f"SELECT {R.DETAIL} FROM tx WHERE id > (SELECT max(id) // 2 FROM tx)")


def last_week(messages: DataFrame) -> DataFrame:
    newest = messages.agg(F.max("received_at").cast("date").alias("d")).first().d
    return S.recent_days(messages, "received_at", F.lit(newest).cast("date")).select("id", "received_at")


R.query("recent_days", last_week, "SELECT id, received_at FROM msg WHERE received_at >= (SELECT cast(max(received_at) AS date) - 7 FROM msg)", source=R.messages)


def batches(messages: DataFrame) -> DataFrame:
    """Batches by each mode, cold and above a cursor, and the cursor after those that may advance it."""
    out = None
    for name, after, mode in (("oldest", 100, None), ("newest", 100, " latest "), ("cold", None, "EARLIEST_FIRST"), ("cold newest", None, "LATEST_WINDOW")):
        rows = C.next_batch(messages, after, 50, mode).select("id", F.lit(name).alias("batch"))
        try:
            cursor = C.advanced(messages, after, rows)
        except ValueError:
            cursor = None
        rows = rows.withColumn("cursor", F.lit(cursor).cast("long"))
        out = rows if out is None else out.unionByName(rows)
    return out


R.query("select_batch", batches, " UNION ALL ".join(
    f"SELECT id, '{name}' AS batch, {cursor} AS cursor FROM (SELECT id FROM msg WHERE {where} ORDER BY id {order} LIMIT 50)" for name, where, order, cursor in (
        ("oldest", "id > 100", "ASC", "max(id) OVER ()"), ("newest", "id > 100", "DESC", "cast(NULL AS bigint)"), ("cold", "true", "ASC", "max(id) OVER ()"), ("cold newest", "true", "DESC", "cast(NULL AS bigint)"))), source=R.messages)


def parts_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as messages in two or three parts: html, plain text, and one that may be null."""
    part = lambda is_html, content: F.struct(F.lit(is_html).alias("is_html"), content.alias("content"))
    parts = F.array(part(True, F.col("html")), part(False, F.col("url")), part(True, F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<b>page</b> "), F.col("page_id").cast("string")))))
    return R.table(spark, sf_dir, "pages").select("page_id", parts.alias("parts"))


TRIMMED = "regexp_replace({}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"
BARE = TRIMMED.format("regexp_replace(html, '<[^>]*>', '', 'g')")
WHOLE = f"concat_ws(chr(10), {BARE}, url, CASE WHEN page_id % 2 = 0 THEN concat('page ', cast(page_id AS varchar)) END)"
QUERIES["strip_html"] = lambda spark, d: parts_of_pages(spark, d).select("page_id", X.body_of_parts(F.col("parts")).alias("body"))
SQL["strip_html"] = f"SELECT page_id, {TRIMMED.format(WHOLE)} AS body FROM pages"
