"""Summaries by name in SQL: views of all periods, and functions of a period's label whose range lies below the aggregate.

    register(spark, transactions, tail="0025")
    spark.sql("SELECT * FROM weekly_summary_of('2024-W05')")
    spark.sql("SELECT stat_date, net_expense FROM daily_summary ORDER BY stat_date DESC LIMIT 5")

Names live as long as the session; ``prefix`` tells several tables apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copperleaf.plans import summaries as S

EXPENSE = S.EXPENSE
MONDAY = "date_add(trunc(make_date(cast(substr(label, 1, 4) AS int), 1, 4), 'week'), 7 * (cast(substr(label, 7) AS int) - 1))"
#: Kind of a summary: the label's type, its first day and the day after its last in SQL, what is grouped by.
KINDS = {
    "daily": ("DATE", "label", "date_add(label, 1)", "to_date(tx_time)"),
    "weekly": ("STRING", MONDAY, f"date_add({MONDAY}, 7)", "trunc(to_date(tx_time), 'week')"),
    "monthly": ("STRING", "to_date(concat(label, '-01'))", "add_months(to_date(concat(label, '-01')), 1)", "trunc(to_date(tx_time), 'month')"),
}
WEEK = "concat(extract(YEAROFWEEK FROM first), '-W', lpad(weekofyear(first), 2, '0'))"


def _sum(condition: str, name: str) -> str:
    return f"cast(sum(CASE WHEN {condition} THEN amount ELSE 0 END) AS decimal(18,2)) AS {name}"


def _figures(kind: str, foreign: str, tail: str) -> list[str]:
    out = ["min(id) AS min_id", "max(id) AS max_id", f"count_if({EXPENSE}) AS tx_count"]
    out += [_sum(c, n) for n, c in S.SUMS.items() if kind != "weekly" or n != "total_transfer"]
    if kind == "weekly":
        return out + [_sum(f"{EXPENSE} AND weekday(tx_time) >= 5", "weekend_expense"), _sum(f"{EXPENSE} AND weekday(tx_time) < 5", "weekday_expense"), "min(to_date(tx_time)) AS week_start_date", "max(to_date(tx_time)) AS week_end_date"]
    out.append(f"cast(max(CASE WHEN {EXPENSE} THEN amount END) AS decimal(18,2)) AS max_single_amount")
    return out + ([_sum(f"is_valid_tx AND currency = '{foreign}'", "foreign_total"), _sum(f"{EXPENSE} AND card_tail = '{tail}'", "card_expense")] if kind == "monthly" else [])


def summary_sql(kind: str, rows: str, foreign: str, tail: str) -> str:
    """A summary's SQL over the rows of a query or view."""
    net = "cast(total_expense - total_refund AS decimal(18,2))"
    named = {
        "daily": "first AS stat_date, cast(weekday(first) + 1 AS bigint) AS day_of_week, weekday(first) >= 5 AS is_weekend",
        "weekly": f"cast(extract(YEAROFWEEK FROM first) AS int) AS stat_year, weekofyear(first) AS week, {WEEK} AS week_period, cast(round({net} / 7, 2) AS decimal(18,2)) AS avg_daily_expense",
        "monthly": "date_format(first, 'yyyy-MM') AS stat_month",
    }[kind]
    return f"SELECT * EXCEPT (first), {named}, {net} AS net_expense FROM (SELECT {KINDS[kind][3]} AS first, {', '.join(_figures(kind, foreign, tail))} FROM {rows} GROUP BY 1)"


def register(spark: SparkSession, tx: DataFrame, tail: str, foreign: str = "USD", prefix: str = "") -> list[str]:
    """Views ``transactions``, ``daily_summary``, ``weekly_summary``, ``monthly_summary`` and ``merchant_ranking``, and functions ``daily_summary_of(date)``,
    ``weekly_summary_of(label)``, ``monthly_summary_of(label)``, ``transactions_of(kind, label)``; returns the names."""
    if not all(c.isalnum() or c == "_" for c in prefix + foreign + tail):
        raise ValueError("prefix, currency and card are letters, digits and underscores")
    base = f"{prefix}transactions"
    tx.createOrReplaceTempView(base)
    S.merchant_ranking(spark.table(base)).createOrReplaceTempView(f"{prefix}merchant_ranking")
    names = [base, f"{prefix}merchant_ranking"]
    for kind, (label, low, high, _) in KINDS.items():
        view, function = f"{prefix}{kind}_summary", f"{prefix}{kind}_summary_of"
        spark.sql(summary_sql(kind, base, foreign, tail)).createOrReplaceTempView(view)
        rows = f"(SELECT * FROM {base} WHERE tx_time >= cast({low} AS timestamp_ntz) AND tx_time < cast({high} AS timestamp_ntz))"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.table(view).schema)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {function}(label {label}) RETURNS TABLE ({columns}) RETURN {summary_sql(kind, rows, foreign, tail)}")
        names += [view, function]
    return names


def columns(spark: SparkSession, name: str) -> DataFrame:
    """position, name and type of a view's columns."""
    fields = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(spark.table(name).schema)]
    return spark.createDataFrame(fields, "position int, name string, type string").orderBy(F.col("position"))
