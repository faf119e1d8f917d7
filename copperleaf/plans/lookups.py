"""Single questions to transactions and their summaries: one period, the newest ones, the largest of each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from copperleaf.plans import reports as P
from copperleaf.plans import rollup as U
from copperleaf.plans import summaries as S


def valid_in(tx: DataFrame, kind: str, value: str) -> DataFrame:
    """Valid rows of a day, week or month in the order of time, equal times by id."""
    return S.in_period(tx, kind, value).filter("is_valid_tx").orderBy(S.T, "id")


def summary_for(tx: DataFrame, kind: str, value: str, tail: str = "") -> DataFrame:
    """The summary row of one day, week or month: only its range of time is read. ``tail`` is the card of a month's reconciliation."""
    rows = S.in_period(tx, kind, value)
    return S.daily_summary(rows) if kind == "day" else S.weekly_summary(rows) if kind == "week" else S.monthly_summary(rows, tail=tail)


def active(summary: DataFrame) -> DataFrame:
    """The summary rows of periods with a transaction that counts."""
    return summary.filter("tx_count > 0")


def latest_active(summary: DataFrame, period: str) -> DataFrame:
    """The whole row of the newest active period. A summary without transfers or a largest amount (as of weeks) has 0 and null there."""
    row = newest(active(summary), period, 1)
    for name, value in (("total_transfer", F.lit(0)), ("max_single_amount", F.lit(None))):
        row = row if name in row.columns else row.withColumn(name, value.cast(S.MONEY))
    return row


def newest(rows: DataFrame, period: str, n: int) -> DataFrame:
    """The rows of the n newest periods, the newest first."""
    return rows.orderBy(F.desc(period)).limit(n)


def day_totals(tx: DataFrame) -> DataFrame:
    """Rows and amount of each day, whatever they are."""
    return tx.groupBy(S.day().alias(U.DAY)).agg(F.count("*").alias("n"), F.sum("amount").cast(S.MONEY).alias("total"))


def max_merchant(tx: DataFrame, period: Callable[[], Column] = S.day, name: str = U.DAY) -> DataFrame:
    """The merchant of each period's largest expense; of equal ones the smallest id."""
    rows = tx.filter(S.is_expense() & F.col("amount").isNotNull())
    return rows.groupBy(period().alias(name)).agg(F.max_by(S.merchant(), F.struct("amount", -F.col("id"))).alias("max_merchant"))


def top_category(tx: DataFrame, period: Callable[[], Column] = S.week, name: str = "week_period") -> DataFrame:
    """Each period's category with the largest expense, and its amount; of equal ones the last by name."""
    rows = tx.filter(S.is_expense() & F.col("category").isNotNull() & F.col("amount").isNotNull())
    sums = rows.groupBy(period().alias(name), "category").agg(F.sum("amount").cast(S.MONEY).alias("amount"))
    return sums.groupBy(name).agg(F.max(F.struct("amount", "category")).alias("m")).select(name, "m.category", "m.amount")


def top_merchants_json(tx: DataFrame, period_type: str = "WEEKLY", n: int = 3) -> DataFrame:
    """The n largest merchants of each period of a type as a JSON array in the order of their ranks."""
    entry = F.struct("rank", "merchant_name", F.coalesce("total_amount", F.lit(0)).cast(S.MONEY).alias("total_amount"))
    rows = P.top_merchants(tx, n).filter(F.col("period_type") == period_type)
    return rows.groupBy("period_value").agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("top"))  # n entries


def institution_totals(tx: DataFrame, institution: str, period: Callable[[], Column] = S.month, name: str = "stat_month") -> DataFrame:
    """Expense through one institution in each period."""
    return tx.groupBy(period().alias(name)).agg(S.total(S.is_expense() & (F.col("institution") == institution)).alias("institution_total"))


def top_transactions(tx: DataFrame, kind: str, value: str, n: int) -> DataFrame:
    """The n largest rows of a period, ties by id."""
    return S.in_period(tx, kind, value).orderBy(F.desc_nulls_last("amount"), "id").limit(n)


def with_figures(details: DataFrame, figures: DataFrame) -> DataFrame:
    """Each detail row with the figures of its day, its week and its month (three rows)."""
    return P.by_period(details).join(figures, U.KEY)


def chart_series(tx: DataFrame, period: Callable[[], Column] = S.month, name: str = "stat_month", zeros: bool = False) -> DataFrame:
    """Labels and values of each period's chart of categories, as arrays of the same size that are not empty.

    Without ``zeros`` (a chart of shares) categories without an amount are left out, unless
    none has one; with them (bars) all are kept.
    """
    rows = tx.filter(S.is_expense() & F.col("category").isNotNull()).groupBy(period().alias(name), "category")
    each = rows.agg(F.coalesce(F.sum("amount"), F.lit(0)).cast(S.MONEY).alias("v"))
    points = each.groupBy(name).agg(F.array_sort(F.collect_list(F.struct("category", "v"))).alias("p"))  # a point a category
    above = F.filter("p", lambda x: x["v"] > 0)
    shown = points if zeros else points.withColumn("p", F.when(F.size(above) > 0, above).otherwise(F.col("p")))
    return checked_series(shown.select(name, F.col("p.category").alias("labels"), F.col("p.v").alias("series")))


def checked_series(charts: DataFrame) -> DataFrame:
    """The charts; an error where labels and values differ in number or are none."""
    good = (F.size("labels") == F.size("series")) & (F.size("labels") > 0)
    return charts.withColumn("labels", F.when(F.coalesce(good, F.lit(False)), F.col("labels")).otherwise(F.raise_error(F.lit("labels and values of a chart must agree and be some"))))
