"""Period summaries, rankings, shares, trends and reports over transactions, for all periods in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# Summed categories and the names of their columns.
CATEGORY_COLUMNS = {
    "FOOD": "food", "TRANSPORT": "transport", "ONLINE_SHOPPING": "online_shopping", "OFFLINE_SHOPPING": "offline_shopping", "SHOPPING": "shopping",
    "MEDICAL": "medical", "COMMUNICATION": "communication", "INSURANCE": "insurance", "PROPERTY_MANAGEMENT": "property", "TRAVEL": "travel",
    "CAR_EXPENSE": "car", "PERSONAL_TRANSFER": "personal_transfer", "OTHER": "other",
}
UNKNOWN_MERCHANT = "未知商户"
T = "tx_time"


def month(t: Column | str = T) -> Column:
    return F.date_format(t, "yyyy-MM")


def week(t: Column | str = T) -> Column:
    return F.concat(F.extract(F.lit("YEAROFWEEK"), t).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(t).cast("string"), 2, "0"))


def day(t: Column | str = T) -> Column:
    return F.to_date(t)


PERIODS = {"day": day, "week": week, "month": month}


def kind(direction: str, tx_type: str) -> Column:
    return F.col("is_valid_tx") & (F.col("direction") == direction) & (F.col("tx_type") == tx_type)


def is_expense() -> Column:
    return kind("OUTFLOW", "EXPENSE")


def in_cny(x: Column) -> Column:
    return x & (F.col("currency") == "CNY")


def total(condition: Column) -> Column:
    """Sum where the condition holds; 0 for a null condition, null where every amount is null."""
    return F.sum(F.when(condition, F.col("amount")).otherwise(0)).cast(MONEY)


EXPENSE = "(is_valid_tx AND direction = 'OUTFLOW' AND tx_type = 'EXPENSE')"


def flow(direction: str, tx_type: str) -> str:
    """SQL: rows of a kind in the home currency."""
    return f"is_valid_tx AND direction = '{direction}' AND tx_type = '{tx_type}' AND currency = 'CNY'"


#: SQL: for which rows the amount is summed, by the sum's name.
SUMS = {
    "total_expense": flow("OUTFLOW", "EXPENSE"), "total_refund": flow("INFLOW", "REFUND"), "total_income": flow("INFLOW", "INCOME"), "total_transfer": flow("OUTFLOW", "TRANSFER"),
    **{f"{n}_expense": f"{EXPENSE} AND category = '{c}'" for c, n in CATEGORY_COLUMNS.items()},
}


def measures() -> list[Column]:
    sums = [f"cast(sum(CASE WHEN {c} THEN amount ELSE 0 END) AS {MONEY}) AS {n}" for n, c in SUMS.items()]
    return [F.expr(x) for x in ("min(id) AS min_id", "max(id) AS max_id", f"count_if({EXPENSE}) AS tx_count", *sums, f"cast(max(CASE WHEN {EXPENSE} THEN amount END) AS {MONEY}) AS max_single_amount")]


def with_net(df: DataFrame) -> DataFrame:
    return df.withColumn("net_expense", (F.col("total_expense") - F.col("total_refund")).cast(MONEY))


def daily_summary(tx: DataFrame) -> DataFrame:
    out = with_net(tx.groupBy(day().alias("stat_date")).agg(*measures()))
    dow = F.weekday("stat_date") + 1
    return out.withColumn("day_of_week", dow.cast("long")).withColumn("is_weekend", dow >= 6)


def weekly_summary(tx: DataFrame) -> DataFrame:
    weekend = F.weekday(T) >= 5
    # grouped by the week's Monday; its names are made once a week, not once a row
    rows = tx.groupBy(F.trunc(F.to_date(T), "week").alias("_first")).agg(
        F.min(day()).alias("week_start_date"), F.max(day()).alias("week_end_date"), *measures(),
        total(is_expense() & weekend).alias("weekend_expense"), total(is_expense() & ~weekend).alias("weekday_expense"),
    )
    rows = with_net(rows).withColumns({"stat_year": F.extract(F.lit("YEAROFWEEK"), "_first").cast("int"), "week": F.weekofyear("_first"), "week_period": week("_first")})
    return rows.withColumn("avg_daily_expense", F.round(F.col("net_expense") / F.lit(7), 2).cast(MONEY)).drop("_first", "total_transfer", "max_single_amount")


def monthly_summary(tx: DataFrame, *, tail: str, foreign: str = "USD") -> DataFrame:
    """``tail``: the card whose expense is reconciled."""
    rows = tx.groupBy(F.trunc(F.to_date(T), "month").alias("_first")).agg(
        *measures(), total(F.col("is_valid_tx") & (F.col("currency") == foreign)).alias("foreign_total"), total(is_expense() & (F.col("card_tail") == tail)).alias("card_expense")
    )
    return with_net(rows).withColumn("stat_month", month("_first")).drop("_first")


def merchant() -> Column:
    return F.coalesce("cleaned_merchant", "counterparty", F.lit(UNKNOWN_MERCHANT))


def merchant_ranking(tx: DataFrame, period=month, name: str = "stat_month") -> DataFrame:
    """Count, sum, average and share by period and merchant."""
    rows = tx.filter(in_cny(is_expense())).groupBy(period().alias(name), merchant().alias("merchant_name"))
    out = rows.agg(F.count("*").alias("tx_count"), F.sum("amount").cast(MONEY).alias("total_amount"), F.count("amount").alias("_n"), F.min("id").alias("min_id"), F.max("id").alias("max_id"))
    return out.withColumn("avg_amount", F.round(F.col("total_amount") / F.col("_n"), 2).cast(MONEY)).drop("_n")


def period_days(kind: str, value: str) -> tuple[Column, Column]:
    """First day of a day, week (2024-W05) or month (2024-05), and the day after its last."""
    if kind == "day":
        low = F.to_date(F.lit(value))
        return low, F.date_add(low, 1)
    if kind == "month":
        low = F.to_date(F.lit(f"{value}-01"))
        return low, F.add_months(low, 1)
    year, number = value.split("-W")
    low = F.date_add(F.trunc(F.make_date(F.lit(int(year)), F.lit(1), F.lit(4)), "week"), 7 * (int(number) - 1))
    return low, F.date_add(low, 7)


def in_period(tx: DataFrame, kind: str, value: str) -> DataFrame:
    """Rows of one day, week or month, as a half-open time range that the scan can use."""
    low, high = period_days(kind, value)
    rows = tx.filter((F.col(T) >= low.cast("timestamp_ntz")) & (F.col(T) < high.cast("timestamp_ntz")))
    # a table laid out by month is read only where the period lies
    return rows.filter(F.col("month").between(F.date_format(low, "yyyy-MM"), F.date_format(F.date_sub(high, 1), "yyyy-MM"))) if "month" in tx.columns else rows


def in_week_range(tx: DataFrame, label: str) -> DataFrame:
    """Rows between the first and the last day that the weekly summary has for a week: two days are looked up, then the scan is filtered by them."""
    row = weekly_summary(in_period(tx, "week", label)).select("week_start_date", "week_end_date").first()
    if row is None:
        return tx.limit(0)
    return tx.filter((F.col(T) >= F.lit(row.week_start_date).cast("timestamp_ntz")) & (F.col(T) < F.date_add(F.lit(row.week_end_date), 1).cast("timestamp_ntz")))


def recent_days(rows: DataFrame, time: str, today: Column, days: int = 7) -> DataFrame:
    """Rows of the last days up to ``today`` and after, the newest first."""
    return rows.filter(F.col(time) >= F.date_sub(today, days).cast("timestamp_ntz")).orderBy(F.desc(time))


def id_window(rows: DataFrame, last: int, current: int) -> DataFrame | None:
    """Rows with last < id <= current; None, so that there is nothing to do, where the window is empty."""
    return rows.filter((F.col("id") > last) & (F.col("id") <= current)) if current > last else None


def top_per(tx: DataFrame, period, by: list[Column], n: int) -> DataFrame:
    """The n largest expenses of each period (and further keys); ties by id."""
    rows = tx.filter(is_expense()).withColumn("period", period())
    order = Window.partitionBy("period", *by).orderBy(F.desc_nulls_last("amount"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def net_trend(daily: DataFrame, days: int = 30) -> DataFrame:
    """The last days' net expense, missing days as 0."""
    last = daily.agg(F.max("stat_date").alias("d"))
    calendar = last.select(F.explode(F.sequence(F.date_sub("d", days - 1), F.col("d"))).alias("stat_date"))
    return calendar.join(daily, "stat_date", "left").select("stat_date", F.coalesce("net_expense", F.lit(0)).cast(MONEY).alias("net_expense"), (F.weekday("stat_date") >= 5).alias("is_weekend"))


def share(part: Column, net: Column) -> Column:
    """part of net in percent with one decimal, as text."""
    return F.when(net > 0, F.concat(F.round(part * 100 / net, 1).cast("decimal(18,1)").cast("string"), F.lit("%"))).otherwise("0.0%")
