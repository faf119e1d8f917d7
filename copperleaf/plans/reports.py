"""Period reports: which period, its bounds, macro figures or a fallback from details, context, and whole report rows for all periods in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from copperleaf.plans import rollup as U
from copperleaf.plans import summaries as S

# The keys of the metrics text, the form of render links.
METRICS = {
    "txCount": "tx_count", "totalExpense": "total_expense", "totalRefund": "total_refund", "netExpense": "net_expense", "totalIncome": "total_income", "totalTransfer": "total_transfer",
    "foodExpense": "food_expense", "transportExpense": "transport_expense", "onlineShoppingExpense": "online_shopping_expense", "offlineShoppingExpense": "offline_shopping_expense",
    "medicalExpense": "medical_expense", "communicationExpense": "communication_expense", "insuranceExpense": "insurance_expense", "propertyExpense": "property_expense",
    "travelExpense": "travel_expense", "carExpense": "car_expense", "personalTransferExpense": "personal_transfer_expense", "otherExpense": "other_expense",
}
RENDER_LINK = r"(https?://quickchart\.io/chart/render/[^\s)\"]+)"

KEY, APART, TYPES = U.KEY, U.APART, U.TYPES
FIGURES = list(METRICS.values())


def by_period(tx: DataFrame) -> DataFrame:
    """tx with a row for its day, its week and its month: period_type and period_value."""
    return U.by_type(tx, S.T)


def macro(tx: DataFrame) -> DataFrame:
    """The figures of every day, week and month, rolled up from the days'. Weeks have no transfers."""
    return U.macro_figures(U.roll_up(U.day_states(tx)), FIGURES)


def fallback(tx: DataFrame) -> DataFrame:
    """The figures of every day, week and month from detail rows alone, rolled up from the days'.

    A null type counts as expense, an unknown one adds to the total expense only; a null or
    unknown category is OTHER; every row counts, whatever its validity, currency or direction.
    """
    return U.spare_figures(U.roll_up(U.day_states(tx)), FIGURES)


def monday(label: Column) -> Column:
    """First day of an ISO week such as 2024-W05; null for any other text and for weeks that a year lacks."""
    part = lambda k: F.regexp_extract(label, r"^(\d{4})-W(\d{2})$", k).try_cast("int")
    first = F.date_add(F.trunc(F.make_date(part(1), F.lit(1), F.lit(4)), "week"), 7 * (part(2) - 1))
    return F.when(S.week(first) == label, first)


def period_bounds(kind: Column, value: Column, today: Column) -> Column:
    """struct<anchor, first, last> of a period by its label; with a label that is none: today, null, null."""
    date = lambda text, form: F.when(text.rlike(form), F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date"))
    first = (
        F.when(kind == "DAILY", date(value, r"^\d{4}-\d{2}-\d{2}$")).when(kind == "WEEKLY", monday(value))
        .when(kind == "MONTHLY", date(F.concat(value, F.lit("-01")), r"^\d{4}-\d{2}-01$"))
    )
    last = F.when(kind == "DAILY", first).when(kind == "WEEKLY", F.date_add(first, 6)).when(kind == "MONTHLY", F.last_day(first))
    return F.struct(F.coalesce(first, today).alias("anchor"), first.alias("first"), last.alias("last"))


def latest_active(figures: DataFrame) -> DataFrame:
    """period_type and period_value of the newest period of each type with a transaction that counts."""
    return figures.filter("tx_count > 0").groupBy("period_type").agg(F.max("period_value").alias("period_value"))


def resolve_periods(figures: DataFrame, requests: DataFrame) -> DataFrame:
    """requests (period_type, explicit, default, and more) with period_value: the period asked for, else the latest active one of its type, else the default."""
    newest = latest_active(figures).withColumnRenamed("period_value", "_newest")  # a row a type
    rows = requests.join(F.broadcast(newest), "period_type", "left")
    return rows.withColumn("period_value", F.coalesce(F.nullif("explicit", F.lit("")), "_newest", "default")).drop("_newest", "explicit", "default")


def metrics_json(first: Column, last: Column) -> Column:
    """All figures of a row as one JSON text; nulls are 0, and "" for names and dates."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    names = [text(F.col("period_type")).alias("periodType"), text(F.col("period_value")).alias("periodValue"), text(first).alias("startDate"), text(last).alias("endDate")]
    return F.to_json(F.struct(*names, *[F.coalesce(F.col(c), F.lit(0)).cast("long" if c == "tx_count" else S.MONEY).alias(k) for k, c in METRICS.items()]))


def chart_urls(text: Column) -> Column:
    """JSON array of the render links in a text, each once, in order; null where there is none."""
    urls = F.array_distinct(F.regexp_extract_all(text, F.lit(RENDER_LINK), F.lit(1)))
    return F.when(F.size(urls) > 0, F.to_json(urls))


def reports(spare: DataFrame, figures: DataFrame, wanted: DataFrame, texts: DataFrame, today: Column, delivered: DataFrame | None = None) -> DataFrame:
    """15 columns for each wanted period (period_type, period_value).

    ``figures`` are macro figures; a period without a row there takes ``spare`` ones, those of
    its details, and one without details either has zeros. ``texts`` has summary_text by period;
    ``delivered`` has slack_status by period, without it nothing was delivered.
    """
    own = figures.select(*KEY, *[F.col(c).alias(f"{c}_own") for c in FIGURES], F.lit(True).alias("known"))
    rows = wanted.select(*KEY).distinct().join(own, KEY, "left").join(spare, KEY, "left").join(texts.select(*KEY, "summary_text"), KEY, "left")
    pick = lambda c: F.when(F.col("known"), F.col(f"{c}_own")).otherwise(F.coalesce(F.col(c), F.lit(0)))
    count = F.coalesce(F.when(F.col("known"), F.col("tx_count_own")), F.col("tx_count"), F.lit(0)).cast("long")
    rows = rows.select(*KEY, "summary_text", count.alias("tx_count"), *[pick(c).cast(S.MONEY).alias(c) for c in FIGURES[1:]])
    rows = rows.join(delivered.select(*KEY, "slack_status"), KEY, "left") if delivered is not None else rows.withColumn("slack_status", F.lit(None).cast("string"))
    rows = rows.withColumn("b", period_bounds(F.col("period_type"), F.col("period_value"), today))
    return rows.select(
        F.concat_ws("_", F.lit("report"), F.lower("period_type"), "period_value").alias("report_id"), *KEY, F.col("b.anchor").alias("report_date"),
        "total_expense", "total_refund", "net_expense", "total_income", "total_transfer", "tx_count", metrics_json(F.col("b.first"), F.col("b.last")).alias("metrics_json"),
        "summary_text", chart_urls(F.col("summary_text")).alias("chart_url"), F.coalesce("slack_status", F.lit("SKIPPED")).alias("slack_status"), F.current_timestamp().alias("created_at"),
    )


def largest(tx: DataFrame, top: int) -> DataFrame:
    """The ``top`` largest expenses of each day, week and month and category, ties by id: the days' ones first, then among those the others'."""
    order = [F.desc_nulls_last("amount"), F.asc("id")]
    best = lambda rows, *by: rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by, "category").orderBy(*order))).filter(F.col("rank") <= top)
    days = best(tx.filter(S.is_expense()).withColumn("_day", S.day()), "_day").drop("rank", "_day")
    return best(by_period(days), *KEY)


def report_context(details: DataFrame, figures: DataFrame, top: int = 5) -> DataFrame:
    """A structured row for each period: figures, number of details, and its largest expenses (id, tx_time, amount, category, merchant), ``top`` of each category at most.

    ``figures`` has n_details besides, as ``period_figures`` gives it.
    """
    # bounded: ``top`` details for each of the fixed categories
    each = largest(details, top).groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct((-F.col("amount")).alias("less"), "id", "tx_time", "amount", "category", S.merchant().alias("merchant")))).alias("d"))
    details_ = F.transform("d", lambda x: F.struct(x["id"].alias("id"), x["tx_time"].alias("tx_time"), x["amount"].alias("amount"), x["category"].alias("category"), x["merchant"].alias("merchant")))
    return figures.join(each, KEY, "left").select(*KEY, F.struct(*FIGURES).alias("figures"), F.coalesce("n_details", F.lit(0)).alias("n_details"), details_.alias("details"))


def period_figures(tx: DataFrame) -> DataFrame:
    """Macro figures and n_details of every day, week and month."""
    return U.macro_figures(U.roll_up(U.day_states(tx)), [*FIGURES, "n_details"])


def top_merchants(tx: DataFrame, n: int = 3) -> DataFrame:
    """The n merchants with the largest totals of each day, week and month: rank, merchant_name, total_amount, tx_count; summed by day first."""
    days = tx.filter(S.in_cny(S.is_expense())).groupBy(S.day().alias(S.T), S.merchant().alias("merchant_name")).agg(F.sum("amount").alias("amount"), F.count("*").alias("n"))
    rows = by_period(days).groupBy(*KEY, "merchant_name").agg(F.sum("amount").cast(S.MONEY).alias("total_amount"), F.sum("n").alias("tx_count"))
    order = Window.partitionBy(*KEY).orderBy(F.desc_nulls_last("total_amount"), "merchant_name")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def merchant_penetration(tx: DataFrame) -> DataFrame:
    """Count, total, average and share of the period's expense, for each month and week and merchant."""
    rows = by_period(tx.filter(S.in_cny(S.is_expense()))).filter("period_type <> 'DAILY'").groupBy(*KEY, S.merchant().alias("merchant_name"))
    rows = rows.agg(F.count("*").alias("tx_count"), F.sum("amount").cast(S.MONEY).alias("total_amount"), F.count("amount").alias("n"))
    # the period's sum from its merchants' rows by partial aggregation, not by a window over them
    total = rows.groupBy(*KEY).agg(F.sum("total_amount").alias("all"))
    share = F.round(F.col("total_amount").cast("double") / F.col("all").cast("double"), 6)
    # a row a week and a month: bounded by the calendar
    return rows.join(F.broadcast(total), KEY).select(*KEY, "merchant_name", "tx_count", "total_amount", F.round(F.col("total_amount") / F.col("n"), 2).cast(S.MONEY).alias("avg_amount"), share.alias("share"))


def account_channel_summary(tx: DataFrame) -> DataFrame:
    """Sum, count and share of each month's expense by payment channel and by card tail."""
    rows = tx.filter(S.is_expense()).withColumn("stat_month", S.month())
    parts = F.explode(F.array(*[F.struct(F.lit(c).alias("grouped_by"), F.col(c).alias("name")) for c in ("payment_channel", "card_tail")]))
    sums = rows.select("stat_month", "amount", parts.alias("p")).groupBy("stat_month", "p.grouped_by", "p.name").agg(F.sum("amount").cast(S.MONEY).alias("total"), F.count("*").alias("n"))
    all_ = sums.groupBy("stat_month", "grouped_by").agg(F.sum("total").alias("all"))
    share = F.when(F.col("all") > 0, F.round(F.col("total").cast("double") / F.col("all").cast("double"), 6))
    return sums.join(all_, ["stat_month", "grouped_by"]).select("stat_month", "grouped_by", "name", "total", "n", share.alias("share"))


def change_by_month(totals: DataFrame, name: str) -> DataFrame:
    """amount, before and change of each name and month against the month before, wherever either has an amount; ``totals``: stat_month, name, amount.

    Each month's amount is sent on to the next month too, so no grid of all names and
    months is made. A month after the last one is left out.
    """
    here = totals.select("stat_month", F.col(name), F.col("amount"), F.lit(0).cast(S.MONEY).alias("before"))
    after = F.date_format(F.add_months(F.to_date(F.concat("stat_month", F.lit("-01"))), 1), "yyyy-MM")
    there = totals.select(after.alias("stat_month"), F.col(name), F.lit(0).cast(S.MONEY).alias("amount"), F.col("amount").alias("before"))
    last = totals.agg(F.max("stat_month").alias("last"))
    rows = here.unionByName(there).groupBy("stat_month", name).agg(F.sum("amount").cast(S.MONEY).alias("amount"), F.sum("before").cast(S.MONEY).alias("before"))
    return rows.join(F.broadcast(last), F.col("stat_month") <= F.col("last")).select("stat_month", name, "amount", "before", (F.col("amount") - F.col("before")).cast(S.MONEY).alias("change"))  # one row
