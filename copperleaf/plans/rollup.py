"""Mergeable states of days: counts, sums and extremes from which days, weeks, months and reports all follow, and which later changes keep up to date.

A state is a row a day: counts and sums, which can be added and taken away, extremes, which
can only be added, and a mask of the sums that are null as all their terms are (which can only
be added too, and is 0 wherever a day has an amount). Details are read and shuffled once,
whatever is made of the states.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from copperleaf.plans import summaries as S

DAY = "stat_date"
# Categories that figures from details alone sum apart.
APART = ["FOOD", "TRANSPORT", "ONLINE_SHOPPING", "OFFLINE_SHOPPING", "MEDICAL", "COMMUNICATION", "INSURANCE", "PROPERTY_MANAGEMENT", "TRAVEL", "CAR_EXPENSE", "PERSONAL_TRANSFER"]
TYPES = {"DAILY": S.day, "WEEKLY": S.week, "MONTHLY": S.month}
KEY = ["period_type", "period_value"]
SUM = "decimal(28,2)"


EXPENSE = S.EXPENSE


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def conditions(foreign: str, tail: str | None) -> dict[str, str]:
    """SQL: for which rows the amount is summed, by the sum's name. Names with ``spare_`` are figures from details alone."""
    out = dict(S.SUMS)
    out |= {"all_expense": EXPENSE, "foreign_total": f"is_valid_tx AND currency = {quoted(foreign)}"}
    if tail is not None:
        out["card_expense"] = f"{EXPENSE} AND card_tail = {quoted(tail)}"
    # a null type counts as expense, an unknown one adds to the total only; a null or unknown category is OTHER
    kind, name, apart = "upper(coalesce(tx_type, 'EXPENSE'))", "upper(coalesce(category, 'OTHER'))", ", ".join(map(quoted, APART))
    spare = {"total_expense": f"{kind} NOT IN ('REFUND', 'INCOME', 'TRANSFER')", "total_refund": f"{kind} = 'REFUND'", "total_income": f"{kind} = 'INCOME'", "total_transfer": f"{kind} = 'TRANSFER'"}
    spare |= {f"{S.CATEGORY_COLUMNS[c]}_expense": f"{kind} = 'EXPENSE' AND {name} = '{c}'" for c in APART} | {"other_expense": f"{kind} = 'EXPENSE' AND {name} NOT IN ({apart})"}
    return out | {f"spare_{n}": c for n, c in spare.items()}


#: Sums in the order of their bits in the mask; the last two are the weeks' own.
BITS = ["total_expense", "total_refund", "total_income", "total_transfer", *[f"{n}_expense" for n in S.CATEGORY_COLUMNS.values()], "all_expense", "foreign_total", "card_expense", "weekend_expense", "weekday_expense"]
MASK = "null_sums"


def bit(name: str) -> int:
    return 1 << BITS.index(name)


def mask(foreign: str, tail: str | None) -> str:
    """SQL over ``kinds``: bits of the sums to which they add nothing but missing amounts."""
    parts = [f"CASE WHEN {c} THEN {bit(n)}L ELSE 0L END" for n, c in conditions(foreign, tail).items() if not n.startswith("spare_")]
    return f"CASE WHEN n_known = 0 THEN {' | '.join(parts)} ELSE 0L END"


#: SQL over ``kinds`` of extremes and counts by name.
EXTREMES = {"min_id": ("min", "min_id"), "max_id": ("max", "max_id"), "max_single_amount": ("max", f"CASE WHEN {EXPENSE} THEN largest END")}
COUNTS = {"tx_count": f"CASE WHEN {EXPENSE} THEN n ELSE 0L END", "n_details": "n", "n_amounts": "n_known"}


def kinds(tx: DataFrame, tail: str | None, sign: str | None = None) -> DataFrame:
    """Rows of a day between which no condition tells, as one: a few sums a row of tx, so that the many of a state are made of far fewer rows."""
    by = ["is_valid_tx", "direction", "tx_type", "currency", "category"]
    card = [] if tail is None else [F.expr(f"CASE WHEN card_tail = {quoted(tail)} THEN card_tail END AS card_tail")]
    one, times = (sign, f" * {sign}") if sign else ("1L", "")
    sums = [f"cast(sum({one}) AS bigint) AS n", f"cast(sum(CASE WHEN amount IS NOT NULL THEN {one} ELSE 0L END) AS bigint) AS n_known", f"cast(sum(amount{times}) AS {SUM}) AS amount"]
    most = [] if sign else ["min(id) AS min_id", "max(id) AS max_id", "max(amount) AS largest"]
    return tx.groupBy(S.day().alias(DAY), *by, *card).agg(*map(F.expr, sums + most))


def ends(tx: DataFrame, foreign: str, tail: str | None) -> DataFrame:
    """What can only be added, by day: extremes and the mask."""
    return kinds(tx, tail).groupBy(DAY).agg(*_ends(foreign, tail))


def _ends(foreign: str, tail: str | None) -> list[Column]:
    return [F.expr(f"{f}({x}) AS {n}") for n, (f, x) in EXTREMES.items()] + [F.expr(f"bit_and({mask(foreign, tail)}) AS {MASK}")]


def day_states(tx: DataFrame, foreign: str = "USD", tail: str | None = None, sign: str | None = None) -> DataFrame:
    """A state for each day of tx; with ``sign``, a column of 1 and -1, rows are added or taken away (then without extremes and mask)."""
    counts = [F.expr(f"sum({x}) AS {n}") for n, x in COUNTS.items()]
    sums = [F.expr(f"cast(sum(CASE WHEN {c} THEN amount END) AS {SUM}) AS {n}") for n, c in conditions(foreign, tail).items()]
    rows = kinds(tx, tail, sign).groupBy(DAY).agg(*counts, *sums, *([] if sign else _ends(foreign, tail)))
    return rows.fillna(0, list(conditions(foreign, tail)))


def _sums(states: DataFrame) -> list[str]:
    return [c for c in states.columns if c in BITS or c.startswith("spare_")]


def merged(states: DataFrame, *by: str) -> DataFrame:
    """States added up by some columns."""
    added = [f"cast(sum({c}) AS bigint) AS {c}" for c in COUNTS] + [f"cast(sum({c}) AS {SUM}) AS {c}" for c in _sums(states)]
    return states.groupBy(*by).agg(*map(F.expr, [*added, *[f"{f}({n}) AS {n}" for n, (f, _) in EXTREMES.items()], f"bit_and({MASK}) AS {MASK}"]))


def by_type(rows: DataFrame, time: str) -> DataFrame:
    """Rows three-fold, for their day, week and month: period_type and period_value."""
    parts = [F.struct(F.lit(k).alias("period_type"), f(time).cast("string").alias("period_value")) for k, f in TYPES.items()]
    return rows.withColumn("p", F.explode(F.array(*parts))).select("*", "p.*").drop("p")


def roll_up(states: DataFrame) -> DataFrame:
    """The states of all days, weeks and months, from those of days."""
    return merged(by_type(states, DAY), *KEY)


def value(name: str) -> Column:
    """A sum as a figure: null where every term is null."""
    return F.expr(f"cast(CASE WHEN {MASK} & {bit(name)}L = 0 THEN {name} END AS {S.MONEY}) AS {name}")


def macro_figures(rolled: DataFrame, names: list[str]) -> DataFrame:
    """The summaries' figures of each period. Weeks have no transfers."""
    rows = S.with_net(rolled.select(*KEY, "tx_count", "n_details", *[value(c) for c in _sums(rolled) if not c.startswith("spare_")]))
    return rows.withColumn("total_transfer", F.when(F.col("period_type") == "WEEKLY", F.lit(0)).otherwise(F.col("total_transfer")).cast(S.MONEY)).select(*KEY, *names)


def spare_figures(rolled: DataFrame, names: list[str]) -> DataFrame:
    """The figures of each period from detail rows alone: every row counts, whatever its validity, currency or direction."""
    rows = rolled.select(*KEY, F.col("n_details").alias("tx_count"), *[F.expr(f"cast({c} AS {S.MONEY}) AS {c.removeprefix('spare_')}") for c in _sums(rolled) if c.startswith("spare_")])
    return S.with_net(rows).select(*KEY, *names)


def _totals(states: DataFrame) -> list[Column]:
    categories = [f"{n}_expense" for n in S.CATEGORY_COLUMNS.values()]
    return [F.col("min_id"), F.col("max_id"), F.col("tx_count"), *[value(c) for c in ("total_expense", "total_refund", "total_income", "total_transfer", *categories)], F.col("max_single_amount").cast(S.MONEY).alias("max_single_amount")]


def daily(states: DataFrame) -> DataFrame:
    """The daily summary's rows."""
    dow = F.weekday(DAY) + 1
    return S.with_net(states.select(DAY, *_totals(states))).withColumn("day_of_week", dow.cast("long")).withColumn("is_weekend", dow >= 6)


def weekly(states: DataFrame) -> DataFrame:
    """The weekly summary's rows: weekends from their days' states."""
    weekend = F.weekday(DAY) >= 5
    parts = {"weekend_expense": weekend, "weekday_expense": ~weekend}
    null = F.col(MASK).bitwiseAND(F.lit(bit("all_expense")).cast("long")) != 0
    bits = F.when(null, F.when(weekend, F.lit(bit("weekend_expense"))).otherwise(F.lit(bit("weekday_expense")))).otherwise(0).cast("long")
    states = states.withColumns({n: F.when(on, F.col("all_expense")).otherwise(0).cast(SUM) for n, on in parts.items()} | {MASK: F.col(MASK).bitwiseOR(bits)})
    states = states.withColumn("_first", F.trunc(DAY, "week"))
    sums = merged(states, "_first").join(states.groupBy("_first").agg(F.min(DAY).alias("week_start_date"), F.max(DAY).alias("week_end_date")).withColumnRenamed("_first", "_same"), F.col("_first").eqNullSafe(F.col("_same")))
    rows = S.with_net(sums.select("_first", "week_start_date", "week_end_date", *_totals(sums), *[value(n) for n in parts]))
    rows = rows.withColumns({"stat_year": F.extract(F.lit("YEAROFWEEK"), "_first").cast("int"), "week": F.weekofyear("_first"), "week_period": S.week("_first")})
    return rows.withColumn("avg_daily_expense", F.round(F.col("net_expense") / F.lit(7), 2).cast(S.MONEY)).drop("_first", "total_transfer", "max_single_amount")


def monthly(states: DataFrame) -> DataFrame:
    """The monthly summary's rows (card_expense where the states were made for a card)."""
    sums = merged(states.withColumn("_first", F.trunc(DAY, "month")), "_first")
    more = [c for c in ("foreign_total", "card_expense") if c in sums.columns]
    return S.with_net(sums.select("_first", *_totals(sums), *[value(c) for c in more])).withColumn("stat_month", S.month("_first")).drop("_first")
