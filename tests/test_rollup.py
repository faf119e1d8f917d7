"""States of days: weeks and months rolled up equal the direct summaries; refreshed states equal those of all rows."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from copperleaf.plans import lookups as L
from copperleaf.plans import maintained as M
from copperleaf.plans import reports as P
from copperleaf.plans import rollup as U
from copperleaf.plans import summaries as S
from copperleaf.sources import changelog as C

TX = "id long, tx_time timestamp_ntz, amount decimal(12,2), currency string, direction string, tx_type string, card_tail string, category string, is_valid_tx boolean, cleaned_merchant string, counterparty string, institution string"
KEYS = ["id", "tx_time"]


def tx_rows(n=300, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        day = datetime.datetime(2023, 12, 25) + datetime.timedelta(days=r.randrange(40), hours=r.randrange(24))
        direction, tx_type = r.choice([("OUTFLOW", "EXPENSE"), ("OUTFLOW", "EXPENSE"), ("INFLOW", "REFUND"), ("INFLOW", "INCOME"), ("OUTFLOW", "TRANSFER"), (None, None), ("OUTFLOW", "odd")])
        amount = None if r.random() < 0.2 else round(r.random() * 100, 2)
        out.append((i, day, amount, r.choice(["CNY", "CNY", "USD", None]), direction, tx_type, r.choice(["0025", "1"]), r.choice(["FOOD", "TRAVEL", "OTHER", "odd", None]), r.choice([True, True, False, None]), r.choice(["m", "n", None]), "c", "CGB"))
    out += [(1000, None, 5, "CNY", "OUTFLOW", "EXPENSE", "1", "FOOD", True, None, None, None), (1001, datetime.datetime(2024, 3, 2), None, "CNY", "OUTFLOW", "EXPENSE", "1", "FOOD", True, None, None, None)]
    return [tuple(None if x is None else __import__("decimal").Decimal(str(x)) if k == 2 else x for k, x in enumerate(row)) for row in out]


def table(df):
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def tx(spark):
    return spark.createDataFrame(tx_rows(), TX).repartition(3)


def test_rolled_up_equals_direct(tx):
    states = U.day_states(tx, tail="0025")
    assert table(U.daily(states)) == table(S.daily_summary(tx))
    assert table(U.weekly(states)) == table(S.weekly_summary(tx))
    assert table(U.monthly(states)) == table(S.monthly_summary(tx, tail="0025"))


def test_states_are_made_of_kinds(tx):
    """The many sums see one row for all of a day's rows between which no condition tells."""
    many = tx.withColumn("id", F.explode(F.array("id", F.col("id") + 10_000)))
    assert U.kinds(many, "0025").count() == U.kinds(tx, "0025").count()
    assert table(U.daily(U.day_states(many))) == table(S.daily_summary(many))


def test_no_rows(tx):
    states = U.day_states(tx.limit(0), tail="0025")
    assert U.daily(states).collect() == U.weekly(states).collect() == U.monthly(states).collect() == U.roll_up(states).collect() == []


def test_refreshed_states(spark, tmp_path, tx):
    log, folder, r = str(tmp_path / "log"), str(tmp_path / "summary"), random.Random(2)
    tie, now = F.coalesce("amount", F.lit(-1)), lambda: C.read(spark, log)
    state = {(x[0], x[1]): x for x in tx_rows()}
    C.append(tx, log, 0)
    assert M.refresh(now(), folder, KEYS, tie, tail="0025") == 0
    for seq in range(1, 6):
        keys = r.sample(sorted(state, key=str), 25)
        op = C.DELETE if seq == 2 else C.UPSERT
        new = {k: (*state[k][:2], None if r.random() < 0.3 else __import__("decimal").Decimal(r.randrange(9000)) / 100, *state[k][3:7], r.choice(["FOOD", "MEDICAL"]), r.choice([True, False]), *state[k][9:]) for k in keys}
        if seq == 3:  # the largest amount of a day goes down, the smallest id goes
            top = max((x for x in state.values() if x[2] and x[1] and x[8] and x[5] == "EXPENSE"), key=lambda x: x[2])
            new[top[:2]] = (*top[:2], __import__("decimal").Decimal("0.01"), *top[3:])
        C.append(spark.createDataFrame(list(new.values()), TX), log, seq, "late" if seq == 4 else "main", op=op)
        state = {k: v for k, v in state.items() if k not in new} if op == C.DELETE else state | new
        assert M.refresh(now(), folder, KEYS, tie, tail="0025") == seq
        whole = spark.createDataFrame(list(state.values()), TX)
        assert table(U.monthly(M.states(spark, folder))) == table(S.monthly_summary(whole, tail="0025"))
    assert M.refresh(now(), folder, KEYS, tie, tail="0025") is None and M.version(spark, folder) == 5
    states = M.states(spark, folder)
    assert table(U.daily(states)) == table(S.daily_summary(whole)) and table(U.weekly(states)) == table(S.weekly_summary(whole))


def test_touched_days_are_ranges():
    days = [datetime.date(2024, 1, d) for d in (3, 1, 2, 9)] + [None]
    text = M.within(days)._jc.toString()
    assert text.count(">=") == 2 and "NULL" in text.upper()
    many = [datetime.date(2020, 1, 1) + datetime.timedelta(days=2 * i + (30 if i > 500 else 0)) for i in range(1000)]
    text = M.within(many)._jc.toString()
    assert text.count(">=") == M.RANGES and str(many[0]) in text and str(many[-1] + datetime.timedelta(1)) in text and str(many[501]) in text


def test_requests_and_charts(spark, tx):
    figures = P.period_figures(tx)
    asked = spark.createDataFrame([("DAILY", None, "d"), ("WEEKLY", "", "d"), ("MONTHLY", "2020-01", "d"), ("YEARLY", None, "none")], "period_type string, explicit string, default string")
    got = {r.period_type: r.period_value for r in P.resolve_periods(figures, asked).collect()}
    assert got["MONTHLY"] == "2020-01" and got["YEARLY"] == "none" and got["WEEKLY"].startswith("2024-W") and got["DAILY"] == "2024-03-02"
    bad = spark.createDataFrame([(["a"], [1, 2])], "labels array<string>, series array<int>")
    with pytest.raises(Exception, match="must agree"):
        L.checked_series(bad).collect()
