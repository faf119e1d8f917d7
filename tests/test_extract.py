import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from copperleaf.functions import extract as X
from copperleaf.functions import text
from copperleaf.plans import joins, summaries
from copperleaf.sources import changelog, offsets
from copperleaf.streaming import incremental

AT = datetime.datetime(2024, 3, 6, 2, 0)
SAMPLE = "【测试银行】您尾号0000信用卡05日09:30消费12.50人民币，交易商户:支付宝-样例快餐。"
D = decimal.Decimal


def facts(spark, body):
    df = spark.createDataFrame([(1, "CGB", AT, body)], "id long, sender string, received_at timestamp_ntz, raw_body string")
    return X.to_transactions(df).first()


def test_whole_row(spark):
    r = facts(spark, SAMPLE)
    assert (r.amount, r.currency, r.direction, r.tx_type, r.card_tail, r.account_type) == (D("12.50"), "CNY", "OUTFLOW", "EXPENSE", "0000", "CREDIT_CARD")
    assert (r.payment_channel, r.counterparty, r.cleaned_merchant, r.category, r.is_valid_tx) == ("ALIPAY", "支付宝-样例快餐", "样例快餐", "FOOD", True)
    assert r.tx_time == datetime.datetime(2024, 3, 5, 1, 30)


@pytest.mark.parametrize(("body", "amount"), [
    ("实付1,080.5元 消费99元", "1080.50"), ("消费0.00元 付款8元", "8.00"), ("消费0元", "0.00"), ("最低还款50元", None), ("还款7.005元", "7.01"),
    ("验证码123 支付5元", None), ("贷款最高 消费5元", None), ("RMB 12", "12.00"), ("", None), (None, None), ("  ", None),
])
def test_amount(spark, body, amount):
    assert facts(spark, body).amount == (D(amount) if amount else None)


@pytest.mark.parametrize(("party", "clean"), [
    ("财付通-样例科技有限公司", "样例"), ("网络科技有限公司", "网络"), ("有限公司", "有限公司"), ("拼多多平台商户", "拼多多"), ("样例收款", "样例"), ("支付宝-", "支付宝-"), (None, None),
])
def test_cleaned_merchant(spark, party, clean):
    df = spark.createDataFrame([(party,)], "p string")
    assert df.select(X.cleaned_merchant(F.col("p"))).first()[0] == clean


def test_facts_and_fields_can_be_replaced_by_name(spark):
    df = spark.createDataFrame([(1, "CGB", AT, SAMPLE)], "id long, sender string, received_at timestamp_ntz, raw_body string")
    own = {"category": lambda: X.category(F.col("raw_body"), [("SNACKS", ["快餐"])]), "cleaned_merchant": lambda: X.cleaned_merchant(F.col("counterparty"), {"样例快餐": "S"}), "n_chars": lambda: F.length("raw_body")}
    r = X.to_transactions(df, own).first()
    assert (r.category, r.cleaned_merchant, r.n_chars, r.amount) == ("SNACKS", "S", len(SAMPLE), D("12.50"))
    mail = spark.createDataFrame([(None, "m", "95508", None, SAMPLE)], "uid long, message_id string, subject string, received_at timestamp_ntz, body string")
    raw = X.assemble_raw(mail, fields={"receiver_phone": lambda: F.lit("one")}).first()
    assert raw.receiver_phone == "one" and raw.sender == "CGB" and raw.id is not None


def test_filters_on_facts_stay_behind_the_dealing(spark, tmp_path):
    """Also, neither side of the join to the messages is broadcast, however small its file is."""
    spark.createDataFrame([(1, "CGB", AT, SAMPLE), (2, "CGB", AT, None), (3, "CGB", AT, " ")], "id long, sender string, received_at timestamp_ntz, raw_body string").write.parquet(str(tmp_path / "m"))
    raw = spark.read.parquet(str(tmp_path / "m"))
    valid = X.to_transactions(raw, tasks=3).filter("is_valid_tx")
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert "消费" in plan[: plan.index("Exchange RoundRobin")] and "消费" not in plan[plan.index("Exchange RoundRobin") :]
    for df, ids in ((joins.lineage(raw, valid), [1]), (joins.gaps(raw, valid), [2, 3])):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.id for r in df.collect()) == ids


def test_message_in_parts(spark):
    part = "array<struct<is_html:boolean,content:string>>"
    df = spark.createDataFrame([([(True, "<p> a </p>"), (False, "b <c>"), (True, None)],), ([],)], f"parts {part}")
    assert [r.b for r in df.select(X.body_of_parts(F.col("parts")).alias("b")).collect()] == ["a\nb <c>", ""]


def test_versions_of_a_key(spark, tmp_path):
    """Replayed batch, late older version, two versions in one commit, as-of before the first commit."""
    put = lambda rows: spark.createDataFrame(rows, "id long, v string")
    for seq, rows in ((1, [(1, "x"), (2, "x")]), (3, [(2, "y"), (2, "z")]), (2, [(2, "late"), (1, "w")]), (3, [(2, "y"), (2, "z")])):
        changelog.append(put(rows), str(tmp_path / "t"), seq)
    log = changelog.read(spark, str(tmp_path / "t"))
    assert {(r.id, r.v) for r in changelog.latest_by_key(log, ["id"], F.col("v")).collect()} == {(1, "w"), (2, "z")}
    assert [(r.n_rows, r.total_rows) for r in changelog.history(log).orderBy("_commit_seq").collect()] == [(2, 2), (2, 4), (2, 6)]
    assert changelog.as_of(log, ["id"], F.lit("2000-01-01").cast("timestamp"), F.col("v")).count() == 0
    months = log.withColumn("t", F.make_timestamp_ntz(F.lit(2024), F.col("id").cast("int"), F.lit(5), F.lit(0), F.lit(0), F.lit(0)))
    changelog.compact(months, str(tmp_path / "c"), ["id"], F.col("v"), "t")
    changelog.compact(months.filter("v <> 'w'"), str(tmp_path / "c"), ["id"], F.col("v"), "t", ["2024-01"])
    rows = spark.read.parquet(str(tmp_path / "c"))
    assert {(r.id, r.v, r.month) for r in rows.withColumn("month", F.col("month").cast("string")).collect()} == {(1, "x", "2024-01"), (2, "z", "2024-02")}


def test_newest_first_does_not_pass_unread_rows(spark):
    df = spark.range(1, 101)
    newest = changelog.next_batch(df, 10, 20, "latest_window")
    assert {r.id for r in newest.collect()} == set(range(81, 101))
    with pytest.raises(ValueError, match="unread"):
        changelog.advanced(df, 10, newest)
    assert changelog.advanced(df, 10, changelog.next_batch(df, 10, 20)) == 30 and changelog.advanced(df, 100, changelog.next_batch(df, 100, 20)) == 100
    assert changelog.advanced(df, 80, newest) == 100
    assert summaries.id_window(df, 5, 5) is None and summaries.id_window(df, 5, 9).count() == 4


def test_failed_runs_are_recorded(spark, tmp_path):
    with pytest.raises(KeyError):
        offsets.run_recorded(spark, str(tmp_path / "runs"), "e1", "job", lambda: {}["x"])
    offsets.run_recorded(spark, str(tmp_path / "runs"), "e2", "job", lambda: (3, 2, 9))
    got = {r.execution_id: (r.status, r.records_in, r.records_out, r.last_offset, r.error_message) for r in spark.read.parquet(str(tmp_path / "runs")).collect()}
    assert got == {"e1": ("FAILED", 0, 0, 0, "KeyError: 'x'"), "e2": ("SUCCESS", 3, 2, 9, None)}


def test_month_layout_is_read_only_where_the_period_lies(spark, tmp_path):
    df = spark.createDataFrame([(i, datetime.datetime(2024, 1 + i % 12, 3)) for i in range(48)], "id long, tx_time timestamp_ntz")
    changelog.write_by_month(df, str(tmp_path / "m"), "tx_time")
    rows = spark.read.schema("id long, tx_time timestamp_ntz, month string").parquet(str(tmp_path / "m"))
    week = summaries.in_period(rows, "week", "2024-W05")
    assert week.count() == 4 and len(week.inputFiles()) >= 1 and "PartitionFilters: [isnotnull(month" in week._jdf.queryExecution().toString()


def test_a_new_checkpoint_adds_to_an_old_sink(spark, tmp_path):
    put = lambda a, b, name: spark.createDataFrame([(i, name) for i in range(a, b)], "id long, v string").write.parquet(str(tmp_path / name))
    put(0, 10, "one")
    put(5, 20, "two")
    schema = spark.read.parquet(str(tmp_path / "one")).schema
    for name in ("one", "two", "one"):
        incremental.run_available(spark, str(tmp_path / name), schema, str(tmp_path / "sink"), str(tmp_path / f"cursor-{name}"), lambda x: x)
    log = changelog.read(spark, str(tmp_path / "sink"))
    latest = {r.id: r.v for r in changelog.latest_by_key(log, ["id"], F.col("v")).collect()}
    assert log.count() == 25 and latest == {i: "one" if i < 5 else "two" for i in range(20)}


@pytest.mark.parametrize("n", [0, 1, 700, 20_000])
def test_blocks_as_cut_one_by_one(spark, n):
    line = "".join("ab\n"[i * i % 7 % 3] if i % 900 else "\n\n" for i in range(n)) + "x" * (n // 2)
    rest, want = line.strip("".join(map(chr, range(33)))), []
    while rest:
        cut = len(rest)
        if cut > text.BLOCK:
            end = rest[: text.BLOCK + 1].rfind("\n")
            cut = end if end > text.LEAST else text.BLOCK
        part, rest = rest[:cut].strip("".join(map(chr, range(33)))), rest[cut:]
        want += [part] if part else []
    assert spark.createDataFrame([(line,)], "t string").select(text.blocks(F.col("t"))).first()[0] == want


def test_stream_gives_the_batch_rows(spark, tmp_path):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(20)], "id long, v string")
    df.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        incremental.run_available(spark, str(tmp_path / "in"), df.schema, str(tmp_path / "out"), str(tmp_path / "cp"), lambda x: x)
    assert changelog.read(spark, str(tmp_path / "out")).count() == 20


def test_days_of_the_month_before(spark):
    """A message of the 31st that is received on the 1st; without the option it lies in the month of receipt, or has no such day."""
    at = lambda text, received, back: spark.createDataFrame([(text, received)], "b string, r timestamp").select(X.tx_time(F.col("b"), F.col("r"), roll_back=back).alias("t")).first().t
    received = datetime.datetime(2024, 3, 1, 2, 0)
    assert at("28日09:30消费5元", received, True) == datetime.datetime(2024, 2, 28, 1, 30)
    assert at("28日09:30消费5元", received, False) == datetime.datetime(2024, 3, 28, 1, 30)
    assert at("01日09:30消费5元", received, True) == datetime.datetime(2024, 3, 1, 1, 30)
    assert at("31日09:30消费5元", received, True) == received  # February has no such day
    assert at("none", received, True) == received
