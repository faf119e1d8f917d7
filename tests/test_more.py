"""Cursors as ranges, logged streams, time zones, sketches, rule tables and named summaries on small inputs."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from copperleaf.plans import named, rules, sketches
from copperleaf.plans import summaries as S
from copperleaf.plans import zones as Z
from copperleaf.sources import ranges
from copperleaf.streaming import incremental


@pytest.fixture(autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")


def test_ranges_take_each_row_once(spark, tmp_path):
    path, r = str(tmp_path / "ranges"), random.Random(4)
    df = spark.createDataFrame([(i,) for i in range(0, 400, 3)], "id long")
    seen, rounds = [], 0
    while True:
        batch, done = ranges.take(df, path, "a", r.choice([1, 7, 20]), r.choice(["LATEST", None]))
        ids = [x.id for x in batch.collect()]
        if not ids:
            break
        if r.random() < 0.2:
            continue  # a batch that was not written is taken again later
        ranges.finish(spark, path, "a", done)
        if r.random() < 0.2:
            ranges.finish(spark, path, "a", done)  # recorded twice
        seen += ids
        rounds += 1
        if rounds == 4:  # new rows come above all others
            df = df.union(spark.createDataFrame([(1000,), (1001,)], "id long"))
    assert sorted(seen) == sorted(x.id for x in df.collect())
    own = ranges.read(spark, path).filter("reader = 'a'")
    assert ranges.merged(own).count() == 1 and ranges.gaps(own, 1001).collect() == []
    assert [x.id for x in ranges.take(df, path, "b", 2, "LATEST")[0].collect()] == [1001, 1000]  # another reader begins anew
    assert ranges.take(df.limit(0), path, "b", 2) [1] == []


def test_merged_ranges_and_gaps(spark):
    rows = spark.createDataFrame([("a", 0, 10), ("a", 10, 20), ("a", 5, 8), ("a", 30, 40), ("a", 3, 3), ("b", 7, 9)], ranges.RANGES)
    of = lambda df: sorted((x.reader, x.low, x.high) for x in df.collect())
    assert of(ranges.merged(rows)) == [("a", 0, 20), ("a", 30, 40), ("b", 7, 9)]
    assert of(ranges.gaps(rows, 50, 0)) == [("a", 20, 30), ("a", 40, 50), ("b", 0, 7), ("b", 9, 50)]


def test_stream_logs(spark, tmp_path):
    source, place = str(tmp_path / "in"), lambda x: str(tmp_path / x)
    put = lambda low: spark.range(low, low + 10).coalesce(1).write.mode("append").parquet(source)
    run = lambda f=lambda rows: rows.filter("id % 2 = 0"): incremental.run_available(spark, source, spark.range(1).schema, place("sink"), place("check"), f, place("logs"))
    runs = lambda: sorted((r.batch, r.status, r.records_in, r.records_out, r.last_offset) for r in spark.read.parquet(place("logs/runs")).collect())
    cursors = lambda: sorted(r.last_offset for r in spark.read.parquet(place("logs/offsets")).collect())
    put(0)
    run()
    assert runs() == [(0, "SUCCESS", 10, 5, 9)] and cursors() == [9]
    put(10)

    def fails(rows):
        raise ValueError("broken")

    with pytest.raises(Exception, match="broken"):
        run(fails)
    assert runs() == [(0, "SUCCESS", 10, 5, 9), (1, "FAILED", 0, 0, 0)] and cursors() == [9]
    run()  # the batch is taken again: its rows replace those of the failure
    assert runs() == [(0, "SUCCESS", 10, 5, 9), (1, "SUCCESS", 10, 5, 19)] and cursors() == [9, 19]
    run()
    assert len(runs()) == 2


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_days_where_clocks_change(spark, kind):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo" if kind == "timestamp" else "UTC")  # which plays no part
    try:
        hours = spark.range(24 * 366).select("id", F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600).alias(S.T))  # 2024 by the hour
        if kind == "timestamp_ntz":
            hours = hours.withColumn(S.T, F.col(S.T).cast("timestamp_ntz"))
        zone = "America/New_York"
        n = lambda k, v, z=zone: Z.in_local_period(hours, k, v, z).count()
        assert [n("day", d) for d in ("2024-03-10", "2024-11-03", "2024-07-01")] == [23, 25, 24]
        assert n("week", "2024-W10") == 167 and n("month", "2024-11") == 721 and n("month", "2024-11", "UTC") == 720
        assert n("day", "2024-09-08", "America/Santiago") == 23  # its midnight does not exist
        by_day = {r.d: r.n for r in Z.localized(hours, zone).groupBy(S.day().cast("string").alias("d")).agg(F.count("*").alias("n")).collect()}
        assert by_day["2024-03-10"] == 23 and by_day["2024-11-03"] == 25 and by_day["2023-12-31"] == 5
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_local_ranges_reach_the_scan(spark, tmp_path):
    spark.range(5).select("id", F.lit(datetime.datetime(2024, 1, 1)).cast("timestamp_ntz").alias(S.T)).write.parquet(str(tmp_path / "t"))
    plan = Z.in_local_period(spark.read.parquet(str(tmp_path / "t")), "day", "2024-01-01", "Asia/Shanghai")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(tx_time), GreaterThanOrEqual(tx_time,2023-12-31T16:00), LessThan(tx_time,2024-01-01T16:00)]" in plan


def test_ten_thousand_rule_words(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefgh中文字") for _ in range(r.choice([1, 2, 3, 6]) if r.random() < 0.01 else r.choice([4, 5, 6])))
    table = [(word(), f"L{r.randrange(50)}", r.randrange(1000)) for _ in range(10_000)] + [("", "never", -1), ("same", "L2", 0), ("same", "L1", 0)]
    texts = [(i, "".join(r.choice("abcdefgh中文字 ") for _ in range(r.randrange(0, 30)))) for i in range(150)] + [(900, None), (901, ""), (902, "the same"), (903, "x")]
    got = {x.id: x.label for x in rules.labelled(spark.createDataFrame(texts, "id long, text string"), spark.createDataFrame(table, "word string, label string, priority int")).collect()}
    want = {i: min((p, label) for w, label, p in table if w and t and w in t)[1] for i, t in texts if t and any(w and w in t for w, _, _ in table)}
    assert got == want and got[902] == "L1" and 903 not in got


def test_texts_are_not_broadcast_for_their_rules(spark, tmp_path):
    spark.range(300).select("id", F.concat(F.lit("中文"), F.col("id").cast("string")).alias("text")).write.parquet(str(tmp_path / "t"))
    texts = spark.read.parquet(str(tmp_path / "t"))  # a small file, as many bytes as Spark takes its n-grams for
    table = spark.createDataFrame([("文7", "a", 1), ("9", "b", 0)], "word string, label string, priority int")
    few, many = [rules.labelled(texts, table, most=m) for m in (2, 1)]
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan(few) and "BuildLeft" not in plan(few) and "Broadcast" not in plan(many)
    want = {i: "b" if "9" in str(i) else "a" for i in range(300) if "9" in str(i) or str(i)[0] == "7"}
    assert {r.id: r.label for r in few.collect()} == {r.id: r.label for r in many.collect()} == want


def test_sketches_merge(spark):
    rows = spark.range(20_000).select(F.timestamp_seconds(F.lit(1704067200) + (F.col("id") % 60) * 86400).cast("timestamp_ntz").alias(S.T), (F.col("id") % 3777).cast("string").alias("cleaned_merchant"), F.lit("c").alias("counterparty"))
    exact = {(r.period_type, r.period_value): r for r in sketches.exact_merchants(rows).collect()}
    near = sketches.distinct_merchants(sketches.day_sketches(rows)).collect()
    assert len(near) == len(exact)
    for r in near:
        e = exact[r.period_type, r.period_value]
        assert r.n_rows == e.n_rows and abs(r.n_merchants - e.n_merchants) <= 1 + 4 * sketches.ERROR * e.n_merchants


def test_named_summaries(spark, tmp_path):
    columns = "id long, tx_time timestamp_ntz, amount decimal(12,2), currency string, direction string, tx_type string, card_tail string, category string, is_valid_tx boolean, cleaned_merchant string, counterparty string"
    spark.createDataFrame([(1, datetime.datetime(2024, 1, 31, 23), None, "CNY", "OUTFLOW", "EXPENSE", "1", "FOOD", True, None, None)], columns).write.parquet(str(tmp_path / "t"))
    names = named.register(spark, spark.read.parquet(str(tmp_path / "t")), tail="1", prefix="t1_")
    assert "t1_weekly_summary_of" in names
    for kind, label in (("daily", "date '2024-01-31'"), ("weekly", "'2024-W05'"), ("monthly", "'2024-01'")):
        df = spark.sql(f"SELECT * FROM t1_{kind}_summary_of({label})")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(tx_time" in plan and "LessThan(tx_time" in plan
        assert df.count() == 1 and df.schema == spark.table(f"t1_{kind}_summary").schema
        assert df.first().card_expense is None if kind == "monthly" else True
    assert spark.sql("SELECT * FROM t1_weekly_summary_of('2024-W06')").count() == 0
    assert [r.name for r in named.columns(spark, "t1_transactions").collect()][:2] == ["id", "tx_time"]
    with pytest.raises(ValueError):
        named.register(spark, spark.range(1), tail="1'")
