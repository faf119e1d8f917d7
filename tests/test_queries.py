"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import datetime
import decimal

import duckdb
import pytest

from copperleaf import registry, registry_more, registry_reports, registry_tables, registry_versions  # noqa: F401

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "orders customer lineitem events pages documents".split():
        con.execute(f"create view {t} as from '{D}/{t}.parquet'")
    return con


def plain(v):
    return round(float(v), 4) if isinstance(v, float | decimal.Decimal) else None if v is None else str(v)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_rows_as_in_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, D)
    want = duck.sql(registry.SQL[name])
    names = sorted(df.columns)
    assert sorted(want.columns) == names
    at = [want.columns.index(c) for c in names]
    assert sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=str) == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)


#: Queries of amounts, which the SQL leaves out where no pattern finds a positive one.
OF_AMOUNTS = ["amount", "audit_amount", "currency", "lineage_join", "to_transactions"]


@pytest.mark.parametrize("name", OF_AMOUNTS)
def test_amounts_of_zero_as_in_sql(spark, tmp_path, name):
    kinds, values = ("purchase", "signup", "error", "click", "view"), (0.0, 0.004, 0.01, 7.25)
    rows = [(i, datetime.datetime(2024, 1, 5), 7, k, v) for i, (k, v) in enumerate((k, v) for k in kinds for v in values for _ in range(2))]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    with duckdb.connect() as con:
        con.execute(f"create view events as from '{tmp_path}/events.parquet/*.parquet'")
        df = registry.QUERIES[name](spark, str(tmp_path))
        names = sorted(df.columns)
        want = con.execute(f"select {', '.join(names)} from ({registry.SQL[name]})").fetchall()
    assert sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=str) == sorted((tuple(map(plain, r)) for r in want), key=str)
