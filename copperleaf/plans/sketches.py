"""Distinct and frequent merchants of any period from stored states of days, within a bound, and exactly beside it.

A day's state has a fixed size whatever its rows: a HyperLogLog sketch of the merchants, and the
most frequent ones with their counts. States of days merge into those of weeks, months and reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from copperleaf.plans import rollup as U
from copperleaf.plans import summaries as S

#: Registers of a sketch as a power of two; its relative error (one standard deviation) is 1.04 over their number's root.
BITS = 12
ERROR = 1.04 / 2 ** (BITS / 2)


def day_sketches(tx: DataFrame, bits: int = BITS) -> DataFrame:
    """stat_date, n_rows, merchants (a sketch of at most 2 ** bits bytes)."""
    return tx.groupBy(S.day().alias(U.DAY)).agg(F.count("*").alias("n_rows"), F.hll_sketch_agg(S.merchant(), F.lit(bits)).alias("merchants"))


def distinct_merchants(sketches: DataFrame) -> DataFrame:
    """n_rows and n_merchants (an estimate) of each day, week and month, from the days' sketches alone."""
    rows = U.by_type(sketches, U.DAY).groupBy(*U.KEY)
    return rows.agg(F.sum("n_rows").alias("n_rows"), F.hll_sketch_estimate(F.hll_union_agg("merchants")).alias("n_merchants"))


def exact_merchants(tx: DataFrame) -> DataFrame:
    """The same, exactly: distinct pairs of day and merchant first, so that details are not taken three-fold."""
    days = tx.groupBy(S.day().alias(U.DAY), S.merchant().alias("merchant")).agg(F.count("*").alias("n"))
    pairs = U.by_type(days, U.DAY).groupBy(*U.KEY, "merchant").agg(F.sum("n").alias("n"))
    return pairs.groupBy(*U.KEY).agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_merchants"))
