"""Audits of extraction over all messages: what was found, by which rule, and what seems to be missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from copperleaf.functions import extract as X
from copperleaf.plans.summaries import MONEY

CODES = ["CNY", *[code for code, _ in X.CURRENCIES]]


def amounts(messages: DataFrame, zeros: bool = True) -> DataFrame:
    """Messages, amounts found, suspected misses (an action word but no amount) and the sum of each currency: one row. Without ``zeros`` only positive amounts are found."""
    body, value = F.col("raw_body"), F.col("amount")
    rows = messages.select("raw_body", X.amount(body, zeros=zeros).alias("amount")).withColumn("currency", X.currency(body, value))
    return rows.agg(
        F.count("*").alias("n_messages"), F.count("amount").alias("n_amounts"), F.count_if(value.isNull() & X.has(body, X.VALID_WORDS)).alias("n_suspected"),
        *[F.coalesce(F.sum(F.when(F.col("currency") == c, value)), F.lit(0)).cast(MONEY).alias(f"sum_{c.lower()}") for c in CODES],
    )


def time_sources(messages: DataFrame) -> DataFrame:
    """How many times came from the stamp, the body and the receipt."""
    return messages.groupBy(X.time_source(F.col("raw_body"), F.col("received_at")).alias("time_source")).agg(F.count("*").alias("n"))


def validity(messages: DataFrame) -> DataFrame:
    """Valid and invalid messages and their rates: one row; rates are null without messages."""
    valid = X.is_valid_tx(F.col("raw_body"))
    rows = messages.agg(F.count("*").alias("n_messages"), F.count_if(valid).alias("valid"), F.count_if(~valid).alias("invalid"))
    rate = lambda c: F.round(F.try_divide(F.col(c), F.col("n_messages")), 4).alias(f"{c}_rate")
    return rows.select("*", rate("valid"), rate("invalid"))


def merchants(facts: DataFrame, top: int = 10) -> DataFrame:
    """The most frequent merchants (ties by name), each beside the number of rows with a merchant and of distinct ones."""
    named = facts.filter(F.col("cleaned_merchant").isNotNull()).groupBy("cleaned_merchant").agg(F.count("*").alias("n"))
    best = named.orderBy(F.desc("n"), "cleaned_merchant").limit(top)
    return best.select("*", named.agg(F.sum("n")).scalar().alias("n_extracted"), named.agg(F.count("*")).scalar().alias("n_distinct"))


def distribution(facts: DataFrame, *columns: str) -> DataFrame:
    """Rows by each value of each column, in one pass."""
    return facts.groupingSets([[c] for c in columns], *columns).agg(F.count("*").alias("n"))
