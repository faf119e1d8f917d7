"""Joins of facts to what they came from, and of merchants to a table of aliases.

Facts and messages are merged, as either may be large when its files are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lineage(raw: DataFrame, facts: DataFrame) -> DataFrame:
    """Facts with the sender of their raw message."""
    return facts.hint("merge").join(raw.select(F.col("id").alias("raw_record_id"), "sender"), "raw_record_id")


def gaps(raw: DataFrame, facts: DataFrame) -> DataFrame:
    """Raw messages without a fact."""
    return raw.hint("merge").join(facts.select(F.col("raw_record_id").alias("id")), "id", "left_anti")


def alias_join(tx: DataFrame, aliases: DataFrame) -> DataFrame:
    """``merchant_name``: the alias of the counterparty (one row a name in ``aliases``), else its cleaned name, else itself.

    The alias table may be of any size: Spark broadcasts it below its threshold and shuffles beyond it.
    """
    names = aliases.select(F.col("name").alias("counterparty"), F.col("alias").alias("_alias"))
    named = tx.filter(F.col("counterparty").isNotNull()).join(names, "counterparty", "left")
    # rows without a name stay out of the join, as they would all meet in one task
    rest = tx.filter(F.col("counterparty").isNull()).withColumn("_alias", F.lit(None).cast("string"))
    return named.unionByName(rest).withColumn("merchant_name", F.coalesce("_alias", "cleaned_merchant", "counterparty")).drop("_alias")
