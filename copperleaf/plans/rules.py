"""Labels of texts by a table of rule words of any size: the rule of least priority any of whose words a text holds.

Each word is filed under one of its n-grams, the one that fewest words have. A text asks for
its distinct n-grams once, so its work grows with its length and with the words that may be in
it, not with the number of rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

N = 2
#: Rules that are broadcast at most: some 10 MB.
BROADCAST = 100_000


def _grams(text: Column, n: int) -> Column:
    """array<string> of a text's distinct n-grams."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    each = lambda a: F.filter(F.transform(a, lambda _, i: F.array_join(F.slice(a, i + 1, F.lit(n)), "")), lambda g: F.length(g) == n)
    return F.array_distinct(F.get(F.transform(F.array(chars), each), F.lit(0)))


def filed(rules: DataFrame, n: int = N) -> DataFrame:
    """gram, word, label, priority: each word (one character or more) under its rarest n-gram; shorter words under themselves."""
    words = rules.filter(F.length("word") > 0).select("word", "label", "priority").distinct()
    grams = words.withColumn("gram", F.explode(F.when(F.length("word") >= n, _grams(F.col("word"), n)).otherwise(F.array("word"))))
    common = grams.groupBy("gram").agg(F.count("*").alias("n"))
    best = F.row_number().over(Window.partitionBy("word", "label", "priority").orderBy("n", "gram"))
    return grams.join(common, "gram").withColumn("r", best).filter("r = 1").select("gram", "word", "label", "priority")


def labelled(texts: DataFrame, rules: DataFrame, id_col: str = "id", text_col: str = "text", n: int = N, most: int = BROADCAST) -> DataFrame:
    """id and label of the texts that hold a rule's word; ``rules``: word, label, priority (of equal ones the first label by name).

    Up to ``most`` rules are broadcast. Beyond, n-grams are shuffled without their texts, which
    only pairs that share one come back to. Texts are never broadcast, however small their files are.
    """
    asked = F.concat(*[_grams(F.col("text"), k) for k in range(1, n + 1)])
    texts = texts.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows, words = texts.withColumn("gram", F.explode(asked)), filed(rules, n)
    if rules.limit(most + 1).count() <= most:
        pairs = rows.join(F.broadcast(words), "gram")
    else:
        near = rows.drop("text").hint("merge").join(words, "gram").withColumnRenamed("id", "_id")
        pairs = near.hint("merge").join(texts, F.col("_id").eqNullSafe(F.col("id"))).drop("_id")
    hits = pairs.filter(F.col("text").contains(F.col("word")))
    return hits.groupBy("id").agg(F.min(F.struct("priority", "label")).alias("best")).select(F.col("id").alias(id_col), "best.label")
