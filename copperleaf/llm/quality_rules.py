"""Quality rules: rules of each document, failure rates of each host with an empirical beta prior.

A document is rejected when it fails a base rule itself, or when its host's failure rate,
shrunk towards the rate of all hosts, is over ``max_rate``.

Null or empty text: no words, so the base rule of too few words fails. Null host: such
documents share no host and get no host verdict. Repeated rows count as often as they
occur; a rate equal to ``max_rate`` is kept. Very long texts are counted whole. An empty
table gives an empty result. Extra columns, whatever their names, stay in ``keep_good``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from copperleaf.llm.common import documents, narrow, unused, written

MIN_WORDS = 50
#: Share of words in repeated 3-word windows, in hundredths.
MAX_REPEAT = 50
#: A host goes when its shrunk failure rate is over this.
MAX_RATE = 0.5
#: Bounds of the prior's weight, in documents.
PRIOR_WEIGHT = (2.0, 1000.0)
#: Rejected hosts up to this many are broadcast (under 2 MB at 100 bytes a host); more are joined by shuffle.
BROADCAST_HOSTS = 20_000

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def text_stats(text: bytes | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one UTF-8 text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.split()  # bytes split at exactly the six ASCII spaces
    inside = b"".join(words)
    chars = len(inside.decode())
    symbols = len(inside) - len(inside.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    repeats = 0
    if len(words) > 3:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        seen = Counter(windows)
        if len(seen) < len(windows):
            marks = bytearray(len(words))
            for i, w in enumerate(windows):
                if seen[w] > 1:
                    marks[i : i + 3] = b"\1\1\1"
            repeats = sum(marks)
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeats


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in STATS.split(", ")]
    for b in batches:
        found = [text_stats(t) for t in b.column("text").cast(pa.binary()).to_pylist()]
        columns = [pa.array(c, pa.int64()) for c in (zip(*found, strict=True) if found else [[]] * len(names))]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("host"), *columns], ["id", "host", *names])


def base_failed():
    """Column: the rules that a document fails by itself."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def document_stats(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """id, host, the five figures and base_failed of each document."""
    rows = narrow(docs, "doc_id", "text", F.col(host_col).cast("string").alias("host"))
    return rows.mapInArrow(_stats, f"id long, host string, {STATS}").withColumn("base_failed", base_failed())


def host_verdicts(stats: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """host, n_docs, n_failed, shrunk_rate, rejected: one row for each non-null host.

    The prior Beta(a, b) has the mean of all documents and, by the method of moments,
    the weight that the spread of the hosts' rates tells.
    """
    hosts = (
        stats.filter(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    )
    rate = F.col("n_failed") / F.col("n_docs")
    total = hosts.agg(
        F.sum("n_docs").alias("docs"), F.sum("n_failed").alias("failed"), F.count("*").alias("hosts"),
        F.var_pop(rate).alias("spread"), F.avg(1 / F.col("n_docs")).alias("noise"),
    ).first()  # one row of five sums
    mean = (total.failed or 0) / total.docs if total.docs else 0.0
    between = (total.spread or 0.0) - mean * (1 - mean) * (total.noise or 0.0)
    low, high = PRIOR_WEIGHT
    weight = min(high, max(low, mean * (1 - mean) / between - 1)) if between > 0 else high
    shrunk = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    return hosts.withColumn("shrunk_rate", shrunk).withColumn("rejected", F.col("shrunk_rate") > max_rate)


def quality_rules(docs: DataFrame, host_col: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """One row a document: doc_id, the figures, base_failed, host_rate (null without host), kept."""
    stats = written(document_stats(docs, host_col))
    hosts = host_verdicts(stats, max_rate).select("host", F.col("shrunk_rate").alias("host_rate"), "rejected")
    return stats.join(hosts, "host", "left").select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce("rejected", F.lit(False))).alias("kept"), F.round("host_rate", 6).alias("host_rate"),
    )


def keep_good(docs: DataFrame, host_col: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """The documents that the rules keep, with all their columns; texts are not shuffled for the host verdicts."""
    stats = written(document_stats(docs, host_col).select("host", "base_failed"))
    host = unused(docs, "host")
    bad = host_verdicts(stats, max_rate).filter("rejected").select(F.col("host").alias(host))
    few = len(bad.take(BROADCAST_HOSTS + 1)) <= BROADCAST_HOSTS
    names = [F.col(f"`{c}`") for c in docs.columns]
    good = docs.filter(F.pandas_udf(_passes, BooleanType())(F.col("text")))
    return good.join(F.broadcast(bad) if few else bad, F.col(host_col).cast("string") == F.col(host), "left_anti").select(*names)


def _passes(texts: pd.Series) -> pd.Series:
    def good(t: str | None) -> bool:
        n, _, _, _, repeats = text_stats(t.encode() if t else None)
        return n >= MIN_WORDS and 100 * repeats <= MAX_REPEAT * n

    return texts.map(good).astype(bool)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


SQL = rf"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w),
h AS (SELECT doc_id, i, list_extract(words, i) AS a, list_extract(words, i + 1) AS b, list_extract(words, i + 2) AS c FROM g),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM h) WHERE n > 1),
m AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (VALUES (0), (1), (2)) AS o(k) GROUP BY doc_id),
s AS (SELECT w.doc_id, host, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(m.n, 0) AS n_repeat_words
      FROM w LEFT JOIN m ON w.doc_id = m.doc_id),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed FROM s),
t AS (SELECT host, count(*) AS n_docs, sum(base_failed::int) AS n_failed FROM f WHERE host IS NOT NULL GROUP BY host),
p AS (SELECT sum(n_failed) / sum(n_docs) AS mean, var_pop(n_failed / n_docs) AS spread, avg(1.0::double / n_docs) AS noise FROM t),
q AS (SELECT mean, CASE WHEN spread - mean * (1 - mean) * noise > 0
        THEN least({PRIOR_WEIGHT[1]}::double, greatest({PRIOR_WEIGHT[0]}::double, mean * (1 - mean) / (spread - mean * (1 - mean) * noise) - 1))
        ELSE {PRIOR_WEIGHT[1]}::double END AS weight FROM p),
v AS (SELECT host, (n_failed + mean * weight) / (n_docs + weight) AS host_rate FROM t, q)
SELECT doc_id, n_words::bigint AS n_words, word_chars::bigint AS word_chars, n_symbols::bigint AS n_symbols,
       n_dup_lines::bigint AS n_dup_lines, n_repeat_words::bigint AS n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(host_rate > {MAX_RATE}, false) AS kept, round(host_rate, 6) AS host_rate
FROM f LEFT JOIN v ON f.host = v.host
"""
