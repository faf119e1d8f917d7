"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text.

The units are bytes, so every language and spelling is covered and each n-gram is one
number. N-gram counts come from all trusted texts; continuation counts, contexts, the three
discounts of each order and the interpolated probabilities are DataFrame joins, sharded by
n-gram. Every distinct n-gram of the whole corpus gets its code length by the same joins;
a document's perplexity is 2 ** (mean bits a byte). One in ``HELD_OUT`` trusted texts (by a
hash of the text) is not learned from; a document is kept when its perplexity is at most its
language's quantile over these, times a margin.

The table of code lengths is broadcast only while it has at most ``MAX_TABLE`` rows, which
is checked; beyond, documents meet their n-grams' code lengths by a join on blocks.

Null or empty text has perplexity 1 and is kept (other rules judge it). A null language, or
one without held-out text, uses the quantile of all held-out text, and where there is none,
that of the texts learned from; without any trusted text everything is kept. A perplexity
equal to the threshold is kept. Repeated rows each count and get their own result, very long
texts are scored whole, an empty table gives an empty result. Only the named columns are
read, whatever others there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from copperleaf.llm.common import chunks, documents, narrow, run_sums, starts, written

ORDER = 5
QUANTILE, MARGIN, HELD_OUT = 0.99, 1.2, 8
#: Rows of the broadcast table (12 bytes each, twice that in a worker's hash table), of broadcast trusted ids, of broadcast languages, bytes of text in a block.
MAX_TABLE, MAX_IDS, MAX_LANGS, BLOCK_BYTES = 6_000_000, 2_000_000, 10_000, 16 << 20
#: Bytes of text whose n-grams are counted at a time.
COUNT_BYTES = 12 << 20
LOW = [(1 << 8 * k) - 1 for k in range(ORDER + 1)]


def grams(raw: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte (zero bytes stand before a text), and where each text's begin."""
    at = starts(np.fromiter((len(t) if t else 0 for t in raw), np.int64, len(raw)))
    pad = bytes(ORDER - 1)
    data = np.frombuffer(b"".join(pad + (t or b"") for t in raw) + pad, np.uint8).astype(np.int64)
    out = np.zeros(max(0, len(data) - ORDER + 1), np.int64)
    for j in range(ORDER):
        out = out << 8 | data[j : j + len(out)]
    keep = np.arange(at[-1]) + np.repeat((ORDER - 1) * np.arange(len(raw)), np.diff(at))
    return out[keep], at


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct n-grams of a slice of texts, with their counts in the texts learned from (0 for the others)."""
    for batch, raw in chunks(batches, COUNT_BYTES):
        learned = [x == LEARNED for x in batch.column("role").to_pylist()]
        for flag in (True, False):
            keys, n = np.unique(grams([t for t, x in zip(raw, learned, strict=True) if x == flag])[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64) * flag)], ["g", "c"])


def discounts(level: DataFrame) -> list[float]:
    """D1, D2, D3+ of one order's counts; fixed ones where counts of counts are missing."""
    t = level.agg(*[F.count_if(F.col("c") == k).alias(f"t{k}") for k in (1, 2, 3, 4)]).first()
    if not (t.t1 and t.t2 and t.t3 and t.t4):
        return [0.5, 0.75, 0.9]
    y = t.t1 / (t.t1 + 2 * t.t2)
    return [min(0.95 * k, max(0.05, k - (k + 1) * y * b / a)) for k, a, b in ((1, t.t1, t.t2), (2, t.t2, t.t3), (3, t.t3, t.t4))]


def _discount(c: Column, d: list[float]) -> Column:
    return F.when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])


def levels(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """(probabilities g, p; contexts h, gamma) of each order from 1 up, from the counts (g, c) of the highest order."""
    tables = [counts]
    for k in range(ORDER - 1, 0, -1):  # continuation counts: distinct bytes before
        tables.append(written(tables[-1].groupBy(F.col("g").bitwiseAND(LOW[k]).alias("g")).agg(F.count("*").alias("c"))))
    out: list[tuple[DataFrame, DataFrame]] = []
    for k, level in enumerate(reversed(tables), 1):
        d = discounts(level)
        context = F.shiftright("g", 8)
        sums = level.groupBy(context.alias("h")).agg(F.sum("c").alias("total"), F.sum(_discount(F.col("c"), d)).alias("taken"))
        lower = out[-1][0].select(F.col("g").alias("low"), F.col("p").alias("q")) if out else None
        rows = level.withColumn("h", context).withColumn("low", F.col("g").bitwiseAND(LOW[k - 1])).join(sums, "h")
        rows = rows.join(lower, "low") if out else rows.withColumn("q", F.lit(1 / 256))
        p = (F.col("c") - _discount(F.col("c"), d)) / F.col("total") + F.col("taken") / F.col("total") * F.col("q")
        out.append((written(rows.select("g", p.alias("p"))), written(sums.select("h", (F.col("taken") / F.col("total")).alias("gamma")))))
    return out


def code_lengths(wanted: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """g and bits of each wanted n-gram: its own probability, or the next shorter one's times its context's weight."""
    rows = wanted.select("g").withColumn("p", F.lit(1 / 256))
    for k, (probs, contexts) in enumerate(model, 1):
        key = F.col("g").bitwiseAND(LOW[k])
        rows = rows.withColumn("key", key).withColumn("h", F.shiftright(key, 8))
        rows = rows.join(probs.select(F.col("g").alias("key"), F.col("p").alias("own")), "key", "left").join(contexts, "h", "left")
        rows = rows.select("g", F.coalesce("own", F.coalesce("gamma", F.lit(1.0)) * F.col("p")).alias("p"))
    return rows.select("g", (-F.log2("p")).cast("float").alias("bits"))


class Hashed:
    """Open addressing over n-grams: about one probe a look-up, for whole arrays at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = 64 - max(4, int(np.ceil(np.log2(2 * len(keys) + 1))))
        self.size = 1 << 64 - self.shift
        self.keys, self.values = np.full(self.size, -1, np.int64), np.zeros(self.size, np.float32)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] == -1]
            self.keys[slot[free]] = keys[free]  # of several in one slot, one stays
            won = self.keys[slot[todo]] == keys[todo]
            self.values[slot[todo[won]]] = values[todo[won]]
            todo = todo[~won]
            slot[todo] = (slot[todo] + 1) & (self.size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(self.shift)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        out = self.values[slot]
        todo = np.flatnonzero(self.keys[slot] != keys)
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (self.size - 1)
            out[todo] = self.values[slot[todo]]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
        return out


SCORED = "id long, lang string, role int, n_bytes long, bits double"
#: Roles of documents.
OTHER, LEARNED, TEST = 0, 1, 2


def _near(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """Bits of each document by a broadcast table."""
    table = lengths.toArrow()
    shared = rows.sparkSession.sparkContext.broadcast((np.asarray(table["g"], np.int64), np.asarray(table["bits"], np.float32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Hashed(*shared.value)
        for batch, raw in chunks(batches):
            keys, at = grams(raw)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("lang"), batch.column("role"), pa.array(np.diff(at)), pa.array(run_sums(look(keys), at))], ["id", "lang", "role", "n_bytes", "bits"])

    return rows.mapInArrow(run, SCORED)


def _far(rows: DataFrame, lengths: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Bits of each document by a join: blocks of documents ask for their distinct n-grams."""
    blocks = 1 + (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in chunks(batches):
            block = batch.column("block").to_numpy()
            for b in np.unique(block):
                keys = np.unique(grams([t for t, x in zip(raw, block, strict=True) if x == b])[0])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), b)), pa.array(keys)], ["block", "g"])

    def score(docs: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        look = Hashed(found["g"].to_numpy(np.int64), found["bits"].to_numpy(np.float32))
        out = docs[["id", "lang", "role"]].copy()
        keys, at = grams([t.encode() if isinstance(t, str) else None for t in docs["text"]])
        return out.assign(n_bytes=np.diff(at), bits=run_sums(look(keys), at))

    wanted = dealt.mapInArrow(ask, "block long, g long").distinct().join(lengths, "g")
    return dealt.groupBy("block").cogroup(wanted.groupBy("block")).applyInPandas(score, SCORED)


def perplexities(docs: DataFrame, trusted: DataFrame, max_table: int = MAX_TABLE) -> DataFrame:
    """id, lang, role, n_bytes, bits of each row; ``trusted`` has the ids (id) of trusted documents."""
    ids = written(trusted.select(F.col("id").alias("_t")).distinct())
    ids = F.broadcast(ids) if ids.count() <= MAX_IDS else ids
    rows = narrow(docs, "doc_id", "text", F.col("lang").cast("string").alias("lang")).join(ids, F.col("id") == F.col("_t"), "left")
    role = F.when(F.col("_t").isNull(), OTHER).when(F.pmod(F.xxhash64("text"), F.lit(HELD_OUT)) == 0, TEST).otherwise(LEARNED)
    rows = rows.select("id", "text", "lang", role.alias("role"))
    every = written(rows.select("text", "role").mapInArrow(_count, "g long, c long").groupBy("g").agg(F.sum("c").alias("c")))
    lengths = written(code_lengths(every, levels(every.filter("c > 0"))))
    return written(_near(rows, lengths) if lengths.count() <= max_table else _far(rows, lengths))


def quality_model(docs: DataFrame, trusted: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN, max_table: int = MAX_TABLE) -> DataFrame:
    """doc_id, lang, n_bytes, perplexity, threshold and kept of each row of docs."""
    scored = perplexities(docs, trusted, max_table).withColumn("perplexity", F.when(F.col("n_bytes") > 0, F.pow(2.0, F.col("bits") / F.col("n_bytes"))).otherwise(1.0))
    cut = lambda role: F.percentile_approx(F.when((F.col("role") == role) & (F.col("n_bytes") > 0), F.col("perplexity")), F.lit(quantile), F.lit(10_000))
    overall = scored.agg(F.coalesce(cut(TEST), cut(LEARNED)).alias("q")).first().q
    by_lang = scored.filter(F.col("role") == TEST).groupBy("lang").agg(cut(TEST).alias("q"))  # a row a language
    by_lang = F.broadcast(by_lang) if len(by_lang.take(MAX_LANGS + 1)) <= MAX_LANGS else by_lang
    threshold = margin * F.coalesce("q", F.lit(overall).cast("double"))
    return scored.join(by_lang, "lang", "left").select(
        F.col("id").alias("doc_id"), "lang", "n_bytes", "perplexity", threshold.alias("threshold"),
        F.coalesce(F.col("perplexity") <= threshold, F.lit(True)).alias("kept"),
    )


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model(documents(spark, sf_dir), labels.filter("quality = 1 and toxic = 0").select(F.col("doc_id").alias("id")))
