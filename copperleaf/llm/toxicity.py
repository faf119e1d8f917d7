"""Toxicity: averaged subword-bag embeddings under a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with word edges), hashed into one table of
embeddings, so an unseen misspelling shares most vectors with the known word. A window of
``WINDOW`` words is the average of its words' embeddings; the softmax gives the window's
log odds, and a text's score is that of its worst window, so a few words in a very long
text still count. In training the windows of a text share its label through a log-sum-exp.

Null or empty text has one empty window, whose score is the bias alone. Repeated rows each
get their own result; an id or text that is labelled both ways counts as toxic. Very long
texts are scored whole, but train only up to ``SAMPLE_CHARS``, a bound of the sample. Without
labelled rows of both classes every score is 0. An empty table gives an empty result. Only the
named columns are read, whatever others there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copperleaf.llm.common import WordTable, chunks, documents, narrow, starts
from copperleaf.llm.language_id import crc_class

BUCKETS = 1 << 17
WIDTH = 8
SIZES = (3, 4, 5)
WINDOW = 8
#: Training texts of each class, drawn by a hash of the text; the longest in characters; passes.
SAMPLE = 700
SAMPLE_CHARS = 20_000
EPOCHS = 60
RATE = 1.0
DECAY = 1e-6


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of all words' n-grams, and where each word's begin; every word has one at least."""
    data = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    at = starts(size)
    left = np.repeat(at[1:], size) - np.arange(len(data))  # bytes from here to the word's end
    keys, owner = [], []
    word = np.repeat(np.arange(len(words)), size)
    for n in SIZES:
        ok = np.flatnonzero(left >= n)
        h = np.full(len(ok), n, np.uint64)
        for k in range(n):
            h = (h ^ data[ok + k]) * np.uint64(0x100000001B3)
            h ^= h >> np.uint64(29)
        keys.append(h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 17))
        owner.append(word[ok])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(keys)[order].astype(np.int64), starts(np.bincount(owner, minlength=len(words)))


def _split(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def window_means(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means of each text's windows (half overlapping; the last ones are shorter), and where each text's begin; an empty text has one of zeros."""
    n = np.diff(at)
    count = np.maximum(1, -(-n // (WINDOW // 2)))
    first = starts(count)
    begin = np.repeat(at[:-1], count) + (np.arange(first[-1]) - np.repeat(first[:-1], count)) * (WINDOW // 2)
    end = np.minimum(begin + WINDOW, np.repeat(at[1:], count))
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=total[1:])
    size = np.maximum(1, end - begin)
    return (total[end] - total[begin]) / (size[:, None] if values.ndim > 1 else size), first


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> tuple[np.ndarray, float]:
    """Log odds of each bucket and the bias: the trained embeddings times the softmax' difference."""
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        return np.zeros(BUCKETS), -np.inf
    kinds: dict[bytes, int] = {}
    split = [_split(t) for t in texts]
    rows = np.array([kinds.setdefault(w, len(kinds)) for ws in split for w in ws], np.int64)
    at = starts(np.array([len(ws) for ws in split]))
    flat, cut = subwords(list(kinds))
    seen, flat = np.unique(flat, return_inverse=True)
    owner, share = np.repeat(np.arange(len(kinds)), np.diff(cut)), 1 / np.diff(cut)
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.3, (len(seen), WIDTH)).astype(np.float32)
    out = rng.normal(0, 0.3, (WIDTH, 2)).astype(np.float32)
    bias = np.array([0.0, -2.0])
    squares = [np.full(x.shape, 1e-6) for x in (emb, out, bias)]
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    size = np.diff(at)
    count = np.maximum(1, -(-size // (WINDOW // 2)))
    doc = np.repeat(np.arange(len(y)), count)
    for _ in range(epochs):
        # as the average is linear, windows need each word's two logits only
        words = np.add.reduceat(emb[flat], cut[:-1], axis=0) * share[:, None]
        logits = words @ out
        means, first = window_means(logits[rows], at)
        odds = means[:, 1] - means[:, 0] + bias[1] - bias[0]
        top = np.maximum.reduceat(odds, first[:-1])
        soft = np.exp(odds - top[doc])
        total = np.add.reduceat(soft, first[:-1])
        z = top + np.log(total)
        g_doc = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) * weight
        g_win = g_doc[doc] * soft / total[doc]
        # back to the words: each window gives its share to the words in it
        step = WINDOW // 2
        begin = np.repeat(at[:-1], count) + (np.arange(first[-1]) - np.repeat(first[:-1], count)) * step
        end = np.minimum(begin + WINDOW, np.repeat(at[1:], count))
        each = g_win / np.maximum(1, end - begin)
        edge = np.bincount(begin, each, len(rows) + 1) - np.bincount(end, each, len(rows) + 1)
        g_word = np.bincount(rows, np.cumsum(edge)[:-1], len(kinds))
        pull = (g_word * share)[owner]
        g_sub = np.bincount(flat, pull, len(seen))
        g_out = words.T @ g_word
        for w, g, s, rate in (
            (emb, g_sub[:, None] * (out[:, 1] - out[:, 0])[None, :] + DECAY * emb, squares[0], RATE),
            (out, np.stack([-g_out, g_out], 1), squares[1], RATE / 2),
            (bias, np.array([-g_win.sum(), g_win.sum()]), squares[2], RATE),
        ):
            s += g * g
            w -= (rate * g / np.sqrt(s)).astype(w.dtype)
    table = np.zeros(BUCKETS)
    table[seen] = emb @ (out[:, 1] - out[:, 0])
    return table, float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, learn, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Train on about ``sample`` texts of each class among the labelled rows where ``learn`` holds."""
    known = labels.filter(learn & F.col("toxic").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = lambda c: sample / max(1, counts.get(c, 0))
    draw = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003
    known = known.filter(draw < F.when(F.col("toxic") == 1, share(1)).otherwise(share(0))).orderBy(draw, "id").limit(4 * sample)
    # about 2 * sample rows of 12 bytes; however often their ids occur in docs, as many texts
    texts = narrow(docs).filter(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(known), "id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    rows = sorted((r.text, r.toxic) for r in texts.orderBy(F.xxhash64("text"), "text").limit(4 * sample).collect())
    return train([t for t, _ in rows], [y for _, y in rows])


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """doc_id and score of each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: BUCKETS numbers

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shared.value

        def fill(words: list[bytes]) -> np.ndarray:
            flat, cut = subwords(words)
            return np.add.reduceat(table[flat], cut[:-1]) / np.diff(cut)

        words = WordTable(fill)
        for batch, raw in chunks(batches):
            values, at = words.values([_split((t or b"").decode()) for t in raw])
            means, first = window_means(np.zeros(0) if values is None else values, at)
            odds = np.maximum.reduceat(means, first[:-1]) + bias
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.where(np.isneginf(odds), 0.0, 1 / (1 + np.exp(-np.clip(odds, -500, 500)))))], ["doc_id", "score"])

    return narrow(docs).mapInArrow(scores, "doc_id long, score double")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.coalesce(crc_class("doc_id", 5) == 0, F.lit(False))
    found = score(docs, fit(docs, labels, crc_class("doc_id", 5) != 0))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
