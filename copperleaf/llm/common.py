"""Helpers that the text operators share: shared-folder tables and Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task turns into numpy arrays at a time.
CHUNK_BYTES = 1 << 20
#: Bytes of a batch that Spark hands to Python (its own default is 64 MB, of which JVM and Python each hold several).
BATCH_BYTES = 4 << 20
#: Words that a task remembers before it starts anew.
MEMO_WORDS = 400_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder's full address below spark.checkpoint.dir; where that is unset, a local one in local mode (as in tests) and an error on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"file://{tempfile.gettempdir()}/copperleaf-shared"
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/copperleaf-{uuid.uuid4().hex}")
    return path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString()  # a path without scheme lies in Spark's default file system


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: it cuts the lineage and outlives executors."""
    path = f"{shared_dir(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores after it until df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by ``BATCH_BYTES``; a smaller bound of its own stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(key).rstrip("b")
    if not own.isdigit() or int(own) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the named columns, under the names id, text and their own; Python gets them in small batches."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), *more)


def chunks(batches: Iterable[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Cut record batches into slices of about ``limit`` bytes of UTF-8 text; one very long text is a slice of its own."""
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        begin = size = 0
        for i, t in enumerate(texts):
            n = len(t) if t else 0
            if i > begin and size + n > limit:
                yield batch.slice(begin, i - begin), texts[begin:i]
                begin, size = i, 0
            size += n
        if begin < len(texts):
            yield batch.slice(begin), texts[begin:]


def starts(lengths: np.ndarray) -> np.ndarray:
    """Where each of consecutive runs begins, and at last where all end."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def run_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values[at[i]:at[i+1]] along the first axis; 0 for empty runs. Each run is summed by itself, so its sum does not depend on the runs beside it."""
    out = np.zeros((len(at) - 1, *values.shape[1:]), np.float64)
    there = np.flatnonzero(at[1:] > at[:-1])
    if len(there):
        out[there] = np.add.reduceat(values[: at[-1]].astype(np.float64), at[there], axis=0)
    return out


class _Words(dict):
    """word -> row number. Beyond ``limit`` words it starts anew, so memory stays bounded whatever the vocabulary."""

    def __init__(self, fill, limit: int = MEMO_WORDS):
        super().__init__()
        self.fill, self.limit, self.used = fill, limit, 0
        self._reset()

    def __missing__(self, word):
        row = self[word] = len(self)
        return row

    def rows(self, lists: list[list]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of all lists' words, one after the other, and where each list begins; new words are computed all at once."""
        if self.used > self.limit:
            self.clear()
            self.used = 0
            self._reset()
        at = starts(np.fromiter(map(len, lists), np.int64, len(lists)))
        out = np.fromiter(map(self.__getitem__, chain.from_iterable(lists)), np.int64, at[-1])
        if len(self) > self.used:
            back = reversed(self)
            self._add([next(back) for _ in range(len(self) - self.used)][::-1])
            self.used = len(self)
        return out, at


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    """The array, or a copy of it with room for ``size`` rows and as many again."""
    if size <= len(array):
        return array
    out = np.empty((2 * size, *array.shape[1:]), array.dtype)
    out[: len(array)] = array
    return out


class WordTable(_Words):
    """A row of numbers for each word, made by ``fill`` for many words at once."""

    def _reset(self) -> None:
        self.data = None

    def _add(self, words: list) -> None:
        values = self.fill(words)
        self.data = _grown(values[:0] if self.data is None else self.data, self.used + len(words))
        self.data[self.used : self.used + len(words)] = values

    def values(self, lists: list[list]) -> tuple[np.ndarray | None, np.ndarray]:
        """The numbers of all words, and where each list begins; None where there is no word."""
        rows, at = self.rows(lists)
        return (self.data[rows] if len(rows) else None), at


class ListTable(_Words):
    """A list of integers for each word; ``fill`` makes (all numbers, count of each) for many words at once."""

    def _reset(self) -> None:
        self.flat, self.size = np.empty(0, np.uint32), 0
        self.begin, self.count = np.empty(0, np.int64), np.empty(0, np.int64)

    def _add(self, words: list) -> None:
        flat, count = self.fill(words)
        end = self.used + len(words)
        self.begin, self.count, self.flat = _grown(self.begin, end), _grown(self.count, end), _grown(self.flat, self.size + len(flat))
        self.begin[self.used : end] = self.size + starts(count)[:-1]
        self.count[self.used : end] = count
        self.flat[self.size : self.size + len(flat)] = flat
        self.size += len(flat)

    def lists(self, lists: list[list]) -> tuple[np.ndarray, np.ndarray]:
        """The integers of all words, and where each list's begin."""
        rows, at = self.rows(lists)
        count = self.count[rows]
        to = starts(count)
        return self.flat[np.repeat(self.begin[rows] - to[:-1], count) + np.arange(to[-1])], to[at]
