"""Packing into sequences of fixed size by the harmonic method.

Lengths fall into classes by the reciprocals of the capacity: a piece of class k is at most
capacity / k long, and a sequence of class k holds k such pieces. As documents may be cut,
a document's tokens beyond whole sequences are cut to the longest capacity / k that they
hold, then to the longest of the rest, and so on, until the rest is at most the root of the
capacity long; that rest is a class of its own length. So the classes are at most twice the
root of the capacity, a document has whole sequences and a few pieces more, and a full
sequence wastes fewer tokens than it or its pieces count (under the capacity's root).

Each worker numbers its pieces of each class for itself. The workers' counts (a row for each
worker and class) give every worker its first place in each class, so a piece's sequence and
offset follow from its number alone. Only the last, unfilled sequence of each class is left:
its pieces, fewer than the class's count and so bounded by the capacity whatever the input,
are packed across classes, the longest first, where they fit.

Null text counts as empty: its only token is the end's. A null id is kept as null. Repeated
rows each get pieces of their own. Very long texts are cut as others are. An empty table
gives an empty result. Only the named columns are read, whatever others there are.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from copperleaf.llm.common import documents, narrow, starts, written
from copperleaf.llm.hashed import HashedLists, hashes, remembered, slices, text_bytes

MODEL = "byte_bpe_50k"
END_ID = 1
CAPACITY = 2048
#: Bytes of a word from which it is encoded by itself, and characters beyond which the other library, which takes words of any length, does it.
WORD, LONG = 256, 10_000
#: Lead bytes of the characters among which there is white space beyond ASCII.
WIDE = (0xC2, 0xE1, 0xE2, 0xE3)


def cuts(n: int, capacity: int = CAPACITY) -> list[int]:
    """The lengths of a document's pieces in order."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest * rest > capacity:
        k = -(-capacity // rest)  # the least k whose share the rest holds
        out.append(capacity // k)
        rest -= capacity // k
    return out + [rest] * (rest > 0)


def tails(left: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """(length, number, sequence, offset) of the pieces that fill no sequence of their class: the longest first, where they fit."""
    room: list[int] = []
    out = []
    for length in sorted(left, reverse=True):
        first = 0  # what has no room for one piece has none for the next
        for number in range(left[length]):
            while first < len(room) and room[first] < length:
                first += 1
            if first == len(room):
                room.append(capacity)
            out.append((length, number, first, capacity - room[first]))
            room[first] -= length
    return out


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of the words of texts, and whether each is a text's first one; words are parted by one space between characters that are surely no white space.

    The pattern that cuts a text before merging never joins across such a space, so words
    with the space before them encode apart as they do in the text.
    """
    solid = data > 32
    solid[(data >= 0x7F) & (data < 0x80) | np.isin(data, WIDE)] = False  # what follows a space
    ends = data > 32  # what comes before it: a wide character's last byte is found by its lead
    for back, leads in ((1, WIDE[:1]), (2, WIDE[1:])):
        ends[back:] &= ~np.isin(data[:-back], leads) if len(data) > back else True
    space = np.flatnonzero(data == 32)
    space = space[(space > 0) & (space + 1 < len(data))]
    space = space[ends[space - 1] & solid[space + 1]]
    space = space[~np.isin(space, at) & ~np.isin(space + 1, at)]
    firsts = at[:-1][at[1:] > at[:-1]]
    begin = np.sort(np.concatenate([firsts, space + 1]))
    cut = np.sort(np.concatenate([at[1:][at[1:] > at[:-1]], space]))
    return begin, cut, np.isin(begin, firsts)


class ByteEncoder:
    """Token ids of whole texts: known words by their hashes, new ones by the merge ranks, texts that hold the special token's name by the tokenizers library."""

    def __init__(self, name: str = MODEL):
        import base64

        import public_tokenizers
        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.merge = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_to_numpy
        self.begins = np.zeros(max(ranks.values()) + 1, bool)
        self.begins[[i for b, i in ranks.items() if b[:1] == b" "]] = True
        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        self.special = re.compile("|".join(re.escape(t.content) for t in self.whole.get_added_tokens_decoder().values()).encode())
        self.table = HashedLists()

    def _alone(self, text: bytes) -> np.ndarray:
        t = text.decode()
        if len(t) > LONG:
            return np.array(self.whole.encode(t, add_special_tokens=False).ids, np.uint32)
        return self.merge(t, disallowed_special=())

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, and where each text's begin."""
        data, at = text_bytes(column)
        raw = data.tobytes()
        marked = np.unique(np.searchsorted(at, [m.start() for m in self.special.finditer(raw)], "right") - 1) if self.special.search(raw) else []
        begin, end, first = words(data, at)

        def fill(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            plain = ~first[new] & (end[new] - begin[new] < WORD)
            spelt = [raw[b:e] for b, e in zip(begin[new], end[new], strict=True)]
            plain &= np.fromiter((b" " not in w for w in spelt), bool, len(spelt))
            # plain words go in one call: each begins with the one token of its that begins with a space
            together = [w for w, p in zip(spelt, plain, strict=True) if p]
            flat = self.merge((b" " + b" ".join(together)).decode(), disallowed_special=()) if together else np.zeros(0, np.uint32)
            places = np.append(np.flatnonzero(self.begins[flat]), len(flat))
            others = [self._alone(spelt[i] if first[new[i]] else b" " + spelt[i]) for i in np.flatnonzero(~plain)]
            count = np.empty(len(new), np.int64)
            count[plain], count[~plain] = places[1:] - places[:-1], [len(x) for x in others]
            out, of_plain = np.empty(int(count.sum()), np.uint32), np.repeat(plain, count)
            out[of_plain], out[~of_plain] = flat, np.concatenate(others) if others else []
            return out, count

        flat, to = self.table.lists(hashes(data, begin, end, first), fill)
        to = to[np.searchsorted(begin, at)]
        if not len(marked):
            return flat, to
        parts = [flat[a:b] for a, b in zip(to[:-1], to[1:], strict=True)]
        for i in marked:
            parts[i] = np.array(self.whole.encode(raw[at[i] : at[i + 1]].decode(), add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), starts(np.fromiter(map(len, parts), np.int64, len(parts)))


PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, worker int, number long"


def cut_documents(docs: DataFrame, model: str = MODEL, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece: its document, place and checksum, and its number among its worker's pieces of that length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = remembered(f"byte_encoder {model}", lambda: ByteEncoder(model))
        worker = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        names = [c.split()[0] for c in PIECES.split(", ")]
        types = [pa.int32() if c.endswith(" int") else pa.int64() for c in PIECES.split(", ")]
        for batch in slices(batches):
            flat, at = encoder.encode(batch.column("text"))
            rows: list[tuple] = []
            for doc_id, begin, end in zip(batch.column("id").to_pylist(), at[:-1], at[1:], strict=True):
                ids = np.append(flat[begin:end], end_id).astype("<u4")
                start = 0
                for length in cuts(len(ids), capacity):
                    number = seen.get(length, 0)
                    seen[length] = number + 1
                    rows.append((doc_id, start, length, zlib.crc32(ids[start : start + length]), len(ids), worker, number))
                    start += length
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return narrow(docs).mapInArrow(run, PIECES)


def pack(docs: DataFrame, model: str = MODEL, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id (from 0, without gaps) and offset."""
    spark = docs.sparkSession
    pieces = written(cut_documents(docs, model, end_id, capacity))
    counts = written(pieces.groupBy("worker", "length").agg(F.count("*").alias("n")))
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most twice the capacity's root
    firsts = dict(zip(sorted(totals), starts(np.array([totals[x] // (capacity // x) for x in sorted(totals)], np.int64)).tolist(), strict=False))
    full = sum(n // (capacity // x) for x, n in totals.items())
    classes = spark.createDataFrame([(x, firsts[x], totals[x] // (capacity // x) * (capacity // x)) for x in totals], "length int, first long, n_full long")
    last = spark.createDataFrame([(x, i, full + s, o) for x, i, s, o in tails({x: n % (capacity // x) for x, n in totals.items()}, capacity)], "length int, left long, tail_sequence long, tail_offset long")

    before = Window.partitionBy("length").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)  # a row a worker
    bases = counts.select("worker", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).join(F.broadcast(classes), "length")
    placed = pieces.join(bases, ["worker", "length"]).withColumn("at", F.col("base") + F.col("number"))
    placed = placed.withColumn("left", F.when(F.col("at") >= F.col("n_full"), F.col("at") - F.col("n_full"))).join(F.broadcast(last), ["length", "left"], "left")
    each = F.expr(f"{int(capacity)} div length")
    return placed.select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
        F.coalesce("tail_sequence", F.col("first") + F.floor(F.col("at") / each)).alias("sequence_id"), F.coalesce("tail_offset", F.col("at") % each * F.col("length")).cast("long").alias("offset"),
    )


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
