"""Token-id output: sorted-string-table shards, keyed by document identifier.

A shard file holds blocks of entries in key order, then a sparse index (last key, offset
and length of each block), a Bloom filter over the keys and a footer of fixed size. In a
block, a key shares its prefix with the one before (LEB128 lengths), and the block is
compressed with zstd. ``Shard.lookup`` reads the footer, asks the filter, searches the
index by bisection and reads one run of blocks.

Shards are dealt out by ranges of the identifier, so their names' order is key order. A
task writes under a name of its own and renames at the end; a task that runs again gives
the same files. Repeated identifiers keep all their entries, ordered by text; a null
identifier sorts first. Null text counts as empty. An empty table gives no shard. Very long
texts are encoded whole. Only the named columns are read, whatever others there are.

A folder is a full address (``file:``, ``s3:``, ``s3a:``, ``gs:``, ``hdfs:``) that every task can open;
an address of another kind raises an error instead of being taken for a local folder. Who
asks for shards owns the folder and deletes it.
"""

from __future__ import annotations

import bisect
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from copperleaf.llm.common import documents, narrow, shared_dir, written
from copperleaf.llm.hashed import HashedLists, hashes, remembered, slices, text_bytes

MODEL = "word_bpe_49k.json"
END_ID = 1
BLOCK_BYTES = 256 << 10
SHARD_BYTES = 64 << 20
BLOOM_BITS, BLOOM_HASHES = 10, 7
MAGIC = b"CPLFSST1"
#: index offset, index size, filter offset, filter size, entries, tokens, bytes of an id, magic
FOOTER = "<QQQQQQB8s"
#: last key, offset, size of a block
INDEX = "<9sQI"
#: White space, punctuation at a word's end, what the names of special tokens begin with.
SPACES, ENDING, SPECIAL = b"\x20\x09\x0a\x0b\x0c\x0d", b",.;:!?", re.compile(rb"<\|")


def key_of(doc_id: int | None) -> bytes:
    return bytes(9) if doc_id is None else b"\1" + (doc_id + (1 << 63)).to_bytes(8, "big")


def id_of(key: bytes) -> int | None:
    return int.from_bytes(key[1:], "big") - (1 << 63) if key[0] else None


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        n |= (b & 127) << shift
        at += 1
        if b < 128:
            return n, at
        shift += 7


def _filter_bits(key: bytes, size: int) -> list[int]:
    a, b = zlib.crc32(key), zlib.crc32(key, 0x5BD1E995) | 1
    return [(a + k * b) % size for k in range(BLOOM_HASHES)]


def file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    """The store and the path there of a folder's full address; Spark's names of object stores stand for the store's own."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", folder))


class ShardWriter:
    """Takes (key, ids) in key order; ``finish`` gives (entries, tokens)."""

    def __init__(self, sink, id_bytes: int = 2):
        import zstandard

        self.sink, self.id_bytes, self.pack = sink, id_bytes, zstandard.ZstdCompressor(level=1).compress
        self.block, self.size, self.last, self.offset = [], 0, b"", 0
        self.index, self.keys, self.tokens = [], [], 0

    def add(self, key: bytes, ids: np.ndarray) -> None:
        shared = 0
        if self.block:
            while shared < len(key) and key[shared] == self.last[shared]:
                shared += 1
        value = ids.astype(f"<u{self.id_bytes}").tobytes()
        entry = bytes([shared, len(key) - shared]) + _varint(len(value)) + key[shared:] + value
        self.block.append(entry)
        self.size += len(entry)
        self.last = key
        self.keys.append(key)
        self.tokens += len(ids)
        if self.size >= BLOCK_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.block:
            data = self.pack(b"".join(self.block))
            self.sink.write(data)
            self.index.append(struct.pack(INDEX, self.last, self.offset, len(data)))
            self.offset += len(data)
            self.block, self.size = [], 0

    def finish(self) -> tuple[int, int]:
        self._flush()
        index = b"".join(self.index)
        bits = np.zeros(max(64, BLOOM_BITS * len(self.keys)) // 8 + 1, np.uint8)
        for key in set(self.keys):
            for b in _filter_bits(key, 8 * len(bits)):
                bits[b >> 3] |= 1 << (b & 7)
        self.sink.write(index)
        self.sink.write(bits.tobytes())
        self.sink.write(struct.pack(FOOTER, self.offset, len(index), self.offset + len(index), len(bits), len(self.keys), self.tokens, self.id_bytes, MAGIC))
        return len(self.keys), self.tokens


class Shard:
    """A shard file behind an object with size() and read_at(length, offset)."""

    def __init__(self, file):
        import zstandard

        self.file, self.unpack = file, zstandard.ZstdDecompressor().decompress
        foot = struct.unpack(FOOTER, file.read_at(struct.calcsize(FOOTER), file.size() - struct.calcsize(FOOTER)))
        self.index_at, self.index_size, self.filter_at, self.filter_size, self.entries, self.tokens, self.id_bytes, magic = foot
        if magic != MAGIC:
            raise ValueError("not a shard file")
        self.blocks = list(struct.iter_unpack(INDEX, file.read_at(self.index_size, self.index_at)))

    def _block(self, k: int) -> Iterator[tuple[bytes, np.ndarray]]:
        _, offset, size = self.blocks[k]
        data, at, key = self.unpack(self.file.read_at(size, offset)), 0, b""
        while at < len(data):
            shared, rest = data[at], data[at + 1]
            size, at = _read_varint(data, at + 2)
            key = key[:shared] + data[at : at + rest]
            at += rest
            yield key, np.frombuffer(data, f"<u{self.id_bytes}", size // self.id_bytes, at)
            at += size

    def __iter__(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for k in range(len(self.blocks)):
            for key, ids in self._block(k):
                yield id_of(key), ids

    def lookup(self, doc_id: int | None) -> list[np.ndarray]:
        """The entries of one identifier; none where there is none."""
        key = key_of(doc_id)
        bits = self.file.read_at(self.filter_size, self.filter_at)
        if not all(bits[b >> 3] >> (b & 7) & 1 for b in _filter_bits(key, 8 * len(bits))):
            return []
        out = []
        for k in range(bisect.bisect_left(self.blocks, key, key=lambda x: x[0]), len(self.blocks)):
            found = [(x, ids) for x, ids in self._block(k) if x >= key]
            out += [ids for x, ids in found if x == key]
            if found and found[-1][0] > key:
                break
        return out


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, begin and end of the words that encode apart as they do in the texts: the tokenizer lower-cases and splits letters from punctuation itself.

    A text that may hold a special token's name is left as it is, and only cut at white space.
    """
    kept = np.zeros(len(at) - 1, bool)
    kept[[np.searchsorted(at, m.start(), "right") - 1 for m in SPECIAL.finditer(data.tobytes())]] = True
    as_is = np.repeat(kept, np.diff(at))
    data = data + np.uint8(32) * ((data >= 65) & (data <= 90) & ~as_is)
    solid = np.zeros(len(data) + 2, np.int8)
    solid[1:-1] = ~np.isin(data, np.frombuffer(SPACES, np.uint8))
    inner = np.unique(at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))])
    joint = inner[(solid[inner] == 1) & (solid[inner + 1] == 1)]  # two texts' words touch
    begin = np.sort(np.concatenate([np.flatnonzero(np.diff(solid) == 1), joint]))
    end = np.sort(np.concatenate([np.flatnonzero(np.diff(solid) == -1), joint]))
    if not len(begin):
        return data, begin, end
    # a letter before the punctuation at a word's end
    last = np.maximum.accumulate(np.where(np.isin(data, np.frombuffer(ENDING, np.uint8)), -1, np.arange(len(data))))[end - 1]
    letter = (last >= begin) & (last < end - 1) & (data[last] >= 97) & (data[last] <= 122) & ~as_is[begin]
    cut = last[letter] + 1
    return data, np.sort(np.concatenate([begin, cut])), np.sort(np.concatenate([end, cut]))


class WordEncoder:
    """Token ids of whole texts, by words that are remembered by their hashes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        self.merge, self._encode, self.width = tok.model.tokenize, tok.encode, 2 if tok.get_vocab_size() <= 1 << 16 else 4
        self.table = HashedLists()

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, and where each text's begin."""
        data, at = text_bytes(column)
        data, begin, end = words(data, at)
        raw = data.tobytes()

        def fill(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            flat, count = array("I"), array("q")
            for b, e in zip(begin[new], end[new], strict=True):
                w = raw[b:e]
                # what normaliser and splitter leave as it is goes to the model at once
                ids = [t.id for t in self.merge(w.decode())] if w.isalpha() and w.islower() else self._encode(w.decode(), add_special_tokens=False).ids
                flat.extend(ids)
                count.append(len(ids))
            return np.frombuffer(flat, np.uint32) if flat else np.zeros(0, np.uint32), np.frombuffer(count, np.int64)

        flat, to = self.table.lists(hashes(data, begin, end), fill)
        return flat, to[np.searchsorted(begin, at)]


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode and write all rows; a row for each shard: part, number, path, entries, tokens. Runs when called.

    The tokenizer drops white space and never joins across it, so words are encoded
    apart and remembered (``tests`` hold that against whole texts).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = remembered(f"word_encoder {tokenizer}", lambda: WordEncoder(tokenizer))
        part = TaskContext.get().partitionId()
        store, base = file_system(folder)
        store.create_dir(base, recursive=True)
        done: list[tuple] = []
        writer = sink = temp = None

        def close() -> None:
            entries, tokens = writer.finish()
            sink.close()
            path = f"shard-{part:06d}-{len(done):06d}.sst"
            store.move(temp, f"{base}/{path}")
            done.append((part, len(done), path, entries, tokens))

        for batch in slices(batches):
            flat, at = encoder.encode(batch.column("text"))
            for doc_id, begin, end in zip(batch.column("id").to_pylist(), at[:-1], at[1:], strict=True):
                if writer is None:
                    temp = f"{base}/.{uuid.uuid4().hex}"
                    sink = store.open_output_stream(temp)
                    writer = ShardWriter(sink, encoder.width)
                writer.add(key_of(doc_id), np.append(flat[begin:end], np.uint32(end_id)))
                if writer.offset >= shard_bytes:
                    close()
                    writer = None
        if writer is not None:
            close()
        names = ["part", "number", "path", "entries", "tokens"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "path" else pa.int64()) for n, c in zip(names, list(zip(*done, strict=True)) or [[]] * 5, strict=True)], names)

    ordered = narrow(docs).repartitionByRange(F.col("id")).sortWithinPartitions("id", "text")
    return written(ordered.mapInArrow(run, "part long, number long, path string, entries long, tokens long"))


def read_shards(shards: DataFrame, folder: str) -> DataFrame:
    """id, start (tokens of all documents before it), n_tokens and ids_crc32 of every entry, read from the files."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # a row a shard
    placed = shards.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long")))
    tasks = max(1, min(shards.count(), 100_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                out: tuple[list, ...] = ([], [], [], [])
                with store.open_input_file(f"{base}/{path}") as file:
                    for doc_id, ids in Shard(file):
                        for column, x in zip(out, (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())), strict=True):
                            column.append(x)
                        start += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.select("path", "base").repartition(tasks, "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_token_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    from copperleaf.llm.sentence_pieces import model_path

    folder = shared_dir(spark)
    return read_shards(write_shards(documents(spark, sf_dir), folder, model_path(MODEL)), folder)
