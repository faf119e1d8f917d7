"""Packing against its contract: each id lies in exactly one piece, sequences are gapless, within the capacity and nearly full."""

import os
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))
import __spark_entry__ as entry  # noqa: E402
from copperleaf.llm import packing  # noqa: E402
from copperleaf.llm.hashed import HashedLists, HashIndex, hashes, slices  # noqa: E402

ODD = [
    None, "", "a  b", "  a", " a ", "a\n b", "a \nb", "a b 　c", "it's 's 's", "x\x1c y \x1c z\x85 q", "<|endoftext|> a b", "\0a \0b \1c", "é😀 日本語 12345678 a1b2", "a\t\tb  \n\n  c \r\n d",
    "   ", "\n", "don't we'll I'M", "z" * 40000, "a b" * 3000, "́a ́b", "a ​ b", "a  b", "« b » é à  c", "x\x7f \x7f y", "foo <|endoftext|>", " y  z", "b  ", "q" * 255 + " " + "r" * 256,
]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library(library):
    encoder = packing.ByteEncoder()
    for texts in (ODD, ODD, [None], [], [""], [" ".join(t or "" for t in ODD)], [t for t in ODD if t and "<|" not in t]):
        flat, at = encoder.encode(pa.array(texts, pa.string()).slice(0))
        assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [library(t) for t in texts]
    sliced = pa.array(ODD, pa.string()).slice(3, 9)
    flat, at = encoder.encode(sliced)
    assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [library(t) for t in ODD[3:12]]


def test_tables_by_hash():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(1, 1 << 62, 200_000, np.uint64))
    index = HashIndex(1 << 4)
    for part in np.array_split(keys, 7):
        index.add(part)
    assert (index.find(keys) == np.arange(len(keys))).all() and (index.find(keys + np.uint64(1 << 63)) == -1).all()
    table = HashedLists(limit=50)
    for _ in range(20):  # starts anew again and again
        wanted = rng.choice(keys[:300], 90)
        flat, to = table.lists(wanted, lambda new: (np.repeat((wanted[new] % 97).astype(np.uint32), (wanted[new] % 4).astype(np.int64)), (wanted[new] % 4).astype(np.int64)))  # noqa: B023
        assert [flat[a:b].tolist() for a, b in zip(to[:-1], to[1:], strict=True)] == [[int(w % 97)] * int(w % 4) for w in wanted]
    data = np.frombuffer(b"abcabcd" + b"x" * 200 + b"y" * 100, np.uint8)
    h = hashes(data, np.array([0, 3, 3, 7, 7, 8]), np.array([3, 6, 7, 107, 207, 108]))
    assert h[0] == h[1] != h[2] and h[3] == h[5] != h[4]


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a" * n if n else None for n in (5, 0, 30, 1, 1, 0)])})
    assert [b.num_rows for b in slices([batch], 10)] == [2, 1, 3]


@pytest.mark.parametrize("capacity", [2048, 8, 1])
def test_cuts_and_tails(capacity):
    for n in [*range(1, 200), 2047, 2048, 2049, 100_001]:
        pieces = packing.cuts(n, capacity)
        assert sum(pieces) == n and min(pieces) > 0 and max(pieces) <= capacity
    left = {x: capacity // x - 1 for x in {p for n in range(1, capacity + 1) for p in packing.cuts(n, capacity)}}
    assert len(left) <= 2 * capacity**0.5 + 1  # so few classes, and fewer than the capacity's pieces in each
    seqs = defaultdict(list)
    for length, number, s, offset in packing.tails(left, capacity):
        seqs[s].append((offset, length, number))
    assert sum(len(s) for s in seqs.values()) == sum(left.values())
    for s in seqs.values():
        end = 0
        for offset, length, _ in sorted(s):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(seqs) <= sum(x * n for x, n in left.items()) // capacity + 2


def check(rows, docs, library, spare):
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    for doc_id, texts in docs.items():
        want = sorted((library(t) + [1] for t in texts), key=lambda x: zlib.crc32(np.array(x, "<u4").tobytes()))
        got = sorted(pieces.pop(doc_id), key=lambda r: (r.doc_tokens, r.start))
        assert sum(r.length for r in got) == sum(map(len, want)) and {r.doc_tokens for r in got} == set(map(len, want))
        if len(want) == 1:
            at = 0
            for r in got:
                assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(want[0][at : at + r.length], "<u4").tobytes())
                at += r.length
    assert not pieces and sorted(seqs) == list(range(len(seqs)))
    total = 0
    for s in seqs.values():
        end = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 2048
        total += end
    assert 2048 * len(seqs) - total <= 0.015 * total + spare


def test_odd_documents(spark, library, tmp_path):
    data = [(i, t, 7, "w") for i, t in enumerate(ODD)] + [(None, "null id", 7, "w"), (4, "twice here", 7, "w"), (99, "long " * 40_000, 7, "w")] + [(200 + i, "same text here", 7, "w") for i in range(900)]
    spark.createDataFrame(data, "doc_id long, text string, length int, worker string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    docs = defaultdict(list)
    for i, t, *_ in data:
        docs[i].append(t)
    check(entry.queries()["op12_packing"](spark, str(tmp_path)).collect(), docs, library, 2 * 2048)


def test_given_documents(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: [r.text] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check(entry.queries()["op12_packing"](spark, sf).collect(), docs, library, 2048)


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert entry.queries()["op12_packing"](spark, str(tmp_path)).collect() == []
