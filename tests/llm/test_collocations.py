"""Collocations against phrases counted one by one, with words and pairs in numbers and tries of any size."""

import random
import re
import sys
from collections import Counter
from fractions import Fraction
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))
import __spark_entry__ as entry  # noqa: E402
from copperleaf.llm import collocations as co  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, word string, n long, key long, phrase string"
NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def texts():
    r = random.Random(7)
    common = ["the", "of", "New", "York", "city", "big", "é", "日本", "apple", "a\x1cb", "x'y"]
    out = [(i, "".join(r.choice(common) + r.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n"]) for _ in range(60)), r.choice(["en", "fr", None, "und"])) for i in range(70)]
    out += [(100 + i, "Alpha beta gamma; rare" + str(i), "en") for i in range(12)] + [(200 + i, "alpha beta", "en") for i in range(9)] + [(300, None, "en"), (301, "", None), (302, " \n.;", "de"), (303, "solo", "de")]
    return out + [(400, "same same " * 40, "xx"), (400, "tail", "xx"), (401, "word", "xx"), (402, "word", "xx"), (403, "end.Start", "xx"), (None, "no id here", None), (500, "of the big city " * 2000, "en")]


def plain(rows):
    n, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    out = {}
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= 10}
    for (lang, w), a in candidates.items():
        if len(w) == 2 and any(100 * b >= 50 * a for (g, v), b in candidates.items() if g == lang and len(v) == 3 and w in (v[:2], v[1:])):
            continue
        s, _, left, right = min((int(Fraction(1000000 * a * a, f[lang, w[:k]] * f[lang, w[k:]])), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-s, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, found in out.items() for i, (s, a, p, x, y) in enumerate(sorted(found)[:2000]))


def rows_of(df):
    assert df.columns == NAMES
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def docs(spark):
    rows = texts()
    random.Random(1).shuffle(rows)
    return spark.createDataFrame([(*r, "w", 3, 4, "p") for r in rows], COLUMNS).repartition(4)


@pytest.mark.parametrize("words,pairs", [(1 << 20, 1 << 21), (4, 1 << 21), (1 << 20, 3), (9, 7), (0, 5)])
def test_numbers_and_tries_of_any_size(docs, words, pairs):
    assert rows_of(co.collocations(docs, max_words=words, max_pairs=pairs)) == plain(texts())


def test_top_of_each_language(docs):
    assert rows_of(co.collocations(docs, top=3)) == [r for r in plain(texts()) if r[1] <= 3]


def test_small_tables_of_words(docs, monkeypatch):
    monkeypatch.setattr(co, "MEMO", 5)
    monkeypatch.setattr(co, "WINDOWS", 20)
    monkeypatch.setattr(co, "BATCH", 7)
    assert rows_of(co.collocations(docs)) == plain(texts())


def test_registered_query_and_its_sql(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = plain(texts())
    assert rows_of(entry.queries()["op11_collocations"](spark, str(tmp_path))) == want
    con = duckdb.connect()
    con.execute(f"create view documents as from '{tmp_path}/documents.parquet/*.parquet'")
    got = con.sql(entry.oracle_sql()["op11_collocations"])
    assert sorted(got.columns) == sorted(NAMES)
    assert sorted(got.select(", ".join(NAMES)).fetchall()) == want


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert entry.queries()["op11_collocations"](spark, str(tmp_path)).collect() == []


def test_scores_pass_64_bits(spark):
    a, other = 3 * 10**13, 4 * 10**13
    row = spark.range(1).selectExpr(f"{a}L as a", f"{other}L as l", f"{other}L as r").selectExpr(f"{co._score('l', 'r')} as s").first()
    assert row.s == 1000000 * a * a // (other * other)


def test_trie_accepts_its_pairs_only():
    rng = np.random.default_rng(2)
    a = np.concatenate([rng.integers(0, 50, 30_000), rng.integers(0, 1 << 20, 20_000), np.zeros(5000, int)])
    b = np.concatenate([rng.zipf(1.2, 30_000) % (1 << 20), rng.integers(0, 1 << 20, 20_000), rng.integers(0, 1 << 20, 5000)])
    keys = np.unique(a.astype(np.int64) << 20 | b)
    trie = co.DoubleArrayTrie(keys)
    assert trie.accepts(keys >> 20, keys & ((1 << 20) - 1)).all()
    other = np.setdiff1d(np.concatenate([keys + 1, keys - 1, rng.integers(0, 1 << 40, 100_000)]), keys)
    other = other[other >= 0]
    assert not trie.accepts(other >> 20, other & ((1 << 20) - 1)).any()
    assert len(trie.check) < 4 * len(keys) + 300_000
    assert not co.DoubleArrayTrie(np.zeros(0, np.int64)).accepts(np.array([0, 5]), np.array([0, 7])).any()


def test_words_of_touching_rows():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["ab", None, "cd e.f", "", "g"]), "lang": pa.array(["x"] * 5)})
    data, begin, end, row, follows = co.words_of(batch)
    assert [data[i:j].tobytes() for i, j in zip(begin, end, strict=True)] == [b"ab", b"cd", b"e", b"f", b"g"]
    assert row.tolist() == [0, 2, 2, 2, 4] and follows.tolist() == [False, False, True, False, False]
