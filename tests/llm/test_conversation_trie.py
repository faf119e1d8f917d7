"""The burst trie against prefixes counted one by one, at several container sizes."""

import hashlib
import random
import re
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))
import __spark_entry__ as entry  # noqa: E402
from copperleaf.llm import conversation_trie as ct  # noqa: E402

COLUMNS = "conv_id long, turn long, role string, text string, pos int, key string, owner string"


def talks():
    r = random.Random(3)
    out = []
    for c in [*range(0, 130), 20 * 40 + 3, -5, -17]:
        if c in (40, 60):
            continue  # no such beginning
        shared = [("user", "hello there"), ("bot", f"how are you {c % 2}"), ("user", "fine thanks"), ("bot", "bye now")]
        n = r.choice([1, 2, 3, 4, 6])
        own = shared[:n] if c % 3 else [(r.choice(["user", None]), r.choice(["a b", None, "", "c"])) for _ in range(n)]
        out += [(c, t, *x) for t, x in enumerate(own)]
    out += [(c, t, "user", f"long {t} same") for c in (200, 201, 202, 207) for t in range(9)] + [(207, 9, "user", "and one more")]
    out += [(300, None, "first", "null turn comes first"), (300, 1, "x", "y"), (301, 2, "p", "q"), (301, 2, "p", "q"), (None, 1, "no", "conversation")]
    out += [(1000, t, "user", "w " * (t % 5)) for t in range(500)]
    return out


def plain(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    talk = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        talk[c] = tuple(own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + own[c][h:])
    members, ends = defaultdict(set), defaultdict(set)
    for c, t in talk.items():
        ends[t].add(c)
        for d in range(len(t) + 1):
            members[t[:d]].add(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in kids[p])
    sha = lambda p: hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], sha(p)) for p, m in members.items())


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rows_of(df):
    assert df.columns == NAMES
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def talk(spark):
    rows = talks()
    random.Random(5).shuffle(rows)
    return spark.createDataFrame([(*r, 1, "k", "o") for r in rows], COLUMNS).repartition(5)


@pytest.mark.parametrize("container", [1 << 16, 200, 1])
def test_any_container_gives_the_same_trie(spark, talk, container, monkeypatch):
    monkeypatch.setattr(ct, "JOINED", 3)
    assert rows_of(ct.trie(talk, container)) == plain(talks())


def test_registered_query(spark, talk, tmp_path):
    talk.write.parquet(f"{tmp_path}/conversations.parquet")
    assert rows_of(entry.queries()["op13_conversation_trie"](spark, str(tmp_path))) == plain(talks())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert sorted(con.sql(entry.oracle_sql()["op13_conversation_trie"]).select(", ".join(NAMES)).fetchall()) == plain(talks())


def test_given_conversations(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(entry.queries()["op13_conversation_trie"](spark, sf)) == plain(rows)


def test_no_conversations(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/conversations.parquet")
    assert rows_of(entry.queries()["op13_conversation_trie"](spark, str(tmp_path))) == []
