"""Text operators against plain versions, with nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

import re
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from copperleaf.llm import decontamination as dc
from copperleaf.llm import language_id, near_duplicates, pii, quality_model, quality_rules, secret_scan, sentence_pieces, token_tables, toxicity
from copperleaf.llm.common import WordTable, shared_dir

SCHEMA = "doc_id long, text string, lang string, source string, id string, spans string"
LONG = "abc def " * 5000
TEXTS = [
    "password=hunter2xyz and AKIA" + "A1" * 10, None, "", "   \n\t ", "a b", "a b", LONG, LONG, "é😀 token: 'abcdef0123456789abcdef0123456789' x@y.org",
    "one two three four five six seven eight nine ten", "one two three four five six seven eight nine ten eleven", "ONE two three four five six seven eight nine ten",
    "日本語 ▁ text <|endoftext|>, it's 12,3.", "call +1 (555) 123-4567 card 4111 1111 1111 1111 ip 10.0.0.1 999.1.1.1 iban GB82 WEST 1234 5698 7654 32",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, None if i == 3 else "h", "x", "y") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows + [rows[4], (None, "null id here", None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]


def test_quality_rules(docs, empty):
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}
    for i, t in enumerate(TEXTS):
        w = words(t)
        wins = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        again = {k + j for k, x in enumerate(wins) if wins.count(x) > 1 for j in range(3)} if len(w) < 500 else set(range(len(w)))
        assert (got[i].n_words, got[i].word_chars, got[i].n_repeat_words) == (len(w), sum(map(len, w)), len(again)), i
        assert not got[i].kept or not got[i].base_failed
    assert quality_rules.quality_rules(empty).count() == 0
    assert quality_rules.keep_good(docs).columns == docs.columns


def test_shrunk_rates_pull_small_hosts_to_the_mean(spark):
    rows = [("big", k < 10) for k in range(100)] + [("bad", k < 98) for k in range(100)] + [("tiny", True)]
    v = {r.host: r for r in quality_rules.host_verdicts(spark.createDataFrame(rows, "host string, base_failed boolean")).collect()}
    assert v["bad"].rejected and not v["big"].rejected and 0.1 < v["big"].shrunk_rate < v["tiny"].shrunk_rate < 1


def test_secrets(docs, empty):
    field = secret_scan.fit(docs, 50)
    rows = secret_scan.scan(docs, field).collect()
    assert len(rows) == docs.count() and secret_scan.scan(empty, secret_scan.fit(empty)).count() == 0
    base = {r.doc_id: [(s.start, s.end, s.kind) for s in r.spans if s.kind < 3] for r in rows}
    assert base[0] == [(0, 19, 0), (24, 48, 1)] and base[8] == [(3, 43, 0), (11, 43, 2)] and base[1] == []


def test_viterbi_is_exact():
    rng = np.random.default_rng(0)
    scores, steps = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))
    at = np.array([0, 4, 4, 9])
    tags = secret_scan.viterbi(scores, at, steps)
    for a, b in zip(at[:-1], at[1:], strict=True):
        value = lambda path, a=a: sum(scores[a + i, t] for i, t in enumerate(path)) + sum(steps[x, y] for x, y in zip(path, path[1:], strict=False))
        if b > a:
            best = max(np.ndindex(*[3] * (b - a)), key=value)
            assert list(best) == tags[a:b].tolist()


def test_field_finds_unlisted_forms():
    rng = np.random.default_rng(1)
    secret = lambda: "".join(rng.choice(list("0123456789abcdef"), 20))
    texts = [f"the quick brown fox number {k} password={secret()} jumps over dogs" for k in range(120)] + [f"plain words {k} without anything" for k in range(120)]
    field = secret_scan.train(secret_scan.samples(texts))
    text = f"the quick brown fox passcode={secret()} jumps"
    assert secret_scan.base_spans(text) == []
    assert secret_scan.tagged(field, [text, "plain words"], WordTable(field.fill)) == {0: [(29, 49)]}


def plain_pii(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 14 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def test_pii(docs, empty, spark):
    odd = ["a@b.c_d@e.f x@y..z", "1.2.3.4.5.6.7.8 0001.2.3.4", "00000000000000.0.0.0", "x" * 9000 + " a@" + "b." * 5000 + "c", "+1" * 50, None]
    for df in (docs, spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")):
        for r in pii.find(df).collect():
            assert [(s.start, s.kind, s.end) for s in r.pii_spans if s.kind < 4] == plain_pii(r.text or "")
    text = pii.redact(docs).filter("doc_id = 13").first().text
    assert text == "call <phone> card <card> ip <ip> 999.1.1.1 iban <iban>"
    assert pii.redact(docs).columns == docs.columns and pii.find(empty).count() == 0


def test_pii_takes_an_iban_without_what_follows(spark):
    de, gb, no = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947"
    texts = {
        f"iban {de} The rest": "iban <iban> The rest", f"iban {de} 2024-01-01": "iban <iban> 2024-01-01", f"iban {de} BIC DEUTDEFF": "iban <iban> BIC DEUTDEFF", f"iban {gb} A note": "iban <iban> A note",
        f"{de} {gb} {no} {de}": "<iban> <iban> <iban> <iban>", f"NOTE AB12 3456 7890 1234 {de}": "NOTE AB12 3456 7890 1234 <iban>", f"{de}X": f"{de}X", f"x{de}": f"x{de}",
        "DE88370400440532013000 The": "DE88370400440532013000 The",
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.text for r in pii.redact(df).orderBy("doc_id").collect()] == list(texts.values())


def test_language(spark, docs, empty):
    rng = np.random.default_rng(0)
    speak = lambda letters: " ".join("".join(rng.choice(list(letters), 5)) for _ in range(30))
    rows = [(i, speak("abcde" if i % 2 else "çéèab"), "xa" if i % 2 else "xb") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learn = language_id.crc_class("doc_id", 4) != 2
    got = {r.doc_id: r for r in language_id.identify(df, language_id.fit(df, learn)).collect()}
    assert all(got[i].lang_pred == lang and 0 <= got[i].score <= 1 for i, _, lang in rows)
    odd = language_id.identify(docs, language_id.fit(df, learn)).collect()
    assert {r.doc_id for r in odd if r.lang_pred == "und"} == {1, 2, 3}
    assert language_id.identify(docs, language_id.fit(empty, learn)).filter("lang_pred <> 'und'").count() == 0


def test_code_lengths_by_hand():
    trees = language_id.Trees({"x": (np.array([97 << 8 | 97, 97]), np.array([1.0, 1.0]))})  # the text "aa"
    # first byte: context 000 saw a once: 1 / (1 + 1)
    assert trees.lengths([b"a"])[0, 0] == pytest.approx(1.0)


def test_rare_long_contexts_keep_their_codes():
    many = np.array([(a << 16 | b << 8 | c) << 8 | 101 for a in range(1, 31) for b in range(1, 31) for c in range(1, 16)])  # 13,500 contexts
    rare = int.from_bytes(b"xyzw")
    trees = language_id.Trees({"big": (many, np.full(len(many), 5.0)), "small": (np.array([rare, rare - 1, int.from_bytes(b"ayzv")]), np.array([1.0, 3.0, 10.0]))})
    # under "small", xyz saw v three times and w once: 1 / (4 + 2); x, y and z are nowhere and cost 8 bits each after the escape of order 0, 2 / (14 + 2)
    assert trees.lengths([b"xyzw"])[0, 1] == pytest.approx(3 * (8 - np.log2(2 / 16)) - np.log2(1 / 6), rel=1e-6)


def test_pieces_round_trip(docs, empty):
    back = sentence_pieces.decode(sentence_pieces.encode(docs, sentence_pieces.model_path()), sentence_pieces.model_path())
    assert back.filter("coalesce(text, '') <> decoded").count() == 0 and back.count() == docs.count()
    got = sentence_pieces.encoded_digest(docs, sentence_pieces.model_path())
    assert got.filter("not round_trip").count() == 0 and got.count() == docs.count()
    assert sentence_pieces.encoded_digest(empty, sentence_pieces.model_path()).count() == 0


def test_toxicity_learns_and_handles_misspelling():
    rng = np.random.default_rng(0)
    say = lambda: " ".join("".join(rng.choice(list("abcdefg"), 6)) for _ in range(40))
    texts = [say() + (" moronic" if i % 2 else "") + " " + say() for i in range(200)]
    table, bias = toxicity.train(texts, [i % 2 for i in range(200)])
    flat, cut = toxicity.subwords([b"moronicc", b"abcdef"])
    value = np.add.reduceat(table[flat], cut[:-1]) / np.diff(cut)
    assert value[0] / toxicity.WINDOW + bias > 0 > value[1] + bias


def test_toxicity_rows(spark, docs, empty):
    got = toxicity.score(docs, (np.zeros(toxicity.BUCKETS), -1.0)).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(empty, (np.zeros(toxicity.BUCKETS), 0.0)).count() == 0


def sets(t, k):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


@pytest.mark.parametrize(("k", "percent"), [(5, 80)])
def test_near_duplicates(spark, docs, empty, k, percent):
    rng = np.random.default_rng(k)
    base = [f"w{i}" for i in rng.integers(0, 999, 120)]
    edited = []
    for _ in range(25):
        w = list(base)
        for j in rng.integers(0, 120, rng.integers(1, 4)):
            w[j] = f"new{rng.integers(999)}"
        edited.append(" ".join(w))
    texts = [*edited, " ".join(base), "x", "X", "", None, "a b c", *[" ".join(f"q{v}" for v in rng.integers(0, 9, 8)) for _ in range(30)]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    s = [sets(t, k) for t in texts]
    top = list(range(len(texts)))
    for _ in texts:
        for a, b in combinations(range(len(texts)), 2):
            if s[a] and s[b] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b]):
                top[a] = top[b] = min(top[a], top[b])
    got = {r.doc_id: r for r in near_duplicates.near_duplicates(df, k, percent).collect()}
    assert [got[i].component_id for i in range(len(texts))] == top
    assert [got[i].n_shingles for i in range(len(texts))] == [len(x) for x in s]
    out = near_duplicates.near_duplicates(docs, k, percent)
    assert out.count() == docs.count() and near_duplicates.near_duplicates(empty, k, percent).count() == 0
    assert near_duplicates.keep_one(docs, k, percent).columns == docs.columns


def test_shards(spark, docs, empty):
    from pyarrow import fs
    from tokenizers import Tokenizer

    path = sentence_pieces.model_path(token_tables.MODEL)
    tok, folder = Tokenizer.from_file(path), shared_dir(spark)
    shards = token_tables.write_shards(docs, folder, path)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    start = 0
    want = []
    for i, t in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, token_tables.read_shards(shards, folder).collect()), key=lambda x: x[1]) == want
    store, base = fs.FileSystem.from_uri(folder)
    found = {}
    for r in shards.collect():
        with store.open_input_file(f"{base}/{r.path}") as f:
            class At:
                size = f.size
                read_at = staticmethod(lambda n, at, f=f: f.read_at(n, at))
            s = token_tables.Shard(At)
            for i in (0, 4, 12, 999, None):
                found.setdefault(i, []).extend(len(x) for x in s.lookup(i))
    assert found[999] == [] and len(found[4]) == 2 and len(found[None]) == 1
    assert token_tables.read_shards(token_tables.write_shards(empty, f"{folder}-e", path), f"{folder}-e").count() == 0


def test_words_encode_apart():
    from tokenizers import Tokenizer

    path = sentence_pieces.model_path(token_tables.MODEL)
    tok = Tokenizer.from_file(path)
    texts = ["It's they're, WE'LL. é, É! ΑΣ. İx, ﬁ. 12,3. x'. y's, 日本。!", "<|ENDOFTEXT|> <|endoftext|>, A.", "é, ́a Á.", None, "", " \t", "ends.", "Starts", "a..,! b?!\x0b;c . ,", "x" * 70 + ". X\u00a0y, z\x1c.", "AbC,\nd"]
    encoder = token_tables.WordEncoder(path)
    for column in (pa.array(texts), pa.array(texts), pa.array(texts).slice(2, 6), pa.array([" ".join(t or "" for t in texts)])):
        flat, at = encoder.encode(column)
        assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [tok.encode(t or "", add_special_tokens=False).ids for t in column.to_pylist()]


def test_decontamination(spark, docs, empty):
    item = "Tom buys 5 apples and 7 pears at the market then Tom sells 5 apples to the baker for 20 euros in cash today"
    bench = spark.createDataFrame([(1, item), (2, "too short"), (3, None)], "item_id long, text string")
    changed = item.replace("5", "8").replace("Tom", "Ann").replace("20", "33")
    broken = item.replace("5 apples and", "8 apples and").replace("7", "5").replace("then Tom", "then Zoe")
    rows = [(1, "Intro here. " + item + " and more"), (2, "so " + changed), (3, "so " + broken.replace("20", "5")), (4, "nothing of the kind is in this text at all today"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in dc.leaks(df, bench).collect()}
    assert {1, 2} <= set(got) <= {1, 2, 3} and got[1].exact and not got[2].exact and got[2].consistency == 1.0
    assert 3 not in got or got[3].consistency < 1
    assert dc.leaks(empty, bench).count() == 0 and dc.leaks(docs, bench).count() == 0
    assert dc.clean(df, bench).count() + len(got) == 5 and dc.clean(docs, bench).columns == docs.columns


def test_decontamination_takes_each_occurrence_alone(spark):
    item = "Tom buys 5 apples and 7 pears at the old market then sells 6 apples to the baker for 20 euros"
    again = "In box 3 she put 4 apples at the old market. In box 5 she put 6 apples at the old market."
    bench = spark.createDataFrame([(1, item), (2, again)], "item_id long, text string")
    change = lambda *v: item.replace("5", v[0]).replace("7", v[1]).replace("6", v[2]).replace("20", v[3])
    two = item + ". " + change("11", "12", "13", "14")
    many = ". ".join(change(*[f"{k}{j}" for j in "1234"]) for k in range(31, 39))
    named = "The boys met and Maria Del Carmen buys 5 apples and 7 pears at the old market then Maria Del Carmen sells 6 apples to the baker for 20 euros"
    mixed = "so " + change("9", "9", "9", "9")  # four values become one
    df = spark.createDataFrame([(1, two), (2, many), (3, "see: " + again), (4, named), (5, mixed)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in dc.leaks(df, bench).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 2), (4, 1)}
    assert got[1, 1].exact and got[1, 1].coverage == got[1, 1].consistency == 1.0 and got[3, 2].exact and not got[2, 1].exact
    assert [r.doc_id for r in dc.clean(df, bench).collect()] == [5]


def test_decontamination_finds_passages_of_long_items(spark):
    rng = np.random.default_rng(3)
    speak = lambda n: ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(n)]
    item = speak(200)
    item[70:130:10] = [str(k) for k in range(41, 47)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    other = [str(int(w) * 7) if w.isdigit() else w for w in item]
    crossed = [str(9 + i % 2) if w.isdigit() else w for i, w in enumerate(item)]
    texts = [item[80:120], item[50:63], item[50:62], other[80:120], crossed[75:115], crossed[71:115] + item[115:119], [*item[62:91], *crossed[91:130]]]
    df = spark.createDataFrame([(i, " ".join([*speak(20), *t, *speak(20)])) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in dc.leaks(df, bench).collect()}
    assert set(got) == {0, 1, 3, 6} and got[0].coverage == pytest.approx(33 / 193, abs=1e-6) and got[0].exact and got[1].n_windows == 6 and not got[3].exact and got[6].exact
    assert [r.doc_id for r in dc.clean(df, bench).orderBy("doc_id").collect()] == [2, 4, 5]


def test_decontamination_finds_items_without_windows(spark):
    table = " ".join(f"{k} kg {k * k} cm" for k in range(11, 31))
    items = ["What is the capital of France?", "12 + 30 = 42", "Who wrote Hamlet?", table, None, ""]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [
        "They asked: What is the capital of France? Nobody knew.", "they asked what is the capital of france today", "so What is the capital of Spain", "what is the capital of trade",
        "we know 12 + 30 = 42 by heart", "12 + 30 = 43", "Who wrote Hamlet?", "Who wrote Macbeth?", "rows " + table + " end", table.replace("400", "401"), None, "", "x " * 3 + table[:60],
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = dc.leaks(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(0, 0), (1, 0), (2, 0), (4, 1), (6, 2), (8, 3)} and len(rows) == 6
    assert {r.doc_id for r in rows if not r.exact} == {2} and all(r.coverage == 1 for r in rows)
    assert [r.doc_id for r in dc.clean(df, bench).orderBy("doc_id").collect()] == [3, 5, 7, 9, 10, 11, 12]


def test_quality_model_paths_agree(spark, docs, empty):
    good = spark.createDataFrame([(9,), (10,), (11,)], "id long")
    near = {r.doc_id: r.perplexity for r in quality_model.quality_model(docs, good).collect()}
    far = {r.doc_id: r.perplexity for r in quality_model.quality_model(docs, good, max_table=0).collect()}
    assert near == pytest.approx(far, rel=1e-6) and near[1] == 1.0 and near[9] < near[12]
    none = quality_model.quality_model(docs, good.limit(0))
    assert none.filter("not kept").count() == 0 and quality_model.quality_model(empty, good).count() == 0


def test_sums_do_not_depend_on_their_neighbours():
    from copperleaf.llm.common import run_sums

    values = np.random.default_rng(3).random((5000, 2)) * 1e6
    at = np.array([0, 0, 7, 7, 1900, 4999, 5000, 5000])
    whole = run_sums(values, at)
    for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
        assert (whole[i] == run_sums(values[a:b], np.array([0, b - a]))[0]).all() and np.allclose(whole[i], values[a:b].sum(0))
    assert run_sums(values[:0], np.array([0, 0])).tolist() == [[0, 0]] and run_sums(values[:, 0], np.array([0, 3])).shape == (1,)


def test_same_results_under_any_partitioning(spark, docs):
    rows = docs.filter("lang is not null").union(docs)  # rows that repeat
    trusted = rows.select("doc_id").withColumnRenamed("doc_id", "id").filter("id % 2 = 0")
    bits = lambda n, table: sorted((r.id is None, r.id or 0, r.n_bytes, r.bits) for r in quality_model.perplexities(rows.repartition(n), trusted, table).collect())
    assert bits(1, quality_model.MAX_TABLE) == bits(16, quality_model.MAX_TABLE) == bits(5, 0)
    from pyspark.sql import functions as F

    trees = language_id.fit(rows, F.lit(True))
    scores = lambda n: sorted((r.doc_id is None, r.doc_id or 0, r.lang_pred, r.score) for r in language_id.identify(rows.repartition(n), trees).collect())
    assert scores(1) == scores(16)
