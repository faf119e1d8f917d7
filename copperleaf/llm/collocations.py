"""Phrase collocations: phrases of two and three words that occur often and more often than their parts suggest.

Counting goes level by level, and only over what the level before leaves (a phrase is no more
frequent than its parts). Words are counted first; the frequent ones get numbers, the most
frequent one 0, and texts are written once as arrays of numbers. A window of two numbers is a
pair; frequent pairs are put into double-array tries of at most ``MAX_PAIRS`` pairs, which are
broadcast one after the other. Over an array of numbers a trie takes all positions at once:
the first word gives each position's state, then the upper and the lower ten bits of the next
word's number lead to the next states, and where a state and the one at the next position
both accept, three words follow each other whose pairs are frequent. States are counted
sparsely in each task (an accepting state and the word that follows make one number), as which of
them are candidates of the next level is only known by these counts; shards' counts are then
summed by shuffle. With several tries the second pair is only looked up in the first one's
trie; where it belongs to another, the window is counted without having been looked up, so
nothing is lost.

Up to ``MAX_WORDS`` words (2^20; all words above a count that lets no more in) have numbers,
so a trie's alphabet and what is broadcast are bounded. Phrases with a frequent word that has none are
counted as texts in the same pass; a map of 16 MB, whatever the input, tells those words from
rare ones. Words are told apart by 64-bit hashes inside tasks and by themselves between them.

Null text is empty, null lang ``und``. Repeated rows count as often as they occur. Very long
texts are whole, in slices of their own. Ties in rank are broken by the phrase, which is
unique in its language. An empty table gives an empty result. Only the named columns are
read, whatever others there are.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from copperleaf.llm.common import documents, narrow, written
from copperleaf.llm.hashed import HashIndex, hashes, remembered, slices, text_bytes

MIN_COUNT, KEEP_PERCENT, TOP = 10, 50, 2000
#: Parts into which a language's phrases are dealt before they are ranked together.
SALTS = 16
#: Words with numbers and bits of a number; pairs of a trie; bits of the map of words without.
WORD_BITS, LOW_BITS, MAP_BITS = 20, 10, 27
MAX_WORDS, MAX_PAIRS = 1 << WORD_BITS, 1 << 21
#: Words that a task counts before it starts anew, windows that it gathers before it counts them, rows of a batch that it hands on, and bytes of text that it takes at a time.
MEMO, WINDOWS, BATCH, SLICE = 1 << 18, 1 << 20, 1 << 16, 1 << 19
#: Bytes that end a piece, bytes between words.
BREAKS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
UNKNOWN = "und"


def words_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, begin and end of each word, its row, and whether it goes on the piece of the word before."""
    data, at = text_bytes(batch.column("text"))
    data = data + np.uint8(32) * ((data >= 65) & (data <= 90))
    kinds = np.ones(256, np.uint8)
    kinds[list(BLANKS)], kinds[list(BREAKS)] = 0, 2
    kind = kinds[data]
    solid = np.zeros(len(data) + 2, np.int8)
    solid[1:-1] = kind == 1
    begin = np.flatnonzero(np.diff(solid) == 1)
    end = np.flatnonzero(np.diff(solid) == -1)
    inner = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
    joint = np.unique(inner[(solid[inner] == 1) & (solid[inner + 1] == 1)]) if len(inner) else inner  # two rows' words touch
    begin, end = np.sort(np.concatenate([begin, joint])), np.sort(np.concatenate([end, joint]))
    row = np.searchsorted(at, begin, "right") - 1
    breaks = np.append(0, np.cumsum(kind == 2))
    follows = np.zeros(len(begin), bool)
    follows[1:] = (row[1:] == row[:-1]) & (breaks[begin[1:]] == breaks[end[:-1]])
    return data, begin, end, row, follows


def _langs(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray]:
    langs = [x if x is not None else UNKNOWN for x in batch.column("lang").to_pylist()]
    return langs, np.array([zlib.crc32(x.encode()) | len(x) << 32 for x in langs], np.uint64)


def _batches(columns: list, types: list, names: list[str]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(columns[0]), BATCH):
        yield pa.RecordBatch.from_arrays([pa.array(c[i : i + BATCH], t) for c, t in zip(columns, types, strict=True)], names)


def count_words(docs: DataFrame) -> DataFrame:
    """lang, word, n and the word's hash, for all words of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh() -> tuple[HashIndex, np.ndarray, list, list]:
            return HashIndex(), np.zeros(0, np.int64), [], []

        def rows() -> Iterator[pa.RecordBatch]:
            hashed = np.zeros(index.used, np.int64)
            there = index.keys != 0
            hashed[index.row[there]] = index.keys[there].view(np.int64)
            yield from _batches([langs, spelt, counts[: index.used], hashed], [pa.string(), pa.string(), pa.int64(), pa.int64()], ["lang", "word", "n", "hash"])

        index, counts, langs, spelt = fresh()
        for b in slices(batches, SLICE):
            data, begin, end, row, _ = words_of(b)
            names, marks = _langs(b)
            h = hashes(data, begin, end, marks[row])
            at = index.find(h)
            missing = np.flatnonzero(at < 0)
            if len(missing):
                _, first = np.unique(h[missing], return_index=True)
                first, raw = missing[first], data.tobytes()
                index.add(h[first])
                langs += [names[r] for r in row[first]]
                spelt += [raw[i:j].decode() for i, j in zip(begin[first], end[first], strict=True)]
                at[missing] = index.find(h[missing])
            seen = np.bincount(at, minlength=index.used)
            seen[: len(counts)] += counts
            counts = seen
            if index.used > MEMO:
                yield from rows()
                index, counts, langs, spelt = fresh()
        yield from rows()

    # counted in the tasks, so there is nothing that Spark could combine before the shuffle
    return docs.mapInArrow(run, "lang string, word string, n long, hash long").repartition("lang", "word").groupBy("lang", "word").agg(F.sum("n").alias("n"), F.max("hash").alias("hash"))


class Vocabulary:
    """Numbers of the words that have one, by their hashes, and a map of bits in which frequent words without one are set."""

    def __init__(self, numbered: np.ndarray, rest: np.ndarray | None):
        self.numbered, self.rest, self.name = numbered, rest, uuid.uuid4().hex

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Each word's number; -1 for rare words, -2 for frequent ones without a number (and a few rare ones)."""

        def make() -> HashIndex:
            index = HashIndex(1 << max(4, int(2 * len(self.numbered)).bit_length()))
            index.add(self.numbered)
            return index

        out = remembered(f"vocabulary {self.name}", make).find(h)
        if self.rest is not None:
            bit = h & np.uint64((1 << MAP_BITS) - 1)
            out[(out < 0) & (self.rest[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1 == 1)] = -2
        return out


def vocabulary(words: DataFrame, max_words: int = MAX_WORDS) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary, and number, lang, word of those with a number (``max_words`` at most, the driver sees them)."""
    spark = words.sparkSession
    steps = [MIN_COUNT << k for k in range(40)]
    fit = words.agg(*[F.count_if(F.col("n") >= s).alias(str(k)) for k, s in enumerate(steps)]).first()
    cut = next(s for k, s in enumerate(steps) if fit[k] <= max_words)
    table = words.filter(F.col("n") >= cut).select("lang", "word", "n", "hash").toArrow().sort_by([("n", "descending"), ("lang", "ascending"), ("word", "ascending")])
    numbered = table["hash"].to_numpy().view(np.uint64)
    named = spark.createDataFrame(pa.table({"number": pa.array(np.arange(len(numbered)), pa.int64()), "lang": table["lang"], "word": table["word"]})) if len(numbered) else spark.createDataFrame([], "number long, lang string, word string")
    rest = None
    if fit[0] > len(numbered):
        spot = F.pmod(F.col("hash"), F.lit(1 << MAP_BITS))
        parts = words.filter((F.col("n") >= MIN_COUNT) & (F.col("n") < cut)).select(F.shiftright(spot, 15).alias("bucket"), (spot % (1 << 15)).alias("bit"))
        maps = parts.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map")).collect()  # 4 KB a row, 4096 rows at most
        rest = np.zeros((1 << MAP_BITS - 15, 1 << 12), np.uint8)
        for m in maps:
            rest[m["bucket"]] = np.frombuffer(m["map"], np.uint8)
        rest = rest.ravel()
    return Vocabulary(numbered, rest), written(named)


def numbered_texts(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """ids: arrays of word numbers with -1 where nothing goes on; beside them, in rows without ids, phrases with a word that has no number (size words, n times)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, SLICE):
            data, begin, end, row, follows = words_of(b)
            names, marks = _langs(b)
            number = shared.value.numbers(hashes(data, begin, end, marks[row]))
            ids = np.full(len(number) + int((~follows).sum()), -1, np.int32)
            ids[np.arange(len(number)) + np.cumsum(~follows)] = np.maximum(number, -1)
            ids = ids[(ids >= 0) | np.append(True, ids[:-1] >= 0)]
            rest: Counter = Counter()
            if (number == -2).any():
                raw = data.tobytes()
                for size in (2, 3):
                    fits = number[size - 1 :] != -1
                    for k in range(1, size):
                        fits &= (number[size - 1 - k : -k] != -1) & follows[size - k : len(follows) - k + 1]
                    some = np.logical_or.reduce([number[k : len(number) - size + 1 + k] == -2 for k in range(size)]) if len(number) >= size else np.zeros(0, bool)
                    for i in np.flatnonzero(fits & some):
                        rest[names[row[i]], b" ".join(raw[begin[j] : end[j]] for j in range(i, i + size)).decode(), size] += 1
            keys = list(rest)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids.tobytes()] + [None] * len(keys), pa.binary()), pa.array([None] + [k[0] for k in keys], pa.string()), pa.array([None] + [k[1] for k in keys], pa.string()),
                    pa.array([None] + [k[2] for k in keys], pa.int32()), pa.array([None] + list(rest.values()), pa.int64()),
                ], ["ids", "lang", "phrase", "size", "n"],
            )

    return docs.mapInArrow(run, "ids binary, lang string, phrase string, size int, n long")


def counted(ids: DataFrame, windows) -> DataFrame:
    """key and n, MIN_COUNT or more, of what ``windows`` makes of each array of numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        size = 0

        def rows() -> Iterator[pa.RecordBatch]:
            keys, n = np.unique(np.concatenate(waiting), return_counts=True)
            yield from _batches([keys, n], [pa.int64(), pa.int64()], ["key", "n"])

        for b in batches:
            for x in b.column("ids"):
                waiting.append(windows(np.frombuffer(x.as_buffer(), np.int32)))
                size += len(waiting[-1])
                if size > WINDOWS:
                    yield from rows()
                    waiting, size = [], 0
        if waiting:
            yield from rows()

    return ids.mapInArrow(run, "key long, n long").repartition("key").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def pair_windows(ids: np.ndarray) -> np.ndarray:
    a, b = ids[:-1].astype(np.int64), ids[1:].astype(np.int64)
    both = (a >= 0) & (b >= 0)
    return a[both] << WORD_BITS | b[both]


class DoubleArrayTrie:
    """Pairs of numbers: the first one's children are the upper bits of the second, theirs the lower bits.

    A row of children stands at its base plus each child's symbol, between other rows'
    cells; ``check`` names the cell's owner.
    """

    def __init__(self, pairs: np.ndarray):
        """``pairs``: first << WORD_BITS | second, sorted and distinct."""
        upper = pairs >> LOW_BITS  # first and upper bits: the inner nodes
        inner, inner_at, inner_size = np.unique(upper, return_index=True, return_counts=True)
        first, first_at, first_size = np.unique(inner >> (WORD_BITS - LOW_BITS), return_index=True, return_counts=True)
        symbols = np.concatenate([inner & ((1 << WORD_BITS - LOW_BITS) - 1), pairs & ((1 << LOW_BITS) - 1)]).astype(np.int64)
        at, size = np.concatenate([first_at, len(inner) + inner_at]), np.concatenate([first_size, inner_size])
        base = self._place(symbols, at, size)
        self.first = np.zeros(1 << WORD_BITS, np.int32)
        self.first[first] = base[: len(first)]
        inner_cell = np.repeat(base[: len(first)], first_size) + symbols[: len(inner)]
        self.base[inner_cell], self.check[inner_cell] = base[len(first) :], np.repeat(first, first_size)
        cell = np.repeat(base[len(first) :], inner_size) + symbols[len(inner) :]
        self.check[cell] = (1 << WORD_BITS) + np.repeat(inner_cell, inner_size)

    def _place(self, symbols: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """A base for each row of symbols: long rows first, each where all its cells are free; rows of one symbol take what is left."""
        edge = 1 << max(LOW_BITS, WORD_BITS - LOW_BITS)
        used = np.zeros(int(1.5 * len(symbols)) + 64 * edge, bool)
        used[:edge] = True
        base = np.zeros(len(size), np.int64)
        order = np.argsort(-size, kind="stable")
        tries, start = 32, edge
        for r in order[: int((size > 1).sum())]:
            row = symbols[at[r] : at[r] + size[r]]
            place = start
            while True:
                if place + 2 * edge + 1024 > len(used):
                    used = np.append(used, np.zeros(len(used), bool))
                free = place + np.flatnonzero(~used[place : place + 1024])[:tries]
                fit = ~used[(free - row[0])[:, None] + row].any(axis=1)
                if fit.any():
                    spot = free[fit.argmax()] - row[0]
                    break
                place = start = int(free[-1]) + 1 if len(free) else place + 1024  # what lies before is too full for rows as long as this
            base[r] = spot
            used[spot + row] = True
        alone = order[int((size > 1).sum()) :]
        free = np.flatnonzero(~used)
        if len(free) < len(alone):
            free = np.append(free, np.arange(len(used), len(used) + len(alone) - len(free)))
        base[alone] = free[: len(alone)] - symbols[at[alone]]
        cells = int(max(len(used), (free[len(alone) - 1] if len(alone) else 0) + 1)) + 2 * edge
        self.base, self.check = np.zeros(cells, np.int32), np.full(cells, -1, np.int32)
        return base

    def accepts(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For all positions at once: whether the pair (a, b) is there."""
        cell = self.first[a] + (b >> LOW_BITS)
        ok = np.flatnonzero(self.check[cell] == a)
        cell = cell[ok]
        leaf = self.base[cell] + (b[ok] & ((1 << LOW_BITS) - 1))
        out = np.zeros(len(a), bool)
        out[ok[self.check[leaf] == (1 << WORD_BITS) + cell]] = True
        return out


def triple_windows(shared, tries: int, turn: int):
    """Windows of three whose first pair is in the trie, and the second too where this trie is the one to know."""

    def windows(ids: np.ndarray) -> np.ndarray:
        trie = shared.value
        at = np.flatnonzero((ids[:-2] >= 0) & (ids[1:-1] >= 0) & (ids[2:] >= 0)) if len(ids) > 2 else np.zeros(0, np.int64)
        at = at[ids[at] % tries == turn]
        at = at[trie.accepts(ids[at], ids[at + 1])]
        at = at[(ids[at + 1] % tries != turn) | trie.accepts(ids[at + 1], ids[at + 2])]
        a, b, c = (ids[at + k].astype(np.int64) for k in range(3))
        return a << 2 * WORD_BITS | b << WORD_BITS | c

    return windows


def phrase_counts(docs: DataFrame, max_words: int = MAX_WORDS, max_pairs: int = MAX_PAIRS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (all), pairs and triples (frequent ones): lang, w1 to w3 and n."""
    spark = docs.sparkSession
    words = written(count_words(docs))
    vocab, named = vocabulary(words, max_words)
    texts = written(numbered_texts(docs, vocab))
    ids, rest = texts.filter("ids is not null").select("ids"), texts.filter("ids is null")
    two = written(counted(ids, pair_windows))
    tries = max(1, -(-two.count() // max_pairs))
    three = None
    for turn in range(tries):
        keys = two.filter((F.shiftright("key", WORD_BITS) % tries) == turn).select("key").toArrow()["key"].to_numpy()
        found = counted(ids, triple_windows(spark.sparkContext.broadcast(DoubleArrayTrie(np.sort(keys))), tries, turn))
        three = found if three is None else three.unionByName(found)
    three = written(three)

    def spelt(counts: DataFrame, size: int) -> DataFrame:
        for k in range(size):
            part = F.shiftright("key", WORD_BITS * (size - 1 - k)) % (1 << WORD_BITS)
            counts = counts.withColumn("number", part).join(named.select("number", F.col("word").alias(f"w{k + 1}"), *(["lang"] if k == 0 else [])), "number").drop("number")
        others = rest.filter(F.col("size") == size).groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)
        part = F.split("phrase", " ")
        return written(counts.select("lang", *[f"w{k + 1}" for k in range(size)], "n").unionByName(others.select("lang", *[F.get(part, k).alias(f"w{k + 1}") for k in range(size)], "n")))

    return words.select("lang", F.col("word").alias("w1"), "n"), spelt(two, 2), spelt(three, 3)


def _score(left: str, right: str) -> str:
    return f"(cast(1000000 * cast(a AS decimal(20,0)) AS decimal(20,0)) * cast(a AS decimal(18,0))) div (cast({left} AS decimal(19,0)) * cast({right} AS decimal(19,0)))"


def collocations(docs: DataFrame, lang_col: str = "lang", top: int = TOP, max_words: int = MAX_WORDS, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a (its count), l and r (of its parts at the lowest-scoring cut), n (words of the language), score."""
    one, two, three = phrase_counts(narrow(docs, "doc_id", "text", F.col(lang_col).cast("string").alias("lang")), max_words, max_pairs)
    totals = one.groupBy("lang").agg(F.sum("n").alias("words"))
    known = one.filter(F.col("n") >= MIN_COUNT)

    def part(table: DataFrame, name: str, *columns: str) -> DataFrame:
        return table.select("lang", *[F.col(f"w{k + 1}").alias(c) for k, c in enumerate(columns)], F.col("n").alias(name))

    longer = three.select("lang", "w1", "w2", "n").unionByName(three.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "n")).groupBy("lang", "w1", "w2").agg(F.max("n").alias("longer"))
    alone = two.join(longer, ["lang", "w1", "w2"], "left").filter(F.coalesce(100 * F.col("longer") < KEEP_PERCENT * F.col("n"), F.lit(True)))
    pairs = alone.join(part(known, "l", "w1"), ["lang", "w1"]).join(part(known, "r", "w2"), ["lang", "w2"]).withColumn("a", F.col("n"))
    pairs = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", F.expr(_score("l", "r")).alias("score"))
    cuts = three.join(part(known, "l1", "w1"), ["lang", "w1"]).join(part(two, "r1", "w2", "w3"), ["lang", "w2", "w3"])
    cuts = cuts.join(part(two, "l2", "w1", "w2"), ["lang", "w1", "w2"]).join(part(known, "r2", "w3"), ["lang", "w3"]).withColumn("a", F.col("n"))
    cuts = cuts.select("*", F.expr(_score("l1", "r1")).alias("s1"), F.expr(_score("l2", "r2")).alias("s2"))
    low = lambda x, y: F.when(F.col("s1") <= F.col("s2"), F.col(x)).otherwise(F.col(y))
    triples = cuts.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", low("l1", "l2").alias("l"), low("r1", "r2").alias("r"), low("s1", "s2").alias("score"))
    def best(rows: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
        return rows.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)

    # the first ones of each salt first, so that a language's last task gets SALTS * top rows at most
    dealt = pairs.unionByName(triples).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    best = best(best(dealt, "lang", "salt").drop("rank"), "lang")
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL = rf"""
WITH p AS (SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
one AS (SELECT lang, x AS phrase, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM w) GROUP BY 1, 2),
total AS (SELECT lang, sum(f)::bigint AS n FROM one GROUP BY 1),
two AS (SELECT lang, w1, w2, count(*) AS f FROM (SELECT lang, w[i] AS w1, w[i + 1] AS w2 FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM w)) GROUP BY ALL HAVING f >= {MIN_COUNT}),
three AS (SELECT lang, w1, w2, w3, count(*) AS f FROM (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM w)) GROUP BY ALL HAVING f >= {MIN_COUNT}),
longer AS (SELECT lang, w1, w2, max(f) AS longer FROM (SELECT lang, w1, w2, f FROM three UNION ALL SELECT lang, w2, w3, f FROM three) GROUP BY ALL),
cut AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, 1 AS k, t.f AS a, x.f AS l, y.f AS r FROM two AS t LEFT JOIN longer AS m ON m.lang = t.lang AND m.w1 = t.w1 AND m.w2 = t.w2
    JOIN one AS x ON x.lang = t.lang AND x.phrase = t.w1 JOIN one AS y ON y.lang = t.lang AND y.phrase = t.w2 WHERE m.longer IS NULL OR 100 * m.longer < {KEEP_PERCENT} * t.f
  UNION ALL SELECT t.lang, concat_ws(' ', t.w1, t.w2, t.w3), 1, t.f, x.f, y.f FROM three AS t JOIN one AS x ON x.lang = t.lang AND x.phrase = t.w1 JOIN two AS y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL SELECT t.lang, concat_ws(' ', t.w1, t.w2, t.w3), 2, t.f, x.f, y.f FROM three AS t JOIN two AS x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN one AS y ON y.lang = t.lang AND y.phrase = t.w3),
scored AS (SELECT *, ((1000000::hugeint * a * a) // (l::hugeint * r))::bigint AS score FROM cut),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest) JOIN total USING (lang) WHERE rank <= {TOP}
"""
