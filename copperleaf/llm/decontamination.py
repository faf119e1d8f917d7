"""Benchmark decontamination: template windows and consistent slots.

Words of benchmark items and documents are canonicalised: numbers, units and names (capital
words that don't begin a sentence) become typed placeholders, other words lower case
without outer punctuation. Windows of ``WINDOW`` template words are hashed and joined. A
document leaks an item when one occurrence in it holds a sufficient share of the item's
windows and the placeholders' values map one to one there, so that "5 apples ... 5" may
become "7 apples ... 7" but not "7 apples ... 3". Windows with few plain words are left out.

An occurrence is what lies on one diagonal (place in the document less place in the item);
as a name may have more words than the one it replaces, diagonals within ``DRIFT`` of each
other are tried together too. The best occurrence is reported. Whatever share of the item
it is, a passage of ``RUN`` words in a row is a leak too, if the placeholders' values map
one to one in it, or if a part of it of that length repeats the values themselves.

The documents' windows are first probed against a fixed-size table of bits, so that only
windows that may be in the benchmark are joined.

An item without any such window (it is short, or mostly numbers, names and units) is taken
whole, at its own length: a document leaks it when it holds the same words in a row, case
aside, or, where a short item has ``PLAIN`` plain words, the same template with values that
map one to one. Such items' lengths are sent to the tasks. Null or empty texts hold nothing.
A null id is reported like any other, but in ``clean`` each text without an id stands for
itself. Repeated rows count as one document: where one of an id's rows leaks, all go.
Equal items are each reported; of equally good occurrences one is. An empty table of
documents or items gives no rows. Very long texts are read whole: every window of theirs is
probed. Extra columns, whatever their names, stay in ``clean``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from copperleaf.llm.common import WordTable, chunks, documents, narrow, unused, written
from copperleaf.llm.near_duplicates import P, mix

WINDOW = 8
#: Plain words that a window needs.
PLAIN = 4
#: Share of an item's windows, and of its slots' values that map one to one.
COVERAGE, CONSISTENT = 0.25, 0.8
#: Words by which one name may be longer or shorter than the name in its place.
DRIFT = 3
#: Words in a row that are a leak whatever share of the item they are.
RUN = 13
FILTER_BITS = 24

#: What a document's text and an item's text are told by.
PAIR = ("doc_id", "doc_key", "item_id", "item_key")

P_INVERSE = np.uint64(pow(int(P), -1, 1 << 64))

# Words that count as units of measure.
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds lb lbs ton tons ml l litre litres "
    "liter liters second seconds minute minutes hour hours day days week weeks month months year years euro euros dollar dollars cent cents percent degrees".split()
)
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?$")
EDGE = re.compile(r"^\W+|\W+$")


def canonical(words: list[bytes]) -> np.ndarray:
    """For each word: hash of its template, of it as a plain word, of its value; and 1 number, 2 unit, 3 capital, 0 else, +4 at a sentence's end."""
    import xxhash

    out = np.empty((len(words), 3), np.uint64)
    for i, w in enumerate(words):
        text = w.decode()
        bare = EDGE.sub("", text) or text
        low = bare.lower()
        h = xxhash.xxh3_64_intdigest(low)
        kind = 1 if NUMBER.match(bare) else 2 if low in UNITS else 3 if bare[:1].isupper() else 0
        out[i] = h, xxhash.xxh3_64_intdigest(bare), kind + 4 * text.endswith((".", "!", "?", ":"))
    return out


class Words:
    """The words of texts, one after the other: text, low (hash as a plain word), word (hash as a template word), value (0 for plain ones); and where each text's begin."""

    def __init__(self, raw: list[bytes | None], table: WordTable):
        found, self.at = table.values([t.split() if t else [] for t in raw])
        found = np.zeros((0, 3), np.uint64) if found is None else found
        kind = (found[:, 2] & np.uint64(3)).astype(np.int64)
        begins = np.ones(len(found), bool)
        begins[1:] = found[:-1, 2] >= 4
        begins[self.at[:-1][np.diff(self.at) > 0]] = True
        slot = np.where((kind == 3) & begins, 0, kind)
        self.low, self.capital = found[:, 0], kind == 3
        self.word = np.where(slot > 0, slot.astype(np.uint64), found[:, 0])
        self.value = np.where(slot > 0, found[:, 1] | np.uint64(1), np.uint64(0))
        self.plain = np.concatenate([[0], np.cumsum(slot == 0)])
        self.text = np.repeat(np.arange(len(raw)), np.diff(self.at))

    def starts(self, length: int) -> np.ndarray:
        """Where ``length`` words of one text begin."""
        n = max(0, len(self.text) - length + 1)
        return np.flatnonzero(self.text[:n] == self.text[length - 1 :][:n])

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Where windows with enough plain words begin, and their hashes."""
        n = max(0, len(self.word) - WINDOW + 1)
        h = np.zeros(n, np.uint64)
        for j in range(WINDOW):
            h = h * P + self.word[j : j + n]
        ok = self.starts(WINDOW)
        ok = ok[self.plain[ok + WINDOW] - self.plain[ok] >= PLAIN]
        return ok, mix(h[ok])

    def hashed(self) -> None:
        """Sums from which the hash of any run of words follows."""
        n = len(self.low)
        self.power, back = np.cumprod(np.full(n, P)), np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, P_INVERSE)]))[:n]
        self.sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(w * back)]) for w in (self.low, self.word)]

    def exact(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of ``length`` words from each of ``at`` on, case aside."""
        h = (self.sums[0][at + length] - self.sums[0][at]) * self.power[at + length - 1]
        return mix(h * P + np.uint64(length << 1))

    def template(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the templates; the first word counts as a sentence's first."""
        h = (self.sums[1][at + length] - self.sums[1][at + 1]) * self.power[at + length - 1]
        h += np.where(self.capital[at], self.low[at], self.word[at]) * np.uint64(pow(int(P), length, 1 << 64))
        return mix(h * P + np.uint64(length << 1 | 1))


def _passes(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    spot = h >> np.uint64(64 - FILTER_BITS)
    return np.flatnonzero(bits[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8) & 1)


def _item_rows(w: Words) -> list[tuple]:
    """(begins, hashes, words in each, whether slots count) of items' windows; of those without, whole ones, and the first windows of long ones as anchors (0 words)."""
    at, h = w.windows()
    out = [(at, h, WINDOW, True)]
    size = np.diff(w.at)
    bare = np.flatnonzero((size > 0) & (np.bincount(w.text[at], minlength=len(size)) == 0))
    if len(bare):
        w.hashed()
    for length in np.unique(size[bare]).tolist():
        begin = w.at[bare[size[bare] == length]]
        out.append((begin, w.exact(begin, length), length, False))
        if length >= WINDOW:
            out.append((begin, w.exact(begin, WINDOW), 0, False))
        else:
            begin = begin[w.plain[begin + length] - w.plain[begin] >= PLAIN]
            out.append((begin, w.template(begin, length), length, True))
    return out


def _document_rows(w: Words, bits: np.ndarray, lengths: list[int]) -> list[tuple]:
    at, h = w.windows()
    hit = _passes(h, bits)
    out = [(at[hit], h[hit], WINDOW, True)]
    if not lengths or not len(w.low):
        return out
    w.hashed()
    anchors = None
    for length in lengths:
        if length < WINDOW:
            at = w.starts(length)
        else:
            if anchors is None:
                anchors = w.starts(WINDOW)
                anchors = anchors[_passes(w.exact(anchors, WINDOW), bits)]
            at = anchors[anchors + length <= w.at[w.text[anchors] + 1]]
        for hashes, slots in ((w.exact, False), (w.template, True)):
            if not slots or PLAIN <= length < WINDOW:
                h = hashes(at, length)
                hit = _passes(h, bits)
                out.append((at[hit], h[hit], length, slots))
    return out


def _rows(ids: pa.Array, keys: pa.Array, raw: list, table: WordTable, shared: tuple[np.ndarray, list[int]] | None) -> Iterator[pa.RecordBatch]:
    w = Words(raw, table)
    n = np.bincount(w.text[w.windows()[0]], minlength=len(raw)) if shared is None else np.zeros(len(raw), np.int64)
    for k, (at, h, length, slots) in enumerate(_item_rows(w) if shared is None else _document_rows(w, *shared)):
        owner, whole = w.text[at], k > 0  # the first are windows
        width = length if slots else 0
        each = w.value[at[:, None] + np.arange(width)]
        if whole and width:
            each[w.capital[at], 0] = 0
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * width), pa.array(each.view(np.int64).ravel()))
        words = pa.array(np.full(len(at), length if whole else -1), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(owner)), keys.take(pa.array(owner)), pa.array(np.maximum(1, n[owner])), words, pa.array(at - w.at[owner], pa.int32()), pa.array(h.view(np.int64)), lists],
            ["id", "key", "of", "words", "pos", "hash", "slots"],
        )


def template_windows(rows: DataFrame, shared=None) -> DataFrame:
    """id, key (Spark's hash of the text), of (windows of the text), words, pos, hash, slots (the value of each word that is a placeholder, else 0) of the windows of ``rows`` (id, text).

    ``words`` is -1 for windows; the words of a text taken whole; 0 for anchors, which mark
    where a long one may begin. Without ``shared`` the rows are items; with it (table of
    bits, lengths of whole items) they are documents, and only what the bits let through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(canonical)
        for batch, raw in chunks(batches):
            yield from _rows(batch.column("id"), batch.column("key"), raw, table, None if shared is None else shared.value)

    return rows.select("id", "text", F.xxhash64("text").alias("key")).mapInArrow(run, "id long, key long, of long, words int, pos int, hash long, slots array<long>")


def occurrences(hits: DataFrame) -> DataFrame:
    """``hits`` with a row for each occurrence that they may belong to: ``kind``, its diagonal ``line`` (0 for several) and its number ``part`` there."""
    hits = hits.withColumn("diagonal", F.col("pos") - F.col("item_pos"))
    far = F.col("diagonal") - F.lag("diagonal").over(Window.partitionBy(*PAIR).orderBy("diagonal")) > DRIFT
    hits = hits.withColumn("far", far.cast("int")).withColumn("cluster", F.sum(F.coalesce("far", F.lit(0))).over(Window.partitionBy(*PAIR).orderBy("diagonal")))
    # passages: windows that overlap or touch, and among them those that repeat the values too
    hits = hits.withColumn("same", F.col("slots") == F.col("item_slots"))
    for name, by in (("passage", [*PAIR, "diagonal"]), ("copied", [*PAIR, "diagonal", "same"])):
        order = Window.partitionBy(*by).orderBy("item_pos")
        hits = hits.withColumn("far", (F.col("item_pos") - F.lag("item_pos").over(order) > WINDOW).cast("int"))
        hits = hits.withColumn("far", F.coalesce("far", F.lit(0))).withColumn(name, F.sum("far").over(order))
    line, none = F.col("diagonal"), F.lit(0)
    kinds = {"diagonal": (line, none), "cluster": (none, F.col("cluster")), "passage": (line, F.col("passage")), "copied": (line, F.when(F.col("same"), F.col("copied")))}
    parts = [F.struct(F.lit(k).alias("kind"), at.cast("long").alias("line"), n.cast("long").alias("part")) for k, (at, n) in kinds.items()]
    return hits.withColumn("o", F.explode(F.array(*parts))).select("*", "o.*").filter("part is not null")


def rated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, consistent: float = CONSISTENT, run: int = RUN) -> DataFrame:
    """The occurrences that are leaks: doc_id, doc_key, item_id, n_windows (of the item, found), coverage, consistency, exact."""
    spark = docs.sparkSession
    items = written(template_windows(narrow(benchmark, "item_id")).withColumnsRenamed({"id": "item_id", "key": "item_key", "pos": "item_pos", "slots": "item_slots"}))
    spots = items.select(F.shiftrightunsigned("hash", 64 - FILTER_BITS).alias("s")).distinct().toArrow()  # at most 2 ** FILTER_BITS
    spots = np.asarray(spots["s"], np.int64)
    bits = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
    np.bitwise_or.at(bits, spots >> 3, (1 << (spots & 7)).astype(np.uint8))
    lengths = [r.words for r in items.filter("words > 0").select("words").distinct().orderBy("words").collect()]
    found = template_windows(narrow(docs), spark.sparkContext.broadcast((bits, lengths))).drop("of").withColumnsRenamed({"id": "doc_id", "key": "doc_key"})  # 2 MB
    hits = occurrences(written(found.join(items.filter("words <> 0").distinct(), ["hash", "words"]).drop("hash", "words").distinct()))
    one = [*PAIR, "kind", "line", "part"]
    seen = hits.groupBy(*one).agg(F.count_distinct("item_pos").alias("n_windows"), F.first("of").alias("of"), (F.max("item_pos") - F.min("item_pos") + WINDOW).alias("n_words"))
    pairs = hits.select(*one, F.explode(F.arrays_zip("item_slots", "slots")).alias("p")).filter("p.item_slots <> 0").groupBy(*one, F.col("p.item_slots").alias("was"), F.col("p.slots").alias("now")).agg(F.count("*").alias("n"))
    held = lambda side: pairs.groupBy(*one, side).agg(F.max("n").alias("best"), F.sum("n").alias("n"), F.sum(F.when(F.col("was") == F.col("now"), F.col("n")).otherwise(0)).alias("same") if side == "was" else F.lit(0).alias("same"))
    slots = held("was").select(*one, F.lit(1).alias("side"), "best", "n", "same").unionByName(held("now").select(*one, F.lit(2).alias("side"), "best", "n", "same")).groupBy(*one).agg(
        F.least(*[F.sum(F.when(F.col("side") == k, F.col("best"))) / F.sum(F.when(F.col("side") == k, F.col("n"))) for k in (1, 2)]).alias("consistency"),
        (F.sum("same") == F.sum(F.when(F.col("side") == 1, F.col("n")))).alias("exact"),
    )
    both = seen.withColumn("consistency", F.lit(None).cast("double")).withColumn("exact", F.lit(None).cast("boolean")).unionByName(slots, allowMissingColumns=True)
    each = both.groupBy(*one).agg(*[F.max(c).alias(c) for c in ("n_windows", "of", "n_words", "consistency", "exact")]).select(
        "doc_id", "doc_key", "item_id", "kind", "n_words", "n_windows", F.round(F.col("n_windows") / F.col("of"), 6).alias("coverage"),
        F.round(F.coalesce("consistency", F.lit(1.0)), 6).alias("consistency"), F.coalesce("exact", F.lit(True)).alias("exact"),
    )
    enough = (F.col("coverage") >= coverage) | F.col("kind").isin("passage", "copied") & (F.col("n_words") >= run)
    return each.filter(enough & (F.col("consistency") >= consistent))


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, consistent: float = CONSISTENT, run: int = RUN) -> DataFrame:
    """A row for each document and item that it leaks, of the best occurrence: doc_id, item_id, n_windows (of the item, found), coverage, consistency, exact."""
    best = rated(docs, benchmark, coverage, consistent, run).groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", "exact", "consistency", "n_windows")).alias("b"))
    return best.select("doc_id", "item_id", "b.n_windows", "b.coverage", "b.consistency", "b.exact")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no item, with all their columns."""
    bad, own = unused(docs, "bad"), unused(docs, "own")
    # a text without id is known by its hash
    of_text = lambda doc_id, key: F.when(doc_id.isNull(), key).otherwise(0)
    gone = written(rated(docs, benchmark).select(F.col("doc_id").alias(bad), of_text(F.col("doc_id"), F.col("doc_key")).alias(own)).distinct())
    doc_id = F.col("doc_id").cast("long")
    rest = docs.join(gone, doc_id.eqNullSafe(F.col(bad)) & (of_text(doc_id, F.xxhash64(F.col("text").cast("string"))) == F.col(own)), "left_anti")
    return rest.select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
