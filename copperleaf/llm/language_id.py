"""Language ID: prediction by partial matching over bytes.

For each language a tree of byte contexts (up to ``ORDER`` bytes) holds frozen counts.
A symbol's code length comes from the longest context in the language's tree: a seen
symbol has its share of the context's count, an unseen one pays the escape (method C)
and the next shorter context's code. The language with the shortest code of the whole
text wins. A tree is sorted tables of what the training texts hold: each seen context and
byte with its code, each context with its escape. Look-ups are made once for each distinct
window of a slice of texts.

Null text, or text without any letter: ``und`` with score 0. Without training rows every
text is ``und``. Of equally short codes the first language by name wins. Repeated rows each
get their own result, very long texts are coded whole, an empty table gives an empty result.
Only the named columns are read, whatever others there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copperleaf.llm.common import chunks, documents, narrow, run_sums, starts

ORDER = 3
#: Training texts for each language, chosen by a hash of the text.
SAMPLE = 400


def crc_class(column: str, n: int):
    """Column: crc32 of the id as text, modulo n."""
    return F.crc32(F.col(column).cast("string")) % n


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of four-byte windows (three zero bytes before each text) by language in this task."""
    for batch, raw in chunks(batches):
        langs = batch.column("lang").to_pylist()
        for lang in sorted(set(langs)):
            data = np.frombuffer(b"".join(b"\0\0\0" + t for t, x in zip(raw, langs, strict=True) if x == lang and t), np.uint8).astype(np.uint32)
            if len(data) > 3:
                keys, n = np.unique(data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:], return_counts=True)
                real = keys & 255 > 0  # windows that end in the padding
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * int(real.sum())), pa.array(keys[real].astype(np.int64)), pa.array(n[real].astype(np.int64))], ["lang", "gram", "n"]
                )


def _tree(key: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each order from 0 up: seen windows and their codes' bits, contexts and their escapes' bits."""
    out = []
    for order in range(ORDER + 1):
        seen, back = np.unique(key & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
        count = np.bincount(back, n)
        contexts, row = np.unique(seen >> 8, return_inverse=True)
        kinds = np.bincount(row)
        total = np.bincount(row, count) + kinds
        out.append((seen, -np.log2(count / total[row]), contexts, -np.log2(kinds / total)))
    return out


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the wanted numbers stand in a sorted table, and whether they do."""
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


class Trees:
    """langs, and the tree of each."""

    def __init__(self, grams: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(grams)
        self.trees = [_tree(*grams[lang]) for lang in self.langs]

    def codes(self, windows: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each window (row) under each language (column)."""
        bits = np.zeros((len(windows), len(self.langs)))
        for j, tree in enumerate(self.trees):
            todo = np.arange(len(windows))
            for order in range(ORDER, -1, -1):
                seen, code, contexts, escape = tree[order]
                short = windows[todo] & ((1 << 8 * (order + 1)) - 1)
                at, known = _find(seen, short)
                bits[todo[known], j] += code[at[known]]
                todo, short = todo[~known], short[~known]
                at, known = _find(contexts, short >> 8)
                bits[todo[known], j] += escape[at[known]]
            bits[todo, j] += 8  # a byte that the tree has nowhere
        return bits

    def lengths(self, raw: list[bytes]) -> np.ndarray:
        """Code length in bits of each text (row) under each language (column)."""
        at = starts(np.fromiter(map(len, raw), np.int64, len(raw)))
        data = np.frombuffer(b"".join(b"\0\0\0" + t for t in raw), np.uint8).astype(np.int64)
        real = np.ones(len(data), bool)
        heads = at[:-1] + 3 * np.arange(len(raw))
        for k in range(3):
            real[heads + k] = False
        windows = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
        windows, back = np.unique(windows[real[3:]], return_inverse=True)
        return run_sums(self.codes(windows)[back], at)


def fit(docs: DataFrame, learn, sample: int = SAMPLE, text_col: str = "text", lang_col: str = "lang") -> Trees:
    """Trees from about ``sample`` texts of each language among the rows where ``learn`` holds."""
    rows = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    if not counts:
        return Trees({})
    share = F.element_at(F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, sample / n)]), F.col("lang"))
    drawn = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) / 1_000_003 < share)
    grams = drawn.mapInArrow(_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    return Trees({lang: (g["gram"].to_numpy(np.int64), g["n"].to_numpy(np.float64)) for lang, g in grams.groupby("lang")})


def identify(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, lang_pred, score: the winner's share of 2 ** -bits, over at most 64 bytes' worth of evidence."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(trees))  # bounded by the sample

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Trees({})
        vars(model).update(shared.value)
        for batch, raw in chunks(batches):
            texts = [t or b"" for t in raw]
            letters = np.array([any(map(str.isalpha, t.decode())) for t in texts], bool)
            if model.langs:
                bits = model.lengths(texts)
                size = np.maximum(1, np.fromiter(map(len, texts), np.int64, len(texts)))
                best = bits.argmin(1)
                gap = (bits - bits.min(1, keepdims=True)) * (np.minimum(size, 64) / size)[:, None]
                score = np.where(letters, 1 / np.exp2(-np.minimum(gap, 1000)).sum(1), 0.0)
                langs = [model.langs[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]
            else:
                langs, score = ["und"] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(langs, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return narrow(docs).mapInArrow(predict, "doc_id long, lang_pred string, score double")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(crc_class("doc_id", 4) == 2, F.lit(False))
    found = identify(docs, fit(docs, crc_class("doc_id", 4) != 2))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
