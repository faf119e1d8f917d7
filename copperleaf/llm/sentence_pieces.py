"""SentencePiece encoding and decoding with a batched numpy Viterbi.

The model file is of the merging kind: pieces are merged in the order of their scores. Its
result is the one way to cut a text such that any two neighbouring pieces, merged by
themselves, stay these two pieces; and a text's beginnings are cut likewise. So a Viterbi
finds it: for each end position the last piece is the one that fits the last piece of the
beginning before it. Distinct words (cut before each run of spaces; no piece spans such a
cut) of equal length advance together, one end position at a time: rolling hashes of the
substrings that end there probe the sorted hashes of the pieces, each candidate scores 1 if
it fits and 0 if not, and the vectorised maximum is kept as a back pointer. A character
without a piece becomes its UTF-8 bytes' pieces. The ids equal the library's.

Whether two pieces fit is told by undoing their merges, the latest first, and asking whether
two parts that then touch would have been merged before.

A word longer than ``LONG`` is cut into overlapping segments that advance together as
words of equal length do. Each segment starts anew a little before its place; where its
last pieces there equal those that the segment before it ends with, both go on alike (a
position depends on as many positions before it as the longest piece has characters), else
it is run again from that state. So memory for a word is a few bytes a character.

Decoding joins the pieces' bytes, so it gives back every text, literal U+2581 included.
Null text encodes as empty: no pieces. Repeated rows each get their own result, an empty
table gives an empty result, and only the named columns are read, whatever others there are.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copperleaf.llm.common import ListTable, chunks, documents, narrow, starts

MODEL = "piece_bpe_32k.model"
WORD = re.compile(r" *[^ ]+| +")
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Words times positions that advance together, bits of the table that tells which hashes can be a piece's, bytes of text in a slice.
CELLS = 200_000
MAYBE_BITS = 21
SLICE_BYTES = 2 << 20
#: Words, and places for pairs of pieces (a power of 2), that a task remembers.
MEMO_WORDS, PAIR_BITS = 400_000, 20
#: Words beyond LONG characters are cut into segments of SEGMENT characters that start WARM characters early.
LONG, SEGMENT, WARM = 640, 256, 64
#: Last pieces that are none: a character without a piece, and the beginning of a word.
BARE, BEGIN = -1, -2


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _mix(codes: np.ndarray) -> np.ndarray:
    x = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def merge(text: str, rank: dict[str, int]) -> list[tuple[str, tuple[str, str] | None]]:
    """The pieces of a text by merging neighbours, the lowest rank (then the leftmost) first; each with the two parts of its last merge."""
    parts: list[tuple[str, tuple[str, str] | None] | None] = [(c, None) for c in text]
    right, left = list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
    queue: list[tuple[int, int, str, str]] = []

    def offer(i: int) -> None:
        j = right[i] if i >= 0 else len(parts)
        if j < len(parts) and (r := rank.get(parts[i][0] + parts[j][0])) is not None:
            heapq.heappush(queue, (r, i, parts[i][0], parts[j][0]))

    for i in range(len(text) - 1):
        offer(i)
    while queue:
        _, i, a, b = heapq.heappop(queue)
        j = right[i]
        if parts[i] is None or parts[i][0] != a or j >= len(parts) or parts[j][0] != b:
            continue
        parts[i], parts[j], right[i] = (a + b, (a, b)), None, right[j]
        if right[i] < len(parts):
            left[right[i]] = i
        offer(left[i])
        offer(i)
    return [x for x in parts if x is not None]


class Pieces:
    """The sorted hashes, ranks, ids and last merges of a model file's pieces, and each id's bytes; read on the driver and sent to the tasks (bounded by the vocabulary)."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        self.raw = [b""] * n
        self.byte_ids = np.zeros(256, np.uint32)
        usable = []
        for i, p in enumerate(names):
            if sp.is_byte(i):
                self.byte_ids[int(p[1:-1], 16)] = i
                self.raw[i] = bytes([int(p[1:-1], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                usable.append(i)
                self.raw[i] = p.replace("▁", " ").encode()
        self._build([self.raw[i].decode() for i in usable], [sp.get_score(i) for i in usable], usable)

    def _build(self, texts: list[str], scores: list[float], ids: list[int]) -> None:
        rank = {t: r for r, (_, t) in enumerate(sorted(zip([-s for s in scores], texts, strict=True)))}
        keys = np.array([self._hash(t) for t in texts], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(ids, np.int64)[order]
        assert (self.keys[1:] != self.keys[:-1]).all()
        texts = [texts[i] for i in order]
        place = {t: i for i, t in enumerate(texts)}
        self.texts, self.rank = texts, rank
        self.length = np.array([len(t) for t in texts], np.int64)
        #: when a piece is merged (characters: -1), the two parts it is merged from, whether a part of it is merged later than itself
        self.time = np.array([rank[t] if len(t) > 1 else -1 for t in texts], np.int64)
        self.first, self.second = np.full(len(texts), -1, np.int64), np.full(len(texts), -1, np.int64)
        self.alive, self.odd = self.length == 1, np.zeros(len(texts), bool)
        for i in np.argsort(self.length, kind="stable").tolist():
            if self.length[i] > 1 and len(own := merge(texts[i], rank)) == 1:
                self.alive[i] = True
                a, b = (place[x] for x in own[0][1])
                self.first[i], self.second[i] = a, b
                self.odd[i] = self.odd[a] or self.odd[b] or max(self.time[a], self.time[b]) > self.time[i]
        self.sizes = np.array(sorted({*self.length.tolist(), 1}, reverse=True))
        self.power = np.cumprod(np.append(np.ones(1, np.uint64), np.full(2 * max(self.sizes), BASE)))
        self.known = None
        self.maybe = np.zeros(1 << MAYBE_BITS, bool)
        self.maybe[self.keys >> np.uint64(64 - MAYBE_BITS)] = True

    @staticmethod
    def _hash(text: str) -> int:
        h = np.zeros(1, np.uint64)
        for c in _mix(np.array([ord(c) for c in text])):
            h = h * BASE + c
        return int(h[0])

    def _look(self, keys: np.ndarray) -> np.ndarray:
        """Places of the pieces with these hashes, or BARE."""
        out = np.full(len(keys), BARE, np.int64)
        near = np.flatnonzero(self.maybe[keys >> np.uint64(64 - MAYBE_BITS)])
        at = np.minimum(np.searchsorted(self.keys, keys[near]), len(self.keys) - 1)
        ok = self.keys[at] == keys[near]
        out[near[ok]] = at[ok]
        return out

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces a and b, one after the other, stay two when their text is merged."""
        out = np.ones(len(a), bool)
        for i in np.flatnonzero(self.odd[a] | self.odd[b]).tolist():
            want = [self.texts[a[i]], self.texts[b[i]]]
            out[i] = [t for t, _ in merge("".join(want), self.rank)] == want
        todo = np.flatnonzero(~(self.odd[a] | self.odd[b]))
        x, y, limit = a[todo], b[todo], np.full(len(todo), np.iinfo(np.int64).max)
        while len(todo):
            joined = self._look(self.keys[x] * self.power[self.length[y]] + self.keys[y])
            early = (joined >= 0) & (self.time[joined] < limit)
            out[todo[early]] = False
            left = self.time[x] > self.time[y]
            go = np.flatnonzero(~early & (left | (self.time[y] >= 0)))
            todo, x, y, left = todo[go], x[go], y[go], left[go]
            limit = np.where(left, self.time[x], self.time[y] + 1)
            x, y = np.where(left, self.second[x], x), np.where(left, y, self.first[y])
        return out

    def _fits(self, pairs: np.ndarray) -> np.ndarray:
        """``fits`` for pairs of places as one number each. Answers are remembered; of pairs that share a place in the memory the latest stays."""
        if self.known is None:
            self.known = np.full(1 << PAIR_BITS, -1, np.int64)  # 2 * pair + answer
        spot = (pairs.astype(np.uint64) * BASE >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        found = self.known[spot]
        out = (found & 1).astype(bool)
        new = np.flatnonzero(found >> 1 != pairs)
        if len(new):
            own, first, back = np.unique(pairs[new], return_index=True, return_inverse=True)
            answers = self.fits(own // len(self.keys), own % len(self.keys))
            self.known[spot[new[first]]] = 2 * own + answers
            out[new] = answers[back]
        return out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all words in order, and how many each has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        flat, count = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        begin = 0
        while begin < len(order):
            length = int(lengths[order[begin]])
            if length > LONG:
                stop = begin + 1
                last = self._segments(words[order[begin]])[:, None]
            else:
                stop = min(int(np.searchsorted(lengths[order], length, side="right")), begin + max(1, CELLS // (length + 1)))
                codes = np.frombuffer("".join([words[i] for i in order[begin:stop]]).encode("utf-32-le"), np.uint32).reshape(-1, length)
                last = self._advance(codes, np.full((stop - begin, 1), BEGIN))
            ids, n = self._back([words[i] for i in order[begin:stop]], last)
            flat.append(ids)
            count.append(n)
            begin = stop
        by_length, count = np.concatenate(flat), np.concatenate(count)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        n, at = count[place], starts(count)
        to = starts(n)
        return by_length[np.repeat(at[:-1][place] - to[:-1], n) + np.arange(to[-1])], n

    def _advance(self, codes: np.ndarray, known: np.ndarray) -> np.ndarray:
        """The last piece at each end position (row) of each row of codes (column); ``known`` has those of each row's first positions."""
        rows, length = codes.shape
        mixed = _mix(codes)
        head = np.zeros((rows, length + 1), np.uint64)
        for j in range(length):
            head[:, j + 1] = head[:, j] * BASE + mixed[:, j]
        sizes = self.sizes[self.sizes <= length]
        # what ends at each position, by size: its piece's place among the sorted keys, or BARE
        found = np.full((length + 1, rows, len(sizes)), BARE, np.int32)
        for c, k in enumerate(sizes):
            keys = head[:, k:] - head[:, : length + 1 - k] * self.power[k]
            r, e = np.nonzero(self.maybe[keys >> np.uint64(64 - MAYBE_BITS)])
            at = self._look(keys[r, e])
            ok = (at >= 0) & self.alive[at]
            found[e[ok] + k, r[ok], c] = at[ok]
        last = np.empty((length + 1, rows), np.int32)
        last[: known.shape[1]] = known.T
        row = np.arange(rows)
        for end in range(known.shape[1], length + 1):
            first = int(np.searchsorted(-sizes, -end))  # sizes fall; longer ones than the end don't count
            own = found[end, :, first:]
            r, c = np.nonzero(own >= 0)
            piece, before = own[r, c].astype(np.int64), last[end - sizes[first + c], r].astype(np.int64)
            good = before < 0  # nothing merges with the beginning, or with a character that has no piece
            todo = np.flatnonzero(~good)
            good[todo] = self._fits(before[todo] * len(self.keys) + piece[todo])
            score = np.zeros(own.shape, np.int8)
            score[r[good], c[good]] = 1
            last[end] = own[row, score.argmax(1)]
            last[end][score.max(1) == 0] = BARE
        return last

    def _segments(self, word: str) -> np.ndarray:
        """The last piece at each end position of a long word."""
        most = int(self.sizes[0])
        last = np.empty(len(word) + 1, np.int32)
        head = np.frombuffer(word[: SEGMENT].encode("utf-32-le"), np.uint32)[None, :]
        last[: SEGMENT + 1] = self._advance(head, np.full((1, 1), BEGIN))[:, 0]
        at, step = SEGMENT, max(1, CELLS // (SEGMENT + WARM + 1))
        while at < len(word):
            n = max(1, min(step, (len(word) - at) // SEGMENT))
            size = min(SEGMENT, len(word) - at)
            text = word[at - WARM : at + n * size]
            codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            rows = codes[np.arange(n)[:, None] * size + np.arange(WARM + size)]
            own = self._advance(rows, np.full((n, 1), BEGIN))
            for j in range(n):
                mine = own[:, j]
                if (mine[WARM - most : WARM + 1] != last[at - most : at + 1]).any():
                    mine = self._advance(rows[j : j + 1, WARM - most :], last[None, at - most : at + 1])[:, 0]
                last[at + 1 : at + size + 1] = mine[-size:]
                at += size
        return last

    def _back(self, words: list[str], last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of one length, one after the other, and how many each has: all words walk back together."""
        taken = np.zeros((last.shape[1], last.shape[0]), bool)
        size = np.append(self.length, 1)  # BARE takes the last
        row = np.arange(last.shape[1])
        pos, left = np.full(len(row), last.shape[0] - 1), row
        if len(row) == 1:
            own, p = size[last[:, 0]], last.shape[0] - 1
            while p > 0:
                taken[0, p] = True
                p -= own[p]
            left = left[:0]
        while len(left):
            taken[left, pos[left]] = True
            pos[left] -= size[last[pos[left], left]]
            left = left[pos[left] > 0]
        r, e = np.nonzero(taken)
        at = last[e, r]
        ids = self.ids[at].astype(np.uint32)
        lone = np.flatnonzero(at < 0)
        if len(lone):
            spelt = [self.byte_ids[list(words[r[i]][e[i] - 1].encode())] for i in lone]
            n = np.ones(len(ids), np.int64)
            n[lone] = [len(x) for x in spelt]
            to = starts(n)
            ids = np.repeat(ids, n)
            for i, x in zip(lone, spelt, strict=True):
                ids[to[i] : to[i + 1]] = x
            return ids, np.bincount(np.repeat(r, n), minlength=len(words))
        return ids, taken.sum(1)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids.tolist()))[1:]


def encode(docs: DataFrame, model: str, verify: bool = False) -> DataFrame:
    """id, text and ids (little-endian unsigned 32-bit numbers as binary) of each row; ``model`` is a path that the driver has.

    With ``verify``, round_trip (whether the ids decode to the text; null counts as empty) stands in place of the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(model))
    name, kind = ("round_trip", "boolean") if verify else ("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        table = ListTable(pieces.encode_words, MEMO_WORDS)
        for batch, raw in chunks(batches, SLICE_BYTES):
            flat, at = table.lists([WORD.findall(" " + t.decode()) if t else [] for t in raw])
            each = np.split(flat.astype("<u4"), at[1:-1])
            second = pa.array([pieces.decode(x) == (t or b"") for x, t in zip(each, raw, strict=True)], pa.bool_()) if verify else batch.column("text")
            yield pa.RecordBatch.from_arrays([batch.column("id"), second, pa.array([x.tobytes() for x in each], pa.binary())], ["id", name, "ids"])

    return narrow(docs).mapInArrow(run, f"id long, {name} {kind}, ids binary")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """The rows of ``encoded`` (which has ids) with ``decoded``, the text that the ids stand for."""
    names = [*encoded.columns, "decoded"]
    schema = ", ".join(f"{n} {t}" for n, t in [*encoded.dtypes, ("decoded", "string")])
    shared = encoded.sparkSession.sparkContext.broadcast(Pieces(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            back = [shared.value.decode(np.frombuffer(x, "<u4")).decode() for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(back, pa.string())], names)

    return encoded.mapInArrow(run, schema)


def encoded_digest(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 and round_trip (the ids decode to the text; null counts as empty)."""
    return encode(docs, model, verify=True).select(F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), "round_trip")


def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digest(documents(spark, sf_dir), model_path())
