"""Secret scans: patterns for known kinds, and a linear-chain conditional random field for the rest.

The field tags tokens as begin (B), inside (I) or outside (O) of a secret. Its features
are the token's shape, shapes and words of its neighbours, and figures of the whole file.
It learns from a bounded sample of texts. Their labels are the patterns' matches; so that it
learns more than to repeat them, each such text is also given in disguise: the words before
the secret, what stands between and the secret itself are drawn anew in forms that the
patterns don't list, and texts without a match get decoys (dates, versions, numbers, links,
names) that are no secrets. Decoding is exact Viterbi. Every pattern match stays; a tagged
span is added where it overlaps none.

Null text counts as empty: no spans. Repeated rows each get their own result, spans that
start together are ordered by kind, very long texts are scanned whole, an empty table gives an
empty result (the field is then untrained and tags nothing). Only the named columns are
read, whatever others there are.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copperleaf.llm.common import WordTable, chunks, documents, narrow, starts

# The patterns of the three known kinds, in their listed order.
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ with 24 characters or more
KINDS = ("assign", "access", "hex", "crf")
HIT = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|(?-i:AKIA[A-Z0-9]{16})|(?-i:[0-9a-f]{24})"

#: Texts with and without a match that the field learns from (each), characters of them (around the first match, or from the start), disguises of each.
SAMPLE = 128
SAMPLE_CHARS = 2000
DISGUISES = 4
EPOCHS = 40
#: What each token's score for outside is lowered by in decoding: more makes the field find more, and tag more that is none.
LEAN = 3.0
#: What disguises and decoys are made of.
CUES = ["pwd", "passphrase", "passcode", "credential", "credentials", "auth", "bearer", "signing_key", "client_key", "private key", "login", "access code", "pin", "session", "webhook"]
BETWEEN = ["=", ": ", " = ", " is ", " -> ", " => ", ":", " ", "=\"", ": '", " := "]
PLAIN = ["required", "expired", "rotated", "missing", "stored safely", "never shared", "the same", "changed every month"]
SLOTS = 1 << 14
TOKEN = re.compile(r"[\w+/.-]+|[^\s\w+/.-]+")
B, I, O = 0, 1, 2  # noqa: E741


def base_spans(text: str) -> list[tuple[int, int, str, int, int]]:
    """(start, end, kind, start and end of the secret itself) of each pattern match."""
    out = [(m.start(), m.end(), 0, m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), m.end(), 1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), 2, m.start(), m.end()) for m in HEX.finditer(text)]
    return out


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % (SLOTS - 1) + 1


def shape(word: str) -> str:
    """Character classes of the whole word with runs shortened, Ab12 -> Aa0; of a long shape both ends and how often its classes change."""
    out = re.sub(r"[^\W\d_]", lambda m: "A" if m[0].isupper() else "a", re.sub(r"\d", "0", word))
    out = re.sub(r"(.)\1+", r"\1", out)
    return out if len(out) <= 10 else f"{out[:5]}~{8 * len(out) // len(word)}~{out[-5:]}"


_PLAIN: dict[tuple, list[int]] = {}


def token_slots(word: str, words: frozenset[str]) -> list[int]:
    """Feature slots of one token: shape, length, mixture; and the word itself if it is one of ``words``."""
    low = word.lower()
    if word.isalpha() and low not in words:
        key = (word.islower(), word.isupper(), word[:1].isupper(), min(len(word), 40) // 4)
        if key not in _PLAIN:
            _PLAIN[key] = [_slot(f"plain{key[:3]}"), _slot(f"len{key[3]}")]
        return _PLAIN[key]
    digits = sum(map(str.isdigit, word))
    upper = sum(map(str.isupper, word))
    n = len(word)
    hexes = all(c in "0123456789abcdef" for c in word)
    out = [
        _slot(f"shape{shape(word)}"), _slot(f"len{min(len(word), 40) // 4}"), _slot(f"mix{4 * digits // n},{4 * upper // n},{hexes}"),
        _slot(f"kinds{digits > 0},{0 < upper},{any(map(str.islower, word))},{len(word) > 11}"),
    ]
    if low in words:
        out.append(_slot(f"word{low}"))
    return out


def file_slots(text: str, n_tokens: int) -> list[int]:
    """Feature slots of a whole text: share of digits and of signs, length of its tokens."""
    raw = text.encode()
    digits = len(raw) - len(raw.translate(None, b"0123456789"))
    signs = len(raw) - len(raw.translate(None, b"{}[]()=;:\"'<>_/\\"))
    share = lambda k: min(4, int(k * 50 / max(1, len(raw))))
    return [_slot(f"digits{share(digits)}"), _slot(f"signs{share(signs)}"), _slot(f"length{min(2, len(raw) // max(1, 8 * n_tokens))}")]


class Field:
    """Weights: own, previous, one before it, next (each 3 columns) by token slot, and file (3 columns)."""

    def __init__(self, words: frozenset[str] = frozenset()):
        self.words = words
        self.token = np.zeros((SLOTS, 12))
        self.file = np.zeros((SLOTS, 3))
        self.steps = np.zeros((3, 3))
        self.token[:, O] = 1.0 / 4  # untrained: all outside
        self.lean = 0.0

    def fill(self, tokens: list[str]) -> np.ndarray:
        """12 summed weights of each token."""
        slots = [token_slots(t, self.words) for t in tokens]
        at = starts(np.fromiter(map(len, slots), np.int64, len(slots)))
        flat = np.fromiter((x for s in slots for x in s), np.int64, at[-1])
        return np.add.reduceat(self.token[flat], at[:-1], axis=0).astype(np.float32)

    def emissions(self, values: np.ndarray, at: np.ndarray, file: np.ndarray) -> np.ndarray:
        """Scores of each token and tag: from itself, its neighbours in the same text, and the file."""
        out = values[:, :3] + np.repeat(file, np.diff(at), axis=0)
        out[:, O] -= self.lean
        first = np.zeros(len(values), bool)
        first[at[:-1][np.diff(at) > 0]] = True
        inner = np.flatnonzero(~first)
        out[inner] += values[inner - 1, 3:6]
        out[inner - 1] += values[inner, 9:12]
        second = inner[~first[inner - 1]] if len(inner) else inner
        out[second] += values[second - 2, 6:9]
        return out


def viterbi(scores: np.ndarray, at: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Best tags of each run at[i]:at[i+1]; all runs advance together, the longest first in line."""
    n = np.diff(at)
    line = np.argsort(-n, kind="stable")
    ends, begin = n[line], at[:-1][line]
    alive = np.searchsorted(-ends, -np.arange(ends[0] if len(ends) else 0), side="left")
    back, tags = np.zeros((len(scores), 3), np.int8), np.zeros(len(scores), np.int8)
    best = np.zeros((len(line), 3), scores.dtype)
    for t, k in enumerate(alive):
        pos = begin[:k] + t
        if t == 0:
            best[:k] = scores[pos]
            continue
        paths = best[:k, :, None] + steps
        back[pos] = paths.argmax(1)
        best[:k] = paths.max(1) + scores[pos]
    tag = best.argmax(1)
    for t in range(len(alive) - 1, -1, -1):
        k = alive[t]
        pos = begin[:k] + t
        going = ends[:k] > t + 1
        tag[:k] = np.where(going, back[np.minimum(pos + 1, len(scores) - 1), tag[:k]], tag[:k])
        tags[pos] = tag[:k]
    return tags


def secret_value(rng: np.random.Generator) -> str:
    """A secret of a random kind: hexadecimal, letters and digits, base 64, groups, or with signs."""
    draw = lambda letters, n: "".join(letters[i] for i in rng.integers(0, len(letters), n))
    low, up, digit = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    kind = int(rng.integers(0, 6))
    if kind == 0:
        return draw(digit + "abcdef", int(rng.integers(12, 41)))
    if kind == 1:
        return draw(low + digit, int(rng.integers(10, 33)))
    if kind == 2:
        return draw(low + up + digit, int(rng.integers(10, 41)))
    if kind == 3:
        return draw(low + up + digit + "+/", int(rng.integers(16, 45))) + "=" * int(rng.integers(0, 3))
    if kind == 4:
        return "-".join(draw(digit + "abcdef", n) for n in (8, 4, 4, 4, 12))
    return draw(low + up, int(rng.integers(3, 7))) + draw("!@$%&*#", 1) + draw(low + digit, int(rng.integers(4, 9))) + draw(up + digit, int(rng.integers(1, 5)))


def decoy(rng: np.random.Generator) -> str:
    """What looks a little like a secret and is none."""
    n = rng.integers(0, 10_000, 6).tolist()
    forms = [
        f"{2000 + n[0] % 30}-{1 + n[1] % 12:02d}-{1 + n[2] % 28:02d}", f"v{n[0] % 20}.{n[1] % 30}.{n[2] % 99}", f"{n[0]}", f"{n[0]},{n[1] % 1000:03d}.{n[2] % 100:02d}", f"https://example.org/{n[0] % 90}/page-{n[1]}.html",
        f"user{n[0] % 100}@example.org", f"+1 {n[0] % 900} {n[1] % 900} {n[2]:04d}", f"10.{n[0] % 255}.{n[1] % 255}.{n[2] % 255}", "RuntimeConfiguration", "self-contained", "NASA/ESA", f"item_{n[0]}", f"{n[0]:x}", f"chapter{n[1] % 40}",
        f"{CUES[n[3] % len(CUES)]}{BETWEEN[n[4] % 8]}{PLAIN[n[5] % len(PLAIN)]}", f"{['password', 'token', 'secret'][n[3] % 3]} is {PLAIN[n[5] % len(PLAIN)]}",
    ]
    return forms[int(rng.integers(0, len(forms)))]


def disguised(text: str, rng: np.random.Generator) -> tuple[str, list[tuple[int, int]]]:
    """The text with each of its secrets drawn anew in a form that the patterns don't list, and where the secrets now are."""
    out, spans, at, size = [], [], 0, 0
    for start, end, *_ in sorted(base_spans(text)):
        if start >= at:
            cue = CUES[int(rng.integers(0, len(CUES)))] + BETWEEN[int(rng.integers(0, len(BETWEEN)))] if rng.random() < 0.6 else ""
            value = secret_value(rng)
            size += start - at + len(cue)
            spans.append((size, size + len(value)))
            out += [text[at:start], cue, value]
            size += len(value)
            at = end
    return "".join([*out, text[at:]]), spans


def with_decoys(text: str, rng: np.random.Generator) -> str:
    """The text with a decoy after about every fiftieth word."""
    words = text.split(" ")
    for i in rng.integers(0, len(words), 1 + len(words) // 50).tolist():
        words[i] += " " + decoy(rng)
    return " ".join(words)


def samples(texts: list[str], seed: int = 11) -> list[tuple[str, list[tuple[int, int]]]]:
    """Texts with the places of their secrets: as they are, in disguise, and with decoys."""
    rng, out = np.random.default_rng(seed), []
    for text in texts:
        spans = [(s, e) for *_, s, e in base_spans(text)]
        if spans:
            out += [(text, spans), *[disguised(with_decoys(text, rng), rng) for _ in range(DISGUISES)]]
        else:
            out.append((with_decoys(text, rng), []))
    return out


def train(labelled_texts: list[tuple[str, list[tuple[int, int]]]], epochs: int = EPOCHS) -> Field:
    """Fit a field to texts and the places of their secrets by gradient steps (Adagrad) on the exact likelihood, in windows of 64 tokens."""
    labelled, near = [], Counter()
    for text, spans in labelled_texts:
        tokens, tags, inside = [], [], -1
        for m in TOKEN.finditer(text):
            hit = next((k for k, (s, e) in enumerate(spans) if m.start() < e and m.end() > s), -1)
            tags.append(O if hit < 0 else I if hit == inside else B)
            inside = hit
            tokens.append(m[0])
        labelled.append((text, tokens, tags))
        near.update({t.lower() for i, tag in enumerate(tags) if tag == B for t in tokens[max(0, i - 2) : i] if t.isalpha()})
    field = Field(frozenset(w for w, k in near.items() if k >= 5))
    if not any(B in tags for _, _, tags in labelled):
        return field
    field.token[:, O] = 0
    kinds: dict[str, int] = {}
    rows = np.array([kinds.setdefault(t, len(kinds)) for _, ts, _ in labelled for t in ts])
    gold = np.array([t for _, _, ts in labelled for t in ts])
    at = starts(np.array([len(ts) for _, ts, _ in labelled]))
    slots = [token_slots(t, field.words) for t in kinds]
    cut = starts(np.array([len(s) for s in slots]))
    owner = np.repeat(np.arange(len(slots)), np.diff(cut))
    flat = np.array([x for s in slots for x in s])
    files = np.array([file_slots(text, len(ts)) for text, ts, _ in labelled])
    doc = np.repeat(np.arange(len(labelled)), np.diff(at))
    # windows of 64 tokens: index matrix with -1 beyond a text's end
    heads = np.concatenate([np.arange(a, b, 64) for a, b in zip(at[:-1], at[1:], strict=True)])
    stops = np.minimum(heads + 64, at[1:][doc[heads]])
    grid = heads[:, None] + np.arange(64)
    real = grid < stops[:, None]
    grid = np.where(real, grid, 0)
    first = np.zeros(len(rows), bool)
    first[at[:-1][np.diff(at) > 0]] = True
    inner = np.flatnonzero(~first)
    second = inner[~first[inner - 1]]
    seen = [np.full_like(w, 1e-3) for w in (field.token, field.file, field.steps)]
    hot = np.eye(3)[gold]
    for _ in range(epochs):
        sums = np.add.reduceat(field.token[flat], cut[:-1], axis=0)
        e = field.emissions(sums[rows], at, field.file[files].sum(1))[grid] * real[..., None]
        a = np.empty_like(e)
        b = np.zeros_like(e)
        a[:, 0] = e[:, 0]
        lse = lambda x, axis: (m := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis))
        for t in range(1, 64):
            a[:, t] = np.where(real[:, t, None], lse(a[:, t - 1, :, None] + field.steps, 1) + e[:, t], a[:, t - 1])
        for t in range(62, -1, -1):
            b[:, t] = np.where(real[:, t + 1, None], lse(field.steps + (e[:, t + 1] + b[:, t + 1])[:, None, :], 2), 0)
        z = lse(a[:, -1], 1)
        p = np.exp(a + b - z[:, None, None]) * real[..., None]
        pair = np.zeros((3, 3))
        for t in range(1, 64):
            ok = real[:, t]
            x = a[ok, t - 1, :, None] + field.steps + (e[ok, t] + b[ok, t])[:, None, :] - z[ok, None, None]
            pair += np.exp(x).sum(0)
            np.add.at(pair, (gold[grid[ok, t - 1]], gold[grid[ok, t]]), -1)
        d = np.zeros((len(rows), 3))
        d[grid[real]] = p[real]
        d -= hot
        shifted = np.zeros((len(rows), 12))
        shifted[:, :3] = d
        shifted[inner - 1, 3:6] = d[inner]
        shifted[second - 2, 6:9] = d[second]
        shifted[inner, 9:12] = d[inner - 1]
        by_kind = np.stack([np.bincount(rows, shifted[:, j], len(kinds)) for j in range(12)], 1)
        by_slot = np.stack([np.bincount(flat, by_kind[owner, j], SLOTS) for j in range(12)], 1)
        by_doc = np.stack([np.bincount(doc, d[:, j], len(labelled)) for j in range(3)], 1)
        by_file = np.zeros_like(field.file)
        np.add.at(by_file, files, by_doc[:, None, :])
        for w, g, s in zip((field.token, field.file, field.steps), (by_slot, by_file, pair), seen, strict=True):
            g += 0.02 * w
            s += g * g
            w -= 0.5 * g / np.sqrt(s)
    field.lean = LEAN
    return field


def tagged(field: Field, texts: list[str], table: WordTable) -> dict[int, list[tuple[int, int]]]:
    """Spans that Viterbi finds, by the text's number.

    A path other than all-outside gains at most 2 * ``gain`` by steps for each token that
    it tags; where every token of a text is outside by more than that, all-outside is
    the best path and the text needs no further work.
    """
    tokens = [TOKEN.findall(t) for t in texts]
    values, at = table.values(tokens)
    if values is None:
        return {}
    file = np.array([field.file[file_slots(t, len(ts))].sum(0) for t, ts in zip(texts, tokens, strict=True)], np.float32).reshape(-1, 3)
    scores = field.emissions(values, at, file)
    gain = max(0.0, float((field.steps - field.steps[O, O]).max()))
    unsure = np.concatenate([[0], np.cumsum(scores[:, O] - scores[:, :2].max(1) <= 2 * gain)])
    todo = np.flatnonzero(unsure[at[1:]] > unsure[at[:-1]])
    if not len(todo):
        return {}
    sub = starts(np.diff(at)[todo])
    pick = np.repeat(at[:-1][todo] - sub[:-1], np.diff(sub)) + np.arange(sub[-1])
    tags = viterbi(scores[pick], sub, field.steps.astype(np.float32))
    out = {}
    for j, i in enumerate(todo):
        own = tags[sub[j] : sub[j + 1]]
        if (own != O).any():
            spans: list[list[int]] = []
            last = O
            for m, tag in zip(TOKEN.finditer(texts[i]), own, strict=True):
                if tag == I and last != O:
                    spans[-1][1] = m.end()
                elif tag != O:
                    spans.append([m.start(), m.end()])
                last = tag
            trimmed = ((s, s + len(texts[i][s:e].rstrip(".,;:\"'"))) for s, e in spans)
            out[int(i)] = [x for x in trimmed if x[1] > x[0]]
    return out


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id and spans array<struct<start, end, kind, base>> of each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(field))  # fixed size: 15 columns of SLOTS rows

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Field()
        vars(model).update(shared.value)
        table = WordTable(model.fill)
        for batch, raw in chunks(batches):
            texts = [(t or b"").decode() for t in raw]
            more = tagged(model, texts, table)
            out = []
            for i, t in enumerate(texts):
                found = [{"start": s, "end": e, "kind": k} for s, e, k, _, _ in base_spans(t)]
                found += [{"start": s, "end": e, "kind": 3} for s, e in more.get(i, []) if all(e <= x["start"] or s >= x["end"] for x in found)]
                out.append(sorted(found, key=lambda x: (x["start"], x["kind"])))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, kind)], ["doc_id", "spans"])

    return narrow(docs).mapInArrow(spans, "doc_id long, spans array<struct<start:int,end:int,kind:int>>")


def fit(docs: DataFrame, sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> Field:
    """Train on at most ``sample`` distinct texts with a match and as many without: in each of ``sample`` classes of the text's hash the one with the least."""
    rows = docs.select(F.col("text").cast("string").alias("text")).filter(F.col("text").isNotNull())
    h = F.xxhash64("text")
    least = rows.select(F.col("text").rlike(HIT).alias("hit"), h.alias("h")).groupBy("hit", F.pmod("h", F.lit(sample)).alias("class")).agg(F.min("h").alias("h")).collect()  # 2 * sample rows
    window = F.substr("text", F.greatest(F.lit(1), F.regexp_instr("text", F.lit(HIT)) - chars // 2), F.lit(chars))
    found = rows.filter(h.isin([r.h for r in least])).groupBy(h.alias("h")).agg(F.min(window).alias("text")).collect()
    return train(samples(sorted(r.text for r in found)))


def joined(spans, kinds=KINDS):
    """Column: kind:start:end of each span, joined by commas."""
    name = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(name, x["kind"] + 1), x["start"], x["end"])), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = scan(docs, fit(docs))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(F.filter("spans", lambda x: x["kind"] < 3)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


