"""MinHash near-duplicates: one-permutation hashing, bands, star-shaped candidate edges.

1. Each text's set of word shingles is hashed into bins once; the least value of a bin is
   its entry, and an empty bin copies one by optimal densification (its own sequence of
   probes). Bands of entries are bucket keys. Texts with equal sets form a class; only the
   class's smallest id goes on.
2. In every bucket each member is paired with the one that has most bucket mates over all
   its buckets: a star, so pairs grow with the members and not with their square. (An
   original shares more buckets with its edited copies than they do among themselves.)
   Pairs are confirmed on the full sets.
3. Components are taken from the confirmed links. Where members of one bucket still lie in
   different components, their pairs across components are checked too, after bounds by
   their sizes and sketches; so no link that shares a bucket is lost. (A link at
   the threshold shares no bucket with a chance under 1e-7; ``bands_for`` sees to that.)

Texts stream past their centre's sets sorted by centre; a centre with many members is
salted, so no task or memory depends on the size of a group.

Null or empty text has no shingles and is linked with nothing. A text with fewer words
than a shingle is one shingle. A row with null id is its own, kept component. Rows that
repeat an id are one document: a link of any of them is a link of the id, and all get its
component. Ties take the smallest id. Very long texts are taken whole. An empty table gives
an empty result. Extra columns, whatever their names, stay in ``keep_one``.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from copperleaf.llm.common import WordTable, chunks, documents, narrow, unused, written

ROWS = 5
MISS = 1e-7
#: Members that one salt of a centre takes.
SALT_MEMBERS = 500
#: Bits (a power of 2) of the map that tells which ids are no candidates: 16 MB whatever the input.
MAP_BITS = 27
SKETCH = 128
#: Columns: an odd sketch of 512 bits, then one bit of each of the first 128 entries.
SKETCHES = [f"odd{i}" for i in range(8)] + ["least0", "least1"]
#: Sets of this size fill the bins, so that the entries' bits are independent.
LARGE = 1500
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
P = np.uint64(0x9E3779B97F4A7C15)


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands so that a pair at the threshold shares no bucket with a chance under ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_sets(raw: list[bytes | None], k: int, table: WordTable) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: ASCII lower case, words cut at ASCII spaces."""
    values, at = table.values([t.lower().split() if t else [] for t in raw])
    if values is None:
        return [np.zeros(0, np.uint64)] * len(raw)
    rolled = values.copy()
    for j in range(1, k):
        n = max(0, len(values) - j)
        rolled[:n] = rolled[:n] * P + values[j:]
    rolled = mix(rolled)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        else:  # the whole sequence as one, tagged by its length
            h = np.full(min(1, b - a), b - a, np.uint64)
            for v in values[a:b]:
                h = mix(h * P + v)
            out.append(h)
    return out


def signatures(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One-permutation MinHash with optimal densification: a row of ``bins`` values for each set; all EMPTY for empty sets."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    out = np.full((len(sets), bins), EMPTY, np.uint64)
    if not size.sum():
        return out
    v = mix(np.concatenate(sets) + P)
    owner = np.repeat(np.arange(len(sets)), size)
    slot = ((v >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    np.minimum.at(out.ravel(), owner * bins + slot, v & np.uint64(0xFFFFFFFF))
    filled = out != EMPTY
    row, bin_ = np.nonzero(~filled & (size > 0)[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        probe = (mix(bin_.astype(np.uint64) * P + np.uint64(attempt)) % np.uint64(bins)).astype(np.int64)
        hit = filled[row, probe]
        out[row[hit], bin_[hit]] = out[row[hit], probe[hit]]
        row, bin_ = row[~hit], bin_[~hit]
    return out


def odd_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """512 bits a set (8 longs); each shingle flips one. Two sets differ in at least as many shingles as their sketches in bits."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    spot = (mix(np.concatenate(sets) + np.uint64(1)) & np.uint64(511)).astype(np.int64)
    flips = np.bincount(np.repeat(np.arange(len(sets)), size) * 512 + spot, minlength=512 * len(sets)).reshape(-1, 512)
    return np.packbits((flips & 1).astype(np.uint8), axis=1).view(np.int64)


def signed(docs: DataFrame, k: int, percent: int, rows: int = ROWS) -> DataFrame:
    """id, n_shingles, set_hash (binary; null for an empty set), bands array<long> and the sketches of each row."""
    bands = bands_for(percent, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        table = WordTable(word_hashes)
        for batch, raw in chunks(batches):
            sets = shingle_sets(raw, k, table)
            sig = signatures(sets, max(SKETCH, bands * rows))
            keys = np.zeros((len(sets), bands), np.uint64) + np.arange(bands, dtype=np.uint64)
            for r in range(rows):
                keys = mix(keys * P + sig[:, r : bands * rows : rows])
            least = np.packbits((mix(sig[:, :SKETCH]) & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64)
            sketch = np.concatenate([odd_sketches(sets), least], axis=1)
            hashes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands), pa.array(keys.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(hashes, pa.binary()), lists, *map(pa.array, sketch.T)],
                ["id", "n_shingles", "set_hash", "bands", *SKETCHES],
            )

    return narrow(docs).mapInArrow(run, f"id long, n_shingles long, set_hash binary, bands array<long>, {', '.join(f'{c} long' for c in SKETCHES)}")


def only_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs (id, ...) whose id may be among ``ids`` (id): a map of bits, of a fixed size, is broadcast."""
    spot = F.pmod(F.xxhash64("id"), F.lit(1 << MAP_BITS))
    maps = ids.select(F.bitmap_bucket_number(spot).alias("bucket"), F.bitmap_bit_position(spot).alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map"))
    byte = F.conv(F.hex(F.substring("map", (F.bitmap_bit_position(spot) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    near = docs.join(F.broadcast(maps), F.bitmap_bucket_number(spot) == F.col("bucket"))  # 4 KB a row, 1 << MAP_BITS >> 15 rows
    return near.filter(F.call_function("shiftright", byte, (F.bitmap_bit_position(spot) % 8).cast("int")) % 2 == 1).select(*docs.columns)


def confirmed(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Of ``pairs`` (a, b) those whose full sets reach the threshold."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / SALT_MEMBERS).cast("int").alias("salts"))
    members = pairs.join(sizes, "a").select(F.col("b").alias("id"), "a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("role"))
    centres = sizes.select(F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"))
    roles = written(members.unionByName(centres))
    rows = only_ids(narrow(docs), roles.select("id")).join(roles, "id").select("a", "salt", "role", "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(word_hashes)
        now, centre = None, {}  # the distinct sets of the centre's rows
        for batch, raw in chunks(batches):
            sets = shingle_sets(raw, k, table)
            found = []
            for a, salt, role, b, s in zip(*(batch.column(c).to_pylist() for c in ("a", "salt", "role", "id")), sets, strict=True):
                if now != (a, salt):
                    now, centre = (a, salt), {}
                if role == 0:
                    centre[s.tobytes()] = s
                    continue
                for c in centre.values():
                    if 100 * min(len(c), len(s)) >= percent * max(len(c), len(s)):
                        both = np.concatenate([c, s])
                        both.sort()
                        common = int((both[1:] == both[:-1]).sum())
                        if 100 * common >= percent * (len(both) - common) > 0:
                            found.append((a, b))
                            break
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["a", "b"])

    return rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "role").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """id and component (its smallest id) of every id in ``links`` (a, b), by alternating large and small stars."""
    edges = written(links.select("a", "b").filter("a <> b").distinct())
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        edges = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()
        high = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = high.groupBy("u").agg(F.min("v").alias("m"))
        small = high.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
        edges = written(small.filter("a <> b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return edges.groupBy("b").agg(F.min("a").alias("component")).select(F.col("b").alias("id"), "component").unionByName(
        edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    )


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of docs."""
    every = written(signed(docs, k, percent, rows))
    classes = written(
        every.filter("set_hash is not null and id is not null").groupBy("set_hash").agg(F.min(F.struct("id", "n_shingles", "bands", *SKETCHES)).alias("r")).select("set_hash", "r.*")
    )
    keyed = classes.select(F.explode("bands").alias("band"), "id")
    shared = keyed.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    placed = written(keyed.join(shared, "band"))
    degree = placed.groupBy("id").agg(F.sum("n").alias("degree"))
    best = placed.select("band", "id").join(degree, "id").groupBy("band").agg(F.max(F.struct("degree", (-F.col("id")).alias("minus"))).alias("m"))
    stars = placed.select("band", "id").join(best.select("band", (-F.col("m.minus")).alias("centre")), "band").filter("id <> centre")
    tried = written(stars.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b"), "centre").distinct())
    # ids that have several texts: each such id is linked with the class of each
    many = every.filter("id is not null").groupBy("id").agg(F.count("*").alias("n"), F.count("set_hash").alias("full"), F.min("set_hash").alias("low"), F.max("set_hash").alias("high"))
    many = written(many.filter("low < high or (0 < full and full < n)").select("id"))
    ties = every.select("id", "set_hash").join(many, "id").join(classes.select("set_hash", F.col("id").alias("class")), "set_hash")
    ties = written(ties.filter("id <> class").select(F.least("id", "class").alias("a"), F.greatest("id", "class").alias("b")).distinct())
    own = classes.select("id", "n_shingles", *SKETCHES)
    there = own.select(*[F.col(c).alias(f"{c}_") for c in own.columns])
    pairs = written(
        tried.select(F.col("centre").alias("id_"), F.when(F.col("a") == F.col("centre"), F.col("b")).otherwise(F.col("a")).alias("id"))
        .join(own, "id").join(there, "id_").filter(may_link(percent)).select(F.col("id_").alias("a"), F.col("id").alias("b"))
    )
    links = written(confirmed(docs, pairs, k, percent).unionByName(ties))
    found = written(components(links))
    # members of one bucket in different components: their pairs across components
    now = placed.select("band", "id").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    open_ = now.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("band")
    rest = written(now.join(open_, "band").join(own, "id"))
    other = rest.select("band", *[F.col(c).alias(f"{c}_") for c in (*own.columns, "component")])
    across = (
        rest.join(other, "band").filter((F.col("component") < F.col("component_")) & may_link(percent))
        .select(F.least("id", "id_").alias("a"), F.greatest("id", "id_").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    )
    across = written(across)
    if across.take(1):
        links = links.unionByName(written(confirmed(docs, across, k, percent)))
        found = written(components(links))
    of_class = classes.select("set_hash", "id").join(found, "id", "left").select("set_hash", F.coalesce("component", "id").alias("component"))
    full = every.filter("set_hash is not null and id is not null").select("id", "n_shingles", "set_hash").join(of_class, "set_hash").select("id", "n_shingles", "component")
    of_id = full.join(many, "id").groupBy("id").agg(F.min("component").alias("component"))
    bare = every.filter("set_hash is null or id is null").select("id", "n_shingles").join(of_id, "id", "left").select("id", "n_shingles", F.coalesce("component", "id").alias("component"))
    out = full.unionByName(bare).select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def may_link(percent: int) -> Column:
    """Whether a row's two sets (columns, and the same with _ at the end) may reach the threshold.

    By their sizes, and by the odd sketches, no link is lost; by the bits of entries of large
    sets, one with a chance under 1e-7.
    """
    n, m = F.col("n_shingles"), F.col("n_shingles_")
    apart = lambda cs: sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_"))) for c in cs), F.lit(0))
    return (
        (100 * F.least(n, m) >= percent * F.greatest(n, m))
        & (apart(SKETCHES[:8]) * (100 + percent) <= (n + m) * (100 - percent))
        & ((F.least(n, m) < LARGE) | (apart(SKETCHES[8:]) <= sketch_limit(percent)))
    )


def sketch_limit(percent: int) -> int:
    """Differing sketch bits that a pair at the threshold exceeds with a chance under 1e-7 (one bit differs with chance (1 - J) / 2)."""
    p = (1 - percent / 100) / 2
    chance, total = (1 - p) ** SKETCH, 0.0
    for d in range(SKETCH + 1):
        total += chance
        if 1 - total < 1e-7:
            return d
        chance *= (SKETCH - d) / (d + 1) * p / (1 - p)
    return SKETCH


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns: the one with the smallest id."""
    gone = unused(docs, "gone")
    ids = written(near_duplicates(docs, k, percent).filter("not kept").select(F.col("doc_id").alias(gone)).distinct())
    return docs.join(ids, F.col("doc_id") == F.col(gone), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), k=3, percent=85)


def oracle(k: int, percent: int) -> str:
    """DuckDB SQL for the rows of ``near_duplicates``, for ids that do not repeat: sets joined by their shingles, components by recursion."""
    run = ", ".join(f"words[{i}:]" for i in range(1, k + 1))
    of_run = ", ".join(f"x[{i}]" for i in range(1, k + 1))
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) >= {k} THEN list_sort(list_distinct(list_transform(list_zip({run}, true), lambda x: concat_ws(' ', {of_run}))))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE []::varchar[] END AS shingles FROM w),
c AS MATERIALIZED (SELECT min(doc_id) AS id, shingles, len(shingles) AS n FROM s WHERE len(shingles) > 0 GROUP BY shingles),
e AS MATERIALIZED (SELECT id, n, unnest(shingles) AS shingle FROM c),
l AS MATERIALIZED (
  SELECT a.id AS a, b.id AS b FROM e AS a JOIN e AS b ON a.shingle = b.shingle AND a.id < b.id AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT id, id AS seen FROM c UNION SELECT r.id, links.b FROM r JOIN links ON links.a = r.seen),
m AS (SELECT id, min(seen) AS component FROM r GROUP BY id)
SELECT s.doc_id, len(s.shingles)::bigint AS n_shingles, coalesce(m.component, s.doc_id) AS component_id, coalesce(m.component, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN c ON s.shingles = c.shingles LEFT JOIN m ON c.id = m.id
"""


SQL = oracle(3, 85)
