"""Trie of conversation prefixes as a burst trie: containers of suffixes below trie heads.

At first all conversations lie in one container at the root. A container with more than
``CONTAINER`` turns bursts: it becomes a head, and its conversations go to new containers by
their next turn. So on until every container is small or holds one sequence of turns only.
Small containers are dealt to tasks in shards; a task sorts a container's suffixes and
sweeps over them, closing a node where the next suffix leaves it. A container of one
sequence is a chain of nodes, taken from its rows without gathering them. Counts and sums of
heads are those of the containers below them, each added to all heads on its path.

Equal conversations are first taken together as one sequence with a multiplicity, so however
many copies there are, they are one suffix. A node is known by its smallest member and its
depth, which no other node shares. Turns are compared by 128 bits of their SHA-256, whole
sequences by 128 bits of hashes of their places and turns. There are as many rounds of
bursting as the depth down to which prefixes are shared by more than ``CONTAINER`` turns of
different conversations; each round's work is those conversations, a row each.

Conversations are ordered by turn (null first), equal turn numbers by the turns' hashes;
repeated rows are turns of their own. A null role or text is empty. Rows without conv_id
belong to no conversation and are left out. The remainder of a negative id is negative, as in
SQL. Very long texts are only hashed and counted; a very long conversation is dealt to
several tasks, also for numbering its turns. An empty table gives no row (there is no member
to name the root by). Only the named columns are read, whatever others there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from copperleaf.llm.common import small_batches, written

#: Turns in a container beyond which it bursts, and the mean of a shard of containers.
CONTAINER = 1 << 16
#: Ids whose decimals are joined to one text before they are hashed.
JOINED = 50_000
WORDS = r"[^\x20\x09-\x0D]+"
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, end_conv long, path array<bigint>"


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), key (of role and text) and words of each turn, numbered without gathering a conversation in one task."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.left(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), F.lit(32))
    slim = written(
        conversations.filter(F.col("conv_id").isNotNull())
        .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), key.alias("key"), F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"))
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for b in batches:
            ids = b.column("conv_id").to_numpy(zero_copy_only=False)
            if not len(ids):
                continue
            fresh = np.append(True, ids[1:] != ids[:-1])
            begin = np.maximum.accumulate(np.where(fresh, np.arange(len(ids)), 0))
            at = np.arange(len(ids)) - begin + 1
            if ids[0] == last:
                at[begin == 0] += seen
            last, seen = ids[-1], int(at[-1])
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("key"), b.column("words"), pa.array(at, pa.int64()), pa.array(np.full(len(ids), part, np.int32))], ["conv_id", "key", "words", "at", "part"])

    small_batches(conversations.sparkSession)
    ordered = slim.repartitionByRange(F.col("conv_id"), F.asc_nulls_first("turn"), F.col("key")).sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "key")
    ordered = written(ordered.mapInArrow(number, "conv_id long, key string, words long, at long, part int"))
    # a conversation that lies in several parts goes on where the part before ends: two rows a part at most
    runs = ordered.groupBy("conv_id", "part").agg(F.max("at").alias("n"))
    split = runs.groupBy("conv_id").agg(F.count("*").alias("parts")).filter("parts > 1").select("conv_id")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.join(split, "conv_id", "left_semi").select("conv_id", "part", F.sum("n").over(before).alias("base"))
    return ordered.join(bases, ["conv_id", "part"], "left").select("conv_id", (F.col("at") + F.coalesce("base", F.lit(0))).alias("pos"), "key", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, n turns) and turns (conv_id, pos, key, words), each conversation's first h turns taken from the one its id's twenty begins with."""
    lengths = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    heads = turns.filter("pos <= 3")
    base = F.col("conv_id") - F.col("conv_id") % 20
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    base_lengths = heads.groupBy(F.col("conv_id").alias("base")).agg(F.count("*").alias("n_base"))
    convs = lengths.select("conv_id", "n", base.alias("base"), taken.alias("h")).join(base_lengths, "base", "left")
    convs = written(convs.select("conv_id", "n", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("m")))
    own = turns.join(convs.select("conv_id", "h", "m"), "conv_id").filter("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "key", "words")
    first = heads.withColumnRenamed("conv_id", "base").join(convs.filter("m > 0").select("base", "conv_id", "m"), "base").filter("pos <= m").select("conv_id", "pos", "key", "words")
    return convs.select("conv_id", (F.col("m") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("n")), own.unionByName(first)


def alike(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """conv_id and rep, the smallest conversation of the same turns; n turns, mult conversations."""
    sign = turns.groupBy("conv_id").agg(F.bit_xor(F.xxhash64("pos", "key")).alias("a"), F.bit_xor(F.xxhash64(F.lit("b"), "key", "pos")).alias("b"))
    signed = written(convs.join(sign, "conv_id", "left").select("conv_id", "n", F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b")))
    groups = signed.groupBy("n", "a", "b").agg(F.min("conv_id").alias("rep"), F.count("*").alias("mult"))
    return signed.join(groups, ["n", "a", "b"]).select("conv_id", "rep", "n", "mult")


def ends_hashes(members: DataFrame) -> DataFrame:
    """rep and the hash of its members' ids, ascending and comma-joined; ids are joined in many tasks, a text at a time is hashed in one."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            reps, ids = b.column("rep").to_numpy(zero_copy_only=False), b.column("conv_id").to_pylist()
            cut = np.flatnonzero(reps[1:] != reps[:-1]) + 1 if len(reps) else []
            rows = []
            for begin, end in zip([0, *cut], [*cut, len(ids)], strict=True):
                rows += [(reps[i], ids[i], ",".join(map(str, ids[i : min(end, i + JOINED)]))) for i in range(begin, end, JOINED)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())], ["rep", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = state = None
        for b in batches:
            done: list[tuple] = []
            for rep, ids in zip(b.column("rep").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if rep == last:
                    state.update(b"," + ids.encode())
                else:
                    done += [(last, state.hexdigest())] if state else []
                    last, state = rep, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], ["rep", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([state.hexdigest()], pa.string())], ["rep", "ends_sha256"])

    alone = members.filter("mult = 1").select("rep", F.sha2(F.col("rep").cast("string").cast("binary"), 256).alias("ends_sha256"))
    many = written(members.filter("mult > 1").select("rep", "conv_id"))
    parts = many.repartitionByRange("rep", "conv_id").sortWithinPartitions("rep", "conv_id").mapInArrow(joined, "rep long, first long, ids string")
    return alone.unionByName(parts.repartition("rep").sortWithinPartitions("rep", "first").mapInArrow(hashed, "rep long, ends_sha256 string"))


def sweep(suffixes: list[tuple], top: int, words: int) -> list[list]:
    """Nodes of a container at depth ``top``, its own one last: [conv_id, depth, parent, n_convs, n_children, n_leaves, saved_tokens, end_conv].

    ``suffixes``: (keys, conv_id, multiplicity, words of the turns), all different, in order of their keys.
    """
    out: list[list] = []
    nodes = [[None, top, None, 0, 0, 0, 0, None]]  # the open path; children wait for their parent's name
    counts, waiting, before = [words], [[]], ()

    def close() -> None:
        node, count, below = nodes.pop(), counts.pop(), waiting.pop()
        node[5] = node[5] or 1
        node[6] += (node[3] - 1) * count
        for child in below:
            child[2] = node[0]
        if nodes:
            up = nodes[-1]
            up[0] = node[0] if up[0] is None else min(up[0], node[0])
            up[3] += node[3]
            up[4] += 1
            up[5] += node[5]
            up[6] += node[6]
            waiting[-1].append(node)
        out.append(node)

    for keys, conv, mult, each in suffixes:
        same = 0
        for a, b in zip(before, keys):  # noqa: B905
            if a != b:
                break
            same += 1
        while len(nodes) > same + 1:
            close()
        for d in range(same, len(keys)):
            nodes.append([None, top + d + 1, None, 0, 0, 0, 0, None])
            counts.append(each[d])
            waiting.append([])
        node = nodes[-1]
        node[0] = conv if node[0] is None else min(node[0], conv)
        node[3] += mult
        node[7] = conv
        before = keys
    while nodes:
        close()
    return out


def _swept(rows: pd.DataFrame) -> pd.DataFrame:
    """Nodes of a shard of containers; rows: owner, depth, node_words, path, conv, mult, pos, key, words (pos null for a conversation that ends at its container)."""
    out: list[list] = []
    rows = rows.sort_values(["owner", "depth", "conv", "pos"])
    for (_, depth), box in rows.groupby(["owner", "depth"], sort=False):
        suffixes = []
        for conv, suffix in box.groupby("conv", sort=False):
            there = suffix["pos"].notna()
            suffixes.append((tuple(suffix["key"][there]), conv, suffix["mult"].iloc[0], [int(w) for w in suffix["words"][there]]))
        nodes = sweep(sorted(suffixes, key=lambda s: s[0]), int(depth), int(box["node_words"].iloc[0]))
        path = list(box["path"].iloc[0])
        nodes[-1][2] = path[-1] if path else None
        out += [[*n, None] for n in nodes[:-1]] + [[*nodes[-1], path]]
    names = [c.split()[0] for c in NODE.split(", ")]
    table = pd.DataFrame(out, columns=names)
    return table.astype({c: "Int64" for c in names[:-1]})


def trie(conversations: DataFrame, container: int = CONTAINER) -> DataFrame:
    """A row for each node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    convs, turns = rebuilt(written(turn_rows(conversations)))
    turns = written(turns)
    members = written(alike(convs, turns))
    first = members.filter("conv_id = rep").select(F.col("rep").alias("conv"), "mult", "n")
    all_ = first.agg(F.min("conv").alias("owner"), F.sum("mult").alias("n_node"), F.sum("n").alias("size"), F.count("*").alias("reps")).first()

    of = lambda x, kind="long": F.lit(x).cast(kind)
    active = first.select("*", *[of(all_[c]).alias(c) for c in ("owner", "n_node", "size", "reps")], of(0).alias("node_words"), F.array().cast("array<bigint>").alias("path"))
    boxes, heads, depth = [], [], 0
    while True:
        bursts = (F.col("size") > container) & ((F.col("reps") > 1) | F.lit(depth == 0))
        boxes.append(active.filter(~bursts).withColumn("depth", of(depth)))
        large = active.filter(bursts)
        if not large.take(1):
            break
        following = large.join(turns.filter(F.col("pos") == depth + 1).select(F.col("conv_id").alias("conv"), "key", "words"), "conv")
        kids = written(following.groupBy("owner", "key").agg(F.min("conv").alias("kid"), F.sum("mult").alias("k_node"), F.sum(F.col("n") - (depth + 1)).alias("k_size"), F.count("*").alias("k_reps"), F.max("words").alias("k_words")))
        own = large.groupBy("owner").agg(*[F.max(c).alias(c) for c in ("n_node", "node_words", "path")], F.max(F.when(F.col("n") == depth, F.col("conv"))).alias("end_conv"))
        heads.append(written(own.join(kids.groupBy("owner").agg(F.count("*").alias("n_children")), "owner").withColumn("depth", of(depth))))
        moved = following.join(kids, ["owner", "key"]).select(
            "conv", "mult", "n", F.col("kid").alias("owner"), F.col("k_node").alias("n_node"), F.col("k_size").alias("size"), F.col("k_reps").alias("reps"), F.col("k_words").alias("node_words"),
            F.concat("path", F.array("owner")).alias("path"),
        )
        active, depth = written(moved), depth + 1

    every = boxes[0]
    for b in boxes[1:]:
        every = every.unionByName(b)
    rows = turns.withColumnRenamed("conv_id", "conv")
    single = (F.col("reps") == 1) & (F.col("depth") > 0)
    shards = max(1, 2 * (all_["size"] or 0) // container)
    together = every.filter(~single).join(rows, (every["conv"] == rows["conv"]) & (rows["pos"] > every["depth"]), "left").select(every["conv"], "owner", "depth", "node_words", "path", "mult", "pos", "key", "words")
    swept = together.withColumn("shard", F.pmod(F.xxhash64("owner", "depth"), F.lit(shards))).groupBy("shard").applyInPandas(_swept, NODE)
    chain = every.filter(single).join(rows, "conv").filter("pos >= depth")
    below = Window.partitionBy("conv").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
    copies = chain.filter("mult > 1").withColumn("saved", F.sum((F.col("mult") - 1) * F.col("words")).over(below))
    chain = copies.unionByName(chain.filter("mult = 1").withColumn("saved", F.lit(0).cast("long"))).select(
        F.col("conv").alias("conv_id"), F.col("pos").alias("depth"), F.when(F.col("pos") > F.col("depth"), F.col("conv")).otherwise(F.element_at("path", -1)).alias("parent_conv_id"), F.col("mult").alias("n_convs"),
        (F.col("pos") < F.col("n")).cast("long").alias("n_children"), of(1).alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.when(F.col("pos") == F.col("n"), F.col("conv")).alias("end_conv"),
        F.when(F.col("pos") == F.col("depth"), F.col("path")).alias("path"),
    )
    nodes = written(swept.unionByName(chain))
    names = [c.split()[0] for c in NODE.split(", ")][:-1]
    found = nodes.select(*names)
    if heads:
        top = heads[0]
        for h in heads[1:]:
            top = top.unionByName(h)
        saved = (F.col("n_node") - 1) * F.col("node_words")
        adds = nodes.filter("path is not null").select("path", "n_leaves", "saved_tokens").unionByName(top.select(F.concat("path", F.array("owner")).alias("path"), of(0).alias("n_leaves"), saved.alias("saved_tokens")))
        sums = adds.select(F.posexplode("path").alias("depth", "owner"), "n_leaves", "saved_tokens").groupBy("owner", F.col("depth").cast("long").alias("depth")).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
        found = found.unionByName(top.join(sums, ["owner", "depth"]).select(F.col("owner").alias("conv_id"), "depth", F.try_element_at("path", F.lit(-1)).alias("parent_conv_id"), F.col("n_node").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", "end_conv"))
    ends = ends_hashes(members).withColumnRenamed("rep", "end_conv")
    # nodes at which none ends stay out of the join, as they would all meet in one task
    none = found.filter("end_conv is null").select(*names[:-1], F.lit(hashlib.sha256(b"").hexdigest()).alias("ends_sha256"))
    return found.join(ends, "end_conv").select(*names[:-1], "ends_sha256").unionByName(none)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: SQL: the CRC-32 of a number's decimals, bit by bit.
_CRC = "xor(list_reduce([4294967295] || list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
SQL = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, left(sha256(length(role) || ':' || role || text), 32)) AS pos,
             dense_rank() OVER (ORDER BY role, text) AS id, len(regexp_extract_all(text, '{WORDS}')) AS words FROM t),
c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS base, {_CRC} % 4 AS h FROM k GROUP BY conv_id),
m AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS m FROM c LEFT JOIN c AS b ON b.conv_id = c.base),
r AS (SELECT m.conv_id, pos - h + m AS pos, id, words FROM m JOIN k ON k.conv_id = m.conv_id AND pos > h
      UNION ALL SELECT m.conv_id, pos, id, words FROM m JOIN k ON k.conv_id = m.base AND pos <= m),
p AS (SELECT conv_id, pos AS depth, string_agg(id::varchar, ',') OVER (PARTITION BY conv_id ORDER BY pos) AS path, words FROM r UNION ALL SELECT conv_id, 0, '', 0 FROM m),
e AS (SELECT path, string_agg(conv_id::varchar, ',' ORDER BY conv_id) AS ids FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) AS last FROM p) WHERE last = 1 GROUP BY path),
n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words, CASE WHEN depth > 0 THEN regexp_replace(path, ',?[^,]*$', '') END AS up FROM p GROUP BY path, depth),
d AS (SELECT up, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
s AS (SELECT a.path, sum(CASE WHEN d.up IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved
      FROM n LEFT JOIN d ON d.up = n.path JOIN p AS a ON a.conv_id = n.conv_id AND a.depth <= n.depth GROUP BY a.path)
SELECT n.conv_id, n.depth::bigint AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0)::bigint AS n_children, n_leaves::bigint AS n_leaves, saved::bigint AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM n JOIN s ON s.path = n.path LEFT JOIN n AS u ON u.path = n.up LEFT JOIN d ON d.up = n.path LEFT JOIN e ON e.path = n.path
"""
