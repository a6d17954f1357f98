"""Trie of conversation prefixes with subtree totals by centroid decomposition.

Conversation c is rebuilt from the first h turns of conversation c - c % 20 and its own turns after
its first h, with h = crc32(decimal c) % 4; ``%`` keeps the sign of c, as in SQL.  Every distinct
sequence of first turns is a node, known by two 64-bit fingerprints that grow turn by turn.

*Order.*  Turns are ranked by (turn, role, text), nulls first, from ranges of all rows, so that a
long conversation, or one turn repeated, is ranked in many tasks.  Running fingerprints are taken
in blocks of ``BLOCK`` turns and carried from block to block.

*Rollup.*  A node weighs as many as the conversations that share it, so that the weight of a
subtree is the sum over its members of their turns from its top on: known from one aggregation.
In a component of the parent-edge forest the nodes with more than half of its weight below them
are one path; the lowest of them is the centroid, the path leads from it to the component's top.
The centroid's side total, of itself and the components below it, is added along that path; the
centroid is done, and the components that are left have at most half the weight.  Every node
finds the component below the centroid that it falls to through the prefix of one of its
conversations, at the centroid's depth and one more.  So the number of rounds grows with the
logarithm of the rows, whatever the depth of the trie, and each round is a few equi-joins.
Components of no more than ``LOCAL`` weight go on in the same way inside one task.

Rows without conv_id are left out.  Null role or text is empty.  Turns that tie on (turn, role,
text) are equal rows and all count.  Conversations with fewer turns, or without a conversation
c - c % 20, may be left without turns: they are members of the root only.  An empty table gives no
rows.  Other columns are ignored.  The digest of a node's conversations is a sequential hash, so one
task hashes the ids that end at one node; it reads them as sorted chunks, one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chain_dedup import whole
from .staging import Staging

BLOCK = 1024
CHUNK = 8192
#: Weight of components, and so most of their nodes, that one task finishes.
LOCAL = 20_000
KEY = ["k1", "k2"]


def head_turns(conv: str) -> Column:
    """How many turns a conversation takes over."""
    return (F.crc32(F.col(conv).cast("string").cast("binary")) % 4).cast("int")


def ranked(messages: DataFrame, staging: Staging) -> DataFrame:
    """``conv_id``, ``pos`` from 0, digests of the turn and the words of its text."""
    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("conv_id is not null")
    rows = staging.put("rows", rows.select(
        "*", F.xxhash64("role", "text").alias("e1"), F.xxhash64(F.lit("second"), "text", "role").alias("e2"),
        F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words")))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "salt"]
    ranged = (rows.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(n, *order)
              .sortWithinPartitions(*order)
              .select("conv_id", "e1", "e2", "words", F.spark_partition_id().alias("part"),
                      F.monotonically_increasing_id().alias("seq")))
    ranged = staging.put("ranged", ranged)
    staging.drop("rows")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("conv_id", "part").agg(F.min("seq").alias("low"), F.count("*").alias("n"))
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).drop("low", "n")
    out = ranged.join(parts, ["conv_id", "part"]).select(
        "conv_id", (F.col("seq") + F.col("before")).alias("pos"), "e1", "e2", "words")
    return staging.put("ranked", out)


def rebuilt(turns: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """Conversations with their numbers of turns, and their turns at depths from 1."""
    heads = (turns.where("pos < 3 and conv_id % 20 = 0").groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("pos", "e1", "e2", "words"))).alias("head")))
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("h", head_turns("conv_id"))
    convs = (sizes.withColumn("source", F.expr("conv_id - conv_id % 20"))
             .join(heads.withColumnRenamed("conv_id", "source"), "source", "left"))
    convs = convs.withColumn("head", F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.expr("slice(head, 1, 0)")))
    convs = convs.select("conv_id", "h", F.coalesce(F.size("head"), F.lit(0)).alias("taken"), "head",
                         F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("own"))
    convs = convs.withColumn("taken", F.greatest("taken", F.lit(0))).withColumn("length", F.col("taken") + F.col("own"))
    convs = staging.put("convs", convs)
    first = convs.select("conv_id", F.explode("head").alias("t")).select(
        "conv_id", (F.col("t.pos") + 1).alias("depth"), "t.e1", "t.e2", "t.words")
    own = (turns.where(F.col("pos") >= head_turns("conv_id")).join(convs.select("conv_id", "h", "taken"), "conv_id")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("depth"), "e1", "e2", "words"))
    return convs.select("conv_id", "length"), first.union(own)


def prefixes(turns: DataFrame, staging: Staging) -> DataFrame:
    """``conv_id``, ``depth``, ``words``, fingerprints of the prefix and of the one before."""
    turns = turns.select(
        "conv_id", "depth", "words", F.xxhash64("depth", "e1", "e2").alias("x1"),
        F.xxhash64("e2", "depth", "e1").alias("x2"), F.expr("depth div 1024").alias("block"))
    inner = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    turns = staging.put("turns", turns.withColumns({f"k{i}": F.bit_xor(f"x{i}").over(inner) for i in (1, 2)}))
    outer = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Only conversations beyond one block have something to carry.
    blocks = turns.groupBy("conv_id", "block").agg(*[F.bit_xor(f"x{i}").alias(f"b{i}") for i in (1, 2)])
    carried = blocks.withColumns({f"b{i}": F.bit_xor(f"b{i}").over(outer) for i in (1, 2)}).where("b1 is not null")
    out = turns.join(carried, ["conv_id", "block"], "left")
    out = out.withColumns({f"k{i}": F.col(f"k{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0))) for i in (1, 2)})
    return staging.put("prefixes", out.select(
        "conv_id", "depth", "words", *KEY, *[F.col(f"k{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"p{i}") for i in (1, 2)]))


def digests(ends: DataFrame) -> DataFrame:
    """``node`` and the SHA-256 of its ascending ids, of rows (node, conv_id)."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for node, ids in frame.groupby("node", sort=False)["conv_id"]:
                ids = ids.tolist()
                rows += [(node, ids[k], ",".join(map(str, ids[k : k + CHUNK]))) for k in range(0, len(ids), CHUNK)]
            yield pd.DataFrame(rows, columns=["node", "low", "ids"])

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, hashlib.sha256()
        for frame in frames:
            out = []
            for node, ids in zip(frame["node"].tolist(), frame["ids"], strict=True):
                if node != at:
                    if at is not None:
                        out.append((at, state.hexdigest()))
                    at, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=["node", "ends_sha256"])
        if at is not None:
            yield pd.DataFrame({"node": [at], "ends_sha256": [state.hexdigest()]})

    chunks = (ends.repartitionByRange(n, "node", "conv_id").sortWithinPartitions("node", "conv_id")
              .mapInPandas(pack, "node long, low long, ids string"))
    return (chunks.repartition(n, "node").sortWithinPartitions("node", "low")
            .mapInPandas(hashed, "node long, ends_sha256 string"))


def centroid_totals(up: list[int], weight: list[int], values: list[tuple[int, ...]], added: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """Subtree sums of one component in memory.  ``up`` is each node's parent, -1 at the top; parents come first."""
    out, left = list(added), [list(range(len(up)))]
    while left:
        part = left.pop()
        total = weight[part[0]]
        half = [u for u in part if 2 * weight[u] > total]
        centre = half.pop()
        below: dict[int, int] = {}
        pieces: dict[int, list[int]] = {}
        side = values[centre]
        for u in part:
            if (top := u if up[u] == centre else below.get(up[u], -1)) >= 0:
                below[u] = top
                pieces.setdefault(top, []).append(u)
                side = tuple(map(int.__add__, side, values[u]))
        out[centre] = tuple(map(int.__add__, out[centre], side))
        for u in half:
            weight[u] -= weight[centre]
            out[u] = tuple(map(int.__add__, out[u], side))
        rest = [u for u in part if u not in below and u != centre]
        left += [*pieces.values(), *[rest] * bool(rest)]
    return out


def settled(own: list[str], added: list[str]):
    def settle(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Totals of components in consecutive rows, each by depth."""
        for g in whole(frames, "part"):
            node, parent, part = (g[c].tolist() for c in ("node", "parent", "part"))
            weight = g["weight"].tolist()
            values, adds = (list(zip(*[g[c].tolist() for c in cs], strict=True)) for cs in (own, added))
            edge = [0, *[i for i in range(1, len(part)) if part[i] != part[i - 1]], len(part)]
            totals = []
            for a, b in zip(edge, edge[1:], strict=False):
                at = {n: i for i, n in enumerate(node[a:b])}
                totals += centroid_totals([at.get(p, -1) for p in parent[a:b]], weight[a:b], values[a:b], adds[a:b])
            yield pd.DataFrame(totals, columns=own).assign(node=node)[["node", *own]]

    return settle


def subtree_totals(nodes: DataFrame, path: DataFrame, values: list[str], staging: Staging) -> DataFrame:
    """``node`` and, under their names, the sums of ``values`` over its subtree.

    ``nodes``: node, parent (null: a root; one only), conv_id (any conversation through it), depth, weight (of
    its subtree, falling by at least one from parent to child) and the values; ``path``: the node
    and its parent at each conv_id and depth.
    """
    own, added = values, [f"add_{v}" for v in values]
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    level = nodes.select("node", F.coalesce("parent", F.lit(-1)).alias("parent"), "conv_id", "depth", "weight",
                         F.lit(-1).cast("long").alias("part"), *own, *[F.lit(0).cast("long").alias(a) for a in added])
    level, k, done = staging.put("level0", level), 0, []
    below = path.select("conv_id", F.col("depth").alias("next"), F.col("node").alias("child"), F.col("parent").alias("over"))
    while True:
        # The top of a component holds its whole weight.
        total = staging.put(f"total{k}", level.groupBy("part").agg(F.max("weight").alias("total")))
        level = level.join(total, "part")
        small = (level.where(F.col("total") <= LOCAL).repartition(n, "part").sortWithinPartitions("part", "depth")
                 .mapInPandas(settled(own, added), ", ".join(f"{c} long" for c in ["node", *own])))
        done.append(staging.put(f"small{k}", small))
        if total.where(F.col("total") > LOCAL).isEmpty():
            break
        level = level.where(F.col("total") > LOCAL)
        centre = level.where("2 * weight > total").groupBy("part").agg(
            F.max_by(F.struct("node", "depth", "weight"), "depth").alias("c"))
        centre = staging.put(f"centre{k}", centre.select(
            "part", F.col("c.node").alias("centre"), F.col("c.depth").alias("at"), F.col("c.weight").alias("under")))
        placed = level.join(centre, "part").withColumn("next", F.col("at") + 1)
        lower = placed.where("depth > at").join(below, ["conv_id", "next"], "left")
        lower = lower.withColumn("falls", F.col("over") == F.col("centre")).drop("over")
        upper = placed.where("depth <= at").select("*", F.lit(None).cast("long").alias("child"), F.lit(False).alias("falls"))
        placed = staging.put(f"placed{k}", lower.unionByName(upper))
        side = placed.where("falls or node = centre").groupBy("part").agg(*[F.sum(v).alias(f"side_{v}") for v in own])
        moved = placed.join(staging.put(f"side{k}", side), "part")
        alone = F.col("node") == F.col("centre")
        on_path = ~F.col("falls") & (2 * F.col("weight") > F.col("total"))
        sums = [F.when(alone | on_path, F.col(a) + F.col(f"side_{v}")).otherwise(F.col(a)).alias(a) for v, a in zip(own, added, strict=True)]
        moved = moved.select(
            "node", "parent", "conv_id", "depth", F.when(on_path, F.col("weight") - F.col("under")).otherwise(F.col("weight")).alias("weight"),
            F.when(F.col("falls"), F.col("child")).otherwise(F.col("part")).alias("part"), *own, *sums, alone.alias("alone"))
        k += 1
        moved = staging.put(f"level{k}", moved)
        done.append(moved.where("alone").select("node", *[F.col(a).alias(v) for v, a in zip(own, added, strict=True)]))
        level = moved.where("not alone").drop("alone")
        staging.drop(f"placed{k - 1}", f"centre{k - 1}", f"side{k - 1}")
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out


def build(messages: DataFrame) -> DataFrame:
    """One row for every node of the trie."""
    staging = Staging(messages.sparkSession, "trie")
    convs, turns = rebuilt(ranked(messages, staging), staging)
    rows = prefixes(turns, staging)
    staging.drop("ranged", "turns")
    rows = staging.put("sized", rows.join(convs, "conv_id"))
    # The weight below a node: its members' turns from its depth on.
    weight = F.sum(F.col("length") - F.col("depth") + 1).alias("weight")
    nodes = rows.groupBy("depth", *KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.count_if(F.col("length") == F.col("depth")).alias("n_ends"), weight)
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
                     F.count_if(F.col("length") == 0).alias("n_ends"), F.sum(F.col("length") + 1).alias("weight"))
    root = root.where("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in KEY], "conv_id", "n_convs",
        F.lit(0).cast("long").alias("words"), *[F.lit(None).cast("long").alias(c) for c in ("p1", "p2")], "n_ends", "weight")
    nodes = staging.put("nodes", nodes.unionByName(root).withColumn("node", F.monotonically_increasing_id()))
    top = nodes.where("depth = 0").select("node", "conv_id").first()
    if top is None:
        top = (-1, -1)
    # The root's children are known by their depth; the rest find their parents by fingerprint.
    over = nodes.where("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                                           F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    deep = nodes.where("depth > 1").join(over, ["depth", "p1", "p2"])
    high = nodes.where("depth < 2").withColumns({
        "parent": F.when(F.col("depth") == 1, F.lit(top[0])), "parent_conv_id": F.when(F.col("depth") == 1, F.lit(top[1]))})
    nodes = staging.put("linked", deep.unionByName(high))
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = staging.put("family", nodes.withColumns({
        "n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}))
    path = staging.put("path", rows.select("conv_id", "depth", "length", *KEY).join(
        nodes.select("depth", *KEY, "node", "parent"), ["depth", *KEY]).select("conv_id", "depth", "length", "node", "parent"))
    ends = path.where("depth = length").select("node", "conv_id").union(
        convs.where("length = 0").select(F.lit(top[0]).cast("long").alias("node"), "conv_id"))
    told = staging.put("told", digests(ends))
    staging.drop("prefixes", "sized", "nodes", "linked")
    totals = subtree_totals(nodes, path.drop("length"), ["n_leaves", "saved_tokens"], staging)
    out = nodes.drop("n_leaves", "saved_tokens").join(totals, "node").join(told, "node", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
