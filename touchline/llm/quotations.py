"""Conversations in reply order, linked by their quotations and cleared of them.

A line that starts with n marks ``>`` (white space between allowed) is quoted at level n; runs
of neighbouring lines of one level are a passage.  Passages are normalised (A-Z lower-cased,
white space to single spaces) and hashed.  A message offers the hashes of its own text: whole,
by paragraph, by line and by sentence.  A passage is linked to its original, the first message of the
conversation that offers it, if that comes before the quoting one.

A passage without such an original is taken apart: paragraphs, lines, sentences of both, and
neighbouring pairs of each.  The first messages that offer any of these are its candidates, and
the one whose text holds most words of them, the earliest of equals, is the original.

The parent of a message is the latest original of its outermost quoted passages.  Messages
without one are roots.  Root and depth follow by pointer jumping, in as many joins as the
logarithm of the longest reply chain, so a conversation of any size needs no task of its own.
Ordering by ``root_turn, depth, turn`` puts every reply after what it answers; ``position`` is
the place in that order, from 0, shared by rows that repeat (conv_id, turn).

Rows without conv_id or turn are roots of their own (depth 0, no links).  Null and empty texts
offer and quote nothing.  Rows that repeat (conv_id, turn) are kept; they share the latest
parent found for any of them.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import Staging

MARK = re.compile(r"[ \t]*((?:>[ \t]*)+)")
STOP = re.compile(r"(?<=[.!?])\s+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def normal(text: str) -> str:
    return " ".join(text.translate(_LOWER).split())


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:32]


def levels(text: str) -> list[tuple[int, str]]:
    """Quote level and rest of every line."""
    out = []
    for line in text.split("\n"):
        m = MARK.match(line)
        out.append((m.group(1).count(">"), line[m.end():]) if m else (0, line))
    return out


def parts(lines: list[str]) -> list[list[str]]:
    """Normalised paragraphs, lines, sentences of paragraphs and sentences of lines, in order."""
    paragraphs = re.split(r"\n[ \t]*\n", "\n".join(lines))
    kinds = [paragraphs, lines, [s for p in paragraphs for s in STOP.split(p)], [s for x in lines for s in STOP.split(x)]]
    return [[n for x in kind if (n := normal(x))] for kind in kinds]


def pairs(kinds: list[list[str]]) -> set[str]:
    return {f"{a}\n{b}" for kind in kinds for a, b in zip(kind, kind[1:], strict=False)}


def parse(text: str | None) -> tuple[str, list[tuple[int, str]], list[str], list[tuple[str, str, int]]]:
    """Text without quotations, quoted passages by level, what the message offers, and parts of passages with their words."""
    lines = levels(text or "")
    quoted, pieces = [], set()
    for level, run in groupby(lines, key=lambda x: x[0]):
        run = [x[1] for x in run]
        passage = normal(" ".join(run))
        if level and passage:
            quoted.append((level, digest(passage)))
            kinds = parts(run)
            pieces |= {(digest(passage), digest(x), len(x.split())) for kind in kinds for x in kind}
            pieces |= {(digest(passage), digest(x), 0) for x in pairs(kinds)}
    own = [rest for level, rest in lines if not level]
    clean = "\n".join(own).strip()
    kinds = parts(own)
    offered = {normal(clean), *(x for kind in kinds for x in kind), *pairs(kinds)} - {""}
    return clean, quoted, sorted(digest(p) for p in offered), sorted(pieces)


def parsed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = [parse(t) for t in frame["text"]]
        yield pd.DataFrame({
            "conv_id": frame["conv_id"].astype("Int64"), "turn": frame["turn"].astype("Int64"), "role": frame["role"],
            "clean": [r[0] for r in rows], "levels": [[q[0] for q in r[1]] for r in rows],
            "quotes": [[q[1] for q in r[1]] for r in rows], "offers": [r[2] for r in rows],
            "wholes": [[p[0] for p in r[3]] for r in rows], "pieces": [[p[1] for p in r[3]] for r in rows],
            "words": [[p[2] for p in r[3]] for r in rows]})


def positions(places: DataFrame, staging: Staging) -> DataFrame:
    """Each place's rank in its conversation; a long conversation is ranked in several ranges."""
    order = ["root_turn", "depth", "turn"]
    n = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = staging.put("ranged", places.repartitionByRange(n, "conv_id", *order).withColumn("part", F.spark_partition_id()))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = places.groupBy("conv_id", "part").count().select(
        "conv_id", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    ranked = places.withColumn("rank", F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order)))
    return ranked.join(counts, ["conv_id", "part"]).withColumn("position", F.col("before") + F.col("rank") - 1).drop("part", "before", "rank")


def link(messages: DataFrame) -> DataFrame:
    """Every message with its parent, root, depth, quotation counts and formatted text."""
    staging = Staging(messages.sparkSession, "quotations")
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                           F.col("role").cast("string").alias("role"), "text")
    rows = staging.put("parsed", rows.mapInPandas(
        parsed, "conv_id long, turn long, role string, clean string, levels array<int>, quotes array<string>, offers array<string>, "
        "wholes array<string>, pieces array<string>, words array<int>"))
    known = rows.where("conv_id is not null and turn is not null")
    quotes = known.select("conv_id", "turn", F.explode(F.arrays_zip("levels", "quotes")).alias("q")).select(
        "conv_id", "turn", F.col("q.levels").alias("level"), F.col("q.quotes").alias("passage"))
    pieces = known.select("conv_id", "turn", F.explode(F.arrays_zip("wholes", "pieces", "words")).alias("p")).select(
        "conv_id", "turn", F.col("p.wholes").alias("passage"), F.col("p.pieces").alias("piece"), F.col("p.words").alias("words")).distinct()
    asked = quotes.select("conv_id", "passage").union(pieces.select("conv_id", "piece")).distinct()
    offers = known.select("conv_id", F.col("turn").alias("source_turn"), F.explode("offers").alias("passage"))
    offers = staging.put("offers", offers.join(asked, ["conv_id", "passage"], "left_semi").distinct())
    first = staging.put("first", offers.groupBy("conv_id", "passage").agg(F.min("source_turn").alias("source_turn")))
    linked = quotes.join(first, ["conv_id", "passage"]).where("source_turn < turn")
    # passages without an original as a whole: the candidate that covers most
    key = ["conv_id", "turn", "passage"]
    pieces = staging.put("pieces", pieces.join(linked.select(key).distinct(), key, "left_anti"))
    candidates = (pieces.join(first.withColumnRenamed("passage", "piece"), ["conv_id", "piece"]).where("source_turn < turn")
                  .select(*key, "source_turn").distinct())
    covered = (pieces.where("words > 0").join(candidates, key)
               .join(offers.withColumnRenamed("passage", "piece"), ["conv_id", "piece", "source_turn"])
               .groupBy(*key, "source_turn").agg(F.sum("words").alias("words")))
    best = covered.groupBy(key).agg(F.max(F.struct("words", (-F.col("source_turn")).alias("back"))).alias("b"))
    best = best.select(*key, (-F.col("b.back")).alias("source_turn"))
    linked = linked.unionByName(quotes.join(best, key))
    outer = linked.groupBy("conv_id", "turn", "level").agg(F.max("source_turn").alias("parent"), F.count("*").alias("n"))
    parents = outer.groupBy("conv_id", "turn").agg(
        F.min(F.struct("level", "parent")).alias("p"), F.sum("n").alias("n_linked"))
    parents = staging.put("parents", parents.select("conv_id", "turn", F.col("p.parent").alias("parent_turn"), "n_linked"))
    at = staging.put("jump0", parents.select("conv_id", "turn", F.col("parent_turn").alias("root_turn"), F.lit(1).cast("long").alias("depth")))
    k = 0
    while True:
        over = at.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("next"), F.col("depth").alias("more"))
        moved = at.join(over, ["conv_id", "root_turn"], "left")
        k += 1
        moved = staging.put(f"jump{k}", moved.select(
            "conv_id", "turn", F.coalesce("next", "root_turn").alias("root_turn"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved")))
        go_on = not moved.where("moved").isEmpty()
        at = moved.drop("moved")
        staging.drop(f"jump{k - 1}")
        if not go_on:
            break
    places = known.select("conv_id", "turn").distinct().join(at, ["conv_id", "turn"], "left").join(parents, ["conv_id", "turn"], "left")
    places = places.withColumns({"root_turn": F.coalesce("root_turn", "turn"), "depth": F.coalesce("depth", F.lit(0))})
    out = rows.join(positions(places, staging), ["conv_id", "turn"], "left")
    return out.select(
        "conv_id", "turn", "role", "parent_turn", F.coalesce("root_turn", "turn").alias("root_turn"), "position",
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), F.size("quotes").cast("long").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.col("clean")).alias("message"))
