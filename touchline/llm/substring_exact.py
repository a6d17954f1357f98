"""Exact removal of repeated 50-byte substrings by bucket-pointer refinement.

Suffixes are put in buckets by their first 25 bytes, and buckets are refined by the bucket
identifiers found at later offsets; a bucket that lies in one document only leaves at once.
Identifiers are hashes, so any task computes those of its own text and only sorting on them
needs a shuffle.  Three rounds, each reusing what the one before left open:

1. *Initial buckets.*  Of every 50-byte string only its least 25-byte identifier is posted, so
   that consecutive strings share one post (a run).  Identifiers seen in one document only end
   here, with all their strings.
2. *Runs.*  A run refined over its whole length is one string.  If a smaller document holds the
   same run, all its strings are covered.  If no other run anywhere has its identifier, none of
   its strings can be met elsewhere.
3. *Single strings.*  What is still open, mostly around edits, is sorted on the pair of
   identifiers at offsets 0 and 25, which names the 50-byte string.

A task first joins equal identifiers of its own rows, so the hottest passage costs a row a
chunk, not a row a document; sorting spills in the JVM and Python holds one group at a time.

Null text counts as empty.  A row without doc_id is neither source nor target.  Rows that
repeat a doc_id are separate texts that don't match each other.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .staging import Staging

WIDTH, GRAM = 50, 25
CHUNK = 750_000
LOW48 = np.uint64((1 << 48) - 1)
EVEN = np.uint64((1 << 64) - 2)
#: Counts from here on are unknown in a packed post.
MANY = (1 << 15) - 1
#: A post: identifier (in ``h1`` alone, or in both), document, how far the greatest document of a joined
#: post is from it, number of posts (0: answered already), and of the initial bucket, each where asked for.
POST = {"buckets": "h1 long, doc_id long, span long, cnt int", "runs": "h1 long, h2 int, doc_id long, cnt int, need int",
        "strings": "h1 long, h2 int, doc_id long, cnt int"}
COLUMNS = {kind: [c.split()[0] for c in post.split(", ")] for kind, post in POST.items()}


class Runs:
    """All 50-byte strings of a batch of texts, in runs that share their least 25-byte identifier."""

    def __init__(self, raw: list[bytes]):
        self.size = np.array([len(b) for b in raw], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.size)])
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        none = np.zeros(0, np.int64)
        self.start = self.end = self.text = none
        if len(self.data) < WIDTH:
            self.fp = none.view(np.uint64)
            return
        self.prefix = T.Prefix(self.data)
        self.gram = T.mix(self.prefix.windows(GRAM))
        low, step = self.gram, 1
        count = WIDTH - GRAM + 1
        while 2 * step <= count:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        low = np.minimum(low[: len(low) - (count - step)], low[count - step :])
        # A stretch of equal values ends where a text begins and where its last string has begun.
        first = np.maximum(self.offsets[:-1], self.offsets[1:] - WIDTH + 1)
        new = np.ones(len(low) + 1, bool)
        np.not_equal(low[1:], low[:-1], out=new[1:-1])
        for at in (self.offsets, first):
            new[at[at < len(low)]] = True
        bound = np.flatnonzero(new)
        cut = np.searchsorted(bound[:-1], self.offsets)
        text = np.repeat(np.arange(len(raw)), np.diff(cut))
        keep = np.flatnonzero(bound[: len(text)] < first[text])
        self.start, self.end, self.text = bound[keep], bound[keep + 1], text[keep]
        self.fp = low[self.start] & LOW48

    def names(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of whole runs."""
        a, b = self.start[at], self.end[at] + WIDTH - 1
        half = (a + b) // 2
        return self.prefix.spans(a, b) & EVEN, (self.prefix.spans(half, b) >> np.uint64(33)).astype(np.int32)

    def strings(self, at: np.ndarray) -> np.ndarray:
        """Positions of all strings of some runs."""
        n = self.end[at] - self.start[at]
        return np.repeat(self.start[at] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())

    def string_names(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, later = self.gram[x], self.gram[x + GRAM]
        return T.mix(first * np.uint64(0xD1B54A32D192ED03) + later) & EVEN, (later >> np.uint64(33)).astype(np.int32)


class Marks:
    """Lists of identifiers, one list a text, asked for all texts of a batch at once."""

    def __init__(self, lists: list):
        filled = [(i, np.asarray(x).view(np.uint64)) for i, x in enumerate(lists) if x is not None and len(x)]
        self.value = np.concatenate([x for _, x in filled]) if filled else np.zeros(0, np.uint64)
        self.text = np.repeat([i for i, _ in filled], [len(x) for _, x in filled]).astype(np.uint64)

    @staticmethod
    def key(text: np.ndarray, value: np.ndarray) -> np.ndarray:
        return T.mix(value ^ T.mix(text.astype(np.uint64) + np.uint64(1)))

    def __contains__(self, _):
        raise TypeError("ask has()")

    def has(self, text: np.ndarray, value: np.ndarray) -> np.ndarray:
        return np.isin(self.key(text, value), self.key(self.text, self.value))


def live_counts(runs: Runs, posts: list) -> np.ndarray:
    """How often a run's identifier occurs in all documents; 0 unknown, -1 in one document only."""
    marks = Marks(posts)
    if not len(marks.value) or not len(runs.fp):
        return np.full(len(runs.fp), -1)
    count = (marks.value & np.uint64(MANY)).astype(np.int64)
    key = Marks.key(marks.text, marks.value >> np.uint64(15))
    order = np.argsort(key)
    key, count = key[order], count[order]
    asked = Marks.key(runs.text, runs.fp)
    at = np.minimum(np.searchsorted(key, asked), len(key) - 1)
    return np.where(key[at] == asked, count[at], -1)


def collapse(rows: list[tuple[np.ndarray, ...]], kind: str) -> pd.DataFrame:
    """One open row for each identifier of a chunk, and closed rows for its other documents.

    The open row holds the least and greatest document and the number of posts.  The other
    documents' answer is known already: their rows (cnt 0) are dealt out by document.
    """
    h1, h2, doc, need = (np.concatenate(c) for c in zip(*rows, strict=True))
    order = np.argsort(h1)
    h1 = h1[order]
    same = h1[1:] == h1[:-1]
    tied = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same])) if len(h1) else order
    part = order[tied]
    order[tied] = part[np.lexsort((doc[part], h2[part], h1[tied]))]
    h2, doc, need = h2[order], doc[order], need[order]
    if not len(h1):
        return pd.DataFrame({c: [] for c in COLUMNS[kind]})
    new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
    start = np.flatnonzero(new)
    size = np.diff(np.concatenate([start, [len(h1)]]))
    other = ~new & np.concatenate([[False], doc[1:] != doc[:-1]])
    k = np.flatnonzero(other)
    zero = np.zeros(len(k), np.int64)
    at = np.concatenate([start, k])
    order = np.argsort(doc[at], kind="stable")  # equal neighbours shrink in the shuffle files
    out = {"h1": h1[at].view(np.int64), "h2": h2[at], "doc_id": doc[at], "cnt": np.concatenate([size, zero]).astype(np.int32)}
    if "span" in COLUMNS[kind]:
        out["span"] = np.concatenate([doc[start + size - 1] - doc[start], zero])
    if "need" in COLUMNS[kind]:
        out["need"] = np.concatenate([need[start], zero]).astype(np.int32)
    return pd.DataFrame({c: out[c][order] for c in COLUMNS[kind]})


def packed(texts: pd.Series) -> pd.Series:
    """Texts as compressed bytes, which halves what the join by document shuffles and stores."""
    press = zstandard.ZstdCompressor(level=3)
    return pd.Series([press.compress(b) for b in T.encode(texts)])


def texts_of(frame: pd.DataFrame) -> list[bytes]:
    if "text" in frame:
        return T.encode(frame["text"])
    open_ = zstandard.ZstdDecompressor()
    return [open_.decompress(b) for b in frame["data"]]


def posting(rows_of, kind: str):
    """A mapInPandas function that posts ``rows_of(runs, ids, frame)`` in collapsed chunks."""

    def post(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, ...]] = []
        for frame in frames:
            raw = texts_of(frame)
            for a, b in T.batches(raw, T.CACHED):
                part = frame.iloc[a:b]
                held.append(rows_of(Runs(raw[a:b]), part["doc_id"].to_numpy(), part))
                if sum(len(h[0]) for h in held) > CHUNK:
                    yield collapse(held, kind)
                    held = []
        if held:
            yield collapse(held, kind)

    return post


def initial_posts(runs: Runs, ids: np.ndarray, _: pd.DataFrame) -> tuple[np.ndarray, ...]:
    return runs.fp, np.zeros(len(runs.fp), np.int32), ids[runs.text], np.zeros(len(runs.fp), np.int64)


def run_posts(runs: Runs, ids: np.ndarray, frame: pd.DataFrame) -> tuple[np.ndarray, ...]:
    count = live_counts(runs, frame["posts"].tolist())
    at = np.flatnonzero(count >= 0)
    h1, h2 = runs.names(at) if len(at) else (np.zeros(0, np.uint64), np.zeros(0, np.int32))
    return h1, h2, ids[runs.text[at]], count[at]


def open_runs(runs: Runs, frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Runs still to be cut into strings, and covered runs."""
    at = np.flatnonzero(live_counts(runs, frame["posts"].tolist()) >= 0)
    if not len(at):
        return at, at
    h1, _ = runs.names(at)
    done = Marks(frame["runs"].tolist())
    covered = done.has(runs.text[at], h1)
    return at[~covered & ~done.has(runs.text[at], h1 | np.uint64(1))], at[covered]


def string_posts(runs: Runs, ids: np.ndarray, frame: pd.DataFrame) -> tuple[np.ndarray, ...]:
    at, _ = open_runs(runs, frame)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.astype(np.int32), none, none
    x = runs.strings(at)
    h1, h2 = runs.string_names(x)
    return h1, h2, ids[np.repeat(runs.text[at], runs.end[at] - runs.start[at])], np.zeros(len(x), np.int64)


def answers(kind: str):
    """A mapInPandas function over posts sorted by ``h1``; one group may span batches."""

    def settle(g: pd.DataFrame) -> pd.DataFrame:
        h1 = g["h1"].to_numpy()
        h2 = g["h2"].to_numpy() if "h2" in g else np.zeros(len(g), np.int8)
        if ((h1[1:] == h1[:-1]) & (h2[1:] != h2[:-1])).any():
            order = np.lexsort((h2, h1))
            g, h1, h2 = g.iloc[order], h1[order], h2[order]
        doc, cnt = g["doc_id"].to_numpy(), g["cnt"].to_numpy().astype(np.int64)
        start = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
        of = np.repeat(np.arange(len(start)), np.diff(np.concatenate([start, [len(h1)]])))
        known = cnt == 0
        far = np.iinfo(np.int64)
        least = np.minimum.reduceat(np.where(known, far.max, doc), start)[of]
        total = np.add.reduceat(cnt, start)[of]
        if kind == "buckets":
            most = np.maximum.reduceat(np.where(known, far.min, doc + g["span"].to_numpy()), start)[of]
            keep = known | (least < most)
            n = np.where(known | (total >= MANY), 0, total)
            value = (h1 << 15) | n
        else:
            covered = known | (doc > least)
            closed = ~covered & (g["need"].to_numpy() == total) if kind == "runs" else np.zeros(len(g), bool)
            keep = covered | closed
            value = h1 | closed
        return pd.DataFrame({"doc_id": doc[keep], "value": value[keep]})

    def answer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for frame in frames:
            if not len(frame):
                continue
            h1 = frame["h1"].to_numpy()
            cut = int(np.searchsorted(h1, h1[-1]))
            if cut:
                yield settle(pd.concat([*held, frame.iloc[:cut]]) if held else frame.iloc[:cut])
                held = []
            held.append(frame.iloc[cut:])
        if held:
            yield settle(pd.concat(held))

    return answer


def exchange(rows: DataFrame, kind: str, n: int) -> DataFrame:
    """What each document is told about the identifiers it posted, as one array."""
    deal = F.when(F.col("cnt") == 0, F.xxhash64("h1", "doc_id")).otherwise(F.col("h1"))
    # On one long column Spark sorts by radix; equal h1 with different h2 are put in order by the group.
    told = (rows.repartition(n, deal).sortWithinPartitions("h1")
            .mapInPandas(answers(kind), "doc_id long, value long"))
    return told.groupBy("doc_id").agg(F.collect_list("value").alias(kind))


def removal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Byte and run counts and the digest of what stays."""
    for frame in frames:
        raw = texts_of(frame)
        for a, b in T.batches(raw, T.CACHED):
            part = frame.iloc[a:b]
            runs = Runs(raw[a:b])
            at, covered = open_runs(runs, part)
            edge = np.zeros(len(runs.data) + 1, np.int32)
            if len(covered):
                np.add.at(edge, runs.start[covered], 1)
                np.add.at(edge, runs.end[covered] + WIDTH - 1, -1)
            if len(at):
                x = runs.strings(at)
                text = np.repeat(runs.text[at], runs.end[at] - runs.start[at])
                x = x[Marks(part["strings"].tolist()).has(text, runs.string_names(x)[0])]
                np.add.at(edge, x, 1)
                np.add.at(edge, x + WIDTH, -1)
            gone = np.cumsum(edge[:-1]) > 0
            rows = []
            for i, doc in enumerate(part["doc_id"]):
                lo, hi = runs.offsets[i], runs.offsets[i + 1]
                g = gone[lo:hi]
                spans = int(g[0]) + int(np.count_nonzero(g[1:] & ~g[:-1])) if len(g) else 0
                kept = runs.data[lo:hi][~g].tobytes() if spans else raw[a + i]
                rows.append((doc, hi - lo, int(g.sum()), spans, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of every row."""
    spark = docs.sparkSession
    staging = Staging(spark, "substring")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    long_enough = docs.where(f"doc_id is not null and octet_length(text) >= {WIDTH}")
    posts = exchange(long_enough.mapInPandas(posting(initial_posts, "buckets"), POST["buckets"]), "buckets", n)
    posts = staging.put("posts", posts.withColumnRenamed("buckets", "posts"))
    staging.release()
    data = docs.select("doc_id", F.pandas_udf(packed, "binary")("text").alias("data"))
    marked = data.join(posts.hint("shuffle_hash"), "doc_id", "left")
    marked = staging.put_bucketed("marked", marked, "doc_id", n)
    staging.drop("posts")
    staging.release()
    runs = exchange(marked.where("posts is not null").mapInPandas(posting(run_posts, "runs"), POST["runs"]), "runs", n)
    runs = staging.put("runs", runs)
    staging.release()
    cut = marked.join(runs.hint("shuffle_hash"), "doc_id", "left")
    strings = exchange(cut.where("posts is not null").mapInPandas(posting(string_posts, "strings"), POST["strings"]), "strings", n)
    strings = staging.put("strings", strings)
    staging.release()
    return cut.join(strings.hint("shuffle_hash"), "doc_id", "left").mapInPandas(
        removal, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
