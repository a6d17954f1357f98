"""Fuzzy repeated passages by collinear chaining of shared word seeds.

1. *Seeds.*  One in four eight-word k-mers, chosen by its hash alone, so that both texts of a fuzzy
   passage choose the same ones; and the least of any eleven in a row without one.  Seeds held by
   one document only are dropped.
2. *Join.*  Every seed is joined to its first holder (smallest doc_id, then position).  Each later
   occurrence makes one match, so a seed of a third of all documents makes no pairs among them;
   the join key is left to Spark to split.
3. *Runs.*  Seeds of one passage may have first holders in different places.  So runs of seeds are
   joined to the first holder of the run too: the ``MIN_WORDS`` words from a seed on, where their
   seeds don't lie in one place of one holder, and pairs of seeds, one in ``NEAR`` and one in ``FAR`` words, whose
   holders lie apart.  Whether a run is asked for depends on its seeds alone, so that both sides
   ask for the same ones.  Equal passages of ``MIN_WORDS`` + ten words are therefore always found.
4. *Chains.*  The matches of a document with one earlier document are chained in order of both
   positions; of matches in one line one in eight words and the last are kept.
   A chain scores eight a seed less a cost for the words it skips on both sides; the best
   predecessor comes from a Fenwick tree of prefix maxima.  A chain is cut where it skips more
   than ``MAX_GAP`` words.
5. *Alignment.*  The words between chained seeds are aligned, ends are extended by up to
   ``MAX_GAP`` words while equal words outweigh others, and passages of ``MIN_WORDS`` words or
   more with an identity of 0.75 or more stay.  A chain of less identity is cut at its widest gap.
   Chains inside another chain of the document come later, and only where no passage was found that
   holds them: a place of a document is reported with its best source.

Words are as elsewhere: runs without ASCII white space, A-Z lower-cased.  Null and short texts
have no seeds.  Rows without doc_id are left out; rows that repeat a doc_id are texts of one
document, which don't match each other.  Other columns are ignored.  A document whose passages come all from earlier documents
has rows; the first holder of a passage has none for it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .staging import Staging

K = 8
#: One in so many k-mers is a seed by its hash alone; so many k-mers in a row have at least one.
RATE, WINDOW = 4, 11
MIN_WORDS, IDENTITY = 40, 0.75
GAP_COST, MAX_GAP = 0.05, 100
#: Distances of the second seed of a pair, ends included.
NEAR, FAR = (K, 24), (25, 48)
#: Words beyond a chain's ends that may still belong to its passage.
MARGIN, GRID = MAX_GAP, 256
#: An unequal word beyond an end weighs as much as so many equal ones; how far the sum may fall.
UNEQUAL, DROP = 3, 20


def sampled(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which k-mers are seeds: one in ``RATE`` by hash, and the least of ``WINDOW`` in a row of one text without any."""
    pick = h % np.uint64(RATE) == 0
    n = len(h) - WINDOW + 1
    if n > 0:
        count = np.concatenate([[0], np.cumsum(pick)])
        bare = np.flatnonzero((count[WINDOW:] == count[:n]) & (text[WINDOW - 1 :] == text[:n]))
        pick[bare + h[bare[:, None] + np.arange(WINDOW)].argmin(axis=1)] = True
    return pick


def seeds(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sampled k-mers of each text, with the hash of the ``MIN_WORDS`` words from there on (0: text ends before)."""
    for raw, ids, words, at, h, of, pick in picked(frames):
        # k-mers of one text are a row of words: k-mer i + d of the same text is d words on
        text, end = of[pick], pick + MIN_WORDS - K
        long = np.flatnonzero(end < len(at))
        long = long[of[end[long]] == text[long]]
        run = np.zeros(len(pick), np.uint64)
        for k in range(0, MIN_WORDS - K + 1, K):
            run[long] += h[pick[long] + k] * T.WORD_FACTORS[k]
        run[long] = T.mix(run[long])
        copy = np.array([zlib.crc32(x) for x in raw], np.uint32).view(np.int32)
        yield pd.DataFrame({"seed": h[pick].view(np.int64), "run": run.view(np.int64), "doc_id": ids[text], "copy": copy[text],
                            "pos": (at[pick] - words.first[text]).astype(np.int32)})


def leads(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first place of every seed in each text."""
    for _, ids, words, at, h, of, pick in picked(frames):
        if not len(pick):
            continue
        key = h[pick] ^ T.mix(of[pick].astype(np.uint64) + np.uint64(1))
        order = np.argsort(key)
        key = key[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        pick = pick[np.sort(np.minimum.reduceat(order, start))]
        text = of[pick]
        yield pd.DataFrame({"seed": h[pick].view(np.int64), "doc_id": ids[text], "pos": (at[pick] - words.first[text]).astype(np.int32)})


def picked(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Slices of texts: bytes, documents, words, k-mers with their first word, hash and text, and which of them are seeds."""
    for frame in frames:
        raw, ids = T.encode(frame["text"]), frame["doc_id"].to_numpy()
        for a, b in T.batches(raw, T.CACHED):
            words = T.Words(raw[a:b])
            at, h = words.grams(K)
            of = words.text[at]
            yield raw[a:b], ids[a:b], words, at, h, of, np.flatnonzero(sampled(h, of))


def whole(frames: Iterator[pd.DataFrame], key: str = "doc_id") -> Iterator[pd.DataFrame]:
    """Rows sorted by a whole number anew, cut only between different numbers."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        value = frame[key].to_numpy()
        cut = int(np.searchsorted(value, value[-1]))
        if held and held[-1][key].iat[-1] != value[0]:
            yield pd.concat(held)
            held = []
        if cut:
            yield pd.concat([*held, frame.iloc[:cut]])
            held = []
        held.append(frame.iloc[cut:])
    if held:
        yield pd.concat(held)


def runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of seeds whose first holders lie apart, of rows sorted by document."""
    for g in whole(frames):
        doc, copy, x = (g[c].to_numpy() for c in ("doc_id", "copy", "pos"))
        order = np.lexsort((x, copy, doc))
        doc, copy, x = doc[order], copy[order], x[order]
        fresh = np.concatenate([[True], (doc[1:] != doc[:-1]) | (copy[1:] != copy[:-1]) | (x[1:] != x[:-1])])
        order, doc, copy, x = order[fresh], doc[fresh], copy[fresh], x[fresh]  # the same text twice
        src, y = g["src"].to_numpy()[order], g["src_pos"].to_numpy()[order].astype(np.int64)
        seed, run = (g[c].to_numpy()[order].view(np.uint64) for c in ("seed", "run"))
        n = len(doc)
        turn = (doc[1:] != doc[:-1]) | (copy[1:] != copy[:-1])
        text = np.concatenate([[0], np.cumsum(turn)])
        place = text * (1 << 32) + x
        apart = np.concatenate([[0], np.cumsum((src[1:] != src[:-1]) | (np.diff(y) != np.diff(x)))])

        last = np.searchsorted(place, place + MIN_WORDS - K, "right") - 1
        i = np.flatnonzero((run != 0) & (apart[last] > apart))
        ends = [(i, x[i] + MIN_WORDS - K, run[i])]

        for salt, (lo, hi) in enumerate((NEAR, FAR), 1):
            begin, end = np.searchsorted(place, place + lo), np.searchsorted(place, place + hi, "right")
            i = np.flatnonzero((begin < end) & (apart[end - 1] > apart))
            begin, end = begin[i], end[i]
            least, j = np.full(len(i), np.iinfo(np.uint64).max), begin.copy()
            left, at = np.arange(len(i)), begin.copy()
            while len(left):
                value = (seed[i[left]] ^ seed[at]) * T.WORD_FACTORS[0]
                better = value < least[left]
                least[left[better]], j[left[better]] = value[better], at[better]
                more = at + 1 < end[left]
                left, at = left[more], at[more] + 1
            far = y[j] - y[i]
            keep = (src[i] != src[j]) | (far <= 0) | (far > MAX_GAP)
            i, j = i[keep], j[keep]
            ends.append((i, x[j], T.mix(seed[i] * T.WORD_FACTORS[1] + seed[j] * T.WORD_FACTORS[2] + np.uint64(salt))))
        i, end, h = (np.concatenate(c) for c in zip(*ends, strict=True))
        yield pd.DataFrame({"run": h.view(np.int64), "doc_id": doc[i], "pos": x[i], "span": (end - x[i]).astype(np.int32)})


class Fenwick:
    """Prefix maxima under point updates."""

    def __init__(self, n: int):
        self.best = [(-np.inf, -1)] * (n + 1)

    def put(self, i: int, value: tuple[float, int]) -> None:
        i += 1
        while i < len(self.best):
            if value > self.best[i]:
                self.best[i] = value
            i += i & -i

    def below(self, i: int) -> tuple[float, int]:
        found = (-np.inf, -1)
        while i > 0:
            if self.best[i] > found:
                found = self.best[i]
            i -= i & -i
        return found


def chains(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Disjoint collinear chains of matches sorted by (x, y), best first, cut at wide gaps."""
    xs, ys, n = x.tolist(), y.tolist(), len(x)
    score, before = [0.0] * n, [-1] * n
    i = 0
    if len(set(xs)) == n and len({v - u for u, v in zip(xs, ys, strict=True)}) == 1:
        # in one line each match adds K to the greatest sum so far, so the best predecessor is the last one
        top = -np.inf
        while i < n:
            cost = GAP_COST * (xs[i] + ys[i])
            score[i], before[i] = (K + top - cost, i - 1) if top - cost > 0 else (float(K), -1)
            top = score[i] + cost
            i += 1
    else:
        rank = np.unique(y, return_inverse=True)[1].tolist()
        tree = Fenwick(max(rank) + 1)
    while i < n:
        j = i
        while j < n and xs[j] == xs[i]:
            top, at = tree.below(rank[j])
            gain = top - GAP_COST * (xs[j] + ys[j])
            score[j], before[j] = (K + gain, at) if gain > 0 else (float(K), -1)
            j += 1
        for m in range(i, j):
            tree.put(rank[m], (score[m] + GAP_COST * (xs[m] + ys[m]), m))
        i = j
    used, out = [False] * n, []
    for end in sorted(range(n), key=lambda m: (-score[m], m)):
        chain, m = [], end
        while m >= 0 and not used[m]:
            used[m] = True
            chain.append(m)
            m = before[m]
        if chain:
            part = [m := chain.pop()]
            while chain:
                k = chain.pop()
                if xs[k] - xs[m] > MAX_GAP or ys[k] - ys[m] > MAX_GAP:
                    out.append(np.array(part))
                    part = []
                part.append(m := k)
            out.append(np.array(part))
    return out


def thinned(doc: np.ndarray, src: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which matches stay, sorted by (doc, src, x, y): of those of a (doc, src) in one line, at most 2K words apart, one in K words and the last."""
    diagonal = x.astype(np.int64) - y
    order = np.lexsort((x, diagonal, src, doc))
    d, s, e, p = doc[order], src[order], diagonal[order], x[order]
    same = (d[1:] == d[:-1]) & (s[1:] == s[:-1]) & (e[1:] == e[:-1])
    fresh = np.concatenate([[True], ~(same & (np.diff(p) == 0))])
    order, d, s, e, p = (c[fresh] for c in (order, d, s, e, p))
    same = (d[1:] == d[:-1]) & (s[1:] == s[:-1]) & (e[1:] == e[:-1])
    opens = np.concatenate([[True], ~same | (np.diff(p) > 2 * K)])
    first = p[np.flatnonzero(opens)][np.cumsum(opens) - 1]
    place = (p - first) // K
    keep = opens | np.concatenate([[True], place[1:] != place[:-1]]) | np.concatenate([opens[1:], [True]])
    kept = order[keep]
    return kept[np.lexsort((y[kept], x[kept], src[kept], doc[kept]))]


def chained(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chains of each (doc_id, src), of matches sorted by document."""
    for g in whole(frames):
        columns = [g[c].to_numpy() for c in ("doc_id", "src", "pos", "src_pos")]
        kept = thinned(*columns)
        doc, src, x, y = (c[kept] for c in columns)
        rows = []
        start = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (src[1:] != src[:-1])])).tolist()
        for a, b in zip(start, [*start[1:], len(doc)], strict=True):
            if b - a == 1:
                rows.append((doc[a], src[a], x[a:b], y[a:b]))
                continue
            for c in chains(x[a:b], y[a:b]):
                rows.append((doc[a], src[a], x[a:b][c], y[a:b][c]))
        yield pd.DataFrame(rows, columns=["doc_id", "src", "xs", "ys"])


def cut_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words lo to hi of a text for each of its ``parts``, one space between them."""
    lower = bytes(T.LOWER)
    for frame in frames:
        out, size = [], 0
        for doc, text, parts in zip(frame["doc_id"], frame["text"], frame["parts"], strict=True):
            words = text.encode().translate(lower).split()
            for p in parts:
                out.append((doc, p["lo"], p["hi"], b" ".join(words[p["lo"] : p["hi"]]).decode()))
                size += len(out[-1][3])
            if size > T.SLICE:
                yield pd.DataFrame(out, columns=["doc_id", "lo", "hi", "words"])
                out, size = [], 0
        if out:
            yield pd.DataFrame(out, columns=["doc_id", "lo", "hi", "words"])


def reach(pairs: Iterable[tuple[str, str]]) -> int:
    """How many pairs of words extend a passage: up to where equal ones outweigh the others most."""
    score = best = n = 0
    for i, (s, t) in enumerate(pairs, 1):
        score += 1 if s == t else -UNEQUAL
        if score > best:
            best, n = score, i
        elif score < best - DROP:
            break
    return n


def equal(p: list[str], q: list[str]) -> int:
    """How many words are equal, place by place."""
    return len(p) if p == q else sum(map(eq, p, q))


def matched(a: list[str], b: list[str]) -> int:
    """Size of all blocks that ``difflib.SequenceMatcher`` matches: the longest first, then those on its two sides."""
    place: dict[str, list[int]] = {}
    for j, w in enumerate(b):
        place.setdefault(w, []).append(j)
    places = [place.get(w, ()) for w in a]
    total, left = 0, [(0, len(a), 0, len(b))]
    while left:
        a0, a1, b0, b1 = left.pop()
        size = x = y = 0
        before: dict[int, int] = {}
        for i in range(a0, a1):
            here = {}
            for j in places[i]:
                if j >= b1:
                    break
                if j >= b0:
                    here[j] = k = before.get(j - 1, 0) + 1
                    if k > size:
                        size, x, y = k, i + 1, j + 1
            before = here
        if size:
            total += size
            if a0 < x - size and b0 < y - size:
                left.append((a0, x - size, b0, y - size))
            if x < a1 and y < b1:
                left.append((x, a1, y, b1))
    return total


def align(a: list[str], b: list[str], xs: list[int], ys: list[int], known: dict) -> tuple[int, int, int, int, int]:
    """Extent on both sides and number of equal words of the passage around chained seeds.

    The number is exact where it makes a passage; otherwise it may be any bound that makes none.
    ``known`` keeps what the parts of one chain ask for again.
    """
    u, v = xs[0], ys[0]
    if (n := known.get((u, v))) is None:
        n = known[u, v] = reach(zip(reversed(a[max(u - MARGIN, 0) : u]), reversed(b[max(v - MARGIN, 0) : v])))
    x0, y0 = u - n, v - n
    x1, y1 = xs[-1] + K, ys[-1] + K
    if (n := known.get((x1, y1, 0))) is None:
        n = known[x1, y1, 0] = reach(zip(a[x1 : x1 + MARGIN], b[y1 : y1 + MARGIN]))
    x1, y1 = x1 + n, y1 + n
    same, x, y, s, t, gaps = 0, x0, y0, xs[0], ys[0], []
    for u, v in zip(xs, ys, strict=True):
        if u - s != v - t:  # another line: the one before, then the words between both
            same += equal(a[x:s], b[y:t])
            gaps.append((s, u, t, v))
            same += min(u - s, v - t)
            x, y = u, v
        s, t = u, v
    same += equal(a[x:x1], b[y:y1])
    least = IDENTITY * max(x1 - x0, y1 - y0)
    for gap in gaps:
        if same < least:
            break
        s, u, t, v = gap
        if (n := known.get(gap)) is None:
            n = known[gap] = matched(a[s:u], b[t:v])
        same += n - min(u - s, v - t)
    return x0, x1, y0, y1, same


def passages(a: list[str], b: list[str], xs: list[int], ys: list[int]) -> list[tuple[tuple[int, ...], int]]:
    """Passages of enough words and identity around a chain, each with its number of seeds."""
    left, out, known = [(xs, ys)], [], {}
    while left:
        xs, ys = left.pop()
        x0, x1, y0, y1, same = found = align(a, b, xs, ys, known)
        length = max(x1 - x0, y1 - y0)
        if same >= IDENTITY * length:
            if length >= MIN_WORDS and not any(x0 >= f[0] and x1 <= f[1] and y0 >= f[2] and y1 <= f[3] for f, _ in out):
                out.append((found, len(xs)))
        elif len(xs) > 1:
            gaps = [max(xs[k] - xs[k - 1], ys[k] - ys[k - 1]) for k in range(1, len(xs))]
            cut = gaps.index(max(gaps)) + 1
            left += [(xs[cut:], ys[cut:]), (xs[:cut], ys[:cut])]
    return out


def aligned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words = lru_cache(512)(lambda text: text.split(" "))  # the chains of a document share its parts
    for frame in frames:
        rows = []
        columns = [frame[c].tolist() for c in ("doc_id", "src", "xs", "ys", "a_lo", "b_lo", "a_words", "b_words")]
        for doc, src, xs, ys, a_lo, b_lo, a_words, b_words in zip(*columns, strict=True):
            a, b = words(a_words), words(b_words)
            xs, ys = [x - a_lo for x in xs.tolist()], [y - b_lo for y in ys.tolist()]
            if xs[-1] + K > len(a) or ys[-1] + K > len(b):  # the other text of a repeated doc_id
                continue
            for (x0, x1, y0, y1, same), n in passages(a, b, xs, ys):
                rows.append((doc, src, x0 + a_lo, x1 + a_lo, y0 + b_lo, y1 + b_lo, n, same,
                             round(same / max(x1 - x0, y1 - y0), 6), " ".join(a[x0:x1])))
        yield pd.DataFrame(rows, columns=["doc_id", "src_doc_id", "start_word", "end_word", "src_start_word",
                                          "src_end_word", "n_seeds", "n_equal", "identity", "passage"])


CHAINS = "doc_id long, src long, xs array<int>, ys array<int>"


def leading(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Marks the chains that lie inside no other of their document, of rows sorted by document, start and falling end."""
    for g in whole(frames):
        doc, end = g["doc_id"].to_numpy(), np.array([xs[-1] for xs in g["xs"]], np.int64)
        first = np.concatenate([[True], doc[1:] != doc[:-1]])
        # The farthest end before each row, within its document: documents are set apart by a step.
        step = np.cumsum(first) * (1 << 40)
        before = np.concatenate([[0], np.maximum.accumulate(end + step)[:-1]])
        yield g.assign(lead=first | (end + step > before))


def alignments(made: DataFrame, docs: DataFrame, staging: Staging, name: str) -> DataFrame:
    """The passages around chains, with the words of both texts brought to them."""

    def around(c: str, side: str) -> list:
        # On a grid, so that the chains of a text ask for few different parts of it.
        return [F.expr(f"cast(greatest({c}[0] - {MARGIN}, 0) div {GRID} * {GRID} as int)").alias(f"{side}_lo"),
                F.expr(f"cast((element_at({c}, -1) + {K + MARGIN}) div {GRID} * {GRID} + {GRID} as int)").alias(f"{side}_hi")]

    made = made.select("*", *around("xs", "a"), *around("ys", "b"))
    asked = made.select("doc_id", F.col("a_lo").alias("lo"), F.col("a_hi").alias("hi")).union(
        made.select("src", "b_lo", "b_hi")).distinct()
    # a text travels once for all its parts that begin within the same stretch, not once for each
    parts = staging.put(f"{name}_parts", asked.groupBy("doc_id", F.expr("lo div 4096").alias("stretch")).agg(
        F.collect_list(F.struct("lo", "hi")).alias("parts")))
    slices = parts.join(docs, "doc_id").select("doc_id", "text", "parts")
    slices = staging.put(f"{name}_slices", slices.mapInPandas(cut_words, "doc_id long, lo int, hi int, words string"))
    staging.release()

    def side(key: str, s: str) -> DataFrame:
        return slices.select(F.col("doc_id").alias(key), F.col("lo").alias(f"{s}_lo"), F.col("hi").alias(f"{s}_hi"),
                             F.col("words").alias(f"{s}_words"))

    both = made.join(side("doc_id", "a"), ["doc_id", "a_lo", "a_hi"]).join(side("src", "b"), ["src", "b_lo", "b_hi"])
    return both.mapInPandas(aligned, "doc_id long, src_doc_id long, start_word int, end_word int, src_start_word int, "
                            "src_end_word int, n_seeds int, n_equal int, identity double, passage string")


def fuzzy_passages(docs: DataFrame) -> DataFrame:
    """One row for each passage of a document that repeats, exactly or nearly, in an earlier one."""
    spark = docs.sparkSession
    staging = Staging(spark, "chains")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    lead = docs.mapInPandas(leads, "seed long, doc_id long, pos int")
    found = docs.mapInPandas(seeds, "seed long, run long, doc_id long, copy int, pos int")
    # plain numbers only, so that equal seeds of a task are joined by hash before they are sent
    first = (lead.groupBy("seed").agg(F.min("doc_id").alias("src"), F.min_by("pos", "doc_id").alias("src_pos"),
                                      F.max("doc_id").alias("m")).where("src < m").drop("m"))
    first = staging.put("first", first)  # the join can then split a hot seed
    held = staging.put("held", found.join(first.hint("shuffle_hash"), "seed"))
    staging.release()
    # on one long column Spark sorts by radix; the order within a document is made in the task
    asked = (held.repartition(n, "doc_id", "copy").sortWithinPartitions("doc_id")
             .mapInPandas(runs, "run long, doc_id long, pos int, span int"))
    asked = staging.put("runs", asked)
    whole_run = (asked.groupBy("run").agg(F.min(F.struct("doc_id", "pos", "span")).alias("f"), F.max("doc_id").alias("m"))
                 .where("f.doc_id < m").select("run", F.col("f.doc_id").alias("src"), F.col("f.pos").alias("src_pos"),
                                               F.col("f.span").alias("src_span")))
    whole_run = staging.put("first_runs", whole_run)
    ends = asked.join(whole_run, "run").where("doc_id > src")
    matches = (held.where("doc_id > src").select("doc_id", "src", "pos", "src_pos")
               .union(ends.select("doc_id", "src", "pos", "src_pos"))
               .union(ends.select("doc_id", "src", F.expr("pos + span"), F.expr("src_pos + src_span"))))
    made = (matches.repartition(n, "doc_id", "src").sortWithinPartitions("doc_id")
            .mapInPandas(chained, "doc_id long, src long, xs array<int>, ys array<int>"))

    made = staging.put("chains", made)
    staging.release()
    ranked = made.repartition(n, "doc_id").sortWithinPartitions("doc_id", F.element_at("xs", 1), F.element_at("xs", -1).desc(), F.size("xs").desc(), "src")
    ranked = staging.put("ranked", ranked.mapInPandas(leading, CHAINS + ", lead boolean"))
    found = staging.put("passages", alignments(ranked.where("lead").drop("lead"), docs, staging, "lead"))
    # What lies inside another chain counts only where no passage was made of that.
    rest = ranked.where("not lead").drop("lead").join(
        found.select("doc_id", "start_word", "end_word"),
        (ranked["doc_id"] == found["doc_id"]) & (found["start_word"] <= F.element_at("xs", 1)) & (found["end_word"] >= F.element_at("xs", -1) + K),
        "left_anti")
    rest = staging.put("rest", rest)
    return found.union(alignments(rest, docs, staging, "rest"))
