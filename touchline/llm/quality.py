"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is labelled good or bad.  A line's potential is linear in its own features
and those of the lines before and after it; a transition weight ties neighbouring labels.
Training lines take the label of their document.  Forward-backward gives each line's marginal
probability of good, and a document's score is their mean weighted by line length.

The field is fitted on at most ``SAMPLE`` labelled documents of at most ``SAMPLE_BYTES`` bytes,
those with the least id hash, cut into stretches of ``STRETCH`` lines for the fit only.
Everything else reads all documents and whole texts.

A null or empty text has no line with content and scores the share of good training documents;
without labelled rows every score is 0.5.  Labels other than 0 and 1 don't train, nor do rows
without doc_id; of labels that repeat a doc_id the least counts.  Every row is scored, rows
without or with repeated doc_id too.  Other columns are ignored, by ``score`` kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .staging import ship

SAMPLE, SAMPLE_BYTES, STRETCH = 6000, 50_000, 64
ROUNDS, RATE, PENALTY = 250, 0.05, 1e-4

FEATURES = 21
_code = np.arange(256)
LETTERS = ((_code >= 65) & (_code <= 90)) | ((_code >= 97) & (_code <= 122)) | (_code >= 128)
CLASSES = np.array([
    (_code >= 65) & (_code <= 90), (_code >= 48) & (_code <= 57), T.SPACE, np.isin(_code, list(b".,")),
    np.isin(_code, list(b"#$%&*")), _code == ord("!"), _code == ord("|"),
    (_code > 32) & (_code < 127) & ~LETTERS & ~((_code >= 48) & (_code <= 57)) & ~np.isin(_code, list(b".,#$%&*!|")),
    _code >= 128, LETTERS])


class Lines:
    """Lines with content of a batch of texts, with their features."""

    def __init__(self, raw: list[bytes]):
        data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
        text_end = np.cumsum([len(b) + 1 for b in raw])
        end = np.flatnonzero(data == 10)
        start = np.concatenate([[0], end[:-1] + 1])[: len(end)]
        text = np.searchsorted(text_end, start, "right")
        number = np.arange(len(start)) - np.searchsorted(text, text)
        full = end > start
        self.start, self.end, self.text, self.number = start[full], end[full], text[full], number[full]
        self.size = self.end - self.start
        self.features = self._features(data) if len(self.size) else np.zeros((0, FEATURES), np.float32)

    def _features(self, data: np.ndarray) -> np.ndarray:
        bounds = np.column_stack([self.start, self.end]).ravel()
        count = [np.add.reduceat(c[data].astype(np.int32), bounds)[::2] for c in CLASSES]
        inside = ~T.SPACE[data]
        edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
        word, word_end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        prefix, n = T.Prefix(data), self.size
        line = np.searchsorted(self.start, word, "right") - 1
        name = prefix.spans(word, word_end)
        again = (name[1:] == name[:-1]) & (line[1:] == line[:-1])
        words, again = np.bincount(line, minlength=len(n)), np.bincount(line[1:][again], minlength=len(n))
        upper, digit, space, stop, symbol, bang, bar, other, high, letters = count
        key = prefix.spans(self.start, self.end) ^ T.mix(self.text.astype(np.uint64) + np.uint64(1))
        _, at, times = np.unique(key, return_inverse=True, return_counts=True)
        return np.column_stack([
            np.log1p(n), upper / (letters + 1), upper > 0.5 * letters, digit / n, space / n, stop / n, symbol / n,
            symbol > 0.02 * n, bang / n, bang > 0.02 * n, bar / n, bar > 0.01 * n, other / n, high / n,
            letters / n, np.minimum(n / (words + 1), 40), np.log1p(words),
            LETTERS[data[self.start]] & (data[self.start] < 97), times[at] > 1,
            again / (words + 1), again > 0.3 * words]).astype(np.float32)

    def inputs(self) -> np.ndarray:
        """Own, previous and next line's features, and a constant."""
        x = self.features
        same = np.concatenate([[False], self.text[1:] == self.text[:-1]])[:, None]
        zero = np.zeros((1, x.shape[1]), np.float32)
        before = np.where(same, np.concatenate([zero, x[:-1]]), 0) if len(x) else x
        after = np.where(np.concatenate([same[1:], [[False]]]), np.concatenate([x[1:], zero]), 0) if len(x) else x
        return np.column_stack([x, before, after, np.ones(len(x), np.float32)])


def chain(potential: np.ndarray, first: np.ndarray, size: np.ndarray, stay: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of good, of both neighbours equal, and log partition of each sequence.

    Sequence s has the lines first[s] to first[s] + size[s].  ``potential`` is the log-odds of
    good a line, ``stay`` the weight of two equal neighbours.
    """
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    n = len(potential)
    fwd, bwd = np.zeros((n, 2)), np.zeros((n, 2))
    longest = int(size.max(initial=0))
    longer = len(size) - np.searchsorted(size[::-1], np.arange(longest + 1), "right")
    fwd[first, 1] = potential[first]
    for t in range(1, longest):
        a = first[: longer[t]]
        prev, here = fwd[a + t - 1], potential[a + t]
        fwd[a + t, 0] = np.logaddexp(prev[:, 0] + stay, prev[:, 1])
        fwd[a + t, 1] = np.logaddexp(prev[:, 0], prev[:, 1] + stay) + here
    for t in range(longest - 2, -1, -1):
        a = first[: longer[t + 1]]
        nxt, p = bwd[a + t + 1], potential[a + t + 1]
        bwd[a + t, 0] = np.logaddexp(nxt[:, 0] + stay, nxt[:, 1] + p)
        bwd[a + t, 1] = np.logaddexp(nxt[:, 0], nxt[:, 1] + p + stay)
    last = first + size - 1
    z = np.logaddexp(fwd[last, 0], fwd[last, 1])
    place = np.argsort(first)
    whole = np.repeat(z[place], size[place])
    good = np.exp(np.minimum(fwd[:, 1] + bwd[:, 1] - whole, 0))
    inner = np.ones(n, bool)
    inner[first] = False
    k = np.flatnonzero(inner)
    equal = np.exp(fwd[k - 1, 0] + stay + bwd[k, 0] - whole[k]) + np.exp(fwd[k - 1, 1] + stay + potential[k] + bwd[k, 1] - whole[k])
    return good, equal, z[np.argsort(order)]


class Field:
    """A fitted field."""

    def __init__(self, prior: float = 0.5, weights: np.ndarray | None = None, stay: float = 0.0,
                 mean: np.ndarray | None = None, spread: np.ndarray | None = None):
        self.prior, self.weights, self.stay, self.mean, self.spread = prior, weights, stay, mean, spread

    def marginals(self, lines: Lines) -> np.ndarray:
        if self.weights is None:
            return np.full(len(lines.size), self.prior)
        x = (lines.inputs() - self.mean) / self.spread
        first = np.flatnonzero(np.concatenate([[True], lines.text[1:] != lines.text[:-1]])) if len(x) else np.zeros(0, np.int64)
        size = np.diff(np.concatenate([first, [len(x)]]))
        return chain(x @ self.weights, first, size, self.stay)[0] if len(x) else np.zeros(0)

    def scores(self, raw: list[bytes]) -> np.ndarray:
        out = np.empty(len(raw))
        for a, b in T.batches(raw):
            lines = Lines(raw[a:b])
            weight = np.bincount(lines.text, lines.size, b - a)
            total = np.bincount(lines.text, lines.size * self.marginals(lines), b - a)
            out[a:b] = np.where(weight > 0, total / np.where(weight > 0, weight, 1), self.prior)
        return np.clip(out, 0, 1)


def fit(inputs: np.ndarray, good: np.ndarray, first: np.ndarray, size: np.ndarray, prior: float) -> Field:
    """Largest penalised conditional likelihood; every line of a sequence has the same label."""
    mean, spread = inputs.mean(axis=0), inputs.std(axis=0)
    mean[-1], spread = 0, np.where(spread > 1e-6, spread, 1)
    x = ((inputs - mean) / spread).astype(np.float64)
    target, pairs = good.astype(float), float((size - 1).sum())
    theta = np.zeros(x.shape[1] + 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, ROUNDS + 1):
        p, equal, _ = chain(x @ theta[:-1], first, size, theta[-1])
        grad = np.append(x.T @ (target - p), pairs - equal.sum()) / len(x) - PENALTY * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta += RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return Field(prior, theta[:-1], float(theta[-1]), mean, spread)


def line_inputs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for text, quality in zip(T.encode(frame["text"]), frame["quality"], strict=True):
            x = Lines([text]).inputs()
            for a in range(0, len(x), STRETCH):
                yield pd.DataFrame({"quality": [quality], "x": [x[a : a + STRETCH].tobytes()]})


def train(docs: DataFrame, labels: DataFrame) -> Field:
    """A field fitted on documents whose doc_id has a label ``quality`` of 0 or 1."""
    ship(docs.sparkSession)
    picked = (labels.where("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.min("quality").cast("int").alias("quality")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(
        f"text is not null and octet_length(text) <= {SAMPLE_BYTES}")
    picked = picked.join(texts.select("doc_id"), "doc_id", "left_semi")
    chosen = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = texts.join(F.broadcast(chosen), "doc_id").mapInPandas(line_inputs, "quality int, x binary").toPandas()
    prior = chosen.agg(F.avg("quality")).first()[0]
    if not len(rows):
        return Field(0.5 if prior is None else float(prior))
    rows = rows.sort_values(["quality", "x"])  # the same fit whatever order the rows came in
    width = 3 * len(Lines([b"x"]).features[0]) + 1
    parts = [np.frombuffer(b, np.float32).reshape(-1, width) for b in rows["x"]]
    size = np.array([len(p) for p in parts])
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    return fit(np.concatenate(parts), np.repeat(rows["quality"].to_numpy(), size), first, size, float(prior))


def score(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; columns of these names are replaced."""
    ship(docs.sparkSession)

    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(field.scores(T.encode(texts)))

    return docs.drop("score", "predicted").withColumn("score", F.pandas_udf(scored, "double")("text")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, field: Field) -> DataFrame:
    """The documents with a score of 0.5 or more, with their own columns only."""
    ship(docs.sparkSession)

    def good(texts: pd.Series) -> pd.Series:
        return pd.Series(field.scores(T.encode(texts)) >= 0.5)

    return docs.where(F.pandas_udf(good, "boolean")("text"))


def label_lines(docs: DataFrame, field: Field) -> DataFrame:
    """Every line with content: its number from 0, its probability of good and its label."""
    ship(docs.sparkSession)

    def labelled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            raw, ids = T.encode(frame["text"]), frame["doc_id"].astype("Int64").array
            for a, b in T.batches(raw):
                lines = Lines(raw[a:b])
                p = field.marginals(lines)
                yield pd.DataFrame({"doc_id": ids[a:b].take(lines.text), "line": lines.number, "n_bytes": lines.size,
                                    "good": p, "label": np.where(p >= 0.5, "good", "bad")})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        labelled, "doc_id long, line long, n_bytes long, good double, label string")
