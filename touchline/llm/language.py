"""Language identification with bit-sliced Bloom filters of character n-grams.

Training counts n-grams by language over all training rows and keeps, for each language, those
that make up at least ``LEAST_SHARE`` of its n-grams; as shares add up to one, a language keeps
at most 1 / LEAST_SHARE of them, however large the corpus is.  The filters of all languages lie
side by side: one table of bit masks, a bit a language.  ANDing the masks at an n-gram's hash
positions gives all languages that contain it.

A text's popcounts by language are corrected for false positives: with n n-grams, c hits and a
filter that answers wrongly with probability f, (c - n f) / (1 - f) are expected to be true.
The greatest count decides, ties and texts without hits go to the language with more training
n-grams, then to the smaller name.  ``score`` is the winner's share of the summed counts.

N-grams are of two to four UTF-8 bytes of the text with A-Z lower-cased and ASCII characters
other than letters as single spaces, so a text needs no minimum length.  A null text or one
without a letter is ``und`` with score 0; so is every text if nothing could be learned.  Every
row is predicted, rows without or with repeated doc_id too; rows without lang don't train.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .staging import Staging, ship

GRAMS = (2, 3, 4)
LEAST_SHARE = 2e-5
HASHES, SLOTS_PER_GRAM = 3, 8
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
FOLD = T.LOWER.copy()
FOLD[:128] = [b if 97 <= b <= 122 else 32 for b in T.LOWER[:128]]


def gram_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text index of every n-gram of a batch; none crosses texts."""
    data = FOLD[np.frombuffer(b"\n" + b"\n".join([*raw, b""]), np.uint8)]
    size = np.array([len(b) + 1 for b in raw])
    text = np.concatenate([[0], np.repeat(np.arange(len(raw)), size)])
    keep = np.concatenate([[True], (data[1:] != 32) | (data[:-1] != 32)]) if len(data) else np.zeros(0, bool)
    data, text = data[keep].astype(np.uint64), text[keep]
    hashes, where = [], []
    code = data.copy()
    for n in range(2, max(GRAMS) + 1):
        if len(data) < n:
            break
        code = code[:-1] * np.uint64(257) + data[n - 1 :] + np.uint64(1)
        if n in GRAMS:
            # an n-gram may hold a space at its ends only
            whole = np.ones(len(code), bool)
            for j in range(1, n - 1):
                whole &= data[j : len(data) - n + 1 + j] != 32
            hashes.append(T.mix(code[whole] + np.uint64(n << 48)))
            where.append(text[n - 1 :][whole])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(where)


def count_grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """N-gram counts by language, summed within each frame before they are sent on."""
    for frame in frames:
        for lang, part in frame.groupby("lang"):
            raw, sums = T.encode(part["text"]), []
            for a, b in T.batches(raw):
                sums.append(np.unique(gram_hashes(raw[a:b])[0], return_counts=True))
                if len(sums) == 8:
                    sums = [merge(sums)]
            gram, n = merge(sums)
            yield pd.DataFrame({"lang": lang, "gram": gram.view(np.int64), "n": n})


def merge(sums: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    gram, at = np.unique(np.concatenate([s[0] for s in sums]), return_inverse=True)
    return gram, np.bincount(at, np.concatenate([s[1] for s in sums]), len(gram)).astype(np.int64)


class Filters:
    """Bloom filters of all languages, sliced by bit position."""

    def __init__(self, grams: pd.DataFrame):
        weight = grams.groupby("lang")["total"].first().sort_index()
        self.langs = weight.index[np.argsort(-weight.to_numpy(), kind="stable")].tolist()
        largest = int(grams.groupby("lang").size().max()) if len(grams) else 1
        self.bits = max(10, int(np.ceil(np.log2(largest * SLOTS_PER_GRAM))))
        self.slices = np.zeros((1 << self.bits, max(1, -(-len(self.langs) // 64))), np.uint64)
        number = {lang: i for i, lang in enumerate(self.langs)}
        lang = grams["lang"].map(number).to_numpy(np.int64)
        for slots in self.slots(grams["gram"].to_numpy().view(np.uint64)):
            np.bitwise_or.at(self.slices, (slots, lang // 64), np.uint64(1) << (lang % 64).astype(np.uint64))
        filled = [((self.slices[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(self.langs))]
        self.false = np.array(filled) ** HASHES

    def slots(self, gram: np.ndarray) -> list[np.ndarray]:
        a, b = gram, T.mix(gram) | np.uint64(1)
        return [((a + np.uint64(j) * b) >> np.uint64(64 - self.bits)).astype(np.int64) for j in range(HASHES)]

    def counts(self, raw: list[bytes]) -> np.ndarray:
        """Corrected number of n-grams of each text that each language contains."""
        gram, text = gram_hashes(raw)
        mask = None
        for slots in self.slots(gram):
            mask = self.slices[slots] if mask is None else mask & self.slices[slots]
        n = np.bincount(text, minlength=len(raw))
        out = np.empty((len(raw), len(self.langs)))
        for i, f in enumerate(self.false):
            hit = (mask[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            c = np.bincount(text, hit, minlength=len(raw))
            out[:, i] = np.maximum((c - n * f) / (1 - f) if f < 1 else 0, 0)
        return out

    def decide(self, texts: pd.Series) -> pd.DataFrame:
        raw = T.encode(texts)
        lang, score = np.full(len(raw), UNKNOWN, object), np.zeros(len(raw))
        for a, b in T.batches(raw):
            spoken = [i for i in range(a, b) if self.langs and raw[i] and LETTER.search(texts.iloc[i])]
            if not spoken:
                continue
            c = self.counts([raw[i] for i in spoken])
            best, total = c.argmax(axis=1), c.sum(axis=1)
            lang[spoken] = np.array(self.langs, object)[best]
            score[spoken] = np.where(total > 0, c.max(axis=1) / np.where(total > 0, total, 1), 0)
        return pd.DataFrame({"lang_pred": lang, "score": score})


def train(docs: DataFrame) -> Filters:
    """Filters learned from ``text`` and non-null ``lang``."""
    ship(docs.sparkSession)
    rows = docs.where("lang is not null and text is not null").select("text", F.col("lang").cast("string").alias("lang"))
    counted = rows.mapInPandas(count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return Filters(frequent(counted))


def frequent(counted: DataFrame) -> pd.DataFrame:
    """N-grams that reach the least share; bounded by the number of languages / LEAST_SHARE."""
    counted = Staging(counted.sparkSession, "language").put("grams", counted)
    total = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    return (counted.join(F.broadcast(total), "lang").where(F.col("n") >= F.col("total") * LEAST_SHARE)
            .select("lang", "gram", "total").toPandas())


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (replaced where there); the filters' size does not depend on the corpus."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def decide(texts: pd.Series) -> pd.DataFrame:
        return shared.value.decide(texts)

    udf = F.pandas_udf(decide, "lang_pred string, score double")
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*kept, udf("text").alias("_said")).select(*kept, "_said.*")
