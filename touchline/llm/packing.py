"""Harmonic packing of token sequences.

Lengths fall into classes by reciprocal capacity: class k holds lengths in (C/(k+1), C/k], and k
pieces of it fill a sequence.  A document is cut into full sequences first; its rest stays whole
if k copies of it would fill a sequence up to ``SLACK``, otherwise the greatest C/k that fits is
cut off, and so on, which takes few cuts as each rest shrinks to the square.

Pieces are dealt to workers of about ``SHARE`` pieces (``SHARE_IDS`` with token ids) by a hash of their row numbers, so workers never depend on each
other and none grows with the corpus.  A worker fills each class's sequences by count and packs
the last, partial ones of all classes by decreasing length.

Null text counts as empty: a document of one piece, the end id.  Every row is packed, rows
without or with repeated doc_id too.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .staging import Staging

CAPACITY, END = 2048, 1
SLACK = 1 / 128
SHARE = 20_000
#: The same where pieces carry their token ids: at most 41 MB of them a worker.
SHARE_IDS = 5_000
CACHED_WORDS = 800_000
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_code = np.arange(256)
ALNUM = ((_code >= 48) & (_code <= 57)) | ((_code >= 65) & (_code <= 90)) | ((_code >= 97) & (_code <= 122))
#: ASCII punctuation that always stands apart from letters and digits; an apostrophe may not.
MARK = (_code > 32) & (_code < 127) & ~ALNUM & (_code != ord("'"))
SENTINEL = "\x01"
ADDED = b"<|"


class WordEncoder:
    """Token ids of texts by way of their distinct words.

    The tokenizer never joins across white space, nor across the border of an ASCII letter or
    digit and a punctuation mark.  So texts are cut there, equal parts (A-Z lower-cased, as the
    tokenizer does) are found by hash, and only parts not seen before go through the tokenizer,
    many at a time with a sentinel between them.  Texts that may hold the name of an added token
    or the sentinel are encoded as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.between = self.plain(SENTINEL)
        self.forget()

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def forget(self) -> None:
        # Sorted arrays: a worker that stays between stages keeps them, and a dict takes ten times their room.
        self.names = np.zeros(0, np.uint64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def learn(self, names: np.ndarray, parts: list[bytes]) -> None:
        """Ids of parts by their hashes, which are sorted and not known yet."""
        text = f" {SENTINEL} ".join([p.decode() for p in parts])
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        cut = np.flatnonzero(ids == self.between[0])
        begin, end = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(ids)]])
        while len(self.ids) < self.used + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        at = np.searchsorted(self.names, names)
        self.names = np.insert(self.names, at, names)
        self.begin = np.insert(self.begin, at, begin + self.used)
        self.size = np.insert(self.size, at, end - begin)
        self.used += len(ids)

    def encode(self, raw: list[bytes]) -> list[np.ndarray]:
        """Ids of each text."""
        odd = [i for i, b in enumerate(raw) if ADDED in b or SENTINEL.encode() in b]
        if odd:
            raw = list(raw)
            apart = {i: self.plain(raw[i].decode()) for i in odd}
            for i in odd:
                raw[i] = b""
            out = self.encode_parts(raw)
            for i, ids in apart.items():
                out[i] = ids
            return out
        return self.encode_parts(raw)

    def encode_parts(self, raw: list[bytes]) -> list[np.ndarray]:
        if len(self.names) > CACHED_WORDS:
            self.forget()
        joined = b" ".join([*raw, b""])
        data = np.frombuffer(joined, np.uint8)
        size = np.array([len(b) + 1 for b in raw])
        inside = ~T.SPACE[data]
        alnum, mark = ALNUM[data], MARK[data]
        turn = np.concatenate([[True], (alnum[1:] & mark[:-1]) | (mark[1:] & alnum[:-1])]) if len(data) else inside
        opens = inside & (turn | ~np.concatenate([[False], inside[:-1]]))
        start = np.flatnonzero(opens)
        end = np.flatnonzero(inside & ~np.concatenate([inside[1:] & ~opens[1:], [False]])) + 1
        name, first, at = np.unique(T.Prefix(T.LOWER[data]).spans(start, end), return_index=True, return_inverse=True)
        here = np.searchsorted(self.names, name)
        new = np.ones(len(name), bool)
        inner = here < len(self.names)
        new[inner] = self.names[here[inner]] != name[inner]
        if new.any():
            self.learn(name[new], [joined[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)])
            here = np.searchsorted(self.names, name)
        begin, n = self.begin[here][at], self.size[here][at]
        run = np.cumsum(n)
        flat = np.repeat(begin - (run - n), n) + np.arange(int(run[-1]) if len(run) else 0)
        text_end = np.searchsorted(start, np.cumsum(size)[:-1])
        return np.split(self.ids[flat], np.concatenate([[0], run])[text_end])


_encoders: dict[str, WordEncoder] = {}


def cuts(n: int) -> list[int]:
    """Lengths of the pieces of a document of n tokens."""
    out = [CAPACITY] * (n // CAPACITY)
    rest = n % CAPACITY
    while rest:
        k = CAPACITY // rest
        piece = rest if k * rest >= CAPACITY * (1 - SLACK) else CAPACITY // (k + 1)
        out.append(piece)
        rest -= piece
    return out


def piece_maker(path: str, keep_ids: bool):
    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if path not in _encoders:
            _encoders[path] = WordEncoder(path)
        for frame in frames:
            raw, docs = T.encode(frame["text"]), frame["doc_id"].tolist()
            for a, b in T.batches(raw):
                rows = []
                for doc, ids in zip(docs[a:b], _encoders[path].encode(raw[a:b]), strict=True):
                    ids, start = np.append(ids, np.uint32(END)).astype("<u4"), 0
                    for length in cuts(len(ids)):
                        part = ids[start : start + length]
                        rows.append((doc, start, length, zlib.crc32(part.tobytes()), len(ids), *([part.astype(np.int32)] * keep_ids)))
                        start += length
                out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * keep_ids])
                yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    return pieces


def fill(frame: pd.DataFrame) -> pd.DataFrame:
    """Sequence and offset of the pieces of one worker."""
    frame = frame.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    length = frame["length"].to_numpy()
    k = CAPACITY // length
    first = np.concatenate([[True], k[1:] != k[:-1]])
    of = np.cumsum(first) - 1
    begin = np.flatnonzero(first)
    within = np.arange(len(k)) - begin[of]
    total = np.bincount(of)[of]
    full = within < total // k * k
    bins = np.cumsum(np.concatenate([[0], (np.bincount(of) // k[begin])[:-1]]))[of] + within // k
    seq = np.where(full, bins, -1)
    nxt, room = int(seq.max(initial=-1)) + 1, []
    for i in np.flatnonzero(~full):  # already by decreasing length; few: less than one sequence a class
        fit = next((r for r in room if r[0] >= length[i]), None)
        if fit is None:
            room.append(fit := [CAPACITY, nxt])
            nxt += 1
        fit[0] -= int(length[i])
        seq[i] = fit[1]
    order = np.argsort(seq, kind="stable")
    s, n = seq[order], length[order]
    before = np.cumsum(n) - n
    offset = np.empty(len(n), np.int64)
    start = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool)
    offset[order] = before - before[np.flatnonzero(start)][np.cumsum(start) - 1]
    return frame.assign(sequence_id=frame["worker"].astype("int64") * (1 << 32) + seq, offset=offset).drop(columns="worker")


def pack(docs: DataFrame, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row for each piece; with ``keep_ids`` its token ids too."""
    staging = Staging(docs.sparkSession, "packing")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids
    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        piece_maker(path or tokenizer_path(), keep_ids), schema)
    made = staging.put("pieces", made)
    workers = max(1, -(-made.count() // (SHARE_IDS if keep_ids else SHARE)))
    # By row number, as doc_ids may be missing or repeat.
    dealt = made.withColumn("worker", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(workers)).cast("int"))
    return dealt.groupBy("worker").applyInPandas(fill, f"{schema}, sequence_id long, offset long")
