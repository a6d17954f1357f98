"""Whitening of embeddings by the leading eigenvectors of their covariance, found by spectrum slicing.

Components become integers, floor(256 * c).  The fit list holds each distinct vector once; its
sums are exact, its covariance is summed from centred products in tasks and then by Spark.

The covariance, as small as the dimensions, is sliced on the driver.  An LDL' factorisation of
V - s I with diagonal pivots of one and two rows has, by Sylvester's law, as many positive pivots
as V has eigenvalues above s.  Bisection on these counts isolates the eigenvalue of each number;
Rayleigh quotient iteration then converges cubically from the middle of its interval; and counts on
both sides of the quotient certify that it has this number.  Eigenvalues that no interval of the
width of rounding separates get vectors orthogonal to those found before.

Rows whose vector is null, empty, or holds a null or non-finite entry are left out, as are, where
lengths differ, vectors of any but the most frequent length (the shorter on a tie).  Rows without
or with repeated vec_id have their results like any other.  Entries beyond the long range are
held at its ends.  A deviation beyond the long range is null.  There are as many components as
the dimensions, four at most; one whose eigenvalue is no more than rounding (a share of
1e-12 of the trace) has no whitening and no rows, so a single vector or an empty table gives none.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import Staging

SCALE, COMPONENTS = 256, 4
#: Share of the trace below which an eigenvalue is rounding.
LEAST = 1e-12
#: Relative width at which bisection stops: rounding of the factorisation.
WIDTH = 1e-13
PIVOT = (1 + 17 ** 0.5) / 8


def integers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Usable vectors as bytes of longs."""
    for frame in frames:
        ids, out = [], []
        for i, e in zip(frame["vec_id"], frame["embedding"], strict=True):
            if e is None:
                continue
            v = np.array([np.nan if x is None else x for x in e], np.float64)
            if len(v) and np.isfinite(v).all():
                with np.errstate(over="ignore"):
                    x = np.clip(np.floor(SCALE * v), -(2.0 ** 63), 2.0 ** 63 - 1024)
                ids.append(i)
                out.append(x.astype("<i8").tobytes())
        yield pd.DataFrame({"vec_id": pd.array(ids, "Int64"), "vec": out})


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), "<i8").reshape(len(vectors), -1)


def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Exact sum of each dimension, as text, and the number of vectors, as dimension -1."""
    total, n = None, 0
    for frame in frames:
        if len(frame):
            x = matrix(frame["vec"])
            wide = int(np.abs(x.astype(np.float64)).max()) * len(x) >= 1 << 62
            s = x.astype(object).sum(axis=0) if wide else x.sum(axis=0).astype(object)
            total, n = s if total is None else total + s, n + len(x)
    if n:
        yield pd.DataFrame({"dim": range(-1, len(total)), "total": [str(v) for v in [n, *total]]})


def products(frames: Iterator[pd.DataFrame], centred) -> Iterator[pd.DataFrame]:
    """Upper half of the sum of outer products of centred rows."""
    total = None
    for frame in frames:
        if len(frame):
            z = centred(frame)
            total = z.T @ z if total is None else total + z.T @ z
    if total is not None:
        i, j = np.triu_indices(len(total))
        yield pd.DataFrame({"i": i, "j": j, "total": total[i, j]})


def covariance(fit: DataFrame, n: int, size: int, centred) -> np.ndarray:
    """Covariance with divisor n of what ``centred`` makes of the fit list's frames."""
    parts = fit.mapInPandas(lambda frames: products(frames, centred), "i int, j int, total double")
    out = np.zeros((size, size))
    for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():  # bounded by the dimensions
        out[r.i, r.j] = out[r.j, r.i] = r.total / n
    return out


def above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of v lie above a shift: the positive pivots of an LDL' factorisation."""
    a = v - shift * np.eye(len(v))
    tiny = np.finfo(float).tiny
    count = 0
    while len(a):
        d = np.abs(np.diag(a))
        r = int(d.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        p, q = divmod(int(off.argmax()), len(a))
        if d[r] >= PIVOT * off[p, q]:
            pivot = a[r, r]
            if abs(pivot) <= tiny:  # all zero: eigenvalues on the shift are not above it
                return count
            count += pivot > 0
            rest = np.delete(np.arange(len(a)), r)
            a = a[np.ix_(rest, rest)] - np.outer(a[rest, r], a[rest, r] / pivot)
        else:
            count += 1  # the determinant is negative: one of the two is positive
            block = np.ix_([p, q], [p, q])
            rest = np.delete(np.arange(len(a)), [p, q])
            left = a[np.ix_(rest, [p, q])]
            a = a[np.ix_(rest, rest)] - left @ np.linalg.solve(a[block], left.T)
    return int(count)


def quotient_iteration(v: np.ndarray, value: float, start: np.ndarray, found: list[np.ndarray]) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from a shift and a start, away from vectors found before."""
    norm = np.abs(v).sum(axis=1).max()

    def away(x: np.ndarray) -> np.ndarray:
        for f in [*found, *found]:
            x = x - f * (f @ x)
        return x / np.linalg.norm(x)

    x, last = away(start), np.inf
    for _ in range(40):
        try:
            y = np.linalg.solve(v - value * np.eye(len(v)), x)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            y = np.linalg.solve(v - (value + 4 * np.finfo(float).eps * norm) * np.eye(len(v)), x)
        x = away(y)
        value = float(x @ v @ x)
        miss = np.linalg.norm(v @ x - value * x)
        if miss <= 4 * np.finfo(float).eps * norm or miss >= last and miss <= 1e-12 * norm:
            break
        last = miss
    return value, x


def leading(v: np.ndarray, k: int) -> list[tuple[float, np.ndarray]]:
    """The k largest eigenvalues with unit eigenvectors, by number; those beyond rounding only."""
    radius = np.abs(v).sum(axis=1).max(initial=0)
    floor, out = LEAST * np.trace(v), []
    rng = np.random.default_rng(13)
    starts = rng.normal(size=(max(k, 1), len(v)))
    for number in range(1, min(k, len(v)) + 1):
        if not radius or above(v, floor) < number:
            break
        low, high = floor, radius * (1 + 1e-9)  # count above low >= number > count above high
        counts = [above(v, low), above(v, high)]
        while high - low > WIDTH * radius:
            middle = (low + high) / 2
            c = above(v, middle)
            if c >= number:
                low, counts[0] = middle, c
            else:
                high, counts[1] = middle, c
            if counts == [number, number - 1] and high - low < 1e-3 * high:
                value, x = quotient_iteration(v, (low + high) / 2, starts[number - 1], [])
                edge = 64 * np.finfo(float).eps * radius
                if low <= value <= high and above(v, value - edge) >= number > above(v, value + edge):
                    out.append((value, x))
                    break
        else:  # a multiple eigenvalue, to rounding
            out.append(quotient_iteration(v, (low + high) / 2, starts[number - 1], [x for _, x in out]))
    return out


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for every usable vector and component."""
    staging = Staging(vectors.sparkSession, "whitening")
    rows = staging.put("rows", vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInPandas(
        integers, "vec_id long, vec binary"))
    size = rows.groupBy(F.length("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width = size[0] // 8 if size else 1
    rows = rows.where(F.length("vec") == 8 * width)
    fit = staging.put("fit", rows.select("vec").distinct())
    added = fit.mapInPandas(sums, "dim int, total string").groupBy("dim").agg(
        F.sum(F.col("total").cast("decimal(38, 0)")).alias("total"))
    total = {r.dim: int(r.total) for r in added.collect()}  # bounded by the dimensions
    n, s = total.get(-1, 0), [total.get(d, 0) for d in range(width)]
    mean = np.array([v / n if n else 0.0 for v in s])
    v = covariance(fit, n, width, lambda f: matrix(f["vec"]) - mean)
    found = leading(v, components)
    values = [e for e, _ in found]
    axes = np.array([x for _, x in found]).reshape(-1, width).T
    root, trace = np.sqrt(values), float(np.trace(v))

    def whitened(frame: pd.DataFrame) -> np.ndarray:
        return (matrix(frame["vec"]) - mean) @ axes / root

    error = 0.0
    if found:
        k = len(found)
        centre = staging.put("centre", fit.mapInPandas(lambda frames: (
            pd.DataFrame({"i": range(k), "total": whitened(f).sum(axis=0)}) for f in frames if len(f)), "i int, total double"))
        middle = np.zeros(k)
        for r in centre.groupBy("i").agg(F.sum("total").alias("total")).collect():
            middle[r.i] = r.total / n
        error = float(np.abs(covariance(fit, n, k, lambda f: whitened(f) - middle) - np.eye(k)).max())
    most = max((abs(t) for t in s), default=0)

    def deviation(x: np.ndarray) -> list:
        """Exact sums of (n * x - S)^2."""
        top = n * int(np.abs(x.astype(np.float64)).max()) + most
        if top * top * width < 1 << 62:
            z = n * x - np.array(s, np.int64)
            return (z * z).sum(axis=1).tolist()
        z = n * x.astype(object) - np.array(s, object)
        return [d if d < 1 << 63 else None for d in (z * z).sum(axis=1)]

    def told(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            k = len(values)
            if len(frame) and k:
                yield pd.DataFrame({
                    "vec_id": frame["vec_id"].astype("Int64").repeat(k).array, "component": np.tile(np.arange(1, k + 1), len(frame)), "n": n,
                    "deviation": pd.array(deviation(matrix(frame["vec"])), "Int64").repeat(k), "whitened": whitened(frame).ravel(),
                    "explained": np.tile(np.array(values) / trace, len(frame)), "identity_error": error})

    return rows.mapInPandas(told, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
