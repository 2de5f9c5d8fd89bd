"""Embedding whitening: covariances by polarisation, components, and vectors projected on them.

The variance of a sum of two dimensions less the variances of both is twice their covariance. So
only squares are added up: of every dimension and of every sum of two, over whole numbers that are
centred first, and without any rounding. Sums leave a task as whole numbers, a few for each pair of
dimensions whatever the number of vectors, and Spark adds them up; the driver gets one number for
each pair.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Numbers of a block of vectors that are worked on at once.
_BLOCK = 1 << 20
#: Bits of a part of a large sum; parts are added up one by one.
_PART = 60
_SAFE = 1 << 62
_SUMS = "i int, j int, part int, value long"


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is there and holds neither null nor NaN nor infinity."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vectors.where(F.col(column).isNotNull() & ~F.exists(column, bad))


def _whole(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """floor(64 * c) + 1,000,000 of a batch's vectors, as longs; as Python's whole numbers where
    an entry does not fit."""
    c = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    if not c.size or np.abs(c).max() < 2.0**50:
        return np.floor(c * SCALE).astype(np.int64) + SHIFT
    return np.array([[math.floor(SCALE * x) if abs(x) < 2.0**50 else SCALE * int(x) for x in row] for row in c.tolist()], object).reshape(-1, d) + SHIFT


def _centred(x: np.ndarray, centre: list[int]) -> np.ndarray:
    fits = all(abs(c) < _SAFE // 2 for c in centre)
    return x - np.array(centre, np.int64 if fits else object)


def _safe(numbers: np.ndarray, times: int, squared: bool) -> np.ndarray:
    """The numbers as longs if so many of them, or of the squares of their pairs' sums, add up to a long."""
    most = int(abs(numbers).max()) if numbers.size else 0
    fits = times * (4 * most * most if squared else most) < _SAFE
    return numbers.astype(np.int64 if fits else object)


def _parts(i: list[int], j: list[int], sums: list[int]) -> pa.RecordBatch:
    """Whole numbers of any size as longs: the last part has the sign."""
    out: tuple[list, list, list, list] = [], [], [], []
    for a, b, x in zip(i, j, sums):
        k = 0
        while not -_SAFE <= x < _SAFE:
            for column, value in zip(out, (a, b, k, x & ((1 << _PART) - 1))):
                column.append(value)
            x, k = x >> _PART, k + 1
        for column, value in zip(out, (a, b, k, x)):
            column.append(value)
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in out[:3]), pa.array(out[3], pa.int64())], ["i", "j", "part", "value"])


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    rows = max(1, _BLOCK // d)
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield _whole(batch.slice(at, rows), d)


def _dimension_sums(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(d, object)
    for x in _blocks(batches, d):
        total += _safe(x, len(x), False).sum(0).astype(object)
    yield _parts(list(range(d)), [-1] * d, [int(x) for x in total])


def _square_sums(batches: Iterator[pa.RecordBatch], d: int, centre: list[int]) -> Iterator[pa.RecordBatch]:
    """Sums of squares of every dimension (j is -1) and of every sum of two dimensions i < j."""
    total = [np.zeros(d - i, object) for i in range(d)]
    for x in _blocks(batches, d):
        z = _safe(_centred(x, centre), len(x), True)
        for i in range(d):
            both = np.concatenate([z[:, i : i + 1], z[:, i : i + 1] + z[:, i + 1 :]], axis=1)
            total[i] += (both * both).sum(0).astype(object)
    yield _parts([i for i in range(d) for _ in range(d - i)], [j for i in range(d) for j in (-1, *range(i + 1, d))], [int(x) for t in total for x in t])


def _added(vectors: DataFrame, sums: Callable) -> dict[tuple[int, int], int]:
    """Sums of all tasks: at most one row for each pair of dimensions and part reaches the driver."""
    parts = vectors.mapInArrow(sums, _SUMS).groupBy("i", "j", "part").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    out: dict[tuple[int, int], int] = {}
    for r in parts.collect():
        out[r["i"], r["j"]] = out.get((r["i"], r["j"]), 0) + (int(r["value"]) << (_PART * r["part"]))
    return out


def covariance(n: int, rest: list[int], squares: dict[tuple[int, int], int]) -> np.ndarray:
    """Exact covariances, each rounded once, of z-vectors whose dimensions sum to rest."""
    d = len(rest)
    own = [n * squares[i, -1] - rest[i] ** 2 for i in range(d)]
    v = np.diag([x / (n * n) for x in own])
    for i in range(d):
        for j in range(i + 1, d):
            both = n * squares[i, j] - (rest[i] + rest[j]) ** 2
            v[i, j] = v[j, i] = ((both - own[i] - own[j]) // 2) / (n * n)
    return v


def components(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues by falling size and their unit eigenvectors as columns; the entry of a vector
    that is largest by size is positive. What rounding leaves of an eigenvalue of zero is zero."""
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    u = u * np.where(u[np.abs(u).argmax(0), range(u.shape[1])] < 0, -1, 1)
    return np.where(e > np.trace(v) * len(v) * np.finfo(float).eps, e, 0.0), u


def _whitened(z: np.ndarray, mean: np.ndarray, w: np.ndarray) -> np.ndarray:
    return (z.astype(np.float64) - mean) @ w


def _identity_sums(batches: Iterator[pa.RecordBatch], d: int, centre: list[int], mean: np.ndarray, w: np.ndarray) -> Iterator[pa.RecordBatch]:
    c = w.shape[1]
    one, two = np.zeros(c), np.zeros((c, c))
    for x in _blocks(batches, d):
        y = _whitened(_centred(x, centre), mean, w)
        one += y.sum(0)
        two += y.T @ y
    i, j = np.triu_indices(c)
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.arange(c), i]), pa.int32()), pa.array(np.concatenate([np.full(c, -1), j]), pa.int32()), pa.array(np.concatenate([one, two[i, j]]))], ["i", "j", "value"])


def _identity_error(vectors: DataFrame, n: int, w: np.ndarray, sums: Callable) -> float:
    """Largest entry by size of the covariance of the whitened vectors, as they are returned, less the identity."""
    got = {(r["i"], r["j"]): r["value"] for r in vectors.mapInArrow(sums, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}
    pairs = [(i, j) for i in range(w.shape[1]) for j in range(i, w.shape[1])]
    return max((abs(got[i, j] / n - got[i, -1] / n * got[j, -1] / n - (i == j)) for i, j in pairs), default=0.0)


def _projected(batches: Iterator[pa.RecordBatch], d: int, n: int, centre: list[int], rest: list[int], mean: np.ndarray, w: np.ndarray, shown: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows = max(1, _BLOCK // max(d, shown))
    ten = 10**38
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            z = _centred(_whole(part, d), centre)
            y = np.full((len(z), shown), np.nan)
            y[:, : w.shape[1]] = _whitened(z, mean, w)
            far = int(abs(z).max()) * n + max(map(abs, rest))
            apart = (z if far * far * d < _SAFE else z.astype(object)) * n - np.array(rest, object if far * far * d >= _SAFE else np.int64)
            deviation = [x if x < ten else None for x in map(int, (apart * apart).sum(1))]
            which = np.repeat(np.arange(len(z)), shown)
            flat = y.ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(pa.array(which)), pa.array(np.tile(np.arange(1, shown + 1), len(z)), pa.int32()),
                    pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(which)), pa.array(flat, mask=np.isnan(flat)),
                ],
                schema=pa.schema([pa.field("id", part.schema.field("id").type), *schema]),
            )


def whiten(vectors: DataFrame, id: str | Column = "vec_id", column: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """Whitened entries of all usable vectors: one row (vec_id, component, n, deviation, whitened,
    explained, identity_error) for each and component up to most, or the number of dimensions.

    Vectors that are null or hold null, NaN or infinity are dropped. All vectors have as many
    entries as most of them have (of two such numbers the larger); others hold no value where one
    belongs, and are dropped too. No usable vector, or none with an entry: no rows. A null id stays
    null, repeated rows count as often as they are there, and other columns are passed over. Where
    an eigenvalue is zero (fewer vectors than dimensions, equal vectors, a constant dimension)
    whitened is null and explained 0; where all are, explained is null. identity_error is of the
    other components. deviation is a decimal of 38 digits, null if it has more.

    Vectors are read five times: for their lengths, sums, squares, for identity_error, and for the
    result. Nothing is shuffled but sums.
    """
    name = id if isinstance(id, str) else "vec_id"
    kept = usable(vectors, column).select((F.col(id) if isinstance(id, str) else id).alias("id"), F.col(column).alias("v"))
    schema = f"id {kept.schema['id'].dataType.simpleString()}, component int, deviation decimal(38,0), whitened double"
    names = lambda df, n, e, total, error: df.select(
        F.col("id").alias(name), "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        (F.element_at(F.array(*[F.lit(float(x)) for x in e]), F.col("component")) / F.lit(total) if total else F.lit(None).cast("double")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
    length = kept.where(F.size("v") > 0).groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if length is None:
        return names(vectors.sparkSession.createDataFrame([], schema), 0, [], 0.0, 0.0)
    d, n = length["d"], length["n"]
    kept = kept.where(F.size("v") == d)
    only = kept.select("v")
    sums = _added(only, partial(_dimension_sums, d=d))
    total = [sums[i, -1] for i in range(d)]
    centre = [(2 * s + n) // (2 * n) for s in total]
    rest = [s - n * c for s, c in zip(total, centre)]
    v = covariance(n, rest, _added(only, partial(_square_sums, d=d, centre=centre)))
    e, u = components(v, most)
    w = u[:, e > 0] / np.sqrt(e[e > 0])
    mean = np.array([r / n for r in rest])
    error = _identity_error(only, n, w, partial(_identity_sums, d=d, centre=centre, mean=mean, w=w))
    fields = pa.schema([("component", pa.int32()), ("deviation", pa.decimal128(38, 0)), ("whitened", pa.float64())])
    out = kept.mapInArrow(partial(_projected, d=d, n=n, centre=centre, rest=rest, mean=mean, w=w, shown=len(e), schema=fields), schema)
    return names(out, n, e, float(np.trace(v)), error)
