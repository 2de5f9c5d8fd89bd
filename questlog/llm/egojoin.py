"""Near duplicates of embeddings by an epsilon grid order join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questlog.llm.common import components, cut

THRESHOLD = 0.93
#: Leading principal dimensions that the grid has.
GRID_DIMS = 4
#: Vectors that the dimensions are fitted on, about; they order the work and change no result.
SAMPLE = 4096
#: Vectors of an interval, and of one that is compared without further splitting.
INTERVAL = 4096
LEAF = 128
_SLACK = 1e-9


def _unit(vectors: list) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so that no square over- or underflows."""
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_axes(distinct: DataFrame, total: int) -> dict[int, np.ndarray]:
    """Principal axes of a sample of unit vectors, for each length that vectors have in it."""
    share = min(1.0, SAMPLE / max(1, total))
    drawn = distinct.where(F.col("k1").bitwiseAND(F.lit(0xFFFFFF)) / F.lit(0x1000000) < share).select("embedding").toPandas()["embedding"]
    axes: dict[int, np.ndarray] = {}
    for d in {len(v) for v in drawn}:
        x = _unit([v for v in drawn if len(v) == d])
        values, vectors = np.linalg.eigh(np.cov(x, rowvar=False, bias=True).reshape(d, d))
        axes[d] = vectors[:, np.argsort(-values, kind="stable")[:GRID_DIMS]]
    return axes


def _with_cells(distinct: DataFrame, axes: dict[int, np.ndarray], eps: float) -> DataFrame:
    shared = distinct.sparkSession.sparkContext.broadcast(axes)

    @F.pandas_udf("cells array<int>, at array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for vectors in batches:
            at = np.zeros((len(vectors), GRID_DIMS))
            sizes = np.array([len(v) for v in vectors])
            for d in set(sizes.tolist()):
                rows = np.flatnonzero(sizes == d)
                a = shared.value.get(d, np.eye(d)[:, :GRID_DIMS])
                at[rows, : a.shape[1]] = _unit([vectors.iloc[i] for i in rows]) @ a
            yield pd.DataFrame({"cells": list(np.floor(at / eps).astype(np.int32)), "at": list(at)})

    return distinct.withColumn("_g", run("embedding")).select("*", "_g.cells", "_g.at").drop("_g")


def _intervals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cut the sorted rows of a task into intervals of one label and vector length."""
    held: list[tuple] = []

    def out() -> pd.DataFrame:
        at = np.array([r[4] for r in held])
        return pd.DataFrame([{
            "label": held[0][0], "dim": held[0][1], "lo": at.min(axis=0), "hi": at.max(axis=0),
            "ids": [r[2] for r in held], "weights": [r[3] for r in held], "vectors": _unit([r[5] for r in held]).tobytes(), "places": at.tobytes(),
        }])

    for b in batches:
        for row in zip(b["label"], b["dim"], b["vec_id"], b["n"], b["at"], b["embedding"]):
            if held and (len(held) >= INTERVAL or held[0][:2] != row[:2]):
                yield out()
                held = []
            held.append(row)
    if held:
        yield out()


def _leaf_links(links: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> list[tuple[int, int]]:
    """A link from each vector to the first of its component among the links of two blocks."""
    top = np.iinfo(np.int64).max
    of_a, of_b = ids_a.copy(), np.full(len(ids_b), top)
    while True:
        new_b = np.minimum(ids_b, np.where(links, of_a[:, None], top).min(axis=0))
        new_b = np.where(links.any(axis=0), np.minimum(new_b, of_b), top)
        new_a = np.where(links.any(axis=1), np.minimum(of_a, np.where(links, new_b[None, :], top).min(axis=1)), of_a)
        if (new_a == of_a).all() and (new_b == of_b).all():
            break
        of_a, of_b = new_a, new_b
    pairs = [*zip(ids_a[links.any(axis=1)].tolist(), of_a[links.any(axis=1)].tolist()), *zip(ids_b[links.any(axis=0)].tolist(), of_b[links.any(axis=0)].tolist())]
    return [(x, y) for x, y in set(pairs) if x != y]


class _Side:
    def __init__(self, row):
        self.ids, self.weights = np.asarray(row.ids, np.int64), np.asarray(row.weights, np.int64)
        self.x = np.frombuffer(row.vectors, np.float64).reshape(len(self.ids), -1)
        self.at = np.frombuffer(row.places, np.float64).reshape(len(self.ids), -1)
        self.links = np.zeros(len(self.ids), np.int64)


def _join(a: _Side, b: _Side, ra: tuple[int, int], rb: tuple[int, int], eps: float, least: float, edges: list) -> None:
    """Join two pieces of the sequence: skip them if no points of their boxes are within eps in
    every dimension, halve the longer, or compare them whole."""
    (i, j), (k, m) = ra, rb
    pa, pb = a.at[i:j], b.at[k:m]
    gap = np.maximum(0, np.maximum(pa.min(axis=0) - pb.max(axis=0), pb.min(axis=0) - pa.max(axis=0)))
    if math.sqrt(float((gap * gap).sum())) > eps + _SLACK:
        return
    if max(j - i, m - k) > LEAF:
        if j - i >= m - k:
            mid = (i + j) // 2
            _join(a, b, (i, mid), rb, eps, least, edges)
            _join(a, b, (mid, j), rb, eps, least, edges)
        else:
            mid = (k + m) // 2
            _join(a, b, ra, (k, mid), eps, least, edges)
            _join(a, b, ra, (mid, m), eps, least, edges)
        return
    if a is b and i > k:
        return  # the same two pieces come the other way round
    links = a.x[i:j] @ b.x[k:m].T >= least
    if a is b and i == k:
        np.fill_diagonal(links, False)
        a.links[i:j] += links @ a.weights[i:j]
    else:
        a.links[i:j] += links @ b.weights[k:m]
        b.links[k:m] += links.T @ a.weights[i:j]
    if links.any():
        edges += _leaf_links(links, a.ids[i:j], b.ids[k:m])


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """One row (vec_id, n_links, component_id, kept) for each row of vectors.

    Rows of equal label whose cosine in double precision reaches the threshold link. Rows link
    with nothing, and are components of their own, where the label is null, or the vector is null,
    empty, zero, or holds null or non-finite components, or where vec_id is null; vectors of
    different lengths never link. Equal vectors of a label are joined once, with their number as
    weight. n_links counts other rows linked directly; component_id is the smallest vec_id
    reachable; kept marks the row of that id.

    Vectors sorted by their grid cells on the leading principal dimensions are cut into intervals;
    only intervals whose boxes come within eps (the distance of unit vectors at the threshold) are
    paired, and each pair is joined recursively. A pair returns sums and at most one link for each
    vector, so a cluster of any size never becomes a list of pairs.
    """
    eps = math.sqrt(max(0.0, 2 - 2 * threshold))
    e = F.col("embedding")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"), F.col(label).alias("label"))
    good = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull()
        & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0),
        F.lit(False),
    )
    rows = rows.select("*", good.alias("good"), F.xxhash64("label", "embedding").alias("k1"), F.xxhash64("embedding", F.lit(1), "label").alias("k2"))
    keyed = cut(rows.select("vec_id", "good", "k1", "k2"))
    distinct = cut(rows.where("good").groupBy("k1", "k2").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n"), F.any_value("label").alias("label"), F.any_value("embedding").alias("embedding")))
    total = distinct.count()
    cells = _with_cells(distinct, fit_axes(distinct, total), eps).select("label", F.size("embedding").alias("dim"), "vec_id", "n", "cells", "at", "embedding")
    order = ["label", "dim", "cells", "vec_id"]
    kind = distinct.schema["label"].dataType.simpleString()
    blocks = cut(
        cells.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInPandas(_intervals, f"label {kind}, dim int, lo array<double>, hi array<double>, ids array<long>, weights array<long>, vectors binary, places binary")
        .withColumn("block", F.monotonically_increasing_id())
    )
    # intervals whose boxes come within eps: equal or next cells of the first dimension, then all dimensions
    box = blocks.select("block", "label", "dim", "lo", "hi")
    cell = lambda c, d: F.floor(F.get(c, F.lit(d)) / eps).cast("int")
    left = box.select(*[F.col(c).alias(f"{c}_a") for c in ("block", "lo", "hi")], "label", "dim", F.explode(F.sequence(cell(F.col("lo"), 0), cell(F.col("hi"), 0))).alias("cell"))
    right = box.select(*[F.col(c).alias(f"{c}_b") for c in ("block", "lo", "hi")], "label", "dim", F.explode(F.sequence(cell(F.col("lo"), 0) - 1, cell(F.col("hi"), 0) + 1)).alias("cell"))
    near = F.lit(True)
    for d in range(GRID_DIMS):
        at = lambda c, d=d: F.get(F.col(c), F.lit(d))
        near = near & (at("lo_a") - at("hi_b") <= eps + _SLACK) & (at("lo_b") - at("hi_a") <= eps + _SLACK)
    pairs = cut(left.join(right, ["label", "dim", "cell"]).where((F.col("block_a") <= F.col("block_b")) & near).select("block_a", "block_b").distinct().withColumn("pair", F.xxhash64("block_a", "block_b")))
    sides = pairs.select("pair", "block_a", "block_b", F.explode(F.array_distinct(F.array("block_a", "block_b"))).alias("block")).join(
        blocks.select("block", "ids", "weights", "vectors", "places"), "block"
    )

    def compare(key, group: pd.DataFrame) -> pd.DataFrame:
        found = {r.block: _Side(r) for r in group.itertuples()}
        a, b = found[key[0]], found[key[1]]
        edges: list[tuple[int, int]] = []
        _join(a, b, (0, len(a.ids)), (0, len(b.ids)), eps, threshold, edges)
        sums = [(i, None, n) for s in found.values() for i, n in zip(s.ids.tolist(), s.links.tolist()) if n]
        return pd.DataFrame([*sums, *[(x, y, 0) for x, y in set(edges)]], columns=["a", "b", "n"]).astype({"a": "int64", "b": "Int64", "n": "int64"})

    found = cut(sides.groupBy("block_a", "block_b").applyInPandas(compare, "a long, b long, n long"))
    links = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    parts = components(found.where("b is not null").select("a", "b"))
    classes = (
        distinct.select("k1", "k2", F.col("vec_id").alias("rep"), "n")
        .join(links, "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
        .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    linked = keyed.where("good").join(cut(classes), ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = keyed.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
