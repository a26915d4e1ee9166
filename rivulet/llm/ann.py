"""Approximate nearest neighbours: stable projections, a kd-tree, a chi-square stop.

Largest inner products are smallest distances once each vector gets one more
component that lifts all to the same norm. Vectors are projected to a few dimensions
by Gaussian (2-stable) directions: a projected squared distance divided by the true one
is chi-square distributed with that many degrees of freedom. So once the next
projected neighbour lies farther than the chi-square quantile times the k-th distance
found, a better one is left with small probability only, and the search stops.

The upper kd-tree is fitted on a bounded sample and cuts projected space into cells;
every vector is indexed in its cell, and a cell's rows are dealt to tiles of bounded
size. A query searches its own cell first. The k-th distance found there gives the
radius within which the second round visits other cells. Inside a tile a lower
kd-tree gives projected neighbours leaf by leaf, nearest box first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivulet.llm.common import finite_vectors, settle
from rivulet.llm.topk import merge_lists, unpacked


def chi_square_quantile(p: float, freedom: int) -> float:
    """Value below which a chi-square variable of even freedom stays with probability p."""
    def below(x: float) -> float:
        term = total = 1.0
        for i in range(1, freedom // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1.0
    while below(high) < p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


def kd_cells(points: np.ndarray, leaf: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(members, lower, upper) of leaves from median cuts along the widest side."""
    todo, done = [np.arange(len(points))], []
    while todo:
        part = todo.pop()
        here = points[part]
        wide = np.ptp(here, axis=0) if len(part) else np.zeros(1)
        side = int(wide.argmax())
        if len(part) <= leaf or wide[side] == 0:  # copies of one point stay together
            done += [part[a:a + leaf] for a in range(0, max(1, len(part)), leaf)]
            continue
        order = np.argsort(here[:, side], kind="stable")
        todo += [part[order[len(part) // 2:]], part[order[:len(part) // 2]]]
    low = np.array([points[p].min(axis=0) for p in done])
    high = np.array([points[p].max(axis=0) for p in done])
    return done, low, high


@dataclass
class Plan:
    """What all tasks share: directions, upper kd-tree and the stopping rule. Bounded by the sample."""

    directions: np.ndarray
    lift: float  # squared norm that all vectors are lifted to
    nodes: list[tuple[int, float, int, int]]  # side, cut, lower child, upper child; a leaf is ~cell
    low: np.ndarray  # boxes of the cells
    high: np.ndarray
    stop: float  # chi-square quantile

    def project(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        norm = np.einsum("ij,ij->i", vectors, vectors)
        extra = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(self.lift - norm, 0))
        return vectors @ self.directions[:-1] + extra[:, None] * self.directions[-1]

    def bound(self, kth):
        """Projected squared distance to search to; the slack lets in copies despite rounding."""
        return self.stop * kth + 1e-9 * self.lift

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        cells = np.empty(len(points), np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, part = todo.pop()
            side, cut, below, above = self.nodes[node]
            if side < 0:
                cells[part] = below
                continue
            left = points[part, side] <= cut
            todo += [(below, part[left]), (above, part[~left])]
        return cells


def fit_plan(sample: np.ndarray, lift: float, cells: int, dims: int, stop: float, seed: int) -> Plan:
    """The upper kd-tree: median cuts of a sample along the widest side; cells fill all space."""
    size = sample.shape[1]
    directions = np.random.default_rng(seed).standard_normal((size + 1, dims))
    plan = Plan(directions, lift, [], np.empty(0), np.empty(0), stop)
    points = plan.project(sample)
    low, high = [], []
    leaf = max(1, math.ceil(len(points) / cells))

    def grow(part: np.ndarray, box_low: np.ndarray, box_high: np.ndarray) -> int:
        here, node = points[part], len(plan.nodes)
        plan.nodes.append((-1, 0.0, len(low), 0))
        side = int(np.ptp(here, axis=0).argmax()) if len(part) else 0
        cut = float(np.median(here[:, side])) if len(part) else 0.0
        left = here[:, side] <= cut if len(part) else np.empty(0, bool)
        if len(part) <= leaf or left.all():
            low.append(box_low)
            high.append(box_high)
            return node
        below_high, above_low = box_high.copy(), box_low.copy()
        below_high[side] = above_low[side] = cut
        below = grow(part[left], box_low, below_high)
        above = grow(part[~left], above_low, box_high)
        plan.nodes[node] = (side, cut, below, above)
        return node

    grow(np.arange(len(points)), np.full(dims, -np.inf), np.full(dims, np.inf))
    plan.low, plan.high = np.array(low), np.array(high)
    return plan


def gap(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d, None]
        side = np.maximum(np.maximum(low[None, :, d] - x, x - high[None, :, d]), 0)
        out += side * side
    return out


def search_tile(plan: Plan, queries: np.ndarray, query_ids: np.ndarray, ids: np.ndarray,
                vectors: np.ndarray, reach: np.ndarray, k: int, leaf: int = 128
                ) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Up to k best (ids, scores) of a tile per query, by incremental projected neighbours.

    ``reach`` is the k-th squared distance a query has found elsewhere (infinite if none).
    """
    members, low, high = kd_cells(plan.project(vectors), leaf)
    boxes = gap(plan.project(queries, query=True), low, high)
    norms = np.einsum("ij,ij->i", queries, queries) + plan.lift
    out = []
    for q, own, box, norm, known in zip(queries, query_ids, boxes, norms, reach):
        order = np.argsort(box, kind="stable")
        best_ids, best = np.empty(0, np.int64), np.empty(0)
        at, step, kth = 0, 2, known
        while at < len(order) and box[order[at]] <= plan.bound(kth):
            rows = np.concatenate([members[x] for x in order[at:at + step]])
            rows = rows[ids[rows] != own]
            found_ids = np.concatenate([best_ids, ids[rows]])
            found = np.concatenate([best, vectors[rows] @ q])
            keep = np.lexsort((found_ids, -found))[:k]
            best_ids, best = found_ids[keep], found[keep]
            if len(best) == k:
                kth = min(known, max(norm - 2 * best[-1], 0.0))
            at, step = at + step, step * 2
        out.append((int(own), best_ids, best))
    return out


def _searcher(shared, k: int):
    """Rows (queries, tile rows) to lists (query_id, part, vec_id, score)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                asked = batch.column("asked")[i].values
                query_ids, queries = unpacked(batch.column("asked")[i])
                ids, vectors = unpacked(batch.column("rows")[i])
                reach = asked.field("reach").to_numpy(zero_copy_only=False)
                found = search_tile(plan, queries, query_ids, ids, vectors, reach, k)
                lens = [len(x[1]) for x in found]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat([x[0] for x in found], lens), pa.int64()),
                    pa.array(np.full(sum(lens), batch.column("cell")[i].as_py()), pa.int64()),
                    pa.array(np.concatenate([x[1] for x in found]), pa.int64()),
                    pa.array(np.concatenate([x[2] for x in found]), pa.float64())],
                    ["query_id", "part", "vec_id", "score"])

    return run


LISTS = "query_id bigint, part bigint, vec_id bigint, score double"


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id",
                       vector_col: str = "embedding", dims: int = 8, certainty: float = 0.97,
                       tile_rows: int = 4096, queries_per_tile: int = 512,
                       sample_rows: int = 16_384, seed: int = 7) -> DataFrame:
    """The k largest inner products of each query among all vectors, with high recall.

    Returns query_id, rank (from 1), vec_id, score (the exact product in doubles);
    equal scores rank by smaller id. ``certainty`` is the chance that a true neighbour
    lies within the radius searched, so about the recall. ``sample_rows`` bounds the
    sample that places the cells; every vector is indexed. ``dims`` must be even.

    Defined cases: rows whose id or vector is NULL, whose vector is empty, zero, or
    holds a NULL or non-finite component take no part. Rows that share an id count
    once, with their smallest vector, and a query never meets its own id. Vectors not
    of the length that most have (the smaller of equally common ones) take no part
    either: they can't be projected alike. Fewer than k candidates give fewer rows,
    and empty tables an empty one. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = settle(finite_vectors(vectors, id_col, vector_col, zero=False), "vectors")
    asked = settle(finite_vectors(queries, id_col, vector_col, zero=False), "queries")
    norm = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    shape = (rows.groupBy(F.size("vec").alias("dim"))
             .agg(F.count("*").alias("n"), F.max(norm).alias("lift"))
             .orderBy(F.desc("n"), "dim").first())
    if shape is None or asked.isEmpty():
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows, asked = rows.where(F.size("vec") == shape["dim"]), asked.where(F.size("vec") == shape["dim"])
    n = shape["n"]
    share = min(1.0, sample_rows / n)
    mark = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30))
    sample = rows.where(mark < int(share * (1 << 30))).select("vec").limit(2 * sample_rows).collect()
    points = np.array([r["vec"] for r in sample]).reshape(-1, shape["dim"])
    plan = fit_plan(points, shape["lift"], max(1, round(n / tile_rows)), dims,
                    chi_square_quantile(certainty, dims), seed)
    shared = spark.sparkContext.broadcast(plan)  # bounded by sample_rows

    def place(query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vec = np.asarray(batch.column("vec").flatten()).reshape(batch.num_rows, -1)
                cells = shared.value.cell_of(shared.value.project(vec, query))
                yield batch.append_column("cell", pa.array(cells, pa.int64()))

        return run

    def deal(df: DataFrame, most: int) -> DataFrame:
        """Tiles of at most about ``most`` rows; a full cell gets several."""
        tiles = df.groupBy("cell").agg(F.ceil(F.count("*") / most).cast("int").alias("tiles"))
        return df.join(tiles, "cell").withColumn(
            "tile", F.pmod(F.xxhash64("id", F.lit(1)), F.col("tiles")).cast("int"))

    placed = settle(rows.mapInArrow(place(False), "id bigint, vec array<double>, cell bigint"), "cells")
    tiles = settle(deal(placed, tile_rows).groupBy("cell", "tile").agg(
        F.collect_list(F.struct("id", "vec")).alias("rows")), "tiles")

    def blocks(df: DataFrame) -> DataFrame:
        return deal(df, queries_per_tile).groupBy("cell", "tile").agg(
            F.collect_list(F.struct("id", "vec", "reach")).alias("asked")).select("cell", "asked")

    home = settle(asked.mapInArrow(place(True), "id bigint, vec array<double>, cell bigint")
                  .withColumn("reach", F.lit(float("inf"))), "homes")
    first = settle(blocks(home).join(tiles, "cell").mapInArrow(_searcher(shared, k), LISTS), "first")
    # the k-th distance found at home bounds the search of the other cells
    kth = merge_lists(first, k).groupBy("query_id").agg(F.count("*").alias("n"),
                                                        F.min("score").alias("last"))
    reach = F.when(F.col("n") == k, F.greatest(norm + shape["lift"] - 2 * F.col("last"), F.lit(0.0)))
    ready = home.join(kth, F.col("id") == F.col("query_id"), "left").select(
        "id", "vec", "cell", F.coalesce(reach, F.lit(float("inf"))).alias("reach"))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                vec = np.asarray(part.column("vec").flatten()).reshape(part.num_rows, -1)
                reach = part.column("reach").to_numpy()
                near = gap(plan.project(vec, query=True), plan.low, plan.high) <= plan.bound(reach)[:, None]
                near[np.arange(part.num_rows), part.column("cell").to_numpy()] = False
                row, cell = np.nonzero(near)
                picked = part.take(pa.array(row))
                yield picked.set_column(picked.schema.get_field_index("cell"), "cell",
                                        pa.array(cell, pa.int64()))

    away = ready.mapInArrow(visits, "id bigint, vec array<double>, cell bigint, reach double")
    second = blocks(away).join(tiles, "cell").mapInArrow(_searcher(shared, k), LISTS)
    fan = max(1, math.isqrt(len(plan.low)))
    return merge_lists(first.union(second).withColumn("part", F.pmod("part", F.lit(fan))), k)
