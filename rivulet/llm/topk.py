"""Exact top-k search by tiled matrix products.

Vectors are dealt into tiles by a hash of their id; queries form tiles of their
own. Each pair of a query tile and a shard tile is one matrix product, from which
the best k per query are selected at once (a partial selection, no full sort).
The stored tiles meet in a Cartesian product whose tasks read them from the shared
folder: no copy of a tile is shuffled or broadcast, so none reaches the driver.
The short lists then merge in a tree: first within groups of shards, then over
the groups, so no task sees more than the square root of all lists of a query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rivulet.llm.common import finite_vectors, settle

LONG = np.iinfo(np.int64)


def _products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact integer inner products; Python integers where doubles could round."""
    top = np.abs(queries).max(initial=0) * np.abs(shard).max(initial=0) * queries.shape[1]
    if top < 2.0 ** 53:
        return queries @ shard.T
    whole = lambda a: np.array([[int(x) for x in row] for row in a], dtype=object)
    return np.clip(whole(queries) @ whole(shard).T, LONG.min, LONG.max)


def best_of_tile(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, shard: np.ndarray,
                 k: int, exact_int: bool) -> Iterator[tuple]:
    """(query id, ids, scores) of the k best rows of one tile for each query."""
    scores = _products(queries, shard) if exact_int else queries @ shard.T
    for q, line in zip(query_ids, scores):
        other = np.flatnonzero(ids != q)
        line = line[other]
        if len(line) > k:  # all that reach the k-th best score; ties are settled by id below
            floor = np.sort(line)[-k] if line.dtype == object else np.partition(line, -k)[-k]
            near = np.flatnonzero(line >= floor)
            other, line = other[near], line[near]
        order = np.lexsort((ids[other], -line.astype(np.float64)) if line.dtype != object
                           else (ids[other], [-x for x in line]))[:k]
        yield q, ids[other[order]], line[order]


def tile_rows(vectors: DataFrame, tiles: int) -> DataFrame:
    """(tile, dim, ids, vecs): about equal parts of the rows, dealt by a hash of the id."""
    return (vectors.withColumn("tile", F.pmod(F.xxhash64("id"), F.lit(tiles)).cast("int"))
            .groupBy("tile", F.size("vec").alias("dim"))
            .agg(F.collect_list(F.struct("id", "vec")).alias("rows")))


def unpacked(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and matrix of one tile."""
    flat = rows.values if hasattr(rows, "values") else rows
    ids = flat.field("id").to_numpy(zero_copy_only=False)
    vec = flat.field("vec")
    return ids, np.asarray(vec.flatten()).reshape(len(ids), -1)


def merge_lists(lists: DataFrame, k: int) -> DataFrame:
    """The k best of (query_id, part, vec_id, score) lists, in two steps of a tree."""
    def best(df: DataFrame, *keys: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    first = best(lists, "query_id", "part").drop("rank")
    return best(first, "query_id").select("query_id", "rank", "vec_id", "score")


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id",
                vector_col: str = "embedding", scale: float | None = None,
                rows_per_tile: int = 4096, queries_per_tile: int = 1024) -> DataFrame:
    """The k highest inner products of each query with all vectors, exactly.

    Returns query_id, rank (from 1), vec_id, score; equal scores rank by smaller
    id. With ``scale`` the components become floor(scale * x) and the score is an
    integer (bigint, held at its bounds if a product exceeds them); without it,
    doubles.

    Defined cases: rows whose id or vector is NULL, whose vector is empty or holds
    a NULL or non-finite component take no part. Rows that share an id count once,
    with their smallest vector, and a query never meets its own id. Only vectors
    of the query's length are its candidates. Fewer than k candidates give fewer
    rows; no queries or no vectors give an empty table. Other columns are ignored.
    """
    shards = settle(finite_vectors(vectors, id_col, vector_col, zero=True), "vectors")
    asked = settle(finite_vectors(queries, id_col, vector_col, zero=True), "queries")
    n, m = shards.count(), asked.count()
    tiles, blocks = max(1, math.ceil(n / rows_per_tile)), max(1, math.ceil(m / queries_per_tile))
    fan = max(1, math.isqrt(tiles))
    exact_int, factor = scale is not None, scale or 1.0

    shard_tiles = settle(tile_rows(shards, tiles), "tiles")
    query_tiles = settle(tile_rows(asked, blocks), "asked").select(
        F.col("dim").alias("asked_dim"), F.col("rows").alias("asked"))
    # dims are not a key: that would bring all tiles to one task; a broadcast would pass through the driver
    pairs = shard_tiles.join(query_tiles.hint("shuffle_replicate_nl"),
                             F.abs(F.col("dim") - F.col("asked_dim")) < 1).select("tile", "asked", "rows")

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.column("tile")[i].as_py() % fan
                q, a = unpacked(batch.column("asked")[i])
                ids, b = unpacked(batch.column("rows")[i])
                if exact_int:
                    a, b = np.floor(a * factor), np.floor(b * factor)
                found = list(best_of_tile(q, a, ids, b, k, exact_int))
                lens = [len(x[1]) for x in found]
                score = [x for f in found for x in (map(int, f[2]) if exact_int else f[2].tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(q, lens), pa.int64()),
                    pa.array(np.full(sum(lens), part), pa.int32()),
                    pa.array([int(x) for f in found for x in f[1]], pa.int64()),
                    pa.array(score, pa.int64() if exact_int else pa.float64())],
                    ["query_id", "part", "vec_id", "score"])

    kind = "bigint" if exact_int else "double"
    lists = pairs.mapInArrow(select, f"query_id bigint, part int, vec_id bigint, score {kind}")
    return merge_lists(lists, k)
