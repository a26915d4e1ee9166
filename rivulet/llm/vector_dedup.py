"""Near-duplicate vectors by randomised-rotation binary codes.

A unit vector is turned by a fixed random rotation and kept as its signs, with one
correction factor: the inner product f of the vector and its code. The inner product
of another vector with the code, divided by f, is an unbiased estimate of the cosine;
its error is a random direction's share of sqrt(1 - f^2) / f, times the sine between the
two vectors. So a pair at cosine t or more has an estimate of at least

    t - error * sqrt(1 - t^2) * sqrt(1 - f^2) / (f * sqrt(d - 1))

but for a chance that falls like exp(-error^2 / 2). Pairs below that bound are dropped
unseen, the others are computed again from the original vectors.

Vectors of a label are dealt to cells around sampled vectors, cells are cut into
tiles of bounded size, and tiles whose cells are too far apart for a link (by the
triangle inequality of angles) are never compared. A pair of tiles gives back, for each
vector, its number of links, and a star for each group: not the links themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rivulet.llm.common import settle
from rivulet.llm.components import connected_components

ERROR = 6.0  # standard errors of an estimate: loses fewer than one link in 10 million
MOST_CENTRES, CENTRES_EACH = 1024, 64
SLACK = 1e-5  # for products of 32-bit numbers
PAIRS_AT_ONCE = 1 << 14


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """A random rotation of ``dim`` dimensions, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled first, so that squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def encode(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed signs, correction factors) of unit vectors."""
    turned = units @ rotation(units.shape[1])
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / math.sqrt(units.shape[1])


def least_estimates(factor: np.ndarray, dim: int, threshold: float, error: float) -> np.ndarray:
    """The smallest estimate that a pair at the threshold has, within ``error`` standard errors."""
    free = math.sqrt(max(dim - 1, 1))
    side = np.sqrt(np.maximum(1 - factor * factor, 0)) / factor
    return threshold - min(error, free) / free * math.sqrt(max(0.0, 1 - threshold ** 2)) * side - SLACK


def estimates(units: np.ndarray, codes: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Estimated cosines of each of ``units`` with each coded vector."""
    dim = units.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    turned = (units @ rotation(dim)).astype(np.float32)
    return turned @ signs.T / (math.sqrt(dim) * factor).astype(np.float32)


def linked_pairs(left: np.ndarray, right: np.ndarray | None, codes: np.ndarray, factor: np.ndarray,
                 threshold: float, error: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of the rows at a cosine of ``threshold`` or more, some at a time.

    Rows are unit vectors in double precision; codes and factors are those of the right
    side; ``right`` None compares left with itself, each pair once.
    """
    same = right is None
    other = left if same else right
    low = least_estimates(factor, left.shape[1], threshold, error).astype(np.float32)
    step = max(1, (1 << 22) // max(1, len(other)))
    for at in range(0, len(left), step):
        i, j = np.nonzero(estimates(left[at:at + step], codes, factor) >= low)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for a in range(0, len(i), PAIRS_AT_ONCE):
            p, q = i[a:a + PAIRS_AT_ONCE], j[a:a + PAIRS_AT_ONCE]
            near = np.einsum("ij,ij->i", left[p], other[q]) >= threshold
            if near.any():
                yield p[near], q[near]


def _roots(a: np.ndarray, b: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """The roots after the links (a, b): the smallest number of each group."""
    while True:
        low = np.minimum(roots[a], roots[b])
        if (roots[a] == low).all() and (roots[b] == low).all():
            return roots
        np.minimum.at(roots, roots[a], low)
        np.minimum.at(roots, roots[b], low)
        while (roots[roots] != roots).any():
            roots = roots[roots]


def _classes(rows: DataFrame) -> DataFrame:
    """One row for each label and vector: smallest id, number of rows, a number of its own."""
    found = rows.where("takes").groupBy("label", "vec").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
    return settle(found.select("label", F.size("vec").alias("dim"), "vec", "rep", "weight",
                               F.monotonically_increasing_id().alias("node")), "vectors")


def _centres(classes: DataFrame, tile_rows: int) -> DataFrame:
    """(label, dim, centre, cell): vectors that stand for a region each, for labels of several tiles.

    At most MOST_CENTRES in all; other labels are one cell, which is exact, too.
    """
    sizes = classes.groupBy("label", "dim").count().where(F.col("count") > tile_rows).orderBy(
        F.desc("count"), "label", "dim").limit(MOST_CENTRES // CENTRES_EACH)
    some = sizes.select("label", "dim", F.least(
        F.ceil(F.col("count") / tile_rows) * 2, F.lit(CENTRES_EACH)).alias("cells"))
    order = Window.partitionBy("label", "dim").orderBy(F.xxhash64("node"), "node")
    drawn = classes.withColumn("cell", F.row_number().over(order)).where(F.col("cell") <= CENTRES_EACH)
    return drawn.join(F.broadcast(some), ["label", "dim"]).where("cell <= cells").select(
        "label", "dim", F.col("vec").alias("centre"), "cell")


def _coded(classes: DataFrame, centres: DataFrame, real: str) -> DataFrame:
    """label, dim, cell, angle to its centre and (node, weight, vector, code, factor) of each class."""
    near = {}
    for r in centres.collect():  # MOST_CENTRES rows at most
        near.setdefault((r["label"], r["dim"]), []).append(r)
    near = {k: ([r["cell"] for r in v], unit(np.array([r["centre"] for r in v], float)))
            for k, v in near.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            dims = batch.column("dim").to_numpy()
            labels = batch.column("label").to_pylist()
            starts = np.cumsum(dims) - dims
            flat = batch.column("vec").flatten().to_numpy(zero_copy_only=False).astype(real)
            cell, angle, factor = np.zeros(n, np.int32), np.zeros(n), np.zeros(n)
            blobs, codes = [b""] * n, [b""] * n
            groups: dict = {}
            for k, key in enumerate(zip(labels, dims.tolist())):
                groups.setdefault(key if key in near else (None, key[1]), []).append(k)
            for key, members in groups.items():
                at = np.array(members)
                own = flat[starts[at][:, None] + np.arange(key[1])]
                units = unit(own.astype(np.float64))
                packed, factor[at] = encode(units)
                for k, vector, code in zip(members, own, packed):
                    blobs[k], codes[k] = vector.tobytes(), code.tobytes()
                if key in near:
                    names, middle = near[key]
                    cosines = units @ middle.T
                    best = cosines.argmax(axis=1)
                    cell[at] = np.array(names)[best]
                    angle[at] = np.arccos(np.clip(cosines[np.arange(len(at)), best], -1, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("dim"), pa.array(cell), pa.array(angle),
                 batch.column("node"), batch.column("weight"), pa.array(blobs, pa.binary()),
                 pa.array(codes, pa.binary()), pa.array(factor)],
                ["label", "dim", "cell", "angle", "node", "weight", "vec", "code", "factor"])

    kind = classes.schema["label"].dataType.simpleString()
    return classes.select("label", "dim", "vec", "node", "weight").mapInArrow(
        run, f"label {kind}, dim int, cell int, angle double, node bigint, weight bigint, vec binary, "
             "code binary, factor double")


def _tile_pairs(coded: DataFrame, centres: DataFrame, threshold: float, tile_rows: int) -> DataFrame:
    """(dim, left, right): tiles that can hold a link; ``right`` is NULL for a tile and itself."""
    cells = coded.groupBy("label", "dim", "cell").agg(
        F.ceil(F.count("*") / tile_rows).cast("int").alias("chunks"), F.max("angle").alias("radius"))
    cells = settle(cells.join(centres, ["label", "dim", "cell"], "left"), "cells")
    tiles = settle(coded.join(cells.select("label", "dim", "cell", "chunks"), ["label", "dim", "cell"])
                   .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
                   .groupBy("label", "dim", "cell", "chunk")
                   .agg(F.collect_list(F.struct("node", "weight", "vec", "code", "factor")).alias("rows")),
                   "vector_tiles")
    known = tiles.select("label", "dim", "cell", "chunk").join(
        cells.select("label", "dim", "cell", "radius", "centre"), ["label", "dim", "cell"])
    one, two = known.alias("l"), known.alias("r")
    size = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x))
    dot = F.aggregate(F.zip_with("l.centre", "r.centre", lambda x, y: x.cast("double") * y),
                      F.lit(0.0), lambda s, x: s + x)
    apart = F.acos(F.greatest(F.lit(-1.0), F.least(
        F.lit(1.0), dot / (size("l.centre") * size("r.centre")))))
    reach = F.col("l.radius") + F.col("r.radius") + math.acos(min(1.0, threshold)) + 1e-6
    pairs = one.join(two, ["label", "dim"]).where(
        "(l.cell, l.chunk) <= (r.cell, r.chunk)").where(
        F.col("l.centre").isNull() | F.col("r.centre").isNull() | (apart <= reach)).select(
        "label", "dim", F.col("l.cell").alias("cell"), F.col("l.chunk").alias("chunk"),
        F.col("r.cell").alias("cell_2"), F.col("r.chunk").alias("chunk_2"))
    key = ["label", "dim", "cell", "chunk"]
    second = tiles.select("label", "dim", F.col("cell").alias("cell_2"), F.col("chunk").alias("chunk_2"),
                          F.col("rows").alias("right"))
    return pairs.join(tiles.withColumnRenamed("rows", "left"), key).join(
        second, ["label", "dim", "cell_2", "chunk_2"]).select(
        "dim", "left", F.expr("CASE WHEN cell <> cell_2 OR chunk <> chunk_2 THEN right END").alias("right"))


def _opened(scalar: pa.Scalar, dim: int, real: str) -> tuple:
    """(nodes, weights, unit vectors, codes, factors) of a tile."""
    flat = scalar.values
    number = lambda c: flat.field(c).to_numpy(zero_copy_only=False)
    raw = np.frombuffer(b"".join(flat.field("vec").to_pylist()), real).reshape(-1, dim)
    codes = np.frombuffer(b"".join(flat.field("code").to_pylist()), np.uint8).reshape(len(raw), -1)
    return number("node"), number("weight"), unit(raw.astype(np.float64)), codes, number("factor")


def vector_links(pairs: DataFrame, threshold: float, error: float, real: str) -> DataFrame:
    """(node, root, links): links of a class by pair of tiles, and its group there (root, or NULL)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                dim = batch.column("dim")[k].as_py()
                node, weight, units, codes, factor = _opened(batch.column("left")[k], dim, real)
                right, other = batch.column("right")[k], None
                shift, size = 0, len(node)
                if right.is_valid:
                    node_2, weight_2, other, codes, factor = _opened(right, dim, real)
                    node, weight = np.append(node, node_2), np.append(weight, weight_2)
                    shift = size
                links, roots = np.zeros(len(node), np.int64), np.arange(len(node))
                for i, j in linked_pairs(units, other, codes, factor, threshold, error):
                    j = j + shift
                    np.add.at(links, i, weight[j])
                    np.add.at(links, j, weight[i])
                    roots = _roots(i, j, roots)
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[some], pa.int64()), pa.array(node[roots[some]], pa.int64()),
                     pa.array(links[some], pa.int64())], ["node", "root", "links"])

    return pairs.mapInArrow(run, "node bigint, root bigint, links bigint")


def near_duplicate_vectors(df: DataFrame, threshold: float = 0.98, id_col: str = "vec_id",
                           vector_col: str = "embedding", label_col: str = "label",
                           tile_rows: int = 2048, error: float = ERROR) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row.

    Rows of one label link at a cosine of ``threshold`` (above 0) or more, in double precision.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest vec_id
    reachable over links, the row's own included, and ``kept`` marks the row that stays
    for its group. Equal vectors are compared once and counted by their number.

    Defined cases: rows without label, and vectors that are NULL, empty or zero or hold a NULL
    or non-finite component, link with nothing; so do vectors of different length.
    A row without id links with nothing, has no component and is kept. Rows that share an id
    are vectors of their own. Rows keep their number; other columns are ignored.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    single = df.schema[vector_col].dataType.elementType.simpleString() == "float"
    real = "<f4" if single else "<f8"
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).alias("label"),
                     F.col(vector_col).cast(f"array<{'float' if single else 'double'}>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.withColumn("takes", F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite
        & F.exists("vec", lambda x: x != 0), F.lit(False)))
    classes = _classes(rows)
    centres = settle(_centres(classes, tile_rows), "centres")
    coded = settle(_coded(classes, centres, real), "codes")
    found = settle(vector_links(_tile_pairs(coded, centres, threshold, tile_rows), threshold, error,
                                real), "vector_links")
    groups = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.join(counts, "node", "left").join(groups, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    verdicts = named.join(least, "component").select(
        "label", "vec", "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    own = rows.withColumn("vec", F.when(F.col("takes"), F.col("vec")))
    return own.join(verdicts, ["label", "vec"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
