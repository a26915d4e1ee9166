"""Exact top-k and projected neighbours against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from rivulet.llm import ann, topk

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, tile int"


def rows_of(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in vectors], SCHEMA)


def brute(vectors, asked, k, measure):
    out = {}
    for q, x in asked:
        found = sorted(((-measure(x, y), i) for i, y in vectors if i != q and len(x) == len(y)))
        out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return out


def collected(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in out.items()}


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    some = rng.standard_normal((400, 6)).astype(np.float32).round(1)
    some[100:180] = some[3]  # one vector holds a fifth of the rows
    return [(i, [float(x) for x in v]) for i, v in enumerate(some)]


ODD = [(None, [1.0] * 6), (900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
       (903, [float("nan")] * 6), (904, [float("inf")] + [0.0] * 5)]


def test_exact_top_k(spark, vectors):
    df = rows_of(spark, vectors + ODD + [vectors[7], (905, [1.0, 2.0])])
    got = collected(topk.exact_top_k(df, df.where("vec_id % 20 = 0"), k=5, scale=256.0,
                                     rows_per_tile=37, queries_per_tile=6))
    whole = [(i, [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v]) for i, v in vectors]
    want = brute(whole, [v for v in whole if v[0] % 20 == 0], 5,
                 lambda x, y: sum(a * b for a, b in zip(x, y)))
    assert got == want


def test_exact_top_k_sends_no_tiles_through_the_driver(spark, vectors):
    """Tiles of several lengths, small enough for a broadcast, are not broadcast."""
    mixed = vectors + [(1000 + i, v[:3]) for i, v in vectors[:90]]
    df = rows_of(spark, mixed)
    found = topk.exact_top_k(df, df.where("vec_id % 30 = 10"), k=4, scale=16.0, rows_per_tile=50, queries_per_tile=4)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    whole = [(i, [int(np.floor(np.float64(np.float32(x)) * 16)) for x in v]) for i, v in mixed]
    assert collected(found) == brute(whole, [v for v in whole if v[0] % 30 == 10], 4,
                                     lambda x, y: sum(a * b for a, b in zip(x, y)))


def test_exact_top_k_small_cases(spark):
    few = rows_of(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 0.0])])
    got = collected(topk.exact_top_k(few, few.where("vec_id = 0"), k=5))
    assert got == {0: [(1, 1, 0.5), (2, 2, 0.0)]}
    empty = few.where("false")
    assert topk.exact_top_k(empty, empty, k=3).count() == 0
    assert topk.exact_top_k(few, empty, k=3).count() == 0


def test_exact_top_k_beyond_doubles(spark):
    big = spark.createDataFrame([(0, [2.0 ** 30, 1.0]), (1, [2.0 ** 30, 1.0]), (2, [2.0 ** 30, 2.0])],
                                "vec_id bigint, embedding array<double>")
    got = collected(topk.exact_top_k(big, big.where("vec_id = 0"), k=2, scale=1.0))
    assert got == {0: [(1, 2, 2 ** 60 + 2), (2, 1, 2 ** 60 + 1)]}


def test_projected_neighbours_ties_and_odd_rows(spark, vectors):
    zero = [(906, [0.0] * 6)]
    df = rows_of(spark, vectors + ODD + zero + [(907, [1.0, 2.0]), vectors[11]])
    got = collected(ann.nearest_neighbours(df, df.where("vec_id % 20 = 0"), k=20, tile_rows=50,
                                           queries_per_tile=5))
    wide = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in vectors]
    want = brute(wide, [v for v in wide if v[0] % 20 == 0], 20, lambda x, y: float(x @ y))
    hits = [len({i for _, i, _ in got[q]} & {i for _, i, _ in want[q]}) / 20 for q in want]
    assert set(got) == set(want) and np.mean(hits) >= 0.9
    assert all([r for r, _, _ in v] == list(range(1, 21)) for v in got.values())
    # a query that is one of the copies finds the other copies, smallest ids first
    assert [i for _, i, _ in got[120]][:20] == [i for _, i, _ in want[120]][:20]


def test_projected_neighbours_of_nothing(spark):
    few = rows_of(spark, [(0, [1.0, 0.0]), (20, [0.5, 0.5])])
    assert collected(ann.nearest_neighbours(few, few, k=3)) == {0: [(1, 20, 0.5)], 20: [(1, 0, 0.5)]}
    empty = few.where("false")
    assert ann.nearest_neighbours(empty, empty, k=3).count() == 0


def test_recall_on_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    asked = df.where("vec_id % 20 = 0")
    exact = collected(topk.exact_top_k(df, asked, k=20))
    got = collected(ann.nearest_neighbours(df, asked, k=20, tile_rows=64))
    hits = [len({i for _, i, _ in got[q]} & {i for _, i, _ in exact[q]}) / 20 for q in exact]
    assert np.mean(hits) >= 0.9


def test_chi_square_quantile():
    # with two degrees of freedom the distribution is exponential
    assert ann.chi_square_quantile(0.97, 2) == pytest.approx(-2 * np.log(0.03))
    rng = np.random.default_rng(0)
    sums = (rng.standard_normal((200_000, 8)) ** 2).sum(axis=1)
    assert np.mean(sums <= ann.chi_square_quantile(0.9, 8)) == pytest.approx(0.9, abs=0.005)


def test_kd_cells_hold_every_point_once():
    points = np.round(np.random.default_rng(2).standard_normal((500, 3)), 1)
    members, low, high = ann.kd_cells(points, 16)
    assert sorted(np.concatenate(members)) == list(range(500)) and max(map(len, members)) <= 16
    for part, a, b in zip(members, low, high):
        assert (points[part] >= a).all() and (points[part] <= b).all()
