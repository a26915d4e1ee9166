"""Near-duplicate vectors against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from rivulet.llm import vector_dedup

SCHEMA = "vec_id bigint, embedding array<float>, label int, n_links string, component_id int, rep int, cell int"


def brute(rows, threshold):
    """vec_id, n_links, component_id, kept of (id, vector, label) rows, one by one."""
    good = [k for k, (i, v, label) in enumerate(rows)
            if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v)
            and any(v)]
    links = {k: set() for k in range(len(rows))}
    for a in good:
        for b in good:
            (_, x, p), (_, y, q) = rows[a], rows[b]
            if a < b and p == q and len(x) == len(y):
                x, y = np.array(x, np.float32).astype(float), np.array(y, np.float32).astype(float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                    links[a].add(b), links[b].add(a)
    out, group = [], {}
    for k in range(len(rows)):
        if k in group:
            continue
        seen, todo = {k}, [k]
        while todo:
            fresh = links[todo.pop()] - seen
            seen |= fresh
            todo += fresh
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        group |= dict.fromkeys(seen, least)
    for k, (i, _, _) in enumerate(rows):
        out.append((i, len(links[k]), group[k], i is None or i == group[k]))
    return sorted(out, key=str)


def result(spark, rows, **more):
    df = spark.createDataFrame([(i, v, label, "x", 1, 2, 3) for i, v, label in rows], SCHEMA)
    got = vector_dedup.near_duplicate_vectors(df, **more)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    vectors = rng.standard_normal((500, 24)).astype(np.float32)
    for k in range(100, 220):  # near copies, on both sides of the threshold
        vectors[k] = vectors[k % 7] + rng.uniform(0, 0.3) * rng.standard_normal(24)
    vectors[230:300] = vectors[3]  # equal vectors
    vectors[300:320] = vectors[4] * 2.5
    labels = rng.integers(0, 3, 500)
    labels[:250] = 1
    return [(int(i), [float(x) for x in v], int(x)) for i, (v, x) in enumerate(zip(vectors, labels))]


@pytest.mark.parametrize("tile_rows", [2048, 40, 13])
def test_groups_equal_all_pairs(spark, rows, tile_rows):
    assert result(spark, rows, tile_rows=tile_rows) == brute(rows, 0.98)


def test_another_threshold_and_short_vectors(spark, rows):
    short = [(i, v[:2], label) for i, v, label in rows[:120]] + [(1000 + i, v[:1], 0) for i, v, _ in rows[:6]]
    assert result(spark, rows[:250], threshold=0.9, tile_rows=50) == brute(rows[:250], 0.9)
    assert result(spark, short, threshold=0.999, tile_rows=20) == brute(short, 0.999)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [], 1),
            (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 0.0], 1), (9, [None, 1.0], 1),
            (None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1), (0, [1.0, 0.01], 2),
            (11, [1e-30, 0.0], 1), (12, [3e38, 1e37], 1), (13, [-1.0, 0.0], 1)]
    assert result(spark, rows) == brute(rows, 0.98)
    assert result(spark, rows[3:8]) == brute(rows[3:8], 0.98)
    df = spark.createDataFrame([], SCHEMA)
    assert vector_dedup.near_duplicate_vectors(df).count() == 0


def test_estimates_are_unbiased_and_within_their_bounds():
    rng = np.random.default_rng(5)
    x = vector_dedup.unit(rng.standard_normal((300, 64)))
    codes, factor = vector_dedup.encode(x)
    y = vector_dedup.unit(0.98 * x + 0.199 * vector_dedup.unit(rng.standard_normal((300, 64))))
    true = y @ x.T
    guess = vector_dedup.estimates(y, codes, factor)
    away = guess - true
    assert abs(away.mean()) < 4 * away.std() / np.sqrt(away.size)
    near = np.diag(true)
    side = np.sqrt(1 - factor ** 2) / factor / np.sqrt(63) * np.sqrt(1 - near ** 2)
    assert np.abs(np.diag(away) / side).max() < 5 and 0.7 < (np.diag(away) / side).std() < 1.3
    low = vector_dedup.least_estimates(factor, 64, 0.98, vector_dedup.ERROR)
    assert (guess[true >= 0.98] >= np.broadcast_to(low, guess.shape)[true >= 0.98]).all()
    assert (guess >= low).mean() < 0.01  # few pairs are computed again
