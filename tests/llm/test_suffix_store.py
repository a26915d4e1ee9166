"""Batches added to a stored suffix index against one call and against brute force."""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pytest

from rivulet.llm import suffix_dedup, suffix_store
from tests.llm.test_dedup import docs_of, in_order, passages, plain_removal, removal


def index_of(spark, shard_bytes=2000):
    return suffix_store.SuffixIndex(spark, f"{spark.conf.get('spark.checkpoint.dir')}/{uuid.uuid4().hex}",
                                    shard_bytes=shard_bytes)


def rows_of(found):
    return [(r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in found.collect()]


def levels_of(index, part):
    return Counter(r["shard"] for r in index.manifest().where(f"part = '{part}'").collect())


def test_batches_equal_one_call(spark):
    rows = passages()
    ids = [np.inf if i is None else i for i, _ in rows]
    index, got = index_of(spark), []
    for low, high in ((0, 18), (18, 30), (30, 75), (75, np.inf)):
        batch = [r for r, i in zip(rows, ids) if low <= i < high or i == high == np.inf]
        got += rows_of(index.add(docs_of(spark, batch), f"from {low}"))
    assert in_order(got) == in_order(plain_removal(rows, 50))
    assert in_order(got) == in_order(removal(docs_of(spark, rows), shard_bytes=2000))
    shards = index.manifest().selectExpr("min(shards)", "max(shards)").first()
    assert shards[0] < shards[1]  # dealt anew as the text grew


def test_random_batches_against_brute_force(spark):
    rng = np.random.default_rng(0)
    pool = "".join(rng.choice(list("abcdefgh "), 700))
    rows = []
    for i in range(36):  # stretches of one text, so that grams stand in many contexts
        cuts = [(int(a), int(a + n)) for a, n in zip(rng.integers(0, 600, 3), rng.integers(20, 130, 3))]
        rows.append((i, "".join(pool[a:b] + "#%d#" % rng.integers(9) for a, b in cuts)))
    index, got = index_of(spark), []
    for k in range(0, 36, 12):
        got += rows_of(index.add(docs_of(spark, rows[k:k + 12]), f"batch {k}"))
    assert in_order(got) == in_order(plain_removal(rows, 50))


def test_levels_merge_and_stay(spark):
    rng = np.random.default_rng(3)
    index, born = index_of(spark, 1 << 20), []
    for k in range(5):
        text = "".join(rng.choice(list("abcdefgh"), 8000 if k == 0 else 500))
        index.add(docs_of(spark, [(k, text)]), str(k))
        born.append({r["born"] for r in index.manifest().where("part = 'runs'").collect()})
    assert all(0 in b for b in born)  # the large level is never written again
    assert max(levels_of(index, "runs").values()) <= 4


def test_a_batch_is_added_once(spark):
    shared = "".join(np.random.default_rng(4).choice(list("abcdefgh"), 90))
    index = index_of(spark)
    first, second = [(1, "x" + shared), (2, shared)], [(3, "123" + shared + "456")]
    index.add(docs_of(spark, first), "first")
    want = rows_of(index.add(docs_of(spark, second), "second"))
    assert want == [(3, 96, [(3, 93)], b"123456")]
    before = index.manifest().count()
    assert rows_of(index.add(docs_of(spark, second), "second")) == want
    assert in_order(rows_of(index.add(docs_of(spark, first), "first"))) == in_order(plain_removal(first, 50))
    assert index.manifest().count() == before


def test_a_failed_addition_leaves_the_index(spark, monkeypatch):
    shared = "".join(np.random.default_rng(5).choice(list("abcdefgh"), 90))
    index = index_of(spark)
    index.add(docs_of(spark, [(1, shared)]), "first")
    with monkeypatch.context() as m:
        def fail(*_):
            raise RuntimeError("no more disk")
        m.setattr(suffix_store, "refresh_replace", fail)
        with pytest.raises(RuntimeError, match="disk"):
            index.add(docs_of(spark, [(2, "other text " * 20)]), "second")
    got = rows_of(index.add(docs_of(spark, [(2, shared[:70]), (3, "other text " * 20)]), "second"))
    assert in_order(got) == [(2, 70, [(0, 70)], b""), (3, 220, [], b"other text " * 20)]


def test_order_of_arrival_and_odd_batches(spark):
    shared = "".join(np.random.default_rng(6).choice(list("abcdefgh"), 90))
    index = index_of(spark)
    assert rows_of(index.add(docs_of(spark, []), "nothing")) == []
    assert in_order(rows_of(index.add(docs_of(spark, [(9, shared), (None, None), (4, "")]), "one"))) == in_order(
        [(9, 90, [], shared.encode()), (None, 0, [], b""), (4, 0, [], b"")])
    # a smaller id and a missing one that come later; an id that the index has
    got = rows_of(index.add(docs_of(spark, [(1, shared), (None, shared), (9, shared[5:60])]), "two"))
    assert in_order(got) == in_order([(1, 90, [(0, 90)], b""), (None, 90, [(0, 90)], b""), (9, 55, [(0, 55)], b"")])
    with pytest.raises(ValueError, match="50"):
        suffix_store.SuffixIndex(spark, index.path, match=60).add(docs_of(spark, []), "three")
    with pytest.raises(ValueError, match="carried"):
        index.add(docs_of(spark, []), "three", carry=("kept",))


def test_added_rows_carry_columns(spark):
    found = index_of(spark).add(docs_of(spark, [(1, "a" * 60), (2, "b" + "a" * 60)]), "one", carry=("lang", "doc"))
    assert found.columns == ["doc_id", "n_bytes", "spans", "kept", "lang", "doc"]
    assert {(r["doc_id"], bytes(r["kept"]), r["doc"]) for r in found.collect()} == {(1, b"a" * 60, "d"), (2, b"b", "d")}
