"""The pipeline's stages, one by one and as a whole."""

from __future__ import annotations

import re

import numpy as np
import pytest

import corpus_pipeline as pipeline
from rivulet.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def with_odd_rows(spark, docs):
    rows = [(None, None, None, None, None), (900_001, "", "en", "s", 0), (900_002, "12 34", None, "s", 5),
            (None, "The and of it is that the.", "en", None, 26), (0, "The same id again of it.", "en", "s", 24)]
    return docs.union(spark.createDataFrame(rows, docs.schema))


def test_stages_keep_the_columns_and_drop_what_they_should(spark, docs):
    assert [n for n, _ in pipeline.STAGES] == ["language", "quality", "near_duplicates", "passages", "packing"]
    now = with_odd_rows(spark, docs)
    sizes = [now.count()]
    for name, stage in pipeline.STAGES[:-1]:
        now = pipeline.settle(stage(spark, now, SF), name)
        assert now.columns == COLUMNS
        sizes.append(now.count())
    texts = [r["text"] for r in now.collect()]
    assert None not in texts and "12 34" not in texts
    assert sizes == sorted(sizes, reverse=True)


def test_language_keeps_every_labelled_document(spark, docs):
    kept = {r["doc_id"] for r in pipeline.language(spark, docs, SF).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()}


def test_quality_keeps_the_good(spark, docs):
    kept = {r["doc_id"] for r in pipeline.clean(spark, docs, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good = [r["doc_id"] in kept for r in labels if r["quality"] == 1]
    bad = [r["doc_id"] in kept for r in labels if r["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_near_duplicates_leave_one_of_each_group(spark, docs):
    rng = np.random.default_rng(1)
    text = lambda: ["".join(rng.choice(list("abcdef"), 5)) for _ in range(300)]
    rows = []
    for g in range(20):
        words = text()
        for v in range(4):
            some = list(words)
            if v:
                some[40 * v] = "edited"
            rows.append((100 * g + v, " ".join(some), "en", "s", 0))
    kept = pipeline.distinct(spark, spark.createDataFrame(rows, docs.schema), SF).collect()
    assert sorted(r["doc_id"] for r in kept) == [100 * g for g in range(20)]


def test_near_duplicates_judge_rows_not_ids(spark, docs):
    text = lambda seed: " ".join(f"{seed}w{k}" for k in range(40))
    rows = [(1, text("a")), (1, text("b")), (1, text("b")), (2, text("a")), (None, text("c")), (None, text("c")),
            (None, text("b")), (3, text("d"))]
    kept = pipeline.distinct(spark, spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], docs.schema), SF)
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(1, text("a")), (1, text("b")), (None, text("c")), (3, text("d"))], key=str)


def test_passages_are_cut_at_whole_characters(spark, docs):
    shared = "é" * 40
    rows = [(1, shared, "fr", "s", 40), (2, "start " + shared + " end", "fr", "s", 50), (3, None, None, None, None)]
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pipeline.fresh_passages(
        spark, spark.createDataFrame(rows, docs.schema), SF).collect()}
    assert got == {1: (shared, 40), 2: ("start  end", 10), 3: ("", 0)}


def test_passages_keep_replacement_signs_of_the_text(spark, docs):
    shared = "é" * 40
    rows = [(1, "\ufffd " + shared), (2, "a\ufffdb"), (3, "\ufffd start è" + shared + "\ufffd end"), (4, "\ufffd")]
    got = {r["doc_id"]: r["text"] for r in pipeline.fresh_passages(spark, spark.createDataFrame(
        [(i, t, "fr", "s", 0) for i, t in rows], docs.schema), SF).collect()}
    assert got == {1: rows[0][1], 2: "a\ufffdb", 3: "\ufffd start è\ufffd end", 4: "\ufffd"}


def test_whole_run(spark, docs):
    found = pipeline.run(spark, SF)
    rows = found.collect()
    assert rows and {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.collect()}
    assert len({(r["bucket"], r["batch"], r["slot"]) for r in rows}) == len(rows)


def test_empty_documents(spark, docs):
    now = docs.where("false")
    for name, stage in pipeline.STAGES:
        now = pipeline.settle(stage(spark, now, SF), name)
    assert now.count() == 0


CLASHING = ("score lang_pred evidence verdict statistics text_statistics row rep kept spans n_bytes hash doc fp "
            "tile chunk rows component_id ranges carry_0 held_0 cut first node Row_ shingles").split()


def test_stages_keep_columns_with_the_names_of_their_own(spark, docs):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"],
             *[f"{c} {r['doc_id']}" for c in CLASHING]) for r in docs.limit(60).collect()]
    wide = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                 + ", ".join(f"{c} string" for c in CLASHING))
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, wide, SF)
        assert out.columns == wide.columns
        found = out.collect()
        assert found
        for r in found:
            assert [r[c] for c in CLASHING] == [f"{c} {r['doc_id']}" for c in CLASHING], name
    assert pipeline.packed(spark, wide, SF).count()


def test_a_corpus_without_languages_stays(spark, docs):
    some = docs.limit(50).withColumn("lang", pipeline.F.lit(None).cast("string"))
    odd = spark.createDataFrame([(1, None, None, "s", 0), (2, "12 - !", None, "s", 0)], docs.schema)
    kept = pipeline.language(spark, some.union(odd), SF).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(r["doc_id"] for r in some.collect())


def test_language_drops_what_no_language_explains(spark, docs):
    rng = np.random.default_rng(2)
    other = lambda first: " ".join("".join(chr(first + int(c)) for c in rng.integers(0, 30, 5)) for _ in range(300))
    odd = [(900_001, other(0x430)), (900_002, other(0x4E00)), (900_003, "7 + 8 = 15")]
    both = docs.where("lang = 'en'").first()["text"][:3000] + " " + docs.where("lang = 'de'").first()["text"][:3000]
    rows = [(i, t, None, "s", 0) for i, t in odd] + [(900_004, both, None, "s", 0)]
    kept = {r["doc_id"] for r in pipeline.language(
        spark, docs.union(spark.createDataFrame(rows, docs.schema)), SF).collect()}
    assert {i for i in kept if i >= 900_000} == {900_004}


def plain_rows(docs, found):
    """Documents by row number, as (doc_id, text) lists, and the rows of a stage's result."""
    return [(r["doc_id"], r["text"]) for r in docs], sorted((r["doc_id"], r["text"]) for r in found)


def test_near_duplicates_and_passages_equal_a_plain_version(spark, docs):
    rows = docs.limit(150).collect()
    now = spark.createDataFrame(rows, docs.schema)
    given, got = plain_rows(rows, pipeline.distinct(spark, now, SF).collect())
    low = [re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) for _, t in given]
    sets = [{tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in low]
    group = list(range(len(given)))
    for a in range(len(given)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] == sets[b] or both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                group = [group[b] if g == group[a] else g for g in group]
    best = {}
    for g, row in zip(group, given):
        best[g] = min(best.get(g, row), row)
    assert got == sorted(best.values())
    left = sorted(best.values())
    _, cut = plain_rows([], pipeline.fresh_passages(spark, spark.createDataFrame(
        [(i, t, "en", "s", 0) for i, t in left], docs.schema), SF).collect())
    seen, want = {}, []
    for i, t in left:
        raw = t.encode()
        for p in range(len(raw) - 49):
            seen.setdefault(raw[p:p + 50], i)
    for i, t in left:
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 49):
            if seen[raw[p:p + 50]] < i:
                gone[p:p + 50] = True
        pieces, now_ = [b""], True
        for byte, out in zip(raw, gone):
            if out != now_ and not out:
                pieces.append(b"")
            now_ = out
            if not out:
                pieces[-1] += bytes([byte])
        want.append((i, b"".join(x.decode("utf-8", "ignore").encode() for x in pieces).decode()))
    assert cut == want


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
