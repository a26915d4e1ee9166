"""Language labels and quality rules: exactness of the parts, accuracy on held-out rows."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest

from rivulet.llm import langid, quality, queries

SF = "/root/testdata/sf0.01"
SYLLABLES = {"aa": ["ka", "ku", "kor"], "bb": ["li", "lemi", "lo"], "cc": ["zu", "zet", "zazi"]}


def text_in(lang, n, seed):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(SYLLABLES[lang], rng.integers(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def field():
    langs = [lang for lang in SYLLABLES for _ in range(30)]
    return langid.fit([text_in(x, 60, k) for k, x in enumerate(langs)], langs)


def test_marginals_equal_sums_over_all_paths():
    rng = np.random.default_rng(1)
    scores, moves = rng.standard_normal((5, 3)) * 2, rng.standard_normal((3, 3))
    weight = np.zeros((5, 3))
    for path in itertools.product(range(3), repeat=5):
        w = np.exp(sum(scores[t, y] for t, y in enumerate(path))
                   + sum(moves[a, b] for a, b in zip(path, path[1:])))
        for t, y in enumerate(path):
            weight[t, y] += w
    want = weight / weight.sum(axis=1, keepdims=True)
    assert np.allclose(langid.marginals(scores, np.array([5]), moves), want)


def test_marginals_do_not_depend_on_blocks_or_neighbours():
    rng = np.random.default_rng(2)
    lens = np.array([1, 64, 65, 200, 3])
    scores, moves = rng.standard_normal((lens.sum(), 4)) * 30, rng.standard_normal((4, 4))
    together = langid.marginals(scores, lens, moves)
    cuts = np.cumsum(lens)
    for a, b in zip(cuts - lens, cuts):
        assert np.allclose(together[a:b], langid.marginals(scores[a:b], np.array([b - a]), moves))
    assert np.isfinite(together).all()


def test_switches_are_found_word_by_word(spark, field):
    text = text_in("aa", 30, 901) + " " + text_in("cc", 20, 902) + " " + text_in("bb", 25, 903)
    df = spark.createDataFrame([(1, text, "kept")], "doc_id bigint, text string, score string")
    row = langid.label_languages(df, field, words=True).first()
    assert [(r["lang"], r["words"]) for r in row["word_langs"]] == [("aa", 30), ("cc", 20), ("bb", 25)]
    assert row["lang_pred"] == "aa" and 0.35 < row["score"] < 0.45


def test_language_odd_rows(spark, field):
    rows = [(1, None), (2, ""), (3, "12 ½ ²! _ \n"), (4, "ka"), (4, "ka"), (None, text_in("bb", 5000, 7)),
            (6, "k" * 100_000)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows],
                               "doc_id bigint, text string, lang_pred string, word_langs int")
    got = sorted(((r["doc_id"] or 0, r["lang_pred"], 0 <= r["score"] <= 1) for r in
                  langid.label_languages(df, field).collect()))
    assert got[:4] == [(0, "bb", True), (1, "und", True), (2, "und", True), (3, "und", True)]
    assert got[4:6] == [(4, "aa", True)] * 2 and got[6][1] in SYLLABLES
    assert langid.label_languages(df.where("false"), field).count() == 0


def test_field_without_labels(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")
    found = langid.label_languages(df, langid.fit_field(df)).first()
    assert (found["lang_pred"], found["score"]) == ("und", 0.0)
    one = langid.fit(["ka ku"], ["aa"])
    assert langid.label_languages(df, one).first()["lang_pred"] == "aa"


def test_language_on_held_out_documents(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op10_crf_language"](spark, SF).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97


def test_statistics():
    names = dict(zip(quality.STATISTICS, quality.statistics_of("AB cd! cd!\n| 12".encode())))
    assert names["words"] == pytest.approx(np.log(6)) and names["word_bytes"] == 11 / 5
    assert names["upper"] == pytest.approx(1 / 3) and names["digits"] == pytest.approx(2 / 11)
    assert names["bangs"] == 0.4 and names["bars"] == 0.2 and names["doubled"] == 0.2
    assert names["distinct"] == 0.8 and names["lines"] == 2.5 and names["longest"] == 3
    assert set(quality.statistics_of(b"")) == set(quality.statistics_of(b" \n")) == {0.0}


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for k in range(300):
        good = bool(k % 3)
        rows.append((k, text_in("aa", int(rng.integers(5, 60)), k) if good
                     else "ka ka ka !! !! !! " * int(rng.integers(1, 9)), "x"))
        labels.append((k, int(good), 0))
    labels += [(0, None, 0), (None, 1, 0), (1, 1, 0), (1, 0, 0), (1, 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, text_statistics string")
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_rules_separate_and_compile(spark, fitted):
    docs, labels = fitted
    stats, rules = quality.fitted_rules(docs, labels, quality.F.lit(True))
    scores = {r["doc_id"]: r["s"] for r in stats.select("doc_id", rules.score().alias("s")).collect()}
    assert np.mean([(scores[k] >= 0.5) == bool(k % 3) for k in scores]) > 0.98
    assert 0 < len(rules.weights) < 60
    # the columns say what the rules say
    row = stats.first()
    total = rules.intercept + sum(w for r, w in rules.weights if all(
        (row["text_statistics"][n] > c) == above for n, above, c in r.parts))
    assert scores[row["doc_id"]] == pytest.approx(1 / (1 + np.exp(-total)))


def test_quality_odd_rows(spark, fitted):
    docs, labels = fitted
    _, rules = quality.fitted_rules(docs, labels, quality.F.lit(True))
    odd = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, " "), (4, "w " * 100_000)],
                                "doc_id bigint, text string")
    got = quality.with_statistics(odd).select(rules.score().alias("s")).collect()
    assert len(got) == 5 and all(0 <= r["s"] <= 1 for r in got)
    assert quality.with_statistics(odd.where("false")).count() == 0


def test_quality_without_labels(spark, fitted):
    docs, labels = fitted
    for some, score in ((labels.where("false"), 0.5), (labels.where("quality = 1 and doc_id > 1"), 1.0)):
        stats, rules = quality.fitted_rules(docs, some, quality.F.lit(True))
        got = stats.select(rules.score().alias("s")).first()["s"]
        assert got == pytest.approx(score, abs=0.01)


def test_quality_on_held_out_documents(spark):
    quality_of = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.QUERIES["op4_rule_quality"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in quality_of]
    assert np.mean([r["predicted"] == quality_of[r["doc_id"]] for r in held]) > 0.95


def test_a_language_of_long_texts_or_of_copies_is_learned(spark):
    rows = [(k, text_in("aa", 60, k), "aa") for k in range(30)]
    rows += [(100 + k, text_in("bb", 9000, k), "bb") for k in range(8)]  # each longer than a stretch
    rows += [(200 + k, text_in("cc", 60, 0), "cc") for k in range(400)] + [
        (900 + k, text_in("cc", 60, k), "cc") for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    drawn = langid.sample_rows(df, 20, 5000)
    assert {r["lang"] for r in drawn} == {"aa", "bb", "cc"} and max(len(r["text"]) for r in drawn) == 5000
    assert len({(r["lang"], r["text"]) for r in drawn}) == len(drawn)
    assert sum(r["lang"] == "cc" for r in drawn) > 5
    field = langid.fit_field(df, per_language=20, most_chars=5000)
    got = langid.label_languages(df, field).collect()
    assert all(r["lang_pred"] == r["lang"] for r in got)


def test_every_score_equals_a_plain_reading_of_the_rules(spark, fitted):
    docs, labels = fitted
    odd = spark.createDataFrame([(9001, None, None), (9002, "", None), (None, "a | b! 7.", None)], docs.schema)
    stats, rules = quality.fitted_rules(docs.union(odd), labels, quality.F.lit(True))
    got = sorted((r["doc_id"] or -1, r["s"]) for r in stats.select("doc_id", rules.score().alias("s")).collect())
    want = []
    for r in docs.union(odd).collect():
        found = dict(zip(quality.STATISTICS, quality.statistics_of((r["text"] or "").encode())))
        total = rules.intercept
        for rule, weight in rules.weights:
            if all((found[n] > cut) == above for n, above, cut in rule.parts):
                total += weight
        want.append((r["doc_id"] or -1, 1 / (1 + np.exp(-total))))
    assert [i for i, _ in got] == [i for i, _ in sorted(want)]
    assert np.allclose([s for _, s in got], [s for _, s in sorted(want)])
