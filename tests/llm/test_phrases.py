"""Collocations against counting by hand."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from rivulet.llm import phrases

SCHEMA = "doc_id bigint, text string, lang string, n bigint, words string, phrase int, score int"


def brute(rows, least, longest, contain, top):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        if text is None:
            continue
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text)
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in range(1, longest + 1):
                counts[lang].update(zip(*[w[k:] for k in range(m)]))
    out = []
    for lang, c in counts.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in cand.items():
            for m in range(2, len(p)):
                for k in range(len(p) - m + 1):
                    inside[p[k:k + m]] = max(inside[p[k:k + m]], a)
        rows_ = []
        for p, a in cand.items():
            if contain[1] * inside[p] >= contain[0] * a:
                continue
            score, _, left, right = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]])
                                        for k in range(1, len(p)))
            rows_.append((" ".join(p), a, left, right, total[lang], score))
        rows_.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, k + 1, *r) for k, r in enumerate(rows_[:top])]
    return sorted(out)


def texts(seed, n):
    rng = random.Random(seed)
    words = ["of", "the", "a", "new", "york", "city", "Hall", "é", "x-y", "x", "x\x01", "x\x7f", "日本", "it's"]
    out = []
    for _ in range(n):
        t = []
        for _ in range(rng.randint(0, 60)):
            t.append(rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "!\r"]).join(
                rng.choice([["New", "York", "city", "hall"], ["the", "end"], rng.choices(words, k=3)])))
        out.append((rng.choice(["en", "en", "en", "fr", None]), " ".join(t)))
    return out


@pytest.mark.parametrize("rows_per_range,longest", [(50_000, 4), (7, 4), (3, 3), (5, 2)])
def test_collocations_equal_brute_force(spark, rows_per_range, longest):
    rows = texts(longest + rows_per_range, 300) + [("en", None), ("de", ""), (None, "a b " * 40)]
    df = spark.createDataFrame([(i, t, lang, 5, "z", 1, 2) for i, (lang, t) in enumerate(rows)], SCHEMA)
    got = phrases.collocations(df, least=4, longest=longest, contain=(80, 100), top=60,
                               rows_per_range=rows_per_range)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, longest, (80, 100), 60)


def test_a_word_that_begins_most_phrases_lies_in_many_ranges(spark):
    rng = random.Random(3)
    rows = [("en", " . ".join(f"the {rng.randint(0, 40)} {rng.randint(0, 3)} x" for _ in range(40)))
            for _ in range(100)]
    df = spark.createDataFrame([(i, t, lang, 5, "z", 1, 2) for i, (lang, t) in enumerate(rows)], SCHEMA)
    got = phrases.collocations(df, least=3, top=None, rows_per_range=11)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, 4, (80, 100), None)


def test_small_cases(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert phrases.collocations(df).count() == 0
    df = spark.createDataFrame([(1, "a b. a b", "en", 5, "z", 1, 2), (1, "a b. a b", "en", 5, "z", 1, 2)], SCHEMA)
    assert phrases.collocations(df).count() == 0
    assert [tuple(r) for r in phrases.collocations(df, least=4).collect()] == [
        ("en", 1, "a b", 4, 4, 4, 8, 1000000)]
