"""Periodic runs against a definition-by-definition search."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from rivulet.llm import periodic, queries

SF = "/root/testdata/sf0.001"


def brute_runs(words, least_length, least_exponent):
    """All maximal stretches of period q, whose smallest period is q."""
    found = {}
    n = len(words)
    for q in range(1, n // least_exponent + 1):
        start = None
        for i in range(n - q + 1):
            if i < n - q and words[i] == words[i + q]:
                start = i if start is None else start
            elif start is not None:
                found.setdefault((start, i - start + q), q)
                start = None
    return sorted((s, length, q) for (s, length), q in found.items()
                  if length >= max(least_length, least_exponent * q))


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_text(rng):
    """Random words with stretches that repeat, also inside each other."""
    words = []
    for _ in range(rng.randint(1, 6)):
        base = [rng.choice("abcd") for _ in range(rng.randint(1, 9))]
        if rng.random() < 0.4:
            base = base[:2] * rng.randint(2, 6) + base
        words += base * rng.choice([1, 1, 2, 4, 5, 9]) + base[:rng.randint(0, len(base))]
        words += [rng.choice("abcdefg") for _ in range(rng.randint(0, 7))]
    return words


@pytest.mark.parametrize("least_length,least_exponent", [(6, 4), (2, 2), (5, 3), (20, 2)])
def test_runs_equal_brute_force(spark, least_length, least_exponent):
    rng = random.Random(least_length)
    texts = [periodic_text(rng) for _ in range(150)] + [["x"] * 300, ["a", "b"] * 40, list("abcab") * 30]
    rows = [(i, rng.choice([" ", "\t\n ", "  "]).join(t)) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in periodic.periodic_runs(
        spark.createDataFrame(rows, "doc_id bigint, text string"), least_length, least_exponent,
        slice_bytes=700).collect()}
    assert len(got) == len(rows)
    for i, words in enumerate(texts):
        want = brute_runs(words, least_length, least_exponent)
        assert [tuple(x) for x in got[i]["runs"]] == want, words
        assert got[i]["collapsed"] == collapsed(words, want)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n ", "c"), (None, "z " * 8, "d"), (5, "é " * 7, "e"),
            (5, "é " * 7, "e"), (6, long, "f"), (7, "A a A a A a", "g")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, runs string")
    got = sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"])
                  for r in periodic.periodic_runs(df).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    assert got == [(1, [], ""), (2, [], ""), (3, [], ""), (5, [(0, 7, 1)], "é"), (5, [(0, 7, 1)], "é"),
                   (6, [(0, 60_000, 977)], " ".join(f"w{i}" for i in range(977))),
                   (7, [], "A a A a A a"), (None, [(0, 8, 1)], "z")]
    assert periodic.periodic_runs(df.where("false")).count() == 0


def test_neighbours_of_the_suffix_array():
    rng = np.random.default_rng(1)
    words = np.concatenate([[100], rng.integers(0, 3, 400), [101], rng.integers(0, 2, 300), [102]])
    order = sorted(range(len(words)), key=lambda i: words[i:].tolist())

    def shared(i, j):
        n = 0
        while max(i, j) + n < len(words) and words[i + n] == words[j + n]:
            n += 1
        return n

    want = {(a, b, shared(a, b)) for a, b in zip(order, order[1:]) if shared(a, b) >= 5}
    assert set(zip(*(x.tolist() for x in periodic.suffix_neighbours(words, 5)))) == want


def test_query_equals_a_plain_reading_of_its_contract(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert got.keys() == docs.keys()
    planted = 0
    for doc, text in docs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc).encode())
        g = h // 10
        if n > 4000:
            continue  # too long for brute force
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            planted += 1
        runs = brute_runs(words, 6, 4)
        row = got[doc]
        assert row["n_runs"] == len(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        want = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == want
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert planted > 5
