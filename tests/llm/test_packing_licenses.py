"""Length buckets and license scans against brute force."""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict

import numpy as np
import pytest

from tokenizers import Tokenizer
import public_tokenizers

from rivulet.llm import licenses, packing, queries

SCHEMA = "doc_id bigint, text string, bucket string, piece string, template int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "b", "p", 1) for i, t in rows], SCHEMA)


def padding(counts, bounds):
    return sum(n * (min(b for b in bounds if b >= k) - k) for k, n in counts.items())


@pytest.mark.parametrize("seed", range(8))
def test_bounds_are_optimal(seed):
    rng = np.random.default_rng(seed)
    counts = Counter(rng.integers(1, 13, 40).tolist())
    table = np.zeros(20, np.int64)
    for k, n in counts.items():
        table[k] = n
    for buckets in (1, 2, 3, 20):
        bounds = packing.optimal_bounds(table, buckets)
        best = min(padding(counts, [*some, max(counts)]) for r in range(buckets)
                   for some in itertools.combinations(sorted(counts)[:-1], min(r, len(counts) - 1)))
        assert padding(counts, bounds) == best and len(bounds) <= buckets
    assert packing.optimal_bounds(np.zeros(5, np.int64), 3) == []


@pytest.mark.parametrize("rows_per_split", [50_000, 7])
def test_pack(spark, rows_per_split):
    rng = np.random.default_rng(1)
    rows = [(k, "w " * int(rng.integers(1, 70))) for k in range(200)]
    rows += [(7, "a b c")] * 30 + [(None, "a b"), (201, None), (202, ""), (203, " \n"), (204, "w " * 1000)]
    got = packing.pack(docs_of(spark, rows), max_len=64, buckets=5, budget=256,
                       rows_per_split=rows_per_split).collect()
    want = Counter()
    for i, t in rows:
        n = len((t or "").split())
        want.update((i, p, p * 64, min(64, n - p * 64)) for p in range(-(-n // 64)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["n_tokens"]) for r in got) == want
    batches = defaultdict(list)
    for r in got:
        assert r["padding"] == r["bucket"] - r["n_tokens"] >= 0
        batches[r["bucket"], r["batch"]].append(r["slot"])
    for bucket in {b for b, _ in batches}:
        numbers, room = sorted(n for b, n in batches if b == bucket), 256 // bucket
        assert numbers == list(range(len(numbers)))
        assert all(sorted(batches[bucket, n]) == list(range(room)) for n in numbers[:-1])
        assert len(batches[bucket, numbers[-1]]) <= room
    counts = Counter(r["n_tokens"] for r in got)
    table = np.zeros(65, np.int64)
    for k, n in counts.items():
        table[k] = n
    assert sum(r["padding"] for r in got) == padding(counts, packing.optimal_bounds(table, 5))


def test_pack_by_a_given_length(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1), (4, 0), (5, 5)], "doc_id bigint, n int")
    got = packing.pack(df, length=packing.F.col("n"), max_len=8, buckets=2, budget=4).collect()
    # a bucket longer than the budget holds one sequence a batch
    assert sorted((r["doc_id"], r["batch"], r["slot"]) for r in got) in (
        [(1, 0, 0), (5, 1, 0)], [(1, 1, 0), (5, 0, 0)])
    assert packing.pack(df.where("false"), length=packing.F.col("n")).count() == 0


def test_pack_by_tokens_cuts_unspaced_texts(spark):
    rows = [(1, "一二三四五六七八九十" * 400), (2, "x\xa0y\xa0" * 60), (3, "antidisestablishmentarianism " * 20),
            (4, None), (5, " "), (6, "short"), (None, "no id")]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = packing.pack_tokens(docs_of(spark, rows), queries.vocabulary(), max_len=64, buckets=4, budget=256).collect()
    want = Counter()
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert i != 1 or n > 64
        want.update((i, p, p * 64, min(64, n - p * 64)) for p in range(-(-n // 64)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["n_tokens"]) for r in got) == want
    batches = Counter()
    for r in got:
        batches[r["bucket"], r["batch"]] += r["bucket"]
    assert max(batches.values()) <= 256


def plain_scan(texts, templates, containment, slack=licenses.SLACK):
    """Documents and templates of which any stretch of the allowed length holds enough."""
    def grams(text):
        words = licenses.WORD.findall(text.lower())
        return [tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))] if words else []

    found = set()
    for i, t in texts:
        mine = grams(t or "")
        for name, template in templates.items():
            want = set(grams(template))
            n = int(len(grams(template)) * (1 + slack))
            for k in range(max(1, len(mine) - n + 1)):
                if want and len(want & set(mine[k:k + n])) >= containment * len(want):
                    found.add((i, name))
    return found


def test_scan(spark):
    rng = np.random.default_rng(8)
    filler = lambda n: " ".join("".join(rng.choice(list("abcdef"), 4)) for _ in range(n))
    rows = [(1, None), (2, ""), (3, "..."), (4, filler(3000)), (None, "Released under the MIT License.")]
    for k, (name, text) in enumerate(licenses.TEMPLATES.items()):
        for v in range(6):
            words = text.upper().split() if v == 1 else text.split()
            if v == 2 and len(words) > 30:
                words[len(words) // 2] = "other"  # still above the wanted share
            if v == 3:
                words = words[:len(words) // 2]
            rows.append((100 * k + v + 10, " ".join([filler(v * 13), *words, filler(40 - v)])))
    rows.append((5000, filler(30) + " Released under the\nMIT   License, " + filler(9) + " released under the mit license"))
    got = licenses.scan_licenses(docs_of(spark, rows)).collect()
    assert {(r["doc_id"], r["template"]) for r in got} == plain_scan(rows, licenses.TEMPLATES, 0.8)
    texts = dict(rows)
    own = [texts[5000][r["start"]:r["end"]] for r in sorted(got, key=lambda r: r["start"]) if r["doc_id"] == 5000]
    assert own == ["Released under the\nMIT   License", "released under the mit license"]


def test_scan_finds_notices_with_words_inserted_at_every_offset(spark):
    rng = np.random.default_rng(9)
    filler = lambda n: ["".join(rng.choice(list("abcdef"), 4)) for _ in range(n)]
    notice = licenses.TEMPLATES["MIT-permission"].split()
    rows, spread = [], {}
    for inserted in (0, 10, 15, 20, 60):
        for offset in range(24):
            at = len(notice) // 2
            i = 100 * inserted + offset
            spread[i] = inserted
            rows.append((i, " ".join([*filler(offset), *notice[:at], *filler(inserted), *notice[at:], *filler(90)])))
    for templates in (None, spark.createDataFrame(
            [*licenses.TEMPLATES.items(), (None, "x"), ("x", None)], "template string, text string")):
        got = licenses.scan_licenses(docs_of(spark, rows), templates).collect()
        assert {(r["doc_id"], r["template"]) for r in got} == plain_scan(rows, licenses.TEMPLATES, 0.8)
        mine = {r["doc_id"] for r in got if r["template"] == "MIT-permission"}
        assert mine == {i for i, n in spread.items() if n <= 20}
    strict = licenses.scan_licenses(docs_of(spark, rows), slack=0.0).collect()
    assert {(r["doc_id"], r["template"]) for r in strict} == plain_scan(rows, licenses.TEMPLATES, 0.8, 0.0)


def test_templates_of_a_table(spark):
    whole = " ".join(f"clause {i} of this long license says {i * i} things" for i in range(400))
    table = spark.createDataFrame([("L", whole), ("L", whole[::-1]), ("L", whole), ("S", "one short line of five words")],
                                  "template string, text string")
    known = licenses.templates_of(table)
    assert set(known) == {"L", "L#2", "S"} and whole in (known["L"], known["L#2"])
    cut = whole.split()
    cut = " ".join(cut[:1500] + ["something", "else"] * 20 + cut[1700:])
    got = licenses.scan_licenses(docs_of(spark, [(1, "intro " * 50 + whole), (2, cut), (3, whole[:len(whole) // 2])]),
                                 table).collect()
    assert {r["doc_id"] for r in got} == {1, 2} and len(got) == 2
    with pytest.raises(ValueError):
        licenses.templates_of(table, most_chars=100)


def test_scan_odd_cases(spark):
    rows = [(1, "short one"), (1, "short one"), (2, "a " * 50_000 + "short one")]
    got = licenses.scan_licenses(docs_of(spark, rows), {"tiny": "Short, one!", "empty": "..."}).collect()
    # a text of fewer words than a shingle is one shingle, so only whole texts can match it
    assert sorted((r["doc_id"], r["template"], r["containment"]) for r in got) == [(1, "tiny", 1.0)] * 2
    assert licenses.scan_licenses(docs_of(spark, rows), {}).count() == 0
    assert licenses.scan_licenses(docs_of(spark, [])).count() == 0


def test_bands_collide_with_the_wanted_probability():
    for similarity in (0.3, 0.5, 0.8):
        bands = licenses.bands_for(similarity, 0.999)
        assert 1 - (1 - similarity ** licenses.ROWS) ** bands >= 0.999
        assert 1 - (1 - similarity ** licenses.ROWS) ** (bands - 1) < 0.999
