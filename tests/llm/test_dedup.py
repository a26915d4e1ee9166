"""Near duplicates and repeated passages against brute force."""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from rivulet.llm import simhash, suffix_dedup
from rivulet.llm.components import connected_components

SCHEMA = "doc_id bigint, text string, lang string, fp string, component_id int, doc string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "f", 1, "d") for i, t in rows], SCHEMA)


def words(n, seed):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list("abcdefgh"), rng.integers(1, 7))) for _ in range(n)]


def plain_fingerprint(text, k=3):
    found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(
        bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))))
    grams = [b" ".join(found[i:i + k]) for i in range(max(1, len(found) - k + 1))] if found else []
    value = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64(g, seed=42).intdigest() >> bit & 1 for g in grams)
        value |= (ones * 2 > len(grams)) << bit
    return value


def plain_groups(prints, radius):
    """Smallest id reachable, by plain search over all pairs."""
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in itertools.combinations(sorted(prints.items()), 2):
        if (a ^ b).bit_count() <= radius:
            x, y = sorted((root(i), root(j)))
            parent[y] = x
    return {i: root(i) for i in prints}


@pytest.fixture(scope="module")
def texts():
    base = words(60, 1)
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one"), (4, "ONE"), (5, "two words")]
    for k in range(40):  # near copies of one text, in a chain
        some = list(base)
        some[k] = f"x{k}"
        rows.append((10 + k, " ".join(some)))
    rows += [(60 + k, " ".join(words(30, 100 + k))) for k in range(40)]
    rows += [(200 + k, " ".join(base)) for k in range(50)]  # exact copies
    rows.append((300, "é Ä ß É " * 3))
    rows.append((301, " ".join(words(20_000, 9))))
    return rows


@pytest.mark.parametrize("radius,tile_rows", [(2, 4096), (2, 3), (4, 5)])
def test_near_duplicates(spark, texts, radius, tile_rows):
    got = {r["doc_id"]: (bytes(r["fp"]).hex(), r["component_id"]) for r in simhash.near_duplicates(
        docs_of(spark, texts), radius=radius, tile_rows=tile_rows).collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts}
    groups = plain_groups(prints, radius)
    assert got == {i: (f"{prints[i]:016x}", groups[i]) for i in prints}


def test_near_duplicates_odd_ids(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (3, "a b c d"), (None, "q w e r t y u i o p")]
    got = sorted(((r["doc_id"] or -1, r["component_id"]) for r in simhash.near_duplicates(
        docs_of(spark, rows)).collect()), key=str)
    assert got == sorted([(5, 3), (5, 3), (-1, 3), (3, 3), (-1, None)], key=str)
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_long_fingerprints_find_similar_texts(spark):
    rows, pairs = [], 40
    for k in range(pairs):
        some = words(200, 1000 + k)
        rows.append((2 * k, " ".join(some)))
        for at in (30, 150):  # two words changed: similarity about 0.9
            some[at] = "changed"
        rows.append((2 * k + 1, " ".join(some)))
    found = simhash.near_duplicates(docs_of(spark, rows), words=5, radius=90, lanes=8, size_ratio=0.8)
    got = {r["doc_id"]: r["component_id"] for r in found.collect()}
    assert all(got[2 * k] == 2 * k for k in range(pairs))
    assert sum(got[2 * k + 1] == 2 * k for k in range(pairs)) >= pairs - 1


def plain_set(text, k=5):
    found = (text or "").lower().split()
    return {tuple(found[i:i + k]) for i in range(max(1, len(found) - k + 1))} if found else set()


def similar_by_sets(rows, similarity):
    """Smallest id reachable over pairs of exact Jaccard similarity."""
    sets = {i: plain_set(t) for i, t in rows}
    group = {i: i for i in sets}
    for i, j in itertools.combinations(sorted(sets), 2):
        both = len(sets[i] & sets[j])
        if sets[i] == sets[j] or both and both >= similarity * (len(sets[i] | sets[j])) - 1e-9:
            a, b = sorted((group[i], group[j]))
            group = {k: a if g == b else g for k, g in group.items()}
    return group


def similar(spark, rows, **options):
    found = simhash.similar_groups(docs_of(spark, rows), words=5, radius=112, lanes=8, similarity=0.8,
                                   id_col="doc_id", **options)
    return {r["doc_id"]: r["component_id"] for r in found.collect()}


def apart(base, similarity, seed):
    """A text whose shingle set has about that similarity: its end is other words."""
    keep = round((len(base) - 4) * 2 * similarity / (1 + similarity)) + 4
    return base[:keep] + words(len(base) - keep, seed)


@pytest.mark.parametrize("options", [{}, {"tile_rows": 7, "block_shingles": 1000}])
def test_similar_groups_link_by_exact_similarity(spark, options):
    rows, n = [(0, None), (1, ""), (2, "one two"), (3, "One  two"), (4, "a b c d e f g h"), (5, "a b c d e f g h i")], 10
    for k in range(12):
        for share in (0.7, 0.75, 0.805, 0.9):
            base = words(304, 5000 + 10 * k)
            base = [f"{w}{k}.{round(100 * share)}" for w in base]
            rows += [(n, " ".join(base)), (n + 1, " ".join(apart(base, share, n)))]
            n += 2
    template = words(304, 77)  # a family of texts at 0.65 to 0.7
    rows += [(n + k, " ".join(apart(template, 0.68, 9000 + k))) for k in range(40)]
    want = similar_by_sets(rows, 0.8)
    assert similar(spark, rows, **options) == want
    assert sum(want[i] != i for i in want) == 27 and all(want[i] == i for i in range(n, n + 40))


def test_repeated_passages_do_not_hide_near_copies(spark):
    base, other = words(200, 61), words(200, 62)
    rows = [(0, " ".join(base)), (1, " ".join(base * 2)), (2, " ".join(base[:180] + ["new"] + base[181:])),
            (3, " ".join(other)), (4, " ".join(other[:100] * 3 + other))]
    want = similar_by_sets(rows, 0.8)
    assert want == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3}
    assert similar(spark, rows) == want


def test_a_fingerprint_of_two_sizes_is_in_the_tiles_of_both(spark):
    fp = bytes(64)
    prints = spark.createDataFrame([(1, fp, 10), (2, fp, 100), (3, bytes(63) + b"\1", 100)],
                                   "doc_id bigint, fp binary, shingles bigint")
    links = simhash.near_duplicate_links(prints, radius=90, lanes=8, size_ratio=0.8)
    assert {(r["a"], r["b"]) for r in links.collect()} & {(1, 3), (3, 1)}


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(300)] + [(7, 7)]
    df = spark.createDataFrame(links + [(None, 3)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100} | {200 + i: 100 for i in range(300)}
    assert connected_components(df.where("false")).count() == 0


def plain_removal(rows, match):
    """Bytes under a string that starts in a smaller document, string by string."""
    least = {}
    for i, t in rows:
        b = (t or "").encode()
        key = float("inf") if i is None else i
        for p in range(len(b) - match + 1):
            least[b[p:p + match]] = min(key, least.get(b[p:p + match], key))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        key = float("inf") if i is None else i
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - match + 1):
            if least[b[p:p + match]] < key:
                gone[p:p + match] = True
        spans = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]]))).reshape(-1, 2)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), [tuple(s) for s in spans.tolist()], kept))
    return out


def removal(df, **options):
    return [(r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"]))
            for r in suffix_dedup.remove_repeats(df, **options).collect()]


def in_order(rows):
    return sorted(rows, key=repr)


def passages():
    rng = np.random.default_rng(5)
    shared = ["".join(rng.choice(list("abcdé "), n)) for n in (49, 50, 51, 64, 90, 200, 400)]
    rows = [(0, None), (1, ""), (2, "x" * 30), (3, "y" * 500), (4, "y" * 120), (None, "y" * 60)]
    for k in range(60):
        parts = ["".join(rng.choice(list("fghij "), rng.integers(0, 80)))
                 for _ in range(rng.integers(1, 4))]
        for at, s in enumerate(rng.choice(shared, rng.integers(0, 4))):
            cut = rng.integers(0, 30)
            parts.insert(at, s[cut:] if rng.random() < 0.5 else s[:len(s) - cut])
        rows.append((int(rng.integers(5, 40)) if k < 20 else 40 + k, "".join(parts)))
    return rows + rows[10:14] + [(None, shared[5])]


def test_remove_repeats(spark):
    rows = passages()
    assert in_order(removal(docs_of(spark, rows), shard_bytes=2000)) == in_order(plain_removal(rows, 50))


def test_remove_repeats_in_segments_and_batches(spark, monkeypatch):
    rng = np.random.default_rng(6)
    long = "".join(rng.choice(list("abcdefgh"), 3000))
    rows = [(1, long), (2, long[700:1300] + "-" + long[100:160]), (3, "#" + long + "#"), (4, long[5:55])]
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 512)
    monkeypatch.setattr(suffix_dedup, "MOST", 100)
    batches = [pa.RecordBatch.from_pydict({"doc": [i], "hash": [0], "text": [t]}) for i, t in rows]
    found = list(suffix_dedup._index_texts(50, 3)(iter(batches)))
    assert len(found) > 3
    table = pa.Table.from_batches(found)
    outs = [suffix_dedup._family_of_shard(True)(table.filter(pa.compute.equal(table["shard"], s)))
            for s in set(table["shard"].to_pylist())]
    covered, edges = {}, {}
    for out in outs:
        for doc, h, edge, blob in zip(*[out.column(c).to_pylist() for c in ("doc", "hash", "edge", "ranges")]):
            (edges if edge else covered).setdefault(doc, []).append(blob)
    batch = pa.RecordBatch.from_pydict({
        "doc": list(edges), "hash": [0] * len(edges), "text": [dict(rows)[d] for d in edges],
        "ranges": list(edges.values())}, pa.schema([("doc", pa.int64()), ("hash", pa.int64()),
                                                    ("text", pa.string()), ("ranges", pa.list_(pa.binary()))]))
    table = pa.Table.from_batches(list(suffix_dedup._index_edges(50, 1)(iter([batch]))))
    out = suffix_dedup._family_of_shard(False)(table)
    for doc, blob in zip(out.column("doc").to_pylist(), out.column("ranges").to_pylist()):
        covered.setdefault(doc, []).append(blob)
    want = {i: spans for i, _, spans, _ in plain_removal(rows, 50)}
    got = {i: suffix_dedup.removed_spans(*suffix_dedup._ranges(covered.get(i, [])), 50) for i, _ in rows}
    assert got == want


def test_remove_repeats_of_nothing(spark):
    assert suffix_dedup.remove_repeats(docs_of(spark, [])).count() == 0
    rows = [(1, None), (2, "")]
    assert in_order(removal(docs_of(spark, rows))) == in_order(plain_removal(rows, 50))


def test_remove_repeats_carries_columns(spark):
    df = docs_of(spark, [(1, "a" * 60), (2, "b" + "a" * 60)])
    found = suffix_dedup.remove_repeats(df, carry=("lang", "doc", "fp"))
    assert found.columns == ["doc_id", "n_bytes", "spans", "kept", "lang", "doc", "fp"]
    assert {(r["doc_id"], bytes(r["kept"]), r["doc"]) for r in found.collect()} == {
        (1, b"a" * 60, "d"), (2, b"b", "d")}


def test_small_arrays_of_a_shard_are_joined_before_the_family(monkeypatch):
    """A shard's scans follow its suffixes and not the number of batches they come in."""
    rng, blobs = np.random.default_rng(3), []
    by_key = {}
    for b in range(300):
        table = suffix_dedup.Table(np.sort(rng.choice(5000, 30, replace=False)), np.zeros(30, np.int64))
        part = suffix_dedup.Suffixes(
            rng.integers(0, 1500, 40).astype(np.uint64) << np.uint64(24), np.zeros(40, np.uint32),
            rng.integers(0, 30, 40).astype(np.uint32), rng.integers(0, 999, 40).astype(np.uint32) * 2,
            np.zeros(40, np.uint8)).ordered()
        for k, d, low in zip(part.key, table.ids[part.doc], part.low):
            by_key.setdefault(int(k), []).append((int(d), int(low)))
        own = table.ids[part.doc[part.heads()]] >= table.ids[part.doc]
        blobs.append((int(table.ids[0]), suffix_dedup.pack(part.take(own), part.take(~own), table)))
    group = pa.table({"shard": pa.array([0] * 300, pa.int32()), "first_doc": pa.array([f for f, _ in blobs], pa.int64()),
                      "suffixes": pa.array([b for _, b in blobs], pa.binary())})
    sizes, add = [], suffix_dedup.LevelFamily.add
    monkeypatch.setattr(suffix_dedup, "JOINED", 2000, raising=False)
    monkeypatch.setattr(suffix_dedup.LevelFamily, "add", lambda self, run: sizes.append(len(run)) or add(self, run))
    out = suffix_dedup._family_of_shard(False)(group)
    assert len(sizes) <= 300 * 40 // 2000 + 1
    want = {(d, low) for rows in by_key.values() for d, low in rows if d > min(rows)[0]}
    got = set()
    for doc, blob in zip(out.column("doc").to_pylist(), out.column("ranges").to_pylist()):
        for low, more in zip(*suffix_dedup._ranges([blob])):
            got |= {(doc, w) for w in range(low, low + more + 1)}
    assert got == want


def test_candidates_are_those_within_the_radius():
    rng = np.random.default_rng(8)
    for words, flip in ((1, 0.5), (5, 0.5), (8, 0.5), (8, 0.1), (8, 0.12)):
        centre = rng.integers(0, 2, (1, 64 * words))
        x, y = (np.packbits(centre ^ (rng.random((n, 64 * words)) < flip), axis=1).view(np.uint64) for n in (70, 90))
        y[:5], y[5:9] = x[:5], ~x[:4]
        x_size, y_size = rng.integers(1, 40, 70), rng.integers(1, 40, 90)
        apart = np.bitwise_count(x[:, None] ^ y[None]).sum(axis=2, dtype=int)
        few = (x_size <= simhash.FEW)[:, None] & (y_size <= simhash.FEW)
        radius = 14 * words
        assert (simhash._candidates(x, x_size, y, y_size, radius) == (apart <= radius + few * simhash.FEW_MORE)).all()


def test_level_family_merges_geometrically():
    family = suffix_dedup.LevelFamily(np.arange(1000))
    rng = np.random.default_rng(1)
    for k in range(64):
        n = 20
        family.add(suffix_dedup.Suffixes(
            rng.integers(0, 1 << 60, n).astype(np.uint64), np.zeros(n, np.uint32),
            np.full(n, k, np.uint32), np.arange(n, dtype=np.uint32), np.zeros(n, np.uint8)).ordered())
    sizes = [len(x) for x in family.levels]
    assert sum(sizes) == 64 * 20 and len(sizes) <= 7 and sizes == sorted(sizes, reverse=True)
