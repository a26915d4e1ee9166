"""SimHash near-duplicates: tiled exact comparison of all fingerprints.

Distinct fingerprints are dealt into tiles by their population counts. A pair of
tiles is compared only if the counts allow a distance within the radius (the
distance of two fingerprints is at least the difference of their counts, also
when it is added up over parts of the word), with exclusive-or and bit counts on
numpy blocks. Each pair of tiles gives back a spanning forest of its links, not
all pairs, and the forests are joined into components.

``similar_groups`` takes such pairs as candidates only and links two texts if an exact
comparison of their shingle sets says so.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rivulet.llm.common import byte_views, settle, slices
from rivulet.llm.components import connected_components

FEW, FEW_MORE = 15, 18  # sets of so few shingles have rougher fingerprints: bits more to the radius

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
PARTS = 4  # 16 bits each, for 64-bit fingerprints
FIRST_WORDS = 5  # of unlike fingerprints these differ in 160 of 320 bits, give or take 9
CACHED = 1 << 17  # pairs at a time


def shingle_hashes(raw: bytes, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``words`` words, A-Z lower-cased, joined by one space."""
    found = WORD.findall(raw.lower())
    if not found:
        return np.empty(0, np.uint64)
    flat = b" ".join(found)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(flat, 42)], np.uint64)
    lens = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ends = np.cumsum(lens) - 1
    spans = zip((ends - lens + 1).tolist(), ends[words - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    return np.array([digest(flat[a:b], 42) for a, b in spans], np.uint64)


def lane(hashes: np.ndarray, number: int) -> np.ndarray:
    """Another 64 bits of each hash; lane 0 is the hash itself."""
    if not number:
        return hashes
    x = hashes + np.uint64(number * 0x9E3779B97F4A7C15 % 2 ** 64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(hashes: np.ndarray, lanes: int = 1) -> bytes:
    """A bit is 1 if set in over half of the hashes; big-endian, no hashes give zeros."""
    out = np.zeros(lanes, ">u8")
    for k in range(lanes if len(hashes) else 0):
        bits = np.unpackbits(lane(hashes, k).view(np.uint8), bitorder="little").reshape(-1, 64)
        counts = np.zeros(64, np.int64)
        for at in range(0, len(bits), 255):  # sums that fit a byte
            counts += np.add.reduce(bits[at:at + 255], axis=0, dtype=np.uint8)
        out[k] = np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0]
    return out.tobytes()


def fingerprints(docs: DataFrame, words: int = 3, lanes: int = 1, id_col: str = "doc_id",
                 text_col: str = "text", distinct: bool = False) -> DataFrame:
    """(doc_id, fp binary, shingles, hash): the SimHash of each whole text.

    ``shingles`` is the number of distinct shingles and ``hash`` stands for their set;
    with ``distinct`` the fingerprint is that of the set, too.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                prints, sizes, sets = [], [], []
                for raw in byte_views(part.column("text")):
                    hashes = shingle_hashes(raw, words)
                    found = np.unique(hashes)
                    prints.append(fingerprint(found if distinct else hashes, lanes))
                    sizes.append(len(found))
                    sets.append(xxhash.xxh3_128_digest(found.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(prints, pa.binary()), pa.array(sizes, pa.int64()),
                     pa.array(sets, pa.binary())], ["doc_id", "fp", "shingles", "hash"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id bigint, fp binary, shingles bigint, hash binary")


def forest(left: np.ndarray, right: np.ndarray | None, radius: int, block: int = 1 << 20
           ) -> list[tuple[int, int]]:
    """Links (i, j) within the radius that span all components of left and right.

    ``right`` None compares left with itself. Rows are words of 64 bits. Links
    whose ends are joined already are left out.
    """
    same = right is None
    other = left if same else right
    labels = np.arange(len(left) + (0 if same else len(other)))
    shift, links = (0 if same else len(left)), []
    step = max(1, block // max(1, len(other)))
    for at in range(0, len(left), step):
        rows = left[at:at + step]
        apart = np.zeros((len(rows), len(other)), np.uint16 if left.shape[1] > 3 else np.uint8)
        for k in range(left.shape[1]):
            apart += np.bitwise_count(rows[:, k, None] ^ other[None, :, k])
        near_i, near_j = np.nonzero(apart <= radius)
        edges = np.flatnonzero(np.diff(near_i, prepend=-1))
        for a, b in zip(edges, [*edges[1:], len(near_i)]):
            i, cols = at + int(near_i[a]), near_j[a:b]
            roots = labels[cols + shift]
            if (roots == labels[i]).all():
                continue
            fresh, first = np.unique(roots, return_index=True)
            links += [(i, int(cols[f])) for r, f in zip(fresh, first) if r != labels[i]]
            labels[np.isin(labels, fresh)] = labels[i]
    return links


def _coordinates(prints: np.ndarray, sizes: np.ndarray, lanes: int, radius: int,
                 size_ratio: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Tile coordinates as bytes of a bigint: population counts by part, or bands of them."""
    if lanes == 1:
        parts = np.bitwise_count(prints[:, 0, None] >> np.arange(0, 64, 16, dtype=np.uint64)
                                 & np.uint64(0xFFFF)).astype(np.int64)
    else:
        count = np.bitwise_count(prints).sum(axis=1, dtype=np.int64)
        band = count // (radius + 1)
        size = (np.floor(np.log(np.maximum(sizes, 1)) / -math.log(size_ratio)).astype(np.int64)
                if size_ratio else np.zeros(len(band), np.int64))
        parts = np.stack([band, size], axis=1)
    return parts


def _offsets(lanes: int, radius: int) -> list[tuple[int, ...]]:
    """Steps to the tiles that can hold a link; of two opposite steps only one."""
    if lanes == 1:
        steps = (s for s in itertools.product(range(-radius, radius + 1), repeat=PARTS)
                 if sum(map(abs, s)) <= radius)
    else:
        steps = itertools.product((-1, 0, 1), repeat=2)
    return [s for s in steps if s >= tuple([0] * len(s))]


def _code(parts) -> int | np.ndarray:
    """Coordinates as one number; 4096 is above any coordinate and its neighbours."""
    total = 0
    for x in parts:
        total = total * 4096 + x + 2048
    return total


def _tile_pairs(classes: DataFrame, radius: int, lanes: int, size_ratio: float | None,
                tile_rows: int) -> DataFrame:
    """(left, right): pairs of tiles of (fp, rep, shingles) rows that can hold a link.

    ``right`` is NULL where a tile is to be compared with itself.
    """
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = np.frombuffer(b"".join(batch.column("fp").to_pylist()), ">u8")
            words = words.astype(np.uint64).reshape(-1, lanes)
            parts = _coordinates(words, batch.column("shingles").to_numpy(), lanes, radius,
                                 size_ratio)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_code(parts.T), pa.int64()), batch.column("fp"), batch.column("rep"),
                 batch.column("shingles")], ["tile", "fp", "rep", "shingles"])

    placed = settle(classes.select("fp", "rep", "shingles").mapInArrow(
        place, "tile bigint, fp binary, rep bigint, shingles bigint"), "prints")
    # one row per tile: at most 17^4 population counts, or the few bands and sizes, so it may
    # be broadcast; a join by tile would bring all of a full tile to one task
    chunks = settle(placed.groupBy("tile").agg(
        F.ceil(F.count("*") / tile_rows).cast("int").alias("chunks")), "chunks")
    tiles = (placed.join(F.broadcast(chunks), "tile")
             .withColumn("chunk", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("chunks")).cast("int"))
             .groupBy("tile", "chunk").agg(F.collect_list(F.struct("fp", "rep", "shingles")).alias("rows")))
    tiles = settle(tiles, "tiles")
    base = _code([0] * len(_offsets(lanes, radius)[0]))
    steps = F.array(*[F.lit(_code(s) - base).cast("bigint") for s in _offsets(lanes, radius)])
    left = tiles.select(F.col("tile").alias("from_tile"), F.col("chunk").alias("from_chunk"),
                        F.col("rows").alias("left"), F.explode(steps).alias("step")).withColumn(
        "tile", F.col("from_tile") + F.col("step"))
    # each chunk of the other tile is a key of its own: a full tile's pairs go to many tasks
    wanted = left.join(F.broadcast(chunks), "tile").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).where(
        "step <> 0 OR from_chunk <= chunk")
    return wanted.join(tiles, ["tile", "chunk"]).select(
        "left", F.when((F.col("step") != 0) | (F.col("from_chunk") != F.col("chunk")),
                       F.col("rows")).alias("right"))


def _words_of(scalar: pa.Scalar, lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprints, representatives, shingle counts) of one side of a pair of tiles."""
    flat = scalar.values
    words = np.frombuffer(b"".join(flat.field("fp").to_pylist()), ">u8").astype(np.uint64)
    return (words.reshape(-1, lanes), flat.field("rep").to_numpy(zero_copy_only=False),
            flat.field("shingles").to_numpy(zero_copy_only=False))


def near_duplicate_links(prints: DataFrame, radius: int, lanes: int = 1,
                         size_ratio: float | None = None, tile_rows: int = 4096) -> DataFrame:
    """(a, b): links between the smallest documents of distinct fingerprints.

    The links span every component of fingerprints at ``radius`` or fewer differing
    bits. With ``size_ratio`` (for longer fingerprints) documents whose numbers of
    distinct shingles differ by more than that ratio are not compared; a fingerprint
    that documents of different sizes share stands in the tiles of each of them.
    """
    named = prints.where("doc_id IS NOT NULL")
    classes = named.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.min("shingles").alias("shingles"))
    if size_ratio:
        sizes = named.select("fp", "shingles").distinct()
        classes = classes.select("fp", "rep").join(sizes, "fp")
    pairs = _tile_pairs(classes, radius, lanes, size_ratio, tile_rows)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for i in range(batch.num_rows):
                x, x_rep, _ = _words_of(batch.column("left")[i], lanes)
                right = batch.column("right")[i]
                y, y_rep, _ = _words_of(right, lanes) if right.is_valid else (None, x_rep, None)
                for p, q in forest(x, y, radius):
                    a.append(int(x_rep[p]))
                    b.append(int(y_rep[q]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             ["a", "b"])

    return pairs.mapInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2, lanes: int = 1,
                    size_ratio: float | None = None, id_col: str = "doc_id",
                    text_col: str = "text", tile_rows: int = 4096) -> DataFrame:
    """doc_id, fp, component_id of each row; documents link at ``radius`` or fewer differing bits.

    ``component_id`` is the smallest doc_id reachable over links, the document's own
    included. ``lanes`` words of 64 bits make a fingerprint.

    Defined cases: a NULL text counts as empty; texts without a word have fingerprint
    zero and link like any other; a text of fewer words than a shingle is one shingle.
    Rows without doc_id get the component of their fingerprint (NULL if no row with an
    id has it), and link nothing. Repeated rows stay repeated. An empty table gives an
    empty table; other columns are ignored.
    """
    prints = settle(fingerprints(docs, words, lanes, id_col, text_col), "fingerprints")
    links = near_duplicate_links(prints, radius, lanes, size_ratio, tile_rows)
    groups = connected_components(links)
    reps = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    named = reps.join(groups, F.col("rep") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def _candidates(x: np.ndarray, x_size: np.ndarray, y: np.ndarray, y_size: np.ndarray, radius: int
                ) -> np.ndarray:
    """Which rows of x and y are near enough to be compared by their shingles.

    Most pairs are too far apart in their first words of 64 bits already; only the others
    are counted in full. Rows are taken in blocks that a core's cache holds.
    """
    near = np.empty((len(x), len(y)), bool)
    step = max(1, CACHED // max(1, len(y)))
    for at in range(0, len(x), step):
        rows, sizes = x[at:at + step], x_size[at:at + step]
        # bits modulo 256: more than that many look few, which the full count puts right
        apart = np.bitwise_count(rows[:, 0, None] ^ y[None, :, 0])
        for k in range(1, min(FIRST_WORDS, x.shape[1])):
            apart += np.bitwise_count(rows[:, k, None] ^ y[None, :, k])
        part = apart <= radius + FEW_MORE
        some = np.flatnonzero(part)
        if len(some) * 8 > part.size:  # alike texts: all pairs in full cost less than so many one by one
            bits = np.zeros(part.shape, np.uint16)
            for k in range(x.shape[1]):
                bits += np.bitwise_count(rows[:, k, None] ^ y[None, :, k])
            few = (sizes <= FEW)[:, None] & (y_size <= FEW)[None, :]
            part = bits <= np.where(few, np.uint16(radius + FEW_MORE), np.uint16(radius))
        else:
            i, j = np.divmod(some, len(y))
            bits = np.bitwise_count(rows[i] ^ y[j]).sum(axis=1, dtype=np.int64)
            few = (sizes[i] <= FEW) & (y_size[j] <= FEW)
            part[i, j] = bits <= np.where(few, radius + FEW_MORE, radius)
        near[at:at + step] = part
    return near


def _blocks(x: tuple, y: tuple | None, radius: int, most: int
            ) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """Rows of each side that have a candidate on the other, cut into blocks of bounded sets.

    Every candidate pair of the two sides is in one block; a second part of None means
    that the first is compared with itself.
    """
    def parts(member: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        some = np.flatnonzero(member)
        before = np.cumsum(sizes[some]) - sizes[some]
        return np.split(some, np.flatnonzero(np.diff(before // most)) + 1) if len(some) else []

    same = y is None
    (a, _, a_size), (b, _, b_size) = x, x if same else y
    near_a, near_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    step = max(1, (1 << 20) // max(1, len(b)))
    for at in range(0, len(a), step):
        near = _candidates(a[at:at + step], a_size[at:at + step], b, b_size, radius)
        if same:
            near[np.arange(len(near)), at + np.arange(len(near))] = False
        near_a[at:at + step] = near.any(axis=1)
        near_b |= near.any(axis=0)
    left = parts(near_a, a_size)
    right = left if same else parts(near_b, b_size)
    for i, p in enumerate(left):
        for j, q in enumerate(right):
            if same and j < i:
                continue
            if same and i == j:
                yield p, None
                continue
            near = _candidates(a[p], a_size[p], b[q], b_size[q], radius)
            if near.any():
                yield p[near.any(axis=1)], q[near.any(axis=0)]


def similar_forest(near: np.ndarray, left: list[np.ndarray], right: list[np.ndarray] | None,
                   similarity: float) -> list[tuple[int, int]]:
    """Links (i, j) that span what candidates of at least that Jaccard similarity connect.

    ``near`` marks the candidates; sets are arrays of distinct hashes; ``right`` None
    compares left with itself. Pairs whose ends are joined already are not compared.
    """
    same = right is None
    sets = left if same else [*left, *right]
    shift = 0 if same else len(left)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.cumsum(sizes) - sizes
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    mark, labels, links = np.zeros(len(values), bool), np.arange(len(sets)), []
    for i in range(len(left)):
        cols = np.flatnonzero(near[i, i + 1:]) + i + 1 if same else np.flatnonzero(near[i])
        cols = cols[(labels[cols + shift] != labels[i]) & (sizes[cols + shift] > 0)]
        if not len(cols) or not sizes[i]:
            continue
        other = cols + shift
        mine = flat[starts[i]:starts[i] + sizes[i]]
        mark[mine] = True
        held = mark[np.concatenate([flat[starts[j]:starts[j] + sizes[j]] for j in other])]
        mark[mine] = False
        both = np.add.reduceat(held.astype(np.int64), np.cumsum(sizes[other]) - sizes[other])
        alike = both >= similarity * (sizes[i] + sizes[other] - both) - 1e-9
        cols, roots = cols[alike], labels[other[alike]]
        fresh, first = np.unique(roots, return_index=True)
        links += [(i, int(c)) for c in cols[first]]
        labels[np.isin(labels, fresh)] = labels[i]
    return links


def shingle_sets(docs: DataFrame, words: int, id_col: str, text_col: str = "text") -> DataFrame:
    """(rep, shingles): the distinct shingle hashes of each text, 8 bytes each, in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [np.unique(shingle_hashes(raw, words)).tobytes()
                        for raw in byte_views(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array(sets, pa.binary())],
                                                 ["rep", "hashes"])

    return docs.select(F.col(id_col).cast("bigint").alias("rep"), F.col(text_col).alias("text")
                       ).mapInArrow(run, "rep bigint, hashes binary")


def similar_groups(docs: DataFrame, words: int, radius: int, lanes: int, similarity: float, id_col: str,
                   text_col: str = "text", tile_rows: int = 4096, block_shingles: int = 1 << 19
                   ) -> DataFrame:
    """(id, component_id) of each row; texts link at a Jaccard similarity of ``similarity`` or more.

    Shingle sets are compared exactly, for each pair whose fingerprints of ``lanes``
    words are within ``radius`` bits (and some more for the shortest texts). Ids must
    be whole numbers, one for each row. ``component_id`` is the smallest id reachable over links.

    Candidates come as blocks: the rows of two tiles that have one, with their sets, so
    that rows grow with the texts and not with the pairs of a family of texts. A side of a
    block holds about ``block_shingles`` shingles (8 bytes each) and one text more at worst.

    Defined cases: texts without a word are alike, and unlike any other; a text of fewer
    words than a shingle is one shingle. NULL counts as empty. Other columns are ignored.
    """
    prints = settle(fingerprints(docs, words, lanes, id_col, text_col, distinct=True), "fingerprints")
    # texts of one set are one class, so a class has one size
    classes = settle(prints.groupBy("hash").agg(
        F.min("doc_id").alias("rep"), F.first("fp").alias("fp"), F.first("shingles").alias("shingles")),
        "classes")
    pairs = _tile_pairs(classes, radius + FEW_MORE, lanes, similarity, tile_rows)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x, right = _words_of(batch.column("left")[i], lanes), batch.column("right")[i]
                y = _words_of(right, lanes) if right.is_valid else None
                for p, q in _blocks(x, y, radius, block_shingles):
                    one, two = x[1][p], y[1][q] if y else x[1][q if q is not None else []]
                    # blocks differ in the rows they start with or in the set of both sides
                    name = xxhash.xxh3_128_digest(one.tobytes() + b"|" + two.tobytes())
                    n = len(one) + len(two)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * n, pa.binary()), pa.array([False] * len(one) + [True] * len(two)),
                         pa.array(np.concatenate([one, two]), pa.int64())], ["block", "second", "rep"])

    members = settle(pairs.mapInArrow(gather, "block binary, second boolean, rep bigint"), "candidates")
    wanted = members.select("rep").distinct()
    texts = docs.select(F.col(id_col).cast("bigint").alias("rep"), F.col(text_col).alias("text")).join(
        wanted, "rep", "left_semi")
    sets = settle(shingle_sets(texts, words, "rep").join(
        classes.select("rep", "fp"), "rep"), "shingle_sets")

    def verify(block: pa.Table) -> pa.Table:
        block = block.sort_by([("second", "ascending"), ("rep", "ascending")])
        second = block.column("second").to_numpy()
        rep = block.column("rep").to_numpy()
        fp = np.frombuffer(b"".join(block.column("fp").to_pylist()), ">u8").astype(np.uint64)
        fp, n = fp.reshape(-1, lanes), int((~second).sum())
        found = [np.frombuffer(x, np.uint64) for x in block.column("hashes").to_pylist()]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        same = n == len(found)
        at = slice(None) if same else slice(n, None)
        near = _candidates(fp[:n], sizes[:n], fp[at], sizes[at], radius)
        links = similar_forest(near, found[:n], None if same else found[n:], similarity)
        other = rep[at]
        return pa.table({"a": pa.array([int(rep[i]) for i, _ in links], pa.int64()),
                         "b": pa.array([int(other[j]) for _, j in links], pa.int64())})

    links = members.join(sets, "rep").groupBy("block").applyInArrow(verify, "a bigint, b bigint")
    groups = connected_components(links)
    named = classes.join(groups, F.col("rep") == F.col("node"), "left").select(
        "hash", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, "hash").select(F.col("doc_id").alias(id_col), "component_id")
