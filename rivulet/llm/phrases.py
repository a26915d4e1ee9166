"""Phrase collocations from count streams in prefix and suffix order.

Counting. Phrases of one order after another are counted. A phrase can only reach the
least count if its parts do, so words that take part in no frequent word (later: pair)
are passed over; which are frequent is asked of a bit table of bounded size, where a
wrong "yes" costs a row and changes nothing. Counts are added up in each task first.

Streams. The frequent phrases of all orders form one stream. In prefix order each phrase
comes right after its own beginnings and right before its continuations, so one pass
with a stack as deep as the longest phrase gives it the counts of all its first parts and
the largest count among its continuations. Then the stream is put in suffix order
(words from last to first) and the same pass gives the counts of its last parts and of
what precedes it. No count is looked up by a hash.

Ranges. The order is cut into ranges at sampled phrases. A phrase whose continuations
lie in several ranges is sent to each of them, so a word that begins a third of all
phrases is no hot key.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rivulet.llm.common import byte_views, settle, share_file, shared_path, slices

BREAKS = b".,;:!?\n\x0b\x0c\r"
PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + BREAKS,
                        b"abcdefghijklmnopqrstuvwxyz " + b"." * len(BREAKS))
GLUE = "\n"  # no word holds one
MOST_BITS = 28  # of the bit table: 32 MB
BLOCK_BITS = 15
SAMPLE_EACH = 32  # sampled phrases for each range
MOST_RANGES = 4096
U = np.uint64


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a phrase and one more word."""
    out = left * U(0xD6E8FEB86659FD93) + right
    out ^= out >> U(32)
    return out * U(0xFF51AFD7ED558CCD)


def _word_hashes(lang: str, words: list[bytes]) -> list[int]:
    salt = xxhash.xxh64_intdigest(lang.encode())
    return [xxhash.xxh64_intdigest(w, salt) for w in words]


class Table:
    """Bits of frequent phrases by hash, read from the executor's copy of a shared file."""

    def __init__(self, name: str, bits: int):
        self.data, self.shift = np.memmap(shared_path(name), np.uint8, "r"), U(64 - bits)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.data[(at >> U(3)).astype(np.int64)] >> (at & U(7)).astype(np.uint8)) & 1 == 1


def _bit_table(spark: SparkSession, phrases: DataFrame) -> tuple[str, int]:
    """Mark the hash of each (lang, phrase), all of one order; the file's name and the bits of an address."""
    count = phrases.count()
    bits = max(BLOCK_BITS, min(MOST_BITS, (16 * count).bit_length()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            words = np.array([_word_hashes(lang, phrase.encode().split(b"\n")) for lang, phrase in zip(
                batch.column("lang").to_pylist(), batch.column("phrase").to_pylist())], np.uint64)
            whole = words[:, 0]
            for k in range(1, words.shape[1]):
                whole = _mixed(whole, words[:, k])
            found = np.unique(whole >> U(64 - bits)).astype(np.int64)
            for block in np.unique(found >> BLOCK_BITS).tolist():
                inside = found[found >> BLOCK_BITS == block] & ((1 << BLOCK_BITS) - 1)
                held = blocks.setdefault(block, np.zeros(1 << BLOCK_BITS >> 3, np.uint8))
                np.bitwise_or.at(held, inside >> 3, (1 << (inside & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(blocks), pa.int32()), pa.array([b.tobytes() for b in blocks.values()], pa.binary())],
            ["block", "bits"])

    def together(group: pa.Table) -> pa.Table:
        held = np.zeros(1 << BLOCK_BITS >> 3, np.uint8)
        for x in group.column("bits").to_pylist():
            held |= np.frombuffer(x, np.uint8)
        return pa.table({"block": group.column("block").slice(0, 1),
                         "bits": pa.array([held.tobytes()], pa.binary())})

    kind = "block int, bits binary"
    data = bytearray(1 << bits >> 3)
    width = 1 << BLOCK_BITS >> 3
    # 2^MOST_BITS bits at most, whatever the corpus
    for r in phrases.mapInArrow(mark, kind).groupBy("block").applyInArrow(together, kind).toLocalIterator():
        data[r["block"] * width:(r["block"] + 1) * width] = r["bits"]
    return share_file(spark, bytes(data), "phrases"), bits


def _count_orders(orders: tuple[int, ...], table: tuple[str, int] | None):
    """Texts to (lang, phrase, n) of the given orders; a NULL phrase counts all words.

    ``table`` holds the frequent phrases of the order below the first one; a phrase is
    passed over if a part of that length is not in it.
    """
    def counted(lang: str, raws: list[bytes], frequent: Table | None) -> Iterator[pa.RecordBatch]:
        text = b".".join(raws).decode("utf-8", "replace").encode()
        tokens = text.translate(PLAIN).replace(b".", b" . ").split()
        number = {w: i for i, w in enumerate(dict.fromkeys([b".", *tokens]))}
        ids = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
        words = pa.array([w.decode() for w in number], pa.string())
        part = orders[0] - 1
        if not part:
            n = np.bincount(ids[ids != 0], minlength=len(words))
            some = np.flatnonzero(n)
            yield rows(lang, [None], np.array([n.sum()]))
            yield rows(lang, words.take(pa.array(some)), n[some])
            return
        # by first position: all words of a part stand in one piece, and it is frequent
        hashes = np.array(_word_hashes(lang, list(number)), np.uint64)[ids]
        whole, good = hashes, ids != 0
        for k in range(1, part):
            whole = _mixed(whole[:len(ids) - k], hashes[k:])
            good = good[:len(ids) - k] & (ids[k:] != 0)
        good = good & frequent.holds(whole)
        for order in orders:
            here = np.ones(max(0, len(ids) - order + 1), bool)
            for k in range(order - part + 1):
                here &= good[k:k + len(here)]
            at = np.flatnonzero(here)
            if not len(at):
                return
            code = ids[at]
            for k in range(1, order):
                if k > 1:  # as small numbers again
                    _, code = np.unique(code, return_inverse=True)
                code = code * len(words) + ids[at + k]
            _, first, n = np.unique(code, return_index=True, return_counts=True)
            picked = [words.take(pa.array(ids[at[first] + k])) for k in range(order)]
            yield rows(lang, pc.binary_join_element_wise(*picked, GLUE), n)

    def rows(lang: str, phrases, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(n), pa.string()), pa.array(phrases, pa.string()),
             pa.array(n, pa.int64())], ["lang", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Table(*table) if table else None
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                by_lang: dict[str, list[bytes]] = {}
                for lang, raw in zip(part.column("lang").to_pylist(), byte_views(part.column("text"))):
                    by_lang.setdefault(lang, []).append(raw)
                for lang, raws in by_lang.items():
                    yield from counted(lang, raws, frequent)

    return run


def phrase_counts(texts: DataFrame, least: int, longest: int) -> DataFrame:
    """(lang, phrase, n) of all phrases of up to ``longest`` words with at least ``least`` occurrences.

    The words of a phrase are joined by line feeds. A row of each language has the phrase
    NULL and the number of all words. ``texts`` has lang and text, neither NULL.
    """
    spark, found, table = texts.sparkSession, [], None
    steps = [(1,), (2,), tuple(range(3, longest + 1))]
    for orders in [s for s in steps if s and s[0] <= longest]:
        counts = texts.mapInArrow(_count_orders(orders, table), "lang string, phrase string, n bigint")
        counts = settle(counts.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(
            (F.col("n") >= least) | F.col("phrase").isNull()), "phrases")
        found.append(counts)
        if orders[-1] < longest:
            table = _bit_table(spark, counts.where("phrase IS NOT NULL"))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _ranges(rows: DataFrame, rows_per_range: int) -> list[tuple]:
    """Phrases at which the order is cut: a bounded sample, which settles no result."""
    count = rows.count()
    ranges = min(MOST_RANGES, -(-count // rows_per_range))
    if ranges < 2:
        return []
    every = max(1, count // (ranges * SAMPLE_EACH))
    drawn = sorted((r["lang"], *r["words"]) for r in rows.where(
        F.pmod(F.xxhash64("lang", "words"), F.lit(every)) == 0).select("lang", "words").limit(
        4 * ranges * SAMPLE_EACH).collect())
    return sorted({drawn[len(drawn) * k // ranges] for k in range(1, ranges)}) if drawn else []


def _placed(rows: DataFrame, cuts: list[tuple]) -> DataFrame:
    """The rows with the number of their range; phrases that reach into later ranges go there, too."""
    short: dict[int, list[tuple]] = {}

    def last_range(key: tuple) -> int:
        """The range of the last phrase that begins with this one."""
        if len(key) not in short:
            short[len(key)] = [c[:len(key)] for c in cuts]
        return bisect_right(short[len(key)], key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [(lang, *words) for lang, words in zip(batch.column("lang").to_pylist(),
                                                          batch.column("words").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(range(bisect_right(cuts, k), last_range(k) + 1)) for k in keys],
                          pa.list_(pa.int32())), *batch.columns],
                ["ranges", *batch.schema.names])

    names = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    return rows.mapInArrow(run, f"ranges array<int>, {names}").select(
        F.explode("ranges").alias("range"), *rows.columns)


def _stacked(payload: str):
    """Sorted (range, lang, words, n, ...) rows with the counts of their first parts and continuations."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[list] = []  # phrases that the present one begins with
        here = None
        for batch in batches:
            out: list[list] = []
            extra = batch.column(payload).to_pylist()
            far = batch.column("other").to_pylist()
            for place, lang, words, n, more, other in zip(
                    batch.column("range").to_pylist(), batch.column("lang").to_pylist(),
                    batch.column("words").to_pylist(), batch.column("n").to_pylist(), extra, far):
                if here != (place, lang):
                    out += open_
                    open_, here = [], (place, lang)
                while open_ and open_[-1][1] != words[:len(open_[-1][1])]:
                    out.append(open_.pop())
                if open_ and len(open_[-1][1]) == len(words):  # a copy from another range
                    open_[-1][6] = max(open_[-1][6], other)
                    continue
                parts = [p[2] for p in open_]
                if parts and len(parts) == len(words) - 1:
                    open_[-1][4] = max(open_[-1][4], n)
                open_.append([lang, words, n, parts, 0, more, other])
            yield rows(out)
        yield rows(open_)

    def rows(out: list[list]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()), pa.int64(),
                 pa.list_(pa.int64()), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)],
            ["lang", "words", "n", "parts", "longer", payload, "other"])

    return run


def _merged(rows: DataFrame, payload: str, rows_per_range: int) -> DataFrame:
    """One pass over the rows in the order of ``words``: counts of first parts, largest continuation."""
    cuts = _ranges(rows, rows_per_range)
    sorted_rows = _placed(rows, cuts).repartitionById(len(cuts) + 1, F.col("range")).sortWithinPartitions(
        "range", "lang", "words")
    return sorted_rows.mapInArrow(
        _stacked(payload), "lang string, words array<string>, n bigint, parts array<bigint>, "
                           f"longer bigint, {payload} array<bigint>, other bigint")


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, contain: tuple[int, int] = (80, 100),
                 top: int | None = 2000, lang_col: str = "lang", text_col: str = "text",
                 rows_per_range: int = 50_000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases.

    Texts are cut into pieces at `. , ; : ! ?` and line breaks, pieces into words at blanks and
    tabs; A-Z are lower-cased. Phrases have 2 to ``longest`` words and at least ``least``
    occurrences (a). Of the cuts of a phrase in two, with counts l and r, the one with the
    smallest score floor(2000000 a / (l + r)) counts, the first of equal ones. Phrases go that
    stand in a longer one with at least ``contain`` of their occurrences. Ranks are by
    score, then a (both descending), then phrase; ``top`` None returns all. n is the number of
    words of the language. Scores are computed in decimals of 38 digits.

    Defined cases: a NULL language is ``und``; NULL and empty texts have no words. Repeated rows
    count as often as they stand there; other columns are ignored. Texts are never cut. Bytes
    that are no UTF-8 count as U+FFFD.
    """
    if longest < 2:
        raise ValueError("phrases have two words at least")
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.col(text_col).alias("text")).where("text IS NOT NULL")
    counts = phrase_counts(texts, least, longest)
    stream = counts.where("phrase IS NOT NULL").select("lang", F.split("phrase", GLUE).alias("words"), "n")
    none = F.array().cast("array<bigint>")
    forward = _merged(stream.select("*", none.alias("lefts"), F.lit(0).cast("bigint").alias("other")),
                      "lefts", rows_per_range)
    # what the pass found goes along into suffix order
    forward = settle(forward.select("lang", F.reverse("words").alias("words"), "n",
                                    F.col("parts").alias("lefts"), F.col("longer").alias("other")),
                     "prefix_order")
    backward = _merged(forward, "lefts", rows_per_range).where(F.size("words") > 1).select(
        "lang", F.array_join(F.reverse("words"), " ").alias("phrase"), F.col("n").alias("a"), "lefts",
        F.col("parts").alias("rights"), F.greatest("longer", "other").alias("longer"))
    # a phrase that was in several ranges has as many rows, each with a part of its continuations
    whole = backward.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("lefts").alias("lefts"), F.first("rights").alias("rights"),
        F.max("longer").alias("longer"))
    share, of = contain
    big = lambda c: F.col(c).cast("decimal(19,0)")
    kept = whole.where(big("longer") * of < big("a") * share)
    best = kept.withColumn("cut", F.expr("""array_min(transform(lefts, (l, k) -> struct(
        (2000000 * CAST(a AS DECIMAL(19,0)))
          div (CAST(l AS DECIMAL(19,0)) + CAST(rights[size(rights) - 1 - k] AS DECIMAL(19,0))) AS score,
        k, l, rights[size(rights) - 1 - k] AS r)))"""))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn(
        "rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    totals = counts.where("phrase IS NULL").groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
