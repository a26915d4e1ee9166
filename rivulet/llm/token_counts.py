"""Token counts of whole texts, with huge texts cut and spliced.

A text longer than a chunk is cut into overlapping chunks that are counted apart,
in any task. Each chunk reports the token count before every stable boundary
inside its overlaps. A boundary is stable at white space: words and special tokens
hold none, normalisation does not reach across it, so what follows is encoded
alike wherever the encoder started before it. Two neighbours are spliced at the
first boundary both report; where they share none, the text is cut anew with wider
overlaps, at last as one chunk.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.llm import word_bpe
from rivulet.llm.common import settle, slices

SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
KNOWN = 400_000


class _Counts:
    """Token counts of texts. The counts of words are remembered up to a bound: when half of
    it is full, only words asked for again outlive the next half."""

    def __init__(self, bpe: word_bpe.WordBpe):
        self.bpe, self.young, self.old = bpe, {}, {}

    def of_words(self, words: list[str]) -> list[int]:
        """Tokens of each of some different words."""
        found = list(map(self.young.get, words))
        lacking = [k for k, n in enumerate(found) if n is None]
        if lacking and self.old:
            for k in lacking:
                found[k] = self.old.get(words[k])
            fresh = [k for k in lacking if found[k] is None]
        else:
            fresh = lacking
        for k, ids in zip(fresh, self.bpe.merge_many([words[k] for k in fresh])):
            found[k] = len(ids)
        if len(self.young) + len(lacking) > KNOWN // 2:
            self.old, self.young = self.young, {}
        # words too long to be remembered are merged anew
        self.young.update((words[k], found[k]) for k in lacking if len(words[k]) <= 64)
        return found

    def of_all(self, texts: list[str]) -> list[int]:
        """Tokens of each text; equal words of all the texts are looked up once."""
        split = [self.bpe.words(t) for t in texts]
        words = pa.array(list(chain.from_iterable(split)), pa.large_string()).dictionary_encode()
        sizes = np.array(self.of_words(words.dictionary.to_pylist()), np.int64)
        before = np.concatenate([[0], np.cumsum(sizes[words.indices.to_numpy()])])
        ends = np.cumsum([0, *map(len, split)])
        return np.diff(before[ends]).tolist()


_COUNTS: dict[int, _Counts] = {}


def _counts(vocabulary: bytes) -> _Counts:
    if hash(vocabulary) not in _COUNTS:
        _COUNTS.clear()
        _COUNTS[hash(vocabulary)] = _Counts(word_bpe.load(vocabulary))
    return _COUNTS[hash(vocabulary)]


def boundaries(text: str, start: int, overlap: int, last: bool) -> list[int]:
    """Places of white space in the first and, unless it is the last chunk, the last
    ``overlap`` characters of a chunk that starts at ``start`` of its text."""
    marks = [m.start() for m in SPACE.finditer(text, 0, overlap)] if start else []
    if not last:
        marks += [m.start() for m in SPACE.finditer(text, max(overlap if start else 0,
                                                              len(text) - overlap))]
    return marks


def chunk_counts(counts: _Counts, chunks: list[tuple[str, int, bool]], overlap: int
                 ) -> list[tuple[list[int], list[int], int]]:
    """(offsets of boundaries, tokens before each, tokens in all) of (text, start, last) chunks.

    The pieces of all chunks are counted in one go.
    """
    marks = [boundaries(text, start, overlap, last) for text, start, last in chunks]
    pieces = [text[a:b] for (text, _, _), some in zip(chunks, marks)
              for a, b in zip([0, *some], [*some, len(text)])]
    sizes = iter(counts.of_all(pieces))
    out = []
    for (_, start, _), some in zip(chunks, marks):
        total = list(accumulate(islice(sizes, len(some) + 1)))
        out.append(([start + m for m in some], total[:-1], total[-1]))
    return out


def _cut(size: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                for row, text in zip(part.column("row").to_pylist(), part.column("text").to_pylist()):
                    starts = list(range(0, max(1, len(text) - overlap), size - overlap))
                    for k in range(0, len(starts), 64):
                        some = starts[k:k + 64]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([row] * len(some), pa.int64()), pa.array(some, pa.int64()),
                             pa.array([s == starts[-1] for s in some]),
                             pa.array([text[s:s + size] for s in some], pa.string())],
                            ["row", "start", "last", "text"])

    return run


def _long_counts(texts: DataFrame, shared, size: int, overlap: int) -> DataFrame:
    """(row, n_tokens) of long texts; NULL where the overlaps are too narrow."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(shared.value)
        for batch in batches:
            for part in slices(batch, "text", 1 << 21):
                rows = chunk_counts(counts, list(zip(*(part.column(c).to_pylist() for c in (
                    "text", "start", "last")))), overlap)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("start"),
                     pa.array([r[0] for r in rows], pa.list_(pa.int64())),
                     pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                     pa.array([r[2] for r in rows], pa.int64())],
                    ["row", "start", "marks", "counts", "total"])

    chunks = texts.mapInArrow(_cut(size, overlap), "row bigint, start bigint, last boolean, text string")
    dealt = chunks.repartition(F.xxhash64("row", "start"))  # the chunks of a text go to many tasks
    done = dealt.mapInArrow(count, "row bigint, start bigint, marks array<bigint>, "
                                   "counts array<bigint>, total bigint")
    in_text = Window.partitionBy("row").orderBy("start")
    steps = done.withColumns({
        "theirs": F.lag("marks").over(in_text), "their_counts": F.lag("counts").over(in_text),
        "their_total": F.lag("total").over(in_text)}).withColumn("mark", F.try_element_at(
            F.filter("theirs", lambda m: F.array_contains("marks", m)), F.lit(1)))
    lost = (F.try_element_at("counts", F.array_position("marks", F.col("mark")).cast("int"))
            + F.col("their_total")
            - F.try_element_at("their_counts", F.array_position("theirs", F.col("mark")).cast("int")))
    net = F.when(F.col("start") == 0, F.col("total")).otherwise(F.col("total") - lost)
    return (steps.groupBy("row").agg(F.sum(net).alias("n"), F.count("*").alias("all"),
                                     F.count(net).alias("known"))
            .select("row", F.when(F.col("all") == F.col("known"), F.col("n")).alias("n_tokens")))


def token_counts(docs: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text_col: str = "text",
                 chunk_chars: int = 32_768, overlap_chars: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of each whole text, without added special tokens.

    Defined cases: a NULL text counts as empty; empty texts and white space have no
    tokens; special tokens spelled out in a text count as one. Texts over
    ``chunk_chars`` are cut and spliced; a text without white space in any overlap
    ends as one chunk. Rows keep their number, also with equal or NULL ids; other
    columns are ignored.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bytes_of: Column = F.octet_length("text").cast("bigint").alias("n_bytes")
    is_long = F.char_length("text") > chunk_chars

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(shared.value)
        for batch in batches:
            for part in slices(batch, "text", 1 << 23):
                n = counts.of_all(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(n, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"])

    short = rows.where(~is_long).select("doc_id", "text", bytes_of).mapInArrow(
        count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    # rows are numbered once and stored, so that a repeated task numbers them alike
    texts = settle(rows.where(is_long).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text", bytes_of), "long_texts")
    done, left, size, overlap = [], texts.select("row", "text"), chunk_chars, overlap_chars
    while True:
        found = settle(_long_counts(left, shared, size, overlap), "long_counts")
        done.append(found.where("n_tokens IS NOT NULL"))
        failed = found.where("n_tokens IS NULL")
        if failed.isEmpty():
            break
        overlap *= 8
        size = max(size * 4, overlap * 2)  # at last a text is one chunk
        left = texts.select("row", "text").join(failed.select("row"), "row", "left_semi")
    counted = done[0]
    for more in done[1:]:
        counted = counted.union(more)
    long = texts.select("row", "doc_id", "n_bytes").join(counted, "row").select(
        "doc_id", "n_bytes", "n_tokens")
    return short.union(long)
