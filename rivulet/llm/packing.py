"""Packing into optimal length buckets.

The histogram of all sequence lengths (one bin per length up to the longest allowed)
goes through a dynamic program that places the bucket bounds where least padding
results. Inside each bucket sequences are numbered and fill batches of a token budget.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.llm.common import settle
from rivulet.llm.token_counts import token_counts


def word_tokens(text_col: str = "text") -> Column:
    """Number of runs without white space, which are no tokens; a NULL text has none."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("bigint")


def optimal_bounds(counts: np.ndarray, buckets: int) -> list[int]:
    """Bucket bounds that minimise total padding; ``counts[l]`` sequences have length l.

    The last bound is the longest length there is. Fewer bounds are given where they
    reach zero padding. Of equally good ones the lower bounds are taken.
    """
    lengths = np.flatnonzero(counts)
    lengths = lengths[lengths > 0]
    if not len(lengths):
        return []
    n = counts[lengths].astype(np.float64)
    many = np.concatenate([[0], np.cumsum(n)])
    tokens = np.concatenate([[0], np.cumsum(n * lengths)])
    # best[j]: least padding of the j shortest lengths; choice: where the last bucket starts
    best, choices = np.where(np.arange(len(many)) == 0, 0.0, np.inf), []
    for _ in range(min(buckets, len(lengths))):
        fresh, choice = np.full(len(many), np.inf), np.zeros(len(many), np.int64)
        fresh[0] = best[0]
        for j in range(1, len(many)):
            pad = best[:j] + lengths[j - 1] * (many[j] - many[:j]) - (tokens[j] - tokens[:j])
            choice[j] = int(pad.argmin())
            fresh[j] = pad[choice[j]]
        best = fresh
        choices.append(choice)
        if best[-1] == 0:
            break
    bounds, j = [], len(lengths)
    for choice in reversed(choices):
        if j == 0:
            break
        bounds.append(int(lengths[j - 1]))
        j = int(choice[j])
    return sorted(bounds)


def length_counts(pieces: DataFrame, max_len: int) -> np.ndarray:
    """The global histogram; at most ``max_len`` rows reach the driver."""
    rows = pieces.groupBy("n_tokens").count().collect()
    counts = np.zeros(max_len + 1, np.int64)
    for r in rows:
        counts[r["n_tokens"]] += r["count"]
    return counts


def pack(docs: DataFrame, length: Column | None = None, id_col: str = "doc_id", max_len: int = 2048,
         buckets: int = 16, budget: int = 65_536, rows_per_split: int = 50_000) -> DataFrame:
    """Batches of sequences padded to their bucket's bound.

    Returns doc_id, piece, start, n_tokens, bucket (the padded length), padding,
    batch (numbered from 0 inside the bucket) and slot (place in the batch). A
    document longer than ``max_len`` tokens is cut into pieces, none is shortened. A
    batch holds at most ``budget // bucket`` sequences, at least one; all batches of a
    bucket but its last are full.

    Defined cases: a NULL or empty text, or a length that is NULL or below 1, makes no
    sequence. Repeated rows and rows without id are sequences of their own. An empty
    table gives an empty one. Other columns are ignored.
    """
    tokens = word_tokens() if length is None else length.cast("bigint")
    # row numbers are stored, so that a repeated task deals rows alike
    sized = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), tokens.alias("total")).where(
        "total > 0")
    cut = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(total - 1) div {max_len}")))
    pieces = settle(
        sized.select("doc_id", "total", cut.alias("piece"))
        .select("doc_id", "piece", (F.col("piece") * max_len).alias("start"),
                F.least(F.lit(max_len), F.col("total") - F.col("piece") * max_len)
                .cast("int").alias("n_tokens"), F.monotonically_increasing_id().alias("row")), "pieces")
    counts = length_counts(pieces, max_len)
    bounds = optimal_bounds(counts, buckets) or [max_len]
    splits = max(1, math.ceil(int(counts.sum()) / rows_per_split))
    bound = F.element_at(F.filter(F.array(*map(F.lit, bounds)), lambda b: b >= F.col("n_tokens")), 1)
    placed = pieces.withColumn("bucket", bound).withColumn(
        "split", F.pmod(F.xxhash64("row"), F.lit(splits)))
    # where each split starts in its bucket: a running sum over splits, not over rows
    before = Window.partitionBy("bucket").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("bucket", "split").count().select(
        "bucket", "split", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("bucket", "split").orderBy("row")
    place = F.col("offset") + F.row_number().over(inside) - 1
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket"))).cast("bigint")
    return (placed.join(offsets, ["bucket", "split"]).withColumn("place", place)
            .select("doc_id", "piece", "start", "n_tokens", "bucket",
                    (F.col("bucket") - F.col("n_tokens")).alias("padding"),
                    F.floor(F.col("place") / room).alias("batch"),
                    F.pmod("place", room).cast("int").alias("slot")))


def pack_tokens(docs: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text_col: str = "text",
                max_len: int = 2048, buckets: int = 16, budget: int = 65_536) -> DataFrame:
    """``pack`` by the tokens of a vocabulary.

    Lengths are exact counts of each whole text; ``start`` and ``n_tokens`` of a piece
    are a place in the text's token ids, as ``bpe.encode`` gives them.
    """
    counted = token_counts(docs, vocabulary, id_col, text_col)
    return pack(counted, F.col("n_tokens"), "doc_id", max_len, buckets, budget)
