"""Periodic runs of words, by descending-LCP Kruskal over the classes of equal suffixes.

The suffixes of each text (over words) are sorted by prefix doubling, all texts of a
slice at once. Suffixes that share at least L words form classes; going down in L,
neighbours of the suffix array unite two classes at a time. A class is an ordered
set of positions. Two positions that become neighbours in a united set at level L,
d words apart, agree on L words, so the text has period d from the first on, for
d + L words. Every run is met this way: its first position and the one a period later
share exactly what is left of the run, and no position of their class lies between
them, as that would be a shorter period.

Only neighbours near enough for a long run matter, so classes in which no position
has another one near it are left out beforehand.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivulet.llm.common import byte_views, slices

RUN = "struct<start:bigint,length:bigint,period:bigint>"
ARROW_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _group_starts(order_key: np.ndarray) -> np.ndarray:
    """Rank of each value: how many values are smaller."""
    _, which, counts = np.unique(order_key, return_inverse=True, return_counts=True)
    return (np.cumsum(counts) - counts)[which]


def _refined(rank: np.ndarray, active: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks by twice as many words, and the positions that are still tied."""
    key = rank[active] * len(rank) + rank[active + step]
    order = np.argsort(key, kind="stable")
    key, at = key[order], active[order]
    old = rank[at]
    number = np.arange(len(at))
    group = np.maximum.accumulate(np.where(np.diff(old, prepend=-1) != 0, number, 0))
    fresh = np.diff(key, prepend=-1) != 0
    first = np.maximum.accumulate(np.where(fresh, number, 0))
    out = rank.copy()
    out[at] = old + first - group
    alone = fresh & np.append(fresh[1:], True)
    return out, at[~alone]


def suffix_neighbours(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, shared): neighbours of the suffix array that share ``least`` words or more.

    ``words`` are numbers; each text must end in a number that occurs once.
    """
    levels, step = [_group_starts(words)], 1
    active = np.flatnonzero(np.bincount(levels[0], minlength=len(words))[levels[0]] > 1)
    enough = None  # positions that share enough words with another one to matter
    while len(active):
        if step * 2 > least and enough is None:
            enough = active
        rank, active = _refined(levels[-1], active, step)
        levels.append(rank)
        step *= 2
    if enough is None:
        return (np.empty(0, np.int64),) * 3
    enough = enough[np.argsort(levels[-1][enough])]
    left, right = enough[:-1], enough[1:]
    shared = np.zeros(len(left), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][left + shared] == levels[k][right + shared]
        shared[same] += 1 << k
    near = shared >= least
    return left[near], right[near], shared[near]


def _promising(left: np.ndarray, right: np.ndarray, shared: np.ndarray, times: int) -> np.ndarray:
    """Which neighbours lie in a class with a position that has another one near enough."""
    block = np.cumsum(np.append(True, left[1:] != right[:-1])) - 1  # classes at the least level
    where = np.concatenate([left, right])
    of, most = np.concatenate([block, block]), np.concatenate([shared, shared])
    order = np.lexsort((where, of))
    where, of, most = where[order], of[order], most[order]
    fresh = np.flatnonzero(np.append(True, (np.diff(where) != 0) | (np.diff(of) != 0)))
    where, of, most = where[fresh], of[fresh], np.maximum.reduceat(most, fresh)
    near = (np.diff(of) == 0) & (np.diff(where) * times <= most[:-1])
    good = np.zeros(int(block[-1]) + 1, bool)
    good[of[:-1][near]] = True
    return good[block]


def seeds_of(left: list[int], right: list[int], shared: list[int], times: int, least: int
             ) -> list[tuple[int, int, int]]:
    """(position, period, shared words) of positions that become neighbours in a class.

    The pairs come by descending ``shared``. Kept are those at ``times`` periods or more
    of shared words and ``least`` words in all.
    """
    home: dict[int, list[int]] = {}
    seeds = []
    for p, q, level in zip(left, right, shared):
        large, small = home.get(p) or [p], home.get(q) or [q]
        if len(large) < len(small):
            large, small = small, large
        reach = level // times
        for x in small:
            k = bisect_left(large, x)
            if k and x - large[k - 1] <= reach:
                seeds.append((large[k - 1], x - large[k - 1], level))
            if k < len(large) and large[k] - x <= reach:
                seeds.append((x, large[k] - x, level))
        if len(large) == 1:
            home[large[0]] = large
        for x in small:
            home[x] = large
        if len(small) == 1:
            large.insert(k, small[0])
        else:
            large += small
            large.sort()  # two ordered runs: a merge
    return [s for s in seeds if s[1] + s[2] >= least]


def runs_of(words: np.ndarray, least_length: int, least_exponent: int) -> np.ndarray:
    """(start, length, period) rows of all runs, by start, then period.

    ``words`` holds the numbered words of one or more texts, with a number that occurs
    once before the first text and after each.
    """
    times = least_exponent - 1
    least = min(max(least_length - q, times * q) for q in range(1, least_length + 1))
    left, right, shared = suffix_neighbours(words, max(1, least))
    none = np.empty((0, 3), np.int64)
    if not len(left):
        return none
    keep = _promising(left, right, shared, times)
    left, right, shared = left[keep], right[keep], shared[keep]
    down = np.argsort(-shared, kind="stable")
    found = np.array(seeds_of(left[down].tolist(), right[down].tolist(), shared[down].tolist(),
                              times, least_length), np.int64).reshape(-1, 3)
    start, period, shared = found.T
    begins = words[start - 1] != words[start + period - 1]
    start, period, length = start[begins], period[begins], (period + shared)[begins]
    # multiples of a period are found beside it, with the same ends
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.append(True, (np.diff(start) != 0) | (np.diff(length) != 0))[:len(start)]
    out = np.stack([start, length, period], axis=1)[first]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _runs_of_texts(texts: list[list[bytes]], least_length: int, least_exponent: int
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start, length, period) rows; first positions; marks of words to drop."""
    number = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(texts)))}
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    base = np.cumsum(lens + 1) - lens
    total = int(lens.sum()) + len(texts) + 1
    size = len(number) + len(texts) + 1
    words = np.empty(total, np.int64)
    words[0] = len(number)  # as numbers of the first text's words are below
    for k, text in enumerate(texts):  # words of different texts have different numbers
        a = int(base[k])
        words[a:a + len(text)] = list(map(number.__getitem__, text))
        words[a:a + len(text)] += k * size
        words[a + len(text)] = k * size + len(number) + 1 + k
    runs = runs_of(words, least_length, least_exponent)
    which = np.searchsorted(base, runs[:, 0], side="right") - 1
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    runs = np.column_stack([which, runs[:, 0] - base[which], runs[:, 1:]])
    return runs, base, np.cumsum(edge) == 0


def periodic_runs(docs: DataFrame, least_length: int = 6, least_exponent: int = 4,
                  id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = 2 << 20
                  ) -> DataFrame:
    """doc_id, runs (array of start, length, period) and collapsed (string) of each row.

    Words are what stands between white space (blank, \\x09-\\x0D), numbered from 0. A run
    is a stretch of words with smallest period ``period`` that no neighbouring word
    prolongs, of at least ``least_length`` words and ``least_exponent`` (2 or more) periods.
    Runs come by start, then period. ``collapsed`` has the words, joined by one blank,
    without those that a run holds after its first period.

    Defined cases: a NULL or empty text has no run and is empty when collapsed. Texts are
    never cut; a slice holds texts of about ``slice_bytes`` and one longer text at worst.
    Rows keep their number, with or without an id; other columns are ignored.
    """
    if least_exponent < 2 or least_length < 2:
        raise ValueError("a run has two words and two periods at least")
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", slice_bytes):
                texts = [raw.split() for raw in byte_views(part.column("text"))]
                runs, base, keep = _runs_of_texts(texts, least_length, least_exponent)
                cuts = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
                fields = [pa.array(runs[:, k]) for k in (1, 2, 3)]
                lists = pa.ListArray.from_arrays(
                    pa.array(cuts, pa.int32()),
                    pa.StructArray.from_arrays(fields, fields=list(ARROW_RUN)))
                kept = [b" ".join(compress(words, keep[a:a + len(words)].tolist())
                                  if cuts[k] < cuts[k + 1] else words)
                        for k, (words, a) in enumerate(zip(texts, base))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists, pa.array(kept, pa.binary()).cast(pa.string())],
                    ["doc_id", "runs", "collapsed"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind.simpleString()}, runs array<{RUN}>, collapsed string")
