"""Removal of repeated passages with a logarithmic family of suffix arrays.

Which suffixes. Each window of ``match`` bytes has an anchor: the position of its
smallest GRAM-byte hash, leftmost of equal ones. Equal windows have equal anchors,
so only anchored suffixes (about one byte in fourteen) need to be indexed. The
windows that share an anchor form a run, and the run's text is its context.

Suffix arrays. A batch of documents becomes, for each shard of the hash space, an
array of its anchored suffixes sorted by (GRAM hash, context hash); only order
among equal prefixes matters to a search for matches of fixed length, so suffixes
are ordered by fingerprints of their text and not by the text. Each new array is
scanned against every level of the shard's family; a suffix whose context is in a
smaller document is covered and leaves the index. Levels of like size then merge.
The more text, the more and smaller arrays a shard gets: they are joined to arrays of
bounded size first, so that the scans of a shard do not grow in number with the text.

Edges. Where a shared passage ends inside a run, contexts differ though windows are
equal. Such runs (same GRAM, another context) go through the same family once more,
window by window.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rivulet.llm.common import byte_views, settle, slices, text_or_empty

GRAM = 24
SEGMENT = 1 << 20  # bytes handled at once; positions must fit 24 bits
LAST_ID = np.iinfo(np.int64).max  # stands for a missing doc_id
U = np.uint64

_x = np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15)
_x = (_x ^ (_x >> U(30))) * U(0xBF58476D1CE4E5B9)
BYTE = (_x ^ (_x >> U(27))) * U(0x94D049BB133111EB)
OTHER = (BYTE ^ (BYTE >> U(31))) * U(0xD6E8FEB86659FD93)  # for a second hash of the same text


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two pieces of text in a row."""
    out = left * U(0xD6E8FEB86659FD93)
    out += right
    out ^= out >> U(29)
    return out


def _final(x: np.ndarray, salt: int = 0) -> np.ndarray:
    out = (x + U(salt)) * U(0xFF51AFD7ED558CCD)
    out ^= out >> U(33)
    out *= U(0xC4CEB9FE1A85EC53)
    out ^= out >> U(29)
    return out


def rolling_hashes(text: np.ndarray, match: int, values: np.ndarray = BYTE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the GRAM bytes and of the ``match`` bytes from each position on."""
    h, size, gram, eight = values[text], 1, None, None
    while size * 2 <= match:
        h = _join(h[:-size], h[size:])
        size *= 2
        if size == 8:
            eight = h
        if size == 16:  # 16 bytes and the next 8
            gram = _join(h[:len(text) - GRAM + 1], eight[16:][:len(text) - GRAM + 1])
    rest = match - size
    return gram, (_join(h[:len(h) - rest], h[rest:]) if rest else h)


def sliding_argmin(keys: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest key in each window of ``width``; keys end in their position."""
    size = 1
    while size * 2 <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    rest = width - size
    keys = np.minimum(keys[:len(keys) - rest], keys[rest:]) if rest else keys
    return (keys & U(0xFFFFFF)).astype(np.int64)


def runs_of(text: np.ndarray, ends: np.ndarray, match: int) -> tuple[np.ndarray, ...]:
    """(first window, last window, gram hash, context hash) of each run of windows.

    ``ends`` are the ends of the documents joined in ``text``; windows stay inside one.
    """
    none = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    if len(text) < match:
        return none
    gram, whole = rolling_hashes(text, match)
    valid = np.ones(len(text), bool)
    for cut in range(1, match):  # windows that cross an end
        valid[np.maximum(ends - cut, 0)] = False
    # texts shorter than a window lie wholly in front of their end
    at = np.flatnonzero(valid[:len(whole)])
    if not len(at):
        return none
    order = _final(gram)
    keys = (order & ~U(0xFFFFFF)) | np.arange(len(gram), dtype=np.uint64)
    anchor = sliding_argmin(keys, match - GRAM + 1)[at]
    fresh = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(at, prepend=-2) != 1))
    low, high = at[fresh], at[np.append(fresh[1:], len(at)) - 1]
    where = anchor[fresh]
    shape = ((high - low) * 256 + (where - low)).astype(np.uint64)
    context = _final(_join(_join(whole[low], whole[high]), shape), 1)
    # minima crowd near zero; mixed anew they spread evenly over shards
    return low, high, _final(gram[where], 3), context


@dataclass
class Suffixes:
    """A suffix array: anchored suffixes sorted by key, equal keys by check, then document.

    Documents are numbers in a table of (id, hash of the text) sorted by id, which
    tells apart rows that share an id.
    """

    key: np.ndarray  # uint64: 40 bits of the gram hash, 24 of the context hash
    check: np.ndarray  # uint32: 32 more bits of the context hash
    doc: np.ndarray  # uint32: number in the table
    low: np.ndarray  # uint32: first window
    span: np.ndarray  # uint8: windows in the run, less one

    FIELDS = ("key", "check", "doc", "low", "span")

    def __len__(self) -> int:
        return len(self.key)

    def take(self, which) -> Suffixes:
        return Suffixes(*[getattr(self, f)[which] for f in self.FIELDS])

    def ordered(self) -> Suffixes:
        order = np.argsort(self.key)
        same = np.diff(self.key[order]) == 0
        tied = np.flatnonzero(np.append(same, False) | np.insert(same, 0, False))
        some = order[tied]
        order[tied] = some[np.lexsort((self.doc[some], self.check[some], self.key[some]))]
        return self.take(order)

    @staticmethod
    def joined(parts: list[Suffixes]) -> Suffixes:
        return parts[0] if len(parts) == 1 else Suffixes(
            *[np.concatenate([getattr(p, f) for p in parts]) for f in Suffixes.FIELDS])

    def heads(self) -> np.ndarray:
        """For each entry the first one of equal key and check."""
        fresh = np.ones(len(self), bool)
        fresh[1:] = (np.diff(self.key) != 0) | (np.diff(self.check) != 0)
        return np.flatnonzero(fresh)[np.cumsum(fresh) - 1]


class Table:
    """Documents in order of (id, hash): ids and hashes by number."""

    def __init__(self, ids: np.ndarray, hashes: np.ndarray):
        order = np.lexsort((hashes, ids))
        fresh = np.ones(len(ids), bool)
        fresh[1:] = (np.diff(ids[order]) != 0) | (np.diff(hashes[order]) != 0)
        self.ids, self.hashes = ids[order[fresh]], hashes[order[fresh]]
        self.number = np.empty(len(ids), np.uint32)  # of each row given
        self.number[order] = np.cumsum(fresh) - 1


def pack(run: Suffixes, lost: Suffixes, table: Table) -> bytes:
    """The array, and the (doc, low, span) that its batch has covered itself."""
    used = np.zeros(len(table.ids), bool)
    used[run.doc] = used[lost.doc] = True
    number = (np.cumsum(used) - 1).astype(np.uint32)
    head = np.array([len(run), len(lost), used.sum()], np.int64)
    return b"".join(x.tobytes() for x in (
        head, table.ids[used], table.hashes[used], run.key, run.check, number[run.doc], run.low,
        number[lost.doc], lost.low, run.span, lost.span))


def unpack(data: bytes) -> tuple[Suffixes, Suffixes, np.ndarray, np.ndarray]:
    n, m, docs = np.frombuffer(data, np.int64, 3).tolist()
    at, parts = 24, []
    for kind, size in ((np.int64, docs), (np.int64, docs), (np.uint64, n), (np.uint32, n),
                       (np.uint32, n), (np.uint32, n), (np.uint32, m), (np.uint32, m),
                       (np.uint8, n), (np.uint8, m)):
        parts.append(np.frombuffer(data, kind, size, at))
        at += size * np.dtype(kind).itemsize
    ids, hashes, key, check, doc, low, lost_doc, lost_low, span, lost_span = parts
    none = np.zeros(m, np.uint64), np.zeros(m, np.uint32)
    return (Suffixes(key, check, doc, low, span), Suffixes(*none, lost_doc, lost_low, lost_span),
            ids, hashes)


class LevelFamily:
    """Sorted arrays of growing size; adding one costs a scan of each and seldom a large merge."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids  # by document number
        self.levels: list[Suffixes] = []
        self.covered: list[Suffixes] = []

    def add(self, batch: Suffixes) -> None:
        for k, level in enumerate(self.levels):
            batch, self.levels[k] = self._scan(batch, level)
        while self.levels and len(self.levels[-1]) < 2 * len(batch):
            batch = Suffixes.joined([self.levels.pop(), batch]).ordered()
        self.levels.append(batch)

    def _scan(self, batch: Suffixes, level: Suffixes) -> tuple[Suffixes, Suffixes]:
        """Both without what the other covers."""
        if not len(level) or not len(batch):
            return batch, level
        at, last = np.searchsorted(level.key, batch.key), len(level) - 1
        while True:  # keys that agree by chance differ in the check
            here = np.minimum(at, last)
            behind = (at <= last) & (level.key[here] == batch.key) & (level.check[here] < batch.check)
            if not behind.any():
                break
            at[behind] += 1
        same = (at <= last) & (level.key[here] == batch.key) & (level.check[here] == batch.check)
        ours, theirs = self.ids[batch.doc], self.ids[level.doc[here]]
        lost, won = same & (theirs < ours), same & (theirs > ours)
        if won.any():
            beaten = np.zeros(len(level), bool)
            beaten[here[won]] = True
            beaten = beaten[level.heads()]
            self.covered.append(level.take(beaten))
            level = level.take(~beaten)
        if lost.any():
            self.covered.append(batch.take(lost))
            batch = batch.take(~lost)
        return batch, level

    def merged(self) -> Suffixes:
        return Suffixes.joined(self.levels).ordered()


def bounded_arrays(arrays: Iterator[Suffixes], ids: np.ndarray, covered: list[Suffixes],
                   least: int | None = None) -> Iterator[Suffixes]:
    """Arrays in a row joined to sorted ones of ``least`` suffixes or more; only the last may be shorter.

    What an array covers in another one of its row goes to ``covered``.
    """
    least = JOINED if least is None else least

    def joined(row: list[Suffixes]) -> Suffixes:
        if len(row) == 1:
            return row[0]
        run = Suffixes.joined(row).ordered()
        lost = ids[run.doc[run.heads()]] < ids[run.doc]
        covered.append(run.take(lost))
        return run.take(~lost)

    row: list[Suffixes] = []
    for part in arrays:
        if len(part):
            row.append(part)
        if sum(map(len, row)) >= least:
            yield joined(row)
            row = []
    if row:
        yield joined(row)


def _edges(index: Suffixes, ids: np.ndarray) -> Suffixes:
    """Suffixes whose gram stands in another context of another document too."""
    gram, doc = index.key >> U(24), ids[index.doc]
    first = np.flatnonzero(np.diff(gram, prepend=~gram[:1]) != 0)
    mixed = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
    return index.take(np.repeat(mixed, np.diff(np.append(first, len(index)))))


def _range_arrays(found: Suffixes) -> tuple[np.ndarray, pa.Array]:
    """Document numbers and their ranges; a range is a first window and a number of windows less one."""
    if not len(found):
        return np.empty(0, np.int64), pa.array([], pa.binary())
    order = np.argsort(found.doc.astype(np.uint64) << U(32) | found.low)
    doc, low, high = found.doc[order], found.low[order], found.low[order] + found.span[order]
    # windows in a row become one range
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (np.diff(doc) != 0) | (low[1:] > high[:-1] + 1)
    first = np.flatnonzero(fresh)
    doc, low = doc[first], low[first]
    ranges = np.stack([low, np.maximum.reduceat(high, first) - low], axis=1).astype("<u4")
    cuts = np.flatnonzero(np.diff(doc, prepend=~doc[:1]) != 0)
    ends = np.append(cuts, len(doc)).astype(np.int32) * np.int32(ranges.itemsize * 2)
    return doc[cuts].astype(np.int64), pa.Array.from_buffers(
        pa.binary(), len(cuts), [None, pa.py_buffer(ends), pa.py_buffer(ranges)])


def _pack_ranges(found: Suffixes) -> list[tuple[int, bytes]]:
    """(document number, ranges)."""
    doc, ranges = _range_arrays(found)
    return list(zip(doc.tolist(), ranges.to_pylist()))


def _ranges(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(b"".join(blobs), "<u4").reshape(-1, 2).astype(np.int64)
    return found[:, 0], found[:, 1]


EMITTED = "shard int, first_doc bigint, suffixes binary"
FOUND = "doc bigint, hash bigint, edge boolean, ranges binary"
MOST = 300_000  # suffixes in a batch; up to four times as many where they go to many shards
MANY = 64  # shards
JOINED = 1 << 16  # least suffixes of an array that a family takes, but for its last


class _Batch:
    """Gathers the suffixes of documents until they make an array."""

    def __init__(self, shards: int):
        self.shards, self.n = shards, 0
        self.most = MOST * min(4, max(1, shards // MANY))
        self.parts: list[Suffixes] = []
        self.ids: list[int] = []
        self.hashes: list[int] = []

    def add(self, part: Suffixes) -> None:
        self.parts.append(part)
        self.n += len(part)

    def emit(self) -> Iterator[pa.RecordBatch]:
        """One batch's suffix array in shards; what it covers itself goes to other groups.

        Those are named by shard and batch, so a passage that most documents hold brings its
        rows to as many groups as there are shards, not to the shard of the passage, and no
        group gets all rows of a batch.
        """
        if self.n:
            table = Table(np.array(self.ids, np.int64), np.array(self.hashes, np.int64))
            run = Suffixes.joined(self.parts)
            run.doc = table.number[run.doc]
            run = run.ordered()
            keep = table.ids[run.doc[run.heads()]] >= table.ids[run.doc]
            # equal parts of the hash space, in order
            home = (run.key >> U(32)) * U(self.shards) >> U(32)
            cuts = np.searchsorted(home, np.arange(self.shards + 1, dtype=np.uint64))
            batch, packed = int(table.hashes[0]) & 0xFFFFFFFF, []
            for s in np.flatnonzero(np.diff(cuts)).tolist():
                part, own = run.take(slice(cuts[s], cuts[s + 1])), keep[cuts[s]:cuts[s + 1]]
                kept, lost = part.take(own), part.take(~own)
                if len(kept):
                    packed.append((s, pack(kept, part.take(slice(0, 0)), table)))
                if len(lost):
                    packed.append((-1 - (s + batch) % self.shards, pack(part.take(slice(0, 0)), lost, table)))
            for shard, blob in packed:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([int(table.ids[0])], pa.int64()),
                     pa.array([blob], pa.binary())], ["shard", "first_doc", "suffixes"])
        self.__init__(self.shards)


def _index_texts(match: int, shards: int):
    """Batches of (doc, hash, text) to sharded suffix arrays of their runs."""
    def segment(texts: list[bytes], number: int, start: int = 0) -> Suffixes:
        lens = np.array([len(t) for t in texts])
        ends = np.cumsum(lens)
        low, high, gram, context = runs_of(np.frombuffer(b"".join(texts), np.uint8), ends, match)
        which = np.searchsorted(ends, low, side="right")
        return Suffixes((gram & ~U(0xFFFFFF)) | (context >> U(40)),
                        (context & U(0xFFFFFFFF)).astype(np.uint32),
                        (which + number).astype(np.uint32),
                        (low - (ends - lens)[which] + start).astype(np.uint32),
                        (high - low).astype(np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = _Batch(shards)
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                texts, number = byte_views(part.column("text")), len(gathered.ids)
                gathered.ids += part.column("doc").to_pylist()
                gathered.hashes += part.column("hash").to_pylist()
                if max(map(len, texts)) <= SEGMENT:
                    gathered.add(segment(texts, number))
                else:  # a huge text in overlapping segments
                    for k, text in enumerate(texts):
                        for c in range(0, max(1, len(text)), SEGMENT):
                            gathered.add(segment([text[c:c + SEGMENT + match - 1]], number + k, c))
                if gathered.n >= gathered.most:
                    yield from gathered.emit()
        yield from gathered.emit()

    return run


def _index_edges(match: int, shards: int):
    """Batches of (doc, hash, text, ranges) to suffix arrays of single windows."""
    def windows(texts: list[bytes], ranges: list, number: int, start: int = 0) -> Suffixes:
        base = np.cumsum([0, *map(len, texts)])
        low = np.concatenate([r[0] + b for r, b in zip(ranges, base)])
        count = np.concatenate([r[1] for r in ranges]) + 1
        doc = np.repeat(np.arange(len(ranges)) + number, [len(r[0]) for r in ranges])
        at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        doc = np.repeat(doc, count)
        if len(base) == 2:  # of a segment, the windows that start in it
            here = (at >= 0) & (at < min(SEGMENT, base[1] - match + 1))
            at, doc = at[here], doc[here]
        text = np.frombuffer(b"".join(texts), np.uint8)
        h, second = (rolling_hashes(text, match, values)[1][at] for values in (BYTE, OTHER))
        local = at - base[np.maximum(doc - number, 0)] + start
        return Suffixes(_final(h), (_final(second, 2) >> U(32)).astype(np.uint32), doc.astype(np.uint32),
                        local.astype(np.uint32), np.zeros(len(at), np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = _Batch(shards)
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                texts, number = byte_views(part.column("text")), len(gathered.ids)
                ranges = [_ranges(blobs) for blobs in part.column("ranges").to_pylist()]
                gathered.ids += part.column("doc").to_pylist()
                gathered.hashes += part.column("hash").to_pylist()
                if max(map(len, texts)) <= SEGMENT and len(texts) > 1:
                    gathered.add(windows(texts, ranges, number))
                else:
                    for k, (text, (low, span)) in enumerate(zip(texts, ranges)):
                        for c in range(0, len(text) - match + 1, SEGMENT):
                            gathered.add(windows([text[c:c + SEGMENT + match - 1]],
                                                 [(low - c, span)], number + k, c))
                if gathered.n >= gathered.most:
                    yield from gathered.emit()
        yield from gathered.emit()

    return run


def _family_of_shard(with_edges: bool):
    def run(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("first_doc").to_numpy(), kind="stable")
        blobs = [group.column("suffixes")[int(i)].as_py() for i in order]
        opened = [unpack(b)[2:] for b in blobs]
        table = Table(np.concatenate([o[0] for o in opened]), np.concatenate([o[1] for o in opened]))
        numbers = np.split(table.number, np.cumsum([len(o[0]) for o in opened])[:-1])
        family, covered = LevelFamily(table.ids), []

        def arrays() -> Iterator[Suffixes]:
            for blob, number in zip(blobs, numbers):
                run, lost = unpack(blob)[:2]
                run.doc, lost.doc = number[run.doc], number[lost.doc]
                covered.append(lost)
                yield run

        for run in bounded_arrays(arrays(), table.ids, covered):
            family.add(run)
        found = [_range_arrays(Suffixes.joined(covered + family.covered))]
        if with_edges and family.levels:
            found.append(_range_arrays(_edges(family.merged(), table.ids)))
        doc, ranges = np.concatenate([x[0] for x in found]), [x[1] for x in found]
        edge = np.repeat([False, True][:len(found)], [len(x[0]) for x in found])
        return pa.Table.from_arrays(
            [pa.array(table.ids[doc]), pa.array(table.hashes[doc]), pa.array(edge, pa.bool_()),
             pa.chunked_array(ranges, pa.binary())],
            ["doc", "hash", "edge", "ranges"])

    return run


def covered_windows(texts: DataFrame, match: int, shard_bytes: int) -> DataFrame:
    """(doc, hash, ranges): windows of (doc, hash, text) rows that start in a smaller doc too."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(size / shard_bytes))
    suffixes = texts.mapInArrow(_index_texts(match, shards), EMITTED)
    found = settle(suffixes.groupBy("shard").applyInArrow(_family_of_shard(True), FOUND), "runs")
    grouped = found.where("edge").groupBy("doc", "hash").agg(F.collect_list("ranges").alias("ranges"))
    windows = texts.join(grouped, ["doc", "hash"]).mapInArrow(_index_edges(match, shards), EMITTED)
    edges = settle(windows.groupBy("shard").applyInArrow(_family_of_shard(False), FOUND), "edges")
    return found.where("NOT edge").union(edges).select("doc", "hash", "ranges")


def removed_spans(low: np.ndarray, span: np.ndarray, match: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes under windows low .. low + span."""
    order = np.argsort(low, kind="stable")
    start, end = low[order], np.maximum.accumulate((low + span)[order] + match)
    fresh = np.flatnonzero(np.append(True, start[1:] > end[:-1])) if len(start) else []
    return [(int(start[a]), int(end[b - 1])) for a, b in zip(fresh, [*fresh[1:], len(start)])]


def check_options(match: int, carry: tuple[str, ...] = ()) -> None:
    if match < 2 * GRAM or match - GRAM > 255:
        raise ValueError(f"match must be {2 * GRAM} to {255 + GRAM} bytes")
    if {c.lower() for c in carry} & {"doc_id", "n_bytes", "spans", "kept"}:
        raise ValueError("a carried column has the name of a new one")


def order_id(id_col: str) -> Column:
    """The id, with a missing one as the last."""
    return F.coalesce(F.col(id_col).cast("bigint"), F.lit(int(LAST_ID)).cast("bigint"))


def without_windows(docs: DataFrame, covered: DataFrame, match: int, id_col: str, text_col: str,
                    carry: tuple[str, ...], whole: bool) -> DataFrame:
    """The result of ``remove_repeats`` for the covered (doc, hash, ranges) of the documents."""
    ranges = covered.groupBy("doc", "hash").agg(F.collect_list("ranges").alias("ranges"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), order_id(id_col).alias("doc"),
                       text_or_empty(text_col).alias("text"),
                       *[F.col(c).alias(f"carry_{k}") for k, c in enumerate(carry)]).withColumn(
        "hash", F.xxhash64("text"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(text: pa.Array, ranges: pa.Array) -> pa.Array:
        spans, kept = [], []
        for part in slices(pa.RecordBatch.from_arrays([text, ranges], ["text", "ranges"]), "text"):
            for raw, blobs in zip(byte_views(part.column("text")), part.column("ranges").to_pylist()):
                gone = removed_spans(*_ranges(blobs), match) if blobs else []
                edges = [0, *(x for s in gone for x in s), len(raw)]
                pieces = [raw[a:b] for a, b in zip(edges[::2], edges[1::2])]
                if whole and gone:  # pieces lose what is left of a character at their ends
                    pieces = [x.decode("utf-8", "ignore").encode() for x in pieces]
                kept.append(b"".join(pieces))
                spans.append([{"start": a, "end": b} for a, b in gone])
        return pa.StructArray.from_arrays([pa.array(spans, span), pa.array(kept, pa.binary())], ["spans", "kept"])

    cutter = F.arrow_udf(cut, "spans array<struct<start:bigint,end:bigint>>, kept binary")
    return rows.join(ranges, ["doc", "hash"], "left").select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), cutter("text", "ranges").alias("cut"),
        *[F.col(f"carry_{k}").alias(c) for k, c in enumerate(carry)]).select(
        "doc_id", "n_bytes", "cut.spans", "cut.kept", *carry)


def remove_repeats(docs: DataFrame, match: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   carry: tuple[str, ...] = (), shard_bytes: int = 16 << 20, whole: bool = False) -> DataFrame:
    """doc_id, n_bytes, spans (array of start, end) and kept (binary) of each document.

    Columns named in ``carry`` go along. With ``whole`` the characters that an end of a span
    cuts in two are taken from ``kept`` altogether; a text without spans stays as it is.

    A byte goes if it lies under a string of ``match`` bytes that also starts in a
    document with a smaller id. Strings are judged on the input; spans are maximal
    and never touch. ``shard_bytes`` is the text behind one shard of the index (its
    suffixes take about as much memory).

    Defined cases: a NULL text counts as empty, and texts shorter than ``match`` lose
    nothing. A row without id counts as the last document. Rows that share an id
    never remove from each other. Rows keep their number; other columns are ignored, and a
    carried column must not have the name of a new one.
    """
    check_options(match, carry)
    texts = docs.select(order_id(id_col).alias("doc"), text_or_empty(text_col).alias("text")).select(
        "doc", F.xxhash64("text").alias("hash"), "text")
    return without_windows(docs, covered_windows(texts, match, shard_bytes), match, id_col, text_col, carry, whole)
