"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The corpus' frequent words are merged once and compiled into a minimal automaton
that shares suffixes as well as prefixes. Each arc carries the number of words that
sort before it, so the sum along a word's path is the word's rank, and the rank
finds its ids: a transducer from words to id lists. Workers memory-map the file.
Words it does not hold are merged exactly where they are met.
"""

from __future__ import annotations

import mmap
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from rivulet.llm import word_bpe
from rivulet.llm.common import settle, share_file, shared_path, slices
from rivulet.llm.word_bpe import WordBpe

LONGEST = 64  # bytes of a word in the lexicon
KNOWN = 500_000  # words a worker remembers before it starts anew


class _State:
    __slots__ = ("arcs", "final", "number", "words")

    def __init__(self):
        self.arcs: dict[int, _State] = {}
        self.final, self.number, self.words = False, -1, 0

    def key(self):
        return (self.final, *((c, id(t)) for c, t in self.arcs.items()))


def compile_lexicon(entries: dict[bytes, tuple[int, ...]]) -> bytes:
    """The transducer file: arcs of the minimal automaton, then the ids of each word by rank."""
    root, register = _State(), {}
    path = [(0, root)]  # label into the state, state; the word added last
    last = b""

    def freeze(depth: int) -> None:
        while len(path) > depth:
            label, state = path.pop()
            twin = register.setdefault(state.key(), state)
            path[-1][1].arcs[label] = twin

    for word in sorted(entries):
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        freeze(same + 1)
        for label in word[same:]:
            state = _State()
            path[-1][1].arcs[label] = state
            path.append((label, state))
        path[-1][1].final, last = True, word
    freeze(1)

    order: list[_State] = []

    def visit(state: _State) -> None:
        """Numbers states and counts their words; a path is at most LONGEST deep."""
        if state.number < 0:
            state.number = len(order)
            order.append(state)
            for target in state.arcs.values():
                visit(target)
            state.words = state.final + sum(t.words for t in state.arcs.values())

    visit(root)
    first, labels, targets, adds = [0], [], [], []
    for state in order:
        before = int(state.final)
        for label, target in sorted(state.arcs.items()):
            labels.append(label)
            targets.append(target.number)
            adds.append(before)
            before += target.words
        first.append(len(labels))
    ids = [entries[w] for w in sorted(entries)]
    offsets = np.cumsum([0, *map(len, ids)])
    parts = [np.array(x, np.uint32) for x in (
        first, [s.final for s in order], labels, targets, adds, offsets, list(chain(*ids)))]
    return np.array([len(p) for p in parts], np.uint32).tobytes() + b"".join(
        p.tobytes() for p in parts)


class Lexicon:
    """A compiled transducer, mapped into memory."""

    PARTS = 7

    def __init__(self, path: str):
        with open(path, "rb") as f:
            view = memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)).cast("I")
        at, parts = self.PARTS, []
        for n in view[:self.PARTS].tolist():
            parts.append(view[at:at + n])
            at += n
        self.first, self.final, self.labels, self.targets, self.adds, self.offsets, self.ids = parts
        states = np.repeat(np.arange(len(self.final)), np.diff(np.asarray(self.first)))
        self.arcs = states << 8 | np.asarray(self.labels)  # in order, as states and labels are

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def find(self, word: bytes) -> tuple[int, ...] | None:
        state = rank = 0
        for byte in word:
            low, high = self.first[state], self.first[state + 1]
            while low < high:
                mid = (low + high) // 2
                if self.labels[mid] < byte:
                    low = mid + 1
                else:
                    high = mid
            if low == self.first[state + 1] or self.labels[low] != byte:
                return None
            rank += self.adds[low]
            state = self.targets[low]
        if not self.final[state]:
            return None
        return tuple(self.ids[self.offsets[rank]:self.offsets[rank + 1]].tolist())


    def find_many(self, words: list[bytes]) -> list[tuple[int, ...] | None]:
        """``find`` of each word; all take their next arc together."""
        if not words or not len(self.arcs):
            return [self.find(w) for w in words]
        lens = np.fromiter(map(len, words), np.int64, len(words))
        width = int(lens.max())
        codes = np.array(words, f"S{max(1, width)}").view(np.uint8).reshape(len(words), -1)
        targets, adds = (np.asarray(x).astype(np.int64) for x in (self.targets, self.adds))
        state, rank = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for k in range(width):
            go = np.flatnonzero((lens > k) & (state >= 0))
            key = state[go] << 8 | codes[go, k]
            at = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            there = self.arcs[at] == key
            state[go] = np.where(there, targets[at], -1)
            rank[go] += np.where(there, adds[at], 0)
        held = (state >= 0) & (np.asarray(self.final)[np.maximum(state, 0)] > 0)
        offsets, ids = np.asarray(self.offsets), np.asarray(self.ids)
        rank = np.where(held, rank, 0)
        spans = zip(held.tolist(), offsets[rank].tolist(), offsets[rank + 1].tolist())
        return [tuple(ids[a:b].tolist()) if has else None for has, a, b in spans]


class _Known(dict):
    """Numbers of words; ids of word k are ``flat[start[k]:start[k] + size[k]]``."""

    def __init__(self, bpe: WordBpe, lexicon: Lexicon):
        super().__init__()
        self.bpe, self.lexicon = bpe, lexicon
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self.flat = np.empty(0, np.int32)
        self.start = self.size = np.empty(0, np.int64)
        self.long = False  # holds a word too long to be kept

    def _learn(self, words: set[str]) -> None:
        """Look up the new words in the lexicon, merge those it lacks, all at once."""
        fresh = words - self.keys()
        if len(self) + len(fresh) > KNOWN:
            self._forget()
            fresh = words
        if not fresh:
            return
        pairs = [(w, w.encode("utf-8", "replace")) for w in fresh]
        short = [(w, raw) for w, raw in pairs if len(raw) <= LONGEST]
        self.long |= len(short) < len(pairs)
        found = dict(zip((w for w, _ in short), self.lexicon.find_many([raw for _, raw in short])))
        rest = [w for w, _ in pairs if found.get(w) is None]
        found.update(zip(rest, self.bpe.merge_many(rest)))
        self.update(zip(found, range(len(self.start), len(self.start) + len(found))))
        size = np.fromiter(map(len, found.values()), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found.values()), np.int32, int(size.sum()))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, ids])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the texts in a row."""
        split = [self.bpe.words(t) if t else [] for t in texts]
        self._learn(set(chain.from_iterable(split)))
        words = np.array([len(some) for some in split])
        which = np.fromiter(map(self.__getitem__, chain.from_iterable(split)), np.int64, int(words.sum()))
        size = self.size[which]
        ends = np.cumsum(size)
        at = np.repeat(self.start[which] - ends + size, size) + np.arange(size.sum())
        offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(words)])]
        ids = self.flat[at]
        if self.long:
            self._forget()
        return offsets.astype(np.int32), ids


_OPEN: dict[str, _Known] = {}


def _known(vocabulary: bytes, lexicon: str) -> _Known:
    if lexicon not in _OPEN:
        _OPEN.clear()
        _OPEN[lexicon] = _Known(word_bpe.load(vocabulary), Lexicon(shared_path(lexicon)))
    return _OPEN[lexicon]


def word_counts(docs: DataFrame, vocabulary: bytes, text_col: str = "text") -> DataFrame:
    """(word, n) over all texts; words too long for the lexicon are left out."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, seen = word_bpe.load(shared.value), Counter()

        def out() -> pa.RecordBatch:
            rows = [(w, n) for w, n in seen.items() if len(w.encode("utf-8", "replace")) <= LONGEST]
            seen.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in rows], pa.string()),
                 pa.array([n for _, n in rows], pa.int64())], ["word", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column("text").to_pylist():
                    if text:
                        seen.update(bpe.words(text))
                if len(seen) >= KNOWN:
                    yield out()
        yield out()

    return (docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")))


def build_lexicon(docs: DataFrame, vocabulary: bytes, size: int = 65_536,
                  text_col: str = "text") -> str:
    """Compile the most frequent words of the corpus, ``size`` at most; returns the shared file's name.

    A histogram of counts (eight bins to a doubling) tells from which count on the
    words fit, so only those reach the driver. ``size`` bounds the file (some 40 bytes
    a word) and what the driver holds. It changes no result: words outside the lexicon
    are merged when met.
    """
    bpe = WordBpe(vocabulary)
    counts = settle(word_counts(docs, vocabulary, text_col).withColumn(
        "bin", F.floor(F.log2("n") * 8)), "word_counts")
    bins = {r["bin"]: r["count"] for r in counts.groupBy("bin").count().collect()}
    fitting, total = [], 0
    for bin_, n in sorted(bins.items(), reverse=True):
        total += n
        if total > size:
            break
        fitting.append(bin_)
    top = counts.where(F.col("bin") >= min(fitting)).select("word").collect() if fitting else []
    entries = {r["word"].encode(): bpe.merge(r["word"]) for r in top}
    return share_file(docs.sparkSession, compile_lexicon(entries), "lexicon")


def _encoder(shared, lexicon: str):
    """Batches with a ``text`` column to batches with ``ids`` in its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(shared.value, lexicon)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for part in slices(batch, "text", 1 << 21):
                offsets, flat = known.encode(part.column("text").to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield part.set_column(at, "ids", ids)

    return run


def _decoder(tokens: list[str], most: int = 1 << 20):
    """Batches with an ``ids`` column to batches with a ``decoded`` column more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(tokens, pa.string())
        for batch in batches:
            lens = pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_numpy()
            piece = (np.cumsum(lens.astype(np.int64)) - lens) // most
            edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                part = batch.slice(a, b - a)
                lists = part.column("ids")
                flat = lists.flatten()
                offsets = np.concatenate([[0], np.cumsum(lens[a:b])])
                good = pc.fill_null(pc.and_(pc.greater_equal(flat, 0),
                                            pc.less(flat, len(tokens))), False)
                if not pc.all(good, min_count=0).as_py():
                    kept = np.concatenate([[0], np.cumsum(good.to_numpy(zero_copy_only=False))])
                    offsets, flat = kept[offsets], flat.filter(good)
                strings = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), names.take(flat))
                yield part.append_column("decoded", pc.binary_join(strings, " "))

    return run


def encode(docs: DataFrame, vocabulary: bytes, lexicon: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of each whole text, without added special tokens.

    Defined cases: a NULL or empty text, or one of white space alone, has no ids. Special tokens
    spelled out in a text become their ids. Rows keep their number and repeat as
    they do; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_encoder(shared, lexicon), f"id {kind}, ids array<int>").withColumnRenamed(
        "id", id_col)


def decode(encoded: DataFrame, vocabulary: bytes, ids_col: str = "ids") -> DataFrame:
    """The rows with ``decoded``: token strings joined by one space, special tokens included.

    Ids that are NULL or not in the vocabulary have no string and are passed over;
    a NULL list decodes to the empty text.
    """
    rows = encoded.withColumnRenamed(ids_col, "ids")
    fields = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    return rows.mapInArrow(_decoder(WordBpe(vocabulary).tokens()), f"{fields}, decoded string"
                           ).withColumnRenamed("ids", ids_col)


def round_trip(docs: DataFrame, vocabulary: bytes, lexicon: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(id, ids, decoded): both directions in one pass, batch by batch."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    there, back = _encoder(shared, lexicon), _decoder(WordBpe(vocabulary).tokens())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: back(there(batches)),
                           f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)
