"""Language of words and documents by a linear-chain conditional random field.

Each word of a text gets a language; features are affixes, character n-grams and a
lexicon, transitions between languages are learned. Forward-backward gives the
probability of each language at each word, so a text that switches language is
labelled piece by piece; a document's language is the one with most words, counted by
probability.

The field is fitted on a bounded sample of labelled documents. As labels are given by
document, the training sequences join stretches of different documents: the field
sees where languages meet.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rivulet.llm.common import slices

WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 16
BLOCK = 64  # words that are taken through the chain at once
KNOWN = 300_000  # words a worker remembers
MOST_ROWS = 20_000  # labelled rows that a fit sees in all
MOST_PAIRS = 20_000_000  # numbers in the fit's largest table: training sequences times pairs of languages
U = np.uint64


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    found = WORD.findall((text or "").lower())
    if not "".join(found).isalpha():  # number signs such as a superscript are no letters
        found = [w for w in ("".join(filter(str.isalpha, x)) for x in found) if w]
    return found


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x + U(salt * 0x9E3779B97F4A7C15 % 2 ** 64)) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(31))


def _same_size(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, their mask, word hashes) of words of about one length, whole words."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    width = int(lens.max())
    codes = np.zeros((len(words), width + 2), np.uint64)
    codes[:, 1:-1] = np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width)
    codes[:, 0] = 2
    codes[np.arange(len(words)), lens + 1] = 3  # ^ and $
    place = np.arange(width + 2)[None, :]
    features, masks = [], []
    gram = codes
    for n in (2, 3):  # character n-grams, word ends included
        gram = _mix(gram[:, :-1] * U(31) + codes[:, n - 1:], n)
        features.append(gram)
        masks.append(place[:, :gram.shape[1]] <= lens[:, None] + 2 - n)
    rows = np.arange(len(words))[:, None]
    for n in (3, 4):  # affixes
        for salt, start in ((10, np.ones(len(words), np.int64)), (20, np.maximum(lens - n + 1, 1))):
            at = start[:, None] + np.arange(n)[None, :]
            part = np.where(at <= lens[:, None], codes[rows, np.minimum(at, width + 1)], U(0))
            h = part[:, 0]
            for k in range(1, n):
                h = _mix(h * U(31) + part[:, k], salt + n)
            features.append(_mix(h, salt)[:, None])
            masks.append(np.ones((len(words), 1), bool))
    whole = np.zeros(len(words), np.uint64)
    for k in range(width + 2):
        whole = np.where(k <= lens + 1, _mix(whole * U(31) + codes[:, k], 5), whole)
    buckets = (np.concatenate(features, axis=1) >> U(40)) % U(BUCKETS)
    return buckets.astype(np.int64), np.concatenate(masks, axis=1), whole


def by_length(words: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Numbers and words in groups of similar length, so that no matrix is mostly empty."""
    groups: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        groups.setdefault(len(w) if len(w) > 48 else -(-len(w) // 4) * 4, []).append(k)
    for size, some in groups.items():
        step = max(1, 400_000 // size)
        for a in range(0, len(some), step):
            part = some[a:a + step]
            yield part, [words[k] for k in part]


@dataclass
class Field:
    """Learned weights; their size is fixed by the number of languages and the fit's bounds."""

    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages
    lexicon: np.ndarray  # sorted hashes of frequent words of the sample
    lexicon_weights: np.ndarray
    transitions: np.ndarray

    def lexicon_rows(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each word in the lexicon; the last row stands for absent."""
        if not len(self.lexicon):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == hashes, at, len(self.lexicon))

    def emissions(self, words: list[str]) -> np.ndarray:
        """Score of each language for each word."""
        out = np.zeros((len(words), len(self.languages)), np.float32)
        for part, some in by_length(words):
            buckets, mask, hashes = _same_size(some)
            score = self.lexicon_weights[self.lexicon_rows(hashes)]
            for k in range(buckets.shape[1]):
                score = score + self.weights[buckets[:, k]] * mask[:, k, None]
            out[part] = score
        return out


def marginals(scores: np.ndarray, lens: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Probability of each language at each word, by forward-backward over each text.

    ``scores`` holds the words of all texts in a row, ``lens`` their numbers (at least
    one each). Texts are cut into blocks; products of transfer matrices carry the
    messages over whole blocks, so texts of any length go through together.
    """
    k, move = scores.shape[1], np.exp(transitions - transitions.max()).astype(np.float64)
    blocks = -(-lens // BLOCK)
    first = np.cumsum(blocks) - blocks
    text = np.repeat(np.arange(len(lens)), lens)
    within = np.arange(len(scores)) - np.repeat(np.cumsum(lens) - lens, lens)
    row, col = first[text] + within // BLOCK, within % BLOCK
    total = int(blocks.sum())
    emit = np.ones((BLOCK, total, k))
    emit[col, row] = np.exp(scores - scores.max(axis=1, keepdims=True))
    real = np.zeros((BLOCK, total), bool)
    real[col, row] = True
    opening = np.zeros(total, bool)
    opening[first] = True  # its first word has no word before

    def step(x: np.ndarray, t: int) -> np.ndarray:
        """Rows of ``x`` taken over word t of each block; a missing word changes nothing."""
        moved = x @ move
        if t == 0:
            moved = np.where(opening.reshape(-1, *[1] * (x.ndim - 1)), x, moved)
        moved = moved * (emit[t] if x.ndim == 2 else emit[t][:, None, :])
        return np.where(real[t].reshape(-1, *[1] * (x.ndim - 1)), moved, x)

    def scaled(x: np.ndarray, t: int = 3) -> np.ndarray:
        """Now and then brought back to a largest value of 1; doubles hold four words with ease."""
        return x / x.max(axis=tuple(range(1, x.ndim)), keepdims=True) if t % 4 == 3 else x

    over = np.broadcast_to(np.eye(k), (total, k, k)).copy()
    for t in range(BLOCK):
        over = scaled(step(over, t), t)
    enter, leave = np.full((total, k), 1.0 / k), np.ones((total, k))
    for j in range(1, int(blocks.max())):
        some = first[blocks > j] + j
        enter[some] = scaled(np.einsum("nk,nkl->nl", enter[some - 1], over[some - 1]))
    for j in range(int(blocks.max()) - 2, -1, -1):
        some = first[blocks > j + 1] + j
        leave[some] = scaled(np.einsum("nkl,nl->nk", over[some + 1], leave[some + 1]))
    forward = np.empty((BLOCK, total, k))
    x = enter
    for t in range(BLOCK):
        x = forward[t] = scaled(step(x, t), t)
    x = leave
    for t in range(BLOCK - 1, -1, -1):
        forward[t] *= x
        back = (x * emit[t]) @ move.T
        if t == 0:
            break
        x = np.where(real[t][:, None], scaled(back, t), x)
    out = forward[col, row]
    return out / out.sum(axis=1, keepdims=True)


def _sequences(docs: list[list[int]], labels: list[int], rng: np.random.Generator, length: int
               ) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and labels of training sequences: stretches of random documents in turn."""
    pieces = []
    for words, label in zip(docs, labels):
        at = 0
        while at < len(words):
            n = int(rng.geometric(1 / 20))
            pieces.append((words[at:at + n], label))
            at += n
    some = [pieces[k] for k in rng.permutation(len(pieces))]
    flat = np.array([w for p, _ in some for w in p], np.int64)
    gold = np.repeat([y for _, y in some], [len(p) for p, _ in some])
    whole = len(flat) // length * length
    return flat[:whole].reshape(-1, length), gold[:whole].reshape(-1, length)


def fit(texts: list[str], langs: list[str], rounds: int = 25, seed: int = 3, length: int = 50,
        lexicon_size: int = 20_000, shrink: float = 1e-4) -> Field:
    """Maximum likelihood with a quadratic penalty, by adaptive gradient steps."""
    languages = sorted(set(langs))
    number: dict[str, int] = {}
    docs = [[number.setdefault(w, len(number)) for w in words_of(t)] for t in texts]
    words = list(number)
    k = len(languages)
    counts = np.bincount([w for d in docs for w in d], minlength=len(words))
    buckets, owners, hashes = [], [], np.zeros(len(words), np.uint64)
    for part, some in by_length(words):
        b, mask, h = _same_size(some)
        buckets.append(b[mask])
        owners.append(np.broadcast_to(np.array(part)[:, None], mask.shape)[mask])
        hashes[part] = h
    frequent = np.sort(np.argsort(-counts, kind="stable")[:lexicon_size])
    frequent = frequent[counts[frequent] > 2]
    lexicon = np.unique(hashes[frequent])
    field = Field(languages, np.zeros((BUCKETS, k), np.float32), lexicon,
                  np.zeros((len(lexicon) + 1, k), np.float32), np.zeros((k, k)))
    if not words or k < 2:
        return field
    bucket, owner = np.concatenate(buckets), np.concatenate(owners)
    in_lexicon = field.lexicon_rows(hashes)
    seq, gold = _sequences(docs, [languages.index(x) for x in langs],
                           np.random.default_rng(seed), length)
    if not len(seq):
        return field
    if len(seq) * k * k > MOST_PAIRS:
        some = np.random.default_rng(seed).permutation(len(seq))[:max(1, MOST_PAIRS // (k * k))]
        seq, gold = seq[some], gold[some]
    observed = np.stack([np.bincount(seq[gold == y], minlength=len(words)) for y in range(k)], 1)
    turns = np.zeros((k, k))
    np.add.at(turns, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
    speeds = [np.full_like(x, 1e-6) for x in (field.weights, field.lexicon_weights, field.transitions)]
    n = seq.size
    for _ in range(rounds):
        scores = field.lexicon_weights[in_lexicon].astype(np.float64)
        for y in range(k):
            scores[:, y] += np.bincount(owner, field.weights[bucket, y], len(words))
        emit = np.exp(scores - scores.max(axis=1, keepdims=True))[seq]
        move = np.exp(field.transitions)
        forward = np.empty((length, len(seq), k))
        x = emit[:, 0] / emit[:, 0].sum(axis=1, keepdims=True)
        forward[0] = x
        for t in range(1, length):
            x = (x @ move) * emit[:, t]
            x = forward[t] = x / x.sum(axis=1, keepdims=True)
        back = np.ones((len(seq), k))
        expected = np.zeros((len(words), k))
        expected_turns = np.zeros((k, k))
        for t in range(length - 1, -1, -1):
            here = forward[t] * back
            here /= here.sum(axis=1, keepdims=True)
            for y in range(k):
                expected[:, y] += np.bincount(seq[:, t], here[:, y], len(words))
            if t:
                ahead = emit[:, t] * back
                pair = forward[t - 1][:, :, None] * move * ahead[:, None, :]
                expected_turns += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                back = ahead @ move.T
                back /= back.sum(axis=1, keepdims=True)
        slope = (observed - expected) / n
        by_bucket = np.stack([np.bincount(bucket, slope[owner, y], BUCKETS) for y in range(k)], 1)
        by_word = np.stack([np.bincount(in_lexicon, slope[:, y], len(lexicon) + 1) for y in range(k)], 1)
        by_word[-1] = 0
        steps = by_bucket, by_word, (turns - expected_turns) / n
        for value, step, speed in zip((field.weights, field.lexicon_weights, field.transitions),
                                      steps, speeds):
            step = step - shrink * value / n ** 0.5
            speed += (step * step).astype(speed.dtype)
            value += (0.3 * step / np.sqrt(speed)).astype(value.dtype)
    return field


def sample_rows(docs: DataFrame, per_language: int, most_chars: int) -> list:
    """Labelled texts for the fit: about ``per_language`` of each language, by a hash of the text.

    A text is drawn or not whatever number of rows hold it, and comes once. Of a longer
    text a stretch of ``most_chars`` comes, from a place that its hash names.
    """
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(
        "lang", "text", F.xxhash64("text").alias("hash"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(
        F.countDistinct("hash").alias("n")).collect()}
    if not counts:
        return []
    each = max(1, min(per_language, MOST_ROWS // len(counts)))
    draw: Column = F.pmod(F.xxhash64("hash"), F.lit(1 << 40)) / float(1 << 40)
    share = F.element_at(F.create_map(*[x for lang, n in sorted(counts.items()) for x in (
        F.lit(lang), F.lit(min(1.0, each / n)))]), F.col("lang"))
    start = F.pmod("hash", F.greatest(F.lit(1), F.char_length("text") - most_chars + 1)).cast("int") + 1
    return rows.where(draw < share).select("lang", F.substr("text", start, F.lit(most_chars)).alias("text")
                                           ).distinct().limit(2 * each * len(counts)).collect()


def fit_field(labelled: DataFrame, per_language: int = 200, most_chars: int = 32_768) -> Field:
    """Fit on a bounded sample of (text, lang).

    About ``per_language`` different texts of each language come to the driver, at most
    MOST_ROWS in all and ``most_chars`` characters of each; MOST_PAIRS bounds what the fit
    makes of them. Those bounds are its whole appetite. Rows without text or lang teach
    nothing; without any the field knows no language.
    """
    rows = sorted(sample_rows(labelled, per_language, most_chars), key=lambda r: (r["text"], r["lang"]))
    return fit([r["text"] for r in rows], [r["lang"] for r in rows])


class _Known(dict):
    """Emission rows by word, for one field."""

    def __init__(self, field: Field):
        super().__init__()
        self.field, self.scores = field, np.zeros((0, len(field.languages)), np.float32)

    def of(self, words: list[str]) -> np.ndarray:
        fresh = sorted(set(words) - self.keys())
        if fresh:
            if len(self) + len(fresh) > KNOWN:
                self.clear()
                fresh = sorted(set(words))
                self.scores = self.scores[:0]
            base = len(self.scores)
            self.scores = np.concatenate([self.scores, self.field.emissions(fresh)])
            self.update(zip(fresh, range(base, base + len(fresh))))
        return self.scores[np.fromiter(map(self.__getitem__, words), np.int64, len(words))]


def label_texts(field: Field, known: _Known, texts: list[str | None]) -> tuple[list, list]:
    """(words, marginals) of each text."""
    split = [words_of(t) for t in texts]
    flat = [w for words in split for w in words]
    if not flat or not field.languages:
        return split, [None] * len(split)
    lens = np.array([len(w) for w in split])
    p = marginals(known.of(flat).astype(np.float64), lens[lens > 0], field.transitions)
    cuts = np.cumsum(lens)
    return split, [p[b - n:b] if n else None for n, b in zip(lens.tolist(), cuts.tolist())]


def label_languages(docs: DataFrame, field: Field, text_col: str = "text", words: bool = False
                    ) -> DataFrame:
    """The rows with ``lang_pred`` and ``score``; with ``words``, also each word's language.

    ``score`` is the share of the document's words in that language, by probability.
    ``word_langs`` holds runs of words of one language: lang and number of words.

    Defined cases: a text that is NULL, empty or without a letter is ``und`` with score
    0, and so is every text if the field knows no language. Equal shares go to the
    language first in order of names. Rows and their columns are kept; columns that
    are named like the new ones are replaced.
    """
    new = ["lang_pred", "score", *(["word_langs"] if words else [])]
    rows = docs.drop(*new)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        known = _Known(field)
        for batch in batches:
            for part in slices(batch, text_col, 1 << 21):
                _, all_p = label_texts(field, known, part.column(text_col).to_pylist())
                langs, scores, runs = [], [], []
                for p in all_p:
                    if p is None:
                        langs.append("und")
                        scores.append(0.0)
                        runs.append([])
                        continue
                    share = p.mean(axis=0)
                    langs.append(field.languages[int(share.argmax())])
                    scores.append(min(1.0, float(share.max())))
                    if words:
                        best = p.argmax(axis=1)
                        first = np.flatnonzero(np.diff(best, prepend=-1))
                        size = np.diff(np.append(first, len(best)))
                        runs.append([{"lang": field.languages[b], "words": int(n)}
                                     for b, n in zip(best[first], size)])
                columns = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
                if words:
                    columns.append(pa.array(runs, pa.list_(pa.struct(
                        [("lang", pa.string()), ("words", pa.int64())]))))
                yield pa.RecordBatch.from_arrays([*part.columns, *columns],
                                                 [*part.schema.names, *new])

    fields = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    kinds = ["string", "double", "array<struct<lang:string,words:bigint>>"][:len(new)]
    return rows.mapInArrow(run, ", ".join([fields, *(f"{c} {t}" for c, t in zip(new, kinds))]))


def language_verdicts(spark: SparkSession, field: Field):
    """A function of a text column: struct of lang_pred, score (as ``label_languages`` has them) and evidence.

    ``evidence`` is 0 where the field tells no language from another in any word, and 1 where it
    is sure of each word's language, whichever: the mean over words of the greatest probability,
    scaled from 1 / languages to 1. Texts in several languages have it as well as others.
    """
    shared = spark.sparkContext.broadcast(field)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("evidence", pa.float64())])

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        field = shared.value
        known, chance = _Known(field), 1 / max(2, len(field.languages))
        for column in columns:
            batch, out = pa.RecordBatch.from_arrays([column], ["text"]), []
            for part in slices(batch, "text", 1 << 21):
                for p in label_texts(field, known, part.column("text").to_pylist())[1]:
                    if p is None:
                        out.append(("und", 0.0, 0.0))
                        continue
                    share = p.mean(axis=0)
                    sure = (float(p.max(axis=1).mean()) - chance) / (1 - chance)
                    out.append((field.languages[int(share.argmax())], min(1.0, float(share.max())),
                                min(1.0, max(0.0, sure))))
            yield pa.StructArray.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(kind)],
                                             fields=list(kind))

    return F.arrow_udf(run, "lang_pred string, score double, evidence double")
