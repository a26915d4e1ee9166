"""A vocabulary of merges over words: splitting a text, merging a word, naming ids.

Reads the JSON files of the public ``tokenizers`` format whose model is BPE with a
word-end mark, lower-casing, and words free of white space. Anything else in such a
file is refused, as its ids would differ.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections import defaultdict

import numpy as np
import regex

# The split pattern and the word-end mark of the vocabulary file.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"

ANY_SCRIPT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_LETTER, _NUMBER, _SPACE = "a-zA-ZªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
LATIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+")
BEYOND_LATIN = re.compile("[^\x00-ɏ]")


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if visible, else the next from 256 on."""
    visible = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1),
               *range(ord("®"), ord("ÿ") + 1)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


def lowered(text: str) -> str:
    """Lower case character by character: a final sigma is no special case."""
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


class WordBpe:
    """``words`` splits, ``merge`` gives a word's ids, ``tokens`` names them."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if (model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END
                or steps != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None
                or [x["type"] for x in splits] != ["Split", "ByteLevel"]
                or splits[0]["pattern"] != {"Regex": SPLIT}):
            raise ValueError("this vocabulary file is of another kind")
        self.vocab: dict[str, int] = model["vocab"]
        pairs = (x if isinstance(x, list) else x.split(" ") for x in model["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(pairs)}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.specials = re.compile("(" + "|".join(
            map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.mark = re.compile("|".join({re.escape(x[:2]) for x in self.special}) or "(?!)")
        self.chars = byte_characters()
        # the merges as sorted pairs of ids, for many words at once
        pair = np.array([self.vocab[a] << 20 | self.vocab[b] for a, b in self.ranks], np.int64)
        self.pair_order = np.argsort(pair).astype(np.int32)
        self.pairs = pair[self.pair_order]
        self.merged = np.array([self.vocab[a + b] for a, b in self.ranks], np.int32)
        self.inner = np.array([self.vocab.get(c, -1) for c in self.chars], np.int32)
        self.closing = np.array([self.vocab.get(c + WORD_END, -1) for c in self.chars], np.int32)

    def words(self, text: str) -> list[str]:
        """The words of a text in order; a special token's string is one word."""
        if self.specials and self.mark.search(text) and self.specials.search(text):
            found = []
            for k, part in enumerate(self.specials.split(text)):
                found += [part] if k % 2 else self._plain(part)
            return found
        return self._plain(text)

    @staticmethod
    def _plain(text: str) -> list[str]:
        text = lowered(unicodedata.normalize("NFC", text))
        return (ANY_SCRIPT if BEYOND_LATIN.search(text) else LATIN).findall(text)

    def merge(self, word: str) -> tuple[int, ...]:
        """Ids of one word: the merge of lowest rank first, of equal ones the leftmost."""
        if word in self.special:
            return (self.special[word],)
        parts = [self.chars[b] for b in word.encode("utf-8", "replace")]
        parts[-1] += WORD_END
        parts = [p for p in parts if p in self.vocab]
        parts = self._merge_short(parts) if len(parts) < 200 else self._merge_long(parts)
        return tuple(map(self.vocab.__getitem__, parts))

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; the number of merges if there is none."""
        key = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_order[at], np.int32(len(self.merged)))

    def merge_many(self, words: list[str]) -> list[tuple[int, ...]]:
        """``merge`` of each word. Words of one length go through their merges together."""
        out: list[tuple[int, ...] | None] = [None] * len(words)
        by_length = defaultdict(list)
        for k, word in enumerate(words):
            raw = word.encode("utf-8", "replace")
            if word in self.special or len(raw) > 64:
                out[k] = self.merge(word)
            else:
                by_length[len(raw)].append((k, raw))
        for size, some in by_length.items():
            number = np.array([k for k, _ in some])
            codes = np.frombuffer(b"".join(raw for _, raw in some), np.uint8).reshape(-1, size)
            ids = self.inner[codes]
            ids[:, -1] = self.closing[codes[:, -1]]
            for k in number[(ids < 0).any(axis=1)].tolist():  # a byte that the vocabulary lacks
                out[k] = self.merge(words[k])
            known = (ids >= 0).all(axis=1)
            self._merge_block(ids[known], number[known], out)
        return out

    def _merge_block(self, ids: np.ndarray, number: np.ndarray, out: list) -> None:
        """Each round every row makes its next merge and gets one id shorter, or is done."""
        ranks = self._pair_ranks(ids[:, :-1], ids[:, 1:])
        while len(ids):
            width = ids.shape[1]
            at = ranks.argmin(axis=1) if width > 1 else np.zeros(len(ids), np.int64)
            rows = np.arange(len(ids))
            low = ranks[rows, at] if width > 1 else np.full(len(ids), len(self.merged))
            done = low == len(self.merged)
            for k, row in zip(number[done].tolist(), ids[done].tolist()):
                out[k] = tuple(row)
            ids, ranks, number, at, low = (x[~done] for x in (ids, ranks, number, at, low))
            if not len(ids):
                return
            rows, cols = np.arange(len(ids)), np.arange(width)[None, :]
            ids[rows, at] = self.merged[low]
            ids = ids[cols != at[:, None] + 1].reshape(-1, width - 1)
            if width > 2:
                ranks = ranks[cols[:, :-1] != at[:, None]].reshape(-1, width - 2)
                for side in (at - 1, at):  # the pairs on both sides of the new id
                    has = (side >= 0) & (side < width - 2)
                    r, c = rows[has], side[has]
                    ranks[r, c] = self._pair_ranks(ids[r, c], ids[r, c + 1])
            else:
                ranks = ranks[:, :0]

    def _merge_short(self, parts: list[str]) -> list[str]:
        rank, never = self.ranks.get, len(self.ranks)
        ranks = [rank(p, never) for p in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) < never:
            i = ranks.index(low)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), never)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), never)
        return parts

    def _merge_long(self, parts: list[str | None]) -> list[str]:
        """The same merges with a heap, for words of any length."""
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in self.ranks]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or self.ranks.get((parts[i], parts[j])) != rank:
                continue  # a merge since then has changed this pair
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n:
                    fresh = self.ranks.get((parts[left], parts[after[left]]))
                    if fresh is not None:
                        heapq.heappush(heap, (fresh, left))
        return [p for p in parts if p is not None]

    def tokens(self) -> list[str]:
        """The string of each id; unused ids are empty."""
        named = self.vocab | self.special
        out = [""] * (max(named.values()) + 1)
        for token, i in named.items():
            out[i] = token
        return out


_LOADED: dict[int, WordBpe] = {}


def load(data: bytes) -> WordBpe:
    """The vocabulary, parsed once in a Python worker."""
    if hash(data) not in _LOADED:
        _LOADED.clear()
        _LOADED[hash(data)] = WordBpe(data)
    return _LOADED[hash(data)]
