"""Encoding, decoding and counting against the tokenizers library."""

from __future__ import annotations

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from rivulet.llm import bpe, token_counts
from rivulet.llm.word_bpe import WordBpe

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, ids string, decoded int, n_tokens string, row string"
PIECES = ["a", "B", "é", "É", "ß", "İ", "Σ", "ς", "ΑΣ", "ﬁ", " ", "  ", "\n", "\x1c", "\x85", "\xa0", "　",
          "​", "'s", "'re", "'", "!!", "?", "12", "²", "½", "Ⅷ", "一", "五", "한글", "ᄒ", "ᅡ", "é",
          "J̌", "🙂", "<|endoftext|>", "<|startoftext|>", "<|end", "_", "\x00", "ẞ", "क्", " ", "K"]


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    rows = [(0, None), (1, ""), (2, " \n "), (3, "The same row"), (3, "The same row"), (None, "no id")]
    rows += [(10 + k, "".join(rng.choice(PIECES, rng.integers(1, 15)))) for k in range(300)]
    rows += [(400, "x" * 3000), (401, "word " * 3000), (402, "".join(rng.choice(list("abcdeé"), 5000))),
             (403, "<|endoftext|> and more " * 200)]
    return rows


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "i", 1, "n", "r") for i, t in rows], SCHEMA)


def test_merges_of_any_length(vocabulary, library):
    own, rng = WordBpe(vocabulary), np.random.default_rng(1)
    for n in (1, 2, 40, 63, 64, 65, 199, 200, 201, 4000):
        text = "".join(rng.choice(list("abcdefghié"), n))
        ids = [i for w in own.words(text) for i in own.merge(w)]
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert ids == [i for some in own.merge_many(own.words(text)) for i in some]


def test_transducer_holds_what_it_was_given(tmp_path):
    words = ["a", "ab", "abc", "b", "bc", "xbc", "é", "walking", "talking", "walked", "talked"]
    entries = {w.encode(): tuple(range(k, k + k % 3 + 1)) for k, w in enumerate(words)}
    (tmp_path / "lexicon").write_bytes(bpe.compile_lexicon(entries))
    lexicon = bpe.Lexicon(str(tmp_path / "lexicon"))
    assert len(lexicon) == len(words)
    assert {w: lexicon.find(w) for w in entries} == entries
    some = [*entries, b"", b"abcd", b"wal", b"zz", b"a\0"]
    assert lexicon.find_many(some) == [lexicon.find(w) for w in some]
    for absent in (b"", b"abcd", b"wal", b"c", b"zz", b"bcc"):
        assert lexicon.find(absent) is None
    # walk and talk share their endings: fewer arcs than a tree of prefixes has
    assert len(lexicon.labels) < sum(len({w[:k] for w in entries for k in [n] if len(w) >= n})
                                     for n in range(1, 8))


def test_transducer_of_nothing(tmp_path):
    (tmp_path / "empty").write_bytes(bpe.compile_lexicon({}))
    assert bpe.Lexicon(str(tmp_path / "empty")).find(b"a") is None


@pytest.mark.parametrize("size", [0, 5, 1000])
def test_round_trip(spark, vocabulary, library, texts, size):
    docs = docs_of(spark, texts)
    lexicon = bpe.build_lexicon(docs, vocabulary, size=size)
    got = sorted(((r["doc_id"], r["ids"], r["decoded"]) for r in bpe.round_trip(
        docs, vocabulary, lexicon).collect()), key=repr)
    want = []
    for i, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=repr)


def test_encode_then_decode(spark, vocabulary, library):
    docs = docs_of(spark, [(1, "Some text, twice."), (2, None)])
    encoded = bpe.encode(docs, vocabulary, bpe.build_lexicon(docs, vocabulary))
    got = {r["doc_id"]: (r["ids"], r["decoded"]) for r in bpe.decode(encoded, vocabulary).collect()}
    ids = library.encode("Some text, twice.", add_special_tokens=False).ids
    assert got == {1: (ids, library.decode(ids)), 2: ([], "")}
    odd = spark.createDataFrame([(1, [ids[0], None, 10 ** 6, -1, ids[1]]), (2, None)],
                                "doc_id bigint, ids array<int>")
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode(odd, vocabulary).collect()}
    assert got == {1: library.decode(ids[:2]), 2: ""}
    assert bpe.encode(docs.where("false"), vocabulary, bpe.build_lexicon(docs, vocabulary)).count() == 0


@pytest.mark.parametrize("chunk,overlap", [(32_768, 512), (64, 8), (300, 20)])
def test_token_counts(spark, vocabulary, library, texts, chunk, overlap):
    got = sorted((tuple(r) for r in token_counts.token_counts(
        docs_of(spark, texts), vocabulary, chunk_chars=chunk, overlap_chars=overlap).collect()), key=repr)
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
            for i, t in texts]
    assert got == sorted(want, key=repr)


def test_token_counts_of_nothing(spark, vocabulary):
    assert token_counts.token_counts(docs_of(spark, []), vocabulary).count() == 0


def test_other_vocabularies_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f, pytest.raises(ValueError):
        WordBpe(f.read())


def test_words_that_come_again_are_not_merged_again(vocabulary, library, monkeypatch):
    """New words push out those of long ago, not the frequent ones."""
    monkeypatch.setattr(token_counts, "KNOWN", 16)
    bpe_, merged = WordBpe(vocabulary), []
    whole = bpe_.merge_many
    monkeypatch.setattr(bpe_, "merge_many", lambda words: merged.extend(words) or whole(words))
    counts = token_counts._Counts(bpe_)
    texts = [f"the water of {a}x{a} {a}y{a} {a}z{a}" for a in "abcdefghijklmnopqrst"] + ["", " ", "w" * 80]
    for text in texts:
        assert counts.of_all([text]) == [len(library.encode(text, add_special_tokens=False).ids)]
        assert len(counts.young) + len(counts.old) <= 2 * token_counts.KNOWN
    assert [merged.count(w) for w in ("the", "water", "of")] == [1, 1, 1]
    assert counts.of_all(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert counts.of_all([]) == []
