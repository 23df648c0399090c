import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

import brute
from conftest import odd_texts
from roentra.llm import bpe
from roentra.llm.queries import bpe_digests

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(vocabulary, texts):
    import numpy as np

    return [np.frombuffer(r, np.int32).tolist() for r in bpe.Encoder(vocabulary).encode(texts)]


def expected(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(), max_size=5))
def test_any_text(texts):
    vocabulary, library = bpe.Vocabulary(PATH) if not CACHE else CACHE[0], Tokenizer.from_file(PATH)
    CACHE[:] = [vocabulary]
    assert ids_of(vocabulary, texts) == expected(library, texts)


CACHE: list = []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "a", "the", "'s", "1", "é", "<|endoftext|>", "\x1c", " "])))
def test_spaces_and_marks(parts):
    vocabulary, library = bpe.Vocabulary(PATH) if not CACHE else CACHE[0], Tokenizer.from_file(PATH)
    CACHE[:] = [vocabulary]
    assert ids_of(vocabulary, ["".join(parts)]) == expected(library, ["".join(parts)])


def test_every_character_and_token(vocabulary, library):
    letters = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(map(chr, letters[i : i + 64])) for i in range(0, len(letters), 64)]
    texts += [t.decode("utf-8", "ignore") for t in vocabulary.token]
    assert ids_of(vocabulary, texts) == expected(library, texts)


def test_long_words(vocabulary, library):
    texts = ["a" * 5000, "ab" * 3000, "qzxj" * 800, " " * 999 + "x", "é" * 700, "=" * 1001]
    assert ids_of(vocabulary, texts) == expected(library, texts)


def test_wrong_proposals_are_merged_exactly(vocabulary):
    """Greedy longest match alone is wrong for some words, so the check matters."""
    words = [" atan", " hablend", " edorat", " thtion", " onstlyha"] + [f"x{i}ting" for i in range(500)]
    raw = [w.encode() for w in words]
    owner, tokens = vocabulary.propose(raw)
    right = [[*memoryview(i).cast("i")] for i in vocabulary.encode_words(words)]
    proposed = [tokens[owner == i].tolist() for i in range(len(words))]
    assert proposed != right
    assert [vocabulary.merge_long(r) for r in raw] == right


def test_memory_is_bounded(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_CHUNKS", 3)
    encoder = bpe.Encoder(vocabulary)
    for i in range(20):
        encoder.encode([f"w{i} x{i} y{i}"])
        assert len(encoder.after_space) <= 6 and len(encoder.as_is) <= 5


def test_encode_then_decode(spark, odd, vocabulary):
    ids = bpe.encode(odd, vocabulary)
    texts = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in bpe.decode(ids, vocabulary).collect())
    assert texts == sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in odd.collect())


def test_odd_rows(spark, odd, none, library):
    found = bpe_digests(odd).collect()
    assert len(found) == odd.count()
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    for i, text in enumerate(odd_texts()):
        ids = library.encode(text or "", add_special_tokens=False).ids
        row = by_id[i]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == brute.sha(",".join(map(str, ids)))
        assert row["decoded_sha256"] == brute.sha(library.decode(ids, skip_special_tokens=False))
    assert bpe_digests(none).collect() == []


def test_decode_of_any_ids(spark, vocabulary):
    rows = [(1, [220, 50256]), (2, []), (3, None), (4, [187])]
    found = bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), vocabulary)
    texts = {r["doc_id"]: r["text"] for r in found.collect()}
    assert texts == {1: " <|endoftext|>", 2: "", 3: "", 4: "�" if vocabulary.token[187][0] > 127 else vocabulary.token[187].decode()}
    with pytest.raises(Exception, match="outside"):
        bpe.decode(spark.createDataFrame([(1, [99999])], "doc_id long, ids array<int>"), vocabulary).collect()


def test_other_kinds_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
