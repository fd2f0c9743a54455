import hashlib
import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rowloom.llm import piece_encoding, token_counts
from rowloom.llm.queries import PIECE_VOCABULARY, WORD_VOCABULARY

ODD = st.text(alphabet=st.one_of(st.sampled_from(" \n\t▁<s>/abtheSΣİé😀　\x00'"), st.characters(exclude_categories=["Cs"])), max_size=30)


@pytest.fixture(scope="module")
def encoder():
    return piece_encoding.Encoder(piece_encoding.model_bytes(PIECE_VOCABULARY))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_VOCABULARY)


@pytest.fixture(scope="module")
def rules():
    return token_counts.read_rules(WORD_VOCABULARY)


@given(text=ODD)
@settings(max_examples=500, deadline=None)
def test_ids_and_round_trip(encoder, library, text):
    ids, decoded = next(encoder.encoded([text]))
    theirs = library.encode(text) + [library.eos_id()]
    assert ids == " ".join(map(str, theirs)) and decoded == library.decode(theirs)


@given(text=ODD)
@settings(max_examples=500, deadline=None)
def test_counts(rules, text):
    counter, tokenizer = token_counts._counter(rules), Tokenizer.from_str(rules.file)
    assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_specials_and_proof(rules):
    counter, tokenizer = token_counts._counter(rules), Tokenizer.from_str(rules.file)
    chance = random.Random(3)
    for _ in range(300):
        text = "".join(chance.choice(["<|startoftext|>", "<|endoftext|>", "<|endof", "a b", "The ", "'s"]) for _ in range(6))
        assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)
    for entry in list(rules.whole)[:300]:
        assert token_counts.merged(entry, rules.ranks, rules.word_end) == [entry + rules.word_end]


def test_one_long_word(encoder, library, rules):
    text = "abcdefghij" * 3000
    assert next(encoder.encoded([text]))[0] == " ".join(map(str, library.encode(text) + [2]))
    assert token_counts._counter(rules).count(text) == len(Tokenizer.from_str(rules.file).encode(text, add_special_tokens=False).ids)


def test_full_memory_is_emptied(encoder, library, rules, monkeypatch):
    monkeypatch.setattr(piece_encoding, "REMEMBERED", 5)
    monkeypatch.setattr(token_counts, "REMEMBERED", 5)
    texts = [f"word{k} and some more words {k}" for k in range(50)]
    own = piece_encoding.Encoder(piece_encoding.model_bytes(PIECE_VOCABULARY))
    assert [ids for ids, _ in own.encoded(texts, limit=10)] == [" ".join(map(str, library.encode(t) + [2])) for t in texts]
    tokenizer, counter = Tokenizer.from_str(rules.file), token_counts.Counter(rules)
    assert [counter.count(t) for t in texts] == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_a_wrong_encoding_is_noticed(encoder):
    with pytest.raises(ValueError):
        encoder.vocabulary.agrees([" the"], [[1, 2, 3]])


def test_tables(awkward, empty, library, rules):
    counted = token_counts.count_tokens(awkward, "text", WORD_VOCABULARY).collect()
    tokenizer = Tokenizer.from_str(rules.file)
    assert len(counted) == awkward.count()
    assert all(r.n_tokens == len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in counted)
    for r in piece_encoding.encode(awkward, "text", PIECE_VOCABULARY).collect():
        ids = library.encode(r.text or "") + [library.eos_id()]
        assert r.encoded.ids == ids and r.encoded.decoded == library.decode(ids)
    for r in piece_encoding.digests(awkward, "text", PIECE_VOCABULARY, "d").collect():
        ids = library.encode(r.text or "") + [library.eos_id()]
        assert r.d.n_tokens == len(ids) and r.d.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert token_counts.count_tokens(empty, "text", WORD_VOCABULARY).count() == 0
    assert piece_encoding.encode(empty, "text", PIECE_VOCABULARY).count() == 0
