import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowloom.llm import fingerprints as f


def words(chance, n):
    return " ".join("".join(chance.choice("abcdefghijklmno") for _ in range(chance.randint(2, 9))) for _ in range(n))


@given(st.lists(st.text(alphabet="ab é😀", max_size=40), max_size=8))
@settings(max_examples=200, deadline=None)
def test_batches_do_not_matter(texts):
    together = f.sketches(texts)
    assert len(together) == len(texts)
    for t, s in zip(texts, together):
        assert (f.sketches([t])[0] == s).all() and (len(s) > 0) == (t != "")


def test_equal_substrings_share_phrases_at_any_offset():
    chance = random.Random(1)
    shared = words(chance, 400)
    a, b = (f.phrases([words(chance, n) + " " + shared + " " + words(chance, n)])[0] for n in (7, 30))
    alone = np.unique(f.phrases([shared])[0])
    for names in (a, b):
        assert np.isin(alone, names).mean() > 0.9
    assert np.isin(np.unique(a), np.unique(f.phrases([words(chance, 400)])[0])).mean() < 0.1


def test_long_runs_and_long_texts_end():
    assert len(f.sketches(["a" * 200_000, "ab" * 100_000, "x"])) == 3


def brute(docs):
    """docs: (id, text) with distinct ids."""
    docs = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0), reverse=True)
    out = {}
    for (i, t), (_, n) in zip(docs, docs[1:] + docs[:1]):
        t, n = t or "", n or ""
        k = len(t) // 3
        e = t[: len(t) - k] + n[:k]
        own, new, other = f.sketches([t, e, n])
        out[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), own.tobytes().hex(), new.tobytes().hex(), f.likeness(own, new), f.likeness(own, other))
    return out


@pytest.mark.parametrize("parts, at_once", [("8", 1_000_000), ("3", 500)])
def test_next_documents(spark, make, monkeypatch, parts, at_once):
    monkeypatch.setattr(f, "AT_ONCE", at_once)
    chance = random.Random(2)
    docs = [(k * 3, words(chance, chance.randint(0, 60)) if k % 9 else None) for k in range(150)] + [(None, words(chance, 20))]
    docs += [(1, docs[20][1]), (2, "")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = f.fingerprint_changes(make(*((i, t, "a") for i, t in docs))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(rows) == len(docs)
    assert {r.doc_id: tuple(r[1:]) for r in rows} == brute(docs)
    assert all(r.near_edited > r.near_next for r in rows if r.n_chars > 150)


def test_one_document_follows_itself(make):
    row = f.fingerprint_changes(make((1, "abcdef ghijkl mnopqr", "a"))).first()
    assert row.near_next == 1.0


def test_awkward_and_empty(awkward, empty):
    rows = f.fingerprint_changes(awkward).collect()
    assert len(rows) == awkward.count()
    texts = {}
    for r in rows:
        texts.setdefault(r.fingerprint, set()).add(r.n_chars)
    assert texts[""] == {0} and all(len(v) == 1 for v in texts.values())
    assert f.fingerprint_changes(empty).count() == 0
