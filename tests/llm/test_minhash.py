import random
import re

import numpy as np
import pytest

from rowloom.llm import minhash
from rowloom.llm.components import components
from rowloom.llm.superminhash import signatures


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else ({tuple(words)} if words else set())


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def brute(docs, size, percent):
    sets = {i: shingle_set(t, size) for i, t in docs}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {i: (len(sets[i]), r) for i, r in roots(ids, links).items()}


def copies(seed, groups=12, most=14):
    """Groups of texts with ever more changed words, so that some are just linked and some just not."""
    chance, out = random.Random(seed), []
    for _ in range(groups):
        words = [f"w{chance.randrange(400)}" for _ in range(chance.randint(1, 120))]
        for _ in range(chance.randint(1, most)):
            w = list(words)
            for _ in range(chance.randint(0, 6)):
                w[chance.randrange(len(w))] = f"w{chance.randrange(400)}"
            out.append(" ".join(x.upper() if chance.random() < 0.1 else x for x in w))
    chance.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("size, percent, seed", [(3, 85, 1), (5, 80, 2), (3, 85, 3)])
def test_against_brute_force(make, size, percent, seed):
    docs = copies(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(make(*((i, t, "a") for i, t in docs)), size=size, percent=percent).collect()}
    assert got == brute(docs, size, percent)


def test_a_large_group_is_compared_in_parts(make, monkeypatch):
    monkeypatch.setattr(minhash, "CHUNK", 4)
    docs = copies(5, groups=2, most=40)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(make(*((i, t, "a") for i, t in docs)), size=3, percent=85).collect()}
    assert got == brute(docs, 3, 85)


def test_signatures_estimate_similarity():
    chance, slots, off = np.random.default_rng(1), 64, []
    for n in (5, 40, 800):
        for _ in range(60):
            both = chance.integers(0, 2**63, n, dtype=np.uint64)
            a = np.concatenate([both, chance.integers(0, 2**63, n // 4, dtype=np.uint64)])
            table = signatures(np.concatenate([a, both]), np.repeat([0, 1], [len(a), n]), 2, slots)
            off.append((table[0] == table[1]).mean() - n / len(a))
    assert abs(np.mean(off)) < 0.01 and np.std(off) < (0.16 / slots) ** 0.5 * 1.1
    # one set at a time or many together
    sets = [chance.integers(0, 2**63, k, dtype=np.uint64) for k in (0, 1, 2, 30, 500)]
    together = signatures(np.concatenate(sets), np.repeat(range(5), [len(s) for s in sets]), 5, slots)
    for k, s in enumerate(sets[1:], 1):
        assert (signatures(s, np.zeros(len(s), np.int64), 1, slots)[0] == together[k]).all()


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    chance = random.Random(seed)
    links = [(chance.randrange(200), chance.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 360)] + [(None, 3), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == roots({n for x in real for n in x}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_and_empty(awkward, empty):
    got = minhash.near_duplicates(awkward)
    rows = got.collect()
    assert len(rows) == awkward.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.first))
    assert by[1] == [(10, 1, True)] * 2 and by[2] == [(10, 1, False)] and (10, 1, False) in by[None]
    assert by[3] == [(0, 3, True)] and by[4] == [(0, 4, True)] * 2 and by[5] == [(0, 5, True)] and by[8][0][1] == 7
    kept = minhash.keep_first(awkward)
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert kept.columns == awkward.columns
    assert ids == sorted([(False, k) for k in (1, 3, 4, 4, 5, 6, 7, 9, 10)] + [(True, 0), (True, 0)])
    assert minhash.near_duplicates(empty).count() == 0 and minhash.keep_first(empty).count() == 0
