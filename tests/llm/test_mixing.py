import random
import re
from collections import Counter, defaultdict

import pytest

from rowloom.llm import mixing


def targets(sizes):
    """sizes: source -> words; shares by weight, capped, the excess shared again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    out, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        rate = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if rate * weight[s] >= 3 * sizes[s]}
        if not full:
            return out | {s: rate * weight[s] for s in open_}
        for s in full:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


@pytest.mark.parametrize("seed, block", [(1, 512), (2, 4)])
def test_targets_are_met_within_a_document(make, monkeypatch, seed, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    chance = random.Random(seed)
    docs = [(k, "w " * chance.randint(0, 30), chance.choice(["a"] * 6 + ["b", "B", "é", None])) for k in range(900)] + [(900, "one two", "tiny")]
    df = make(*docs)
    rows = mixing.plan_copies(df).collect()
    sizes, taken = Counter(), Counter()
    for _, t, s in docs:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t))
    expected = targets(sizes)
    assert len(rows) == len(docs)
    for r in rows:
        taken[r.source] += r.size * r.copies
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source]) and 0 <= r.copies <= 3
        assert abs(r.copies - r.target / r.source_size) < 1 or not r.size
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= 31, s
    assert sorted(map(str, rows)) == sorted(map(str, mixing.plan_copies(df).collect()))
    mixed = Counter(r.doc_id for r in mixing.mix(df).collect())
    assert mixed == Counter({r.doc_id: r.copies for r in rows})


def test_copies_are_unbiased(make):
    docs = [(k, "w " * (k % 7 + 1), "ab"[k % 2]) for k in range(60)]
    df, sums = make(*docs).select("doc_id", "text", "source").cache(), defaultdict(float)
    n = 12
    for seed in range(n):
        for r in mixing.plan_copies(df, seed=1000 * seed).collect():
            sums[r.source] += r.copies / n / 30
            rate = r.target / r.source_size
            assert r.copies in (int(rate), int(rate) + 1)
    assert sums["a"] == pytest.approx(targets({"a": 1, "b": 1})["a"], abs=0.12)


def test_awkward_and_empty(awkward, empty):
    rows = mixing.plan_copies(awkward).collect()
    assert sum(r.n_rows for r in rows) == awkward.count()
    assert all(r.copies == 1 for r in rows if r.size == 0)
    mixed = mixing.mix(awkward)
    assert mixed.columns == awkward.columns
    assert mixed.count() == sum(r.n_rows * r.copies for r in rows)
    assert mixing.mix(empty).count() == 0 and mixing.plan_copies(empty).count() == 0


def test_repeated_rows_meet_their_target(make):
    docs = [(1, "ten words " * 5, "a")] * 1000 + [(2, "one two three", "b")] * 700 + [(k, "w " * (k % 9), "ab"[k % 2]) for k in range(3, 60)]
    df, sizes, taken = make(*docs).repartition(5), Counter(), Counter()
    for _, t, s in docs:
        sizes[s] += len(t.split())
    rows, expected = mixing.plan_copies(df).collect(), targets(sizes)
    assert sum(r.n_rows for r in rows) == len(docs)
    for r in rows:
        taken[r.source] += r.size * r.copies * r.n_rows
        assert 0 <= r.copies <= 3
    assert all(abs(taken[s] - expected[s]) <= 10 for s in sizes)
    mixed = Counter(r.doc_id for r in mixing.mix(df).collect())
    planned = Counter()
    for r in rows:
        planned[r.doc_id] += r.copies * r.n_rows
    assert mixed == Counter({k: n for k, n in planned.items() if n})
