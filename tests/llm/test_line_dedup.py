import random
import re
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowloom.llm.common import WORD
from rowloom.llm.line_dedup import MIN_CHARS, dedup_lines, variants


@lru_cache(None)
def near(a, b):
    """Edit distance of at most one, by definition."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    """docs: (id, text) in order; the texts that stay."""
    standing = {}
    for i, (_, text) in enumerate(docs):
        for k, line in enumerate((text or "").split("\n")):
            if re.search(WORD, line):
                standing.setdefault(line, (i, k))
    gone = {x for x in standing for y in standing if min(len(x), len(y)) >= MIN_CHARS and standing[y] < standing[x] and near(x, y)}
    return [
        "\n".join(x for k, x in enumerate(t.split("\n")) if x not in standing or (standing[x] == (i, k) and x not in gone)) if t is not None else None
        for i, (_, t) in enumerate(docs)
    ]


@given(st.text(alphabet="ab😀é", max_size=12))
@settings(max_examples=200, deadline=None)
def test_variants_are_hashes_of_deletions(line):
    v = variants(line).tolist()
    assert len(v) == len(line) + 1
    for i in range(len(line)):
        assert v[i] == variants(line[:i] + line[i + 1 :]).tolist()[-1]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(make, seed):
    chance = random.Random(seed)
    base = ["".join(chance.choice("abcd é") for _ in range(chance.randint(18, 26))) for _ in range(25)]

    def line():
        x = chance.choice(base)
        for _ in range(chance.choice([0, 0, 1, 1, 2])):
            i = chance.randrange(len(x))
            x = chance.choice([x[:i] + x[i + 1 :], x[:i] + "z" + x[i:], x[:i] + "y" + x[i + 1 :]])
        return x

    docs = [(k, "\n".join(line() for _ in range(chance.randint(1, 6)))) for k in range(60)]
    got = {r.doc_id: r.text for r in dedup_lines(make(*((i, t, "a") for i, t in docs))).collect()}
    assert [got[i] for i, _ in docs] == brute(docs)


def test_counts_and_short_lines(make):
    same = "a line that is long enough"
    got = dedup_lines(make((2, f"{same}\nshort\nshort", "a"), (1, f"{same}!\nother line, also long enough", "a"), (3, same, "a"))).collect()
    by = {r.doc_id: (r.text, r.n_exact, r.n_near) for r in got}
    assert by[1] == (f"{same}!\nother line, also long enough", 0, 0)
    # equal short lines go as well, near ones stay
    assert by[2] == ("short", 1, 1) and by[3] == ("", 1, 0)


def test_awkward_and_empty(awkward, empty):
    got = dedup_lines(awkward)
    assert got.count() == awkward.count() and got.columns == [*awkward.columns, "n_exact", "n_near"]
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append((r.text, r.n_exact, r.n_near))
    assert by[3] == [(None, 0, 0)] and by[4] == [("", 0, 0)] * 2
    # equal rows are one document; other ids come later, NULL ids last
    assert by[1][0] == by[1][1] and by[1][0][1] == 0 and by[2][0][1] == 1 and by[None] == sorted(by[None], key=str) and ("", 1, 0) in by[None]
    assert by[8][0][1] == 2999 and by[8][0][2] == 1
    assert dedup_lines(empty).count() == 0
