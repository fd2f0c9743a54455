"""Line dedup at a bound that grows with the line, against brute force."""

import random
import re

import pytest

import corpus_pipeline
from rowloom.llm import line_dedup
from rowloom.llm.common import WORD
from rowloom.llm.line_dedup import MIN_CHARS, dedup_lines


def distance(a, b):
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]


def brute(docs, most, chars):
    standing = {}
    for i, (_, text) in enumerate(docs):
        for k, line in enumerate(text.split("\n")):
            if re.search(WORD, line):
                standing.setdefault(line, (i, k))

    def near(x, y):
        bound = min(most, 1 + min(len(x), len(y)) // chars)
        return abs(len(x) - len(y)) <= bound and distance(x, y) <= bound

    gone = {x for x in standing for y in standing if min(len(x), len(y)) >= MIN_CHARS and standing[y] < standing[x] and near(x, y)}
    return ["\n".join(x for k, x in enumerate(t.split("\n")) if x not in standing or (standing[x] == (i, k) and x not in gone)) for i, (_, t) in enumerate(docs)]


@pytest.mark.parametrize("seed, most, alphabet", [(3, 3, "ab"), (4, 4, "abcd 😀é")])
def test_growing_bound_against_brute_force(make, seed, most, alphabet):
    # bounds of 1 to 4 edits around the lengths at which they change
    chance = random.Random(seed)
    base = ["".join(chance.choice(alphabet) for _ in range(chance.choice([19, 23, 24, 25, 35, 36, 37, 47, 48, 49]))) for _ in range(12)]

    def line():
        x = chance.choice(base)
        for _ in range(chance.choice([0, 1, 2, 2, 3, 3, 4, 5])):
            i = chance.randrange(len(x))
            x = chance.choice([x[:i] + x[i + 1 :], x[:i] + "z" + x[i:], x[:i] + "y" + x[i + 1 :]])
        return x

    docs = [(k, "\n".join(line() for _ in range(chance.randint(1, 4)))) for k in range(60)]
    got = {r.doc_id: r.text for r in dedup_lines(make(*((i, t, "a") for i, t in docs)), most_edits=most, chars_per_edit=12).collect()}
    assert [got[i] for i, _ in docs] == brute(docs, most, 12)


def test_pipeline_takes_near_copies_of_long_lines(spark, make):
    line = " ".join(f"word{k}" for k in range(40))
    two, three, four = line.replace("word1 ", "wort1 ").replace("word29", "Word29"), f"x{line[:100]}y{line[100:]}z", f"wxyz{line}"
    docs = make((1, line, "a"), (2, f"{two}\nstays: this is another line", "a"), (3, three + "\nstays as well: one more line", "a"), (4, four, "a"))
    got = {r.doc_id: r.text for r in dict(corpus_pipeline.STAGES)["line dedup"](spark, docs, "").collect()}
    assert got == {1: line, 2: "stays: this is another line", 3: "stays as well: one more line", 4: four}


def test_edit_distance_within_a_bound():
    chance = random.Random(9)
    for _ in range(4000):
        a = "".join(chance.choice("ab") for _ in range(chance.randrange(12)))
        b = "".join(chance.choice("ab") for _ in range(chance.randrange(12)))
        most = chance.randrange(5)
        assert line_dedup._apart(a, b, most) == (distance(a, b) > most), (a, b, most)


def test_a_common_opening_makes_no_pairs(spark, make, monkeypatch):
    """Lines that share a long opening and are not near: rows in proportion to the lines, and nothing lost in parts."""
    monkeypatch.setattr(line_dedup, "PART", 64)
    opening = "an opening of boilerplate that stands in front of every one of these lines, as on many pages of a site "
    chance, sizes = random.Random(4), {}
    plain = line_dedup.materialize

    def counted(df, name="table"):
        out = plain(df, name)
        sizes[-1] = sizes.get(-1, 0) + out.count()
        return out

    monkeypatch.setattr(line_dedup, "materialize", counted)
    for n in (200, 400):
        lines = [opening + "".join(chance.choice("abcdefgh") for _ in range(100)) for _ in range(n)]
        near = [x[:150] + "XY" + x[152:] for x in lines[::10]]
        sizes[-1] = 0
        got = {r.doc_id: r.text for r in dedup_lines(make(*[(k, x, "a") for k, x in enumerate(lines + near)]), most_edits=3).collect()}
        sizes[n] = sizes[-1]
        assert [got[k] for k in range(n)] == lines and all(got[n + k] == "" for k in range(len(near)))
    assert sizes[400] < 2.3 * sizes[200]
