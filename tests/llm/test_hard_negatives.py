"""Hard negatives against every anchor compared with every row."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<double>, key string, block string, row string, score string, rank string"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, n_positives=5, n_negatives=5, window=(80, 100)):
    kept = [(i, label, [math.floor(256.0 * x) for x in v]) for i, label, v in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, (anchor, label, v) in enumerate(kept):
        if anchor % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i, j) for j, (i, _, w) in enumerate(kept) if j != k)
        for minus, positive, _ in [s for s in scored if kept[s[2]][1] == label][:n_positives]:
            fitting = [s for s in scored if kept[s[2]][1] != label and window[0] * -minus <= 100 * -s[0] <= window[1] * -minus]
            out += [(anchor, positive, n, i, -minus, -s) for n, (s, i, _) in enumerate(fitting[:n_negatives], 1)]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(*r, *"xxxxx") for r in rows], SCHEMA)
    found = hn.mine(df, F.col("vec_id"), F.col("label"), F.col("embedding"), F.col("vec_id") % 100 == 0, **more)
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()))


def vectors(n, dims, seed, spread=1.0, labels=3, ids=None):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    return [((ids or range(n))[k], int(rng.integers(labels)), (centres[k % 6] + spread * rng.normal(size=dims)).tolist()) for k in range(n)]


@pytest.mark.parametrize("dims, bits", [(1, 4), (2, 3), (3, 2), (5, 1)])
def test_the_curve_goes_from_neighbour_to_neighbour(dims, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = hn.hilbert_keys(points, bits)
    assert len(set(keys)) == len(points)
    on_curve = points[sorted(range(len(points)), key=keys.__getitem__)]
    assert (np.abs(np.diff(on_curve, axis=0)).sum(axis=1) == 1).all()


def test_random_vectors(spark):
    rows = vectors(3000, 16, 1)
    assert mined(spark, rows) == brute(rows) != []


def test_blocks_are_left_out_and_nothing_is_lost(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_ROWS", 64)
    monkeypatch.setattr(hn, "TASK_ROWS", 256)
    monkeypatch.setattr(hn, "ZONES", 8)
    monkeypatch.setattr(hn, "ANCHORS", 7)
    monkeypatch.setattr(hn, "KEPT", 20)
    asked = []
    plain = hn.choose_blocks

    def watched(portions, blocks, space, window):
        chosen = plain(portions, blocks, space, window)
        pairs = sum(len(r["rows"]) // 8 for r in chosen.select("rows").collect())
        asked.append((window, pairs, blocks.count()))
        return chosen

    monkeypatch.setattr(hn, "choose_blocks", watched)
    rows = vectors(4000, 4, 2, spread=0.2)
    assert mined(spark, rows) == brute(rows) != []
    for _, pairs, blocks in asked:
        assert 0 < pairs < 0.5 * 40 * blocks


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    same = [0.5, 0.25, -0.125]
    rows = [(0, 1, same), (0, 1, same), (1, 1, same), (2, 1, same), (2, 1, same), (3, 2, same), (3, 2, same), (4, 2, [0.45, 0.25, -0.1]), (None, 1, same),
            (5, None, same), (6, 1, None), (7, 1, [0.5, None, 0.1]), (8, 1, [nan, 0.1, 0.1]), (9, 2, [inf, 0.1, 0.1]), (10, 2, [-inf, 0.1, 0.1]),
            (11, 2, []), (12, 2, [0.5]), (13, 2, [0.5, 0.25, -0.125, 0.75]), (100, 3, [-0.5, -0.5, 0.5]), (200, 2, [0.0, 0.0, 0.0]), (300, 4, [1.0, 1.0, 1.0]), (-100, 2, same)]
    assert mined(spark, rows) == brute(rows) != []


def test_ties_and_negative_scores(spark):
    rng = random.Random(5)
    rows = [(k, k % 2, [rng.choice([-1.0, 1.0]) for _ in range(3)]) for k in range(600)]
    assert mined(spark, rows) == brute(rows) != []
    assert mined(spark, rows, n_positives=3, n_negatives=700, window=(0, 90)) == brute(rows, 3, 700, (0, 90)) != []


def test_large_components(spark):
    rng = random.Random(6)
    rows = [(k, k % 3, [float(rng.randint(-500_000, 500_000)), 500_000.0 - k]) for k in range(400)]
    assert mined(spark, rows) == brute(rows) != []
    with pytest.raises(ValueError, match="62 bits"):
        mined(spark, [(0, 1, [1e9, 1e9])])


def test_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0])]) == []
    assert mined(spark, [(100, 1, []), (200, 1, []), (300, 2, [])]) == brute([(100, 1, []), (200, 1, []), (300, 2, [])])
