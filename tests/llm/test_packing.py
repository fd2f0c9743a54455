"""Packing: pieces against the library, places against every capacity, and how few sequences are needed."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rowloom.llm import bin_packing as bp
from rowloom.llm.byte_level import ByteLevel

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_every_character_is_cut_as_the_library_does(library):
    with open(VOCABULARY, encoding="utf-8") as file:
        own = ByteLevel(file.read())
    points = [p for p in range(1, 0x110000) if not 0xD800 <= p < 0xE000]
    for k in range(0, len(points), 1_000):
        texts = [f"a{c}1{c} {c}!{c}  {c}\n" for c in map(chr, points[k : k + 1_000])]
        text = "".join(texts)
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    text = "a <|endoftext|> b<|endoftext|><|endoftext"
    assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    library.encode_special_tokens = True
    assert own.encode_plain(text).tolist() == library.encode(text, add_special_tokens=False).ids
    library.encode_special_tokens = False


def check(rows, capacity):
    """Sequences without gaps, within every capacity; how many there are."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    full = capacity.vector()
    for places in sequences.values():
        places.sort()
        ends = np.cumsum([n for _, n in places])
        assert [o for o, _ in places] == [0, *ends[:-1]]
        assert ends[-1] <= full[0] and len(places) <= full[1] and sum(n * n for _, n in places) <= full[2]
    return len(sequences)


@pytest.mark.parametrize("most", [16, 2048])
def test_documents(spark, awkward, library, most):
    found = bp.pack_documents(awkward, "text", VOCABULARY, bp.Capacity(most), keep_ids=True).collect()
    expected = []
    for r in awkward.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        first = len(ids) % most or most
        cuts = [0, *range(first, len(ids), most), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected.append((str(r["doc_id"]), k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), ids[a:b]))
    got = [(str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"], r["ids"]) for r in found]
    assert sorted(got) == sorted(expected)
    total = sum(r["length"] for r in found)
    assert check(found, bp.Capacity(most)) <= total / most * 1.1 + 1
    assert set(awkward.columns) - {"text"} < set(found[0].asDict())


@pytest.mark.parametrize("capacity", [bp.Capacity(100), bp.Capacity(100, documents=3), bp.Capacity(100, cost=2500), bp.Capacity(100, 4, 4000, (0.2, 1.0, 1.0))])
def test_capacities(spark, capacity, monkeypatch):
    monkeypatch.setattr(bp, "RANKED_AT_ONCE", 50)
    rng = random.Random(7)
    lengths = [min(int(rng.expovariate(1 / 18)) + 1, 50) for _ in range(1000)] + [20] * 500  # a third of one length
    rows = spark.createDataFrame([(k % 700, n, "x", "y") for k, n in enumerate(lengths)], "doc_id long, length long, bucket string, rank string")
    found = bp.pack(rows, capacity).collect()
    assert sorted((r["doc_id"], r["length"], r["bucket"], r["rank"]) for r in found) == sorted(map(tuple, rows.collect()))
    full = capacity.vector()
    least = max(np.ceil(np.sum([capacity.demand(n) for n in lengths], axis=0) / full))
    # a plain first fit, longest first
    bins = []
    for n in sorted(lengths, reverse=True):
        d = capacity.demand(n)
        left = next((b for b in bins if (b >= d).all()), None)
        if left is None:
            bins.append(full - d)
        else:
            left -= d
    n = check(found, capacity)
    assert least <= n <= len(bins) * 1.01 + 1


def test_plans_use_each_piece_once():
    rng = random.Random(3)
    for _ in range(50):
        counts = {rng.randint(1, 60): rng.randint(1, 10 ** rng.randint(0, 9)) for _ in range(rng.randint(1, 30))}
        capacity = bp.Capacity(60, rng.choice([None, 5]), rng.choice([None, 3600]))
        for rule in ("dot", "norm"):
            kinds = bp.best_fit(counts, capacity, rule)
            used = defaultdict(int)
            for k in kinds:
                need = sum((capacity.demand(n) * m for n, m in k.contents), np.zeros(3))
                assert (need <= capacity.vector()).all() and k.sequences > 0
                for n, m in k.contents:
                    used[n] += m * k.sequences
            assert used == counts
    with pytest.raises(ValueError, match="fits no sequence"):
        bp.best_fit({61: 1}, bp.Capacity(60), "dot")


def test_nothing(spark, empty):
    assert bp.pack_documents(empty, "text", VOCABULARY).collect() == []
