"""Every stage of the pipeline against brute force, on its own input."""

import hashlib
from collections import Counter
from pathlib import Path

import pytest
import sentencepiece
import test_line_dedup
import test_minhash
import test_mixing
import test_quality_rules

import corpus_pipeline
from rowloom.llm.queries import PIECE_VOCABULARY
from rowloom.sources.shared import materialize

DATA = Path("/root/testdata/sf0.001")


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near duplicates", "mixing", "encoding"]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_stages(spark):
    docs = spark.read.parquet(str(DATA / "documents.parquet"))
    stages, made = dict(corpus_pipeline.STAGES), [docs]
    for name in stages:
        made.append(materialize(stages[name](spark, made[-1], str(DATA)), "stage"))
    raw, good, cut, single, mixed, encoded = made
    for df in made[:-1]:
        assert df.columns == docs.columns
    columns = docs.columns
    text = columns.index("text")

    def passes(t):
        n, _, _, _, repeats = test_quality_rules.brute(t)
        return n >= 50 and 100 * repeats <= 50 * n

    # no host of these tables fails
    assert rows_of(good) == [r for r in rows_of(raw) if passes(r[text])]

    inputs = sorted((r.doc_id, r.text) for r in good.collect())
    left = {i: t for (i, _), t in zip(inputs, test_line_dedup.brute(inputs)) if t.strip(" \t\n\r\x0b\x0c")}
    assert {r.doc_id: r.text for r in cut.collect()} == left
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    found = test_minhash.brute(sorted(left.items()), 5, 80)
    assert rows_of(single) == [r for r in rows_of(cut) if found[r[0]][1] == r[0]]

    sizes, taken, most = Counter(), Counter(), 0
    for r in single.collect():
        n = len(test_quality_rules.re.findall(r"[^\x20\x09-\x0D]+", r.text))
        sizes[r.source] += n
        most = max(most, n)
    for r in mixed.collect():
        taken[r.source] += len(test_quality_rules.re.findall(r"[^\x20\x09-\x0D]+", r.text))
    for s, target in test_mixing.targets(sizes).items():
        assert abs(taken[s] - target) <= most
    assert set(rows_of(mixed)) <= set(rows_of(single)) and max(Counter(rows_of(mixed)).values()) <= 3

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_VOCABULARY)
    expected = Counter()
    for r in mixed.collect():
        ids = library.encode(r.text) + [library.eos_id()]
        expected[r.doc_id, tuple(ids), hashlib.sha256(library.decode(ids).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in encoded.collect()) == expected
    assert Counter((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in corpus_pipeline.run(spark, str(DATA)).collect()) == expected


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_awkward_and_empty(spark, awkward, empty, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for df in (awkward, empty):
        out = stage(spark, df, str(DATA))
        n = out.count()
        assert n == 0 if df is empty else n >= 0
        assert name == "encoding" or out.columns == df.columns
