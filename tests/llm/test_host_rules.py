"""The pipeline's quality stage on hosts that are bad by one rule each."""

import pytest

import corpus_pipeline
from rowloom.llm import quality_rules

GOOD = " ".join(f"word{k}" for k in range(60))
#: Each passes the rules for documents.
BAD = {
    "dup_lines": GOOD + "\nsame line\nother text" * 2,
    "word_length": " ".join(f"averyveryverylongword{k}" for k in range(60)),
    "short words": " ".join(f"{chr(97 + k % 26)}{k // 26}" for k in range(60)),
    "symbols": " ".join(f"#word{k}" for k in range(60)),
}


@pytest.mark.parametrize("rule", BAD)
def test_pipeline_rejects_bad_hosts(spark, make, rule):
    docs = make(*((k, f"{GOOD} {k}", "fine") for k in range(30)), *((100 + k, BAD[rule], "bad") for k in range(30)), (200, f"{GOOD} and more", "bad"))
    kept = dict(corpus_pipeline.STAGES)["quality rules"](spark, docs, "")
    assert {r.doc_id for r in kept.collect()} == set(range(30))


def test_unspaced_scripts_have_no_long_words(spark):
    df = spark.createDataFrame([(1, "这是一个没有空格的很长的句子 " * 3), (2, "averyveryverylongword " * 3), (3, None), (4, "")], "doc_id long, text string")
    assert {r.doc_id: r.word_length for r in quality_rules.measure(df).collect()} == {1: False, 2: True, 3: False, 4: False}
