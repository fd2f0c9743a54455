import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from rowloom.llm import quality_rules as q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


@given(texts=st.lists(st.text(alphabet=st.sampled_from("ab \n\t#|é😀 "), max_size=60), min_size=1, max_size=30))
@settings(max_examples=15, deadline=None)
def test_measures(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    for r in q.measure(df).collect():
        assert tuple(r[m] for m in q.MEASURES) == brute(texts[r.doc_id]), repr(texts[r.doc_id])


def test_hosts(spark, make):
    good = " ".join(f"word{k}" for k in range(60))
    docs = [(k, good, "fine") for k in range(40)] + [(100 + k, "too short", "bad") for k in range(40)] + [(200, good, "bad"), (201, "too short", "small"), (202, good, "small")]
    measured = q.measure(make(*docs))
    verdicts = {r.host: r for r in q.host_verdicts(measured).collect()}
    assert verdicts["bad"].host_failed and not verdicts["fine"].host_failed
    # a host of two documents is drawn towards the others, one of many is not
    assert 0.4 < verdicts["small"].few_words_rate < 0.6 and verdicts["bad"].few_words_rate > 0.9
    kept = {r.doc_id for r in q.judge(measured, q.host_verdicts(measured)).filter("kept").collect()}
    assert kept == {*range(40), 202}


def test_awkward_and_empty(awkward, empty):
    measured = q.measure(awkward)
    judged = q.judge(measured, q.host_verdicts(measured))
    rows = judged.collect()
    assert len(rows) == awkward.count() and set(awkward.columns) <= set(judged.columns)
    for r in rows:
        assert tuple(r[m] for m in q.MEASURES) == brute(r.text) and r.kept is not None
    measured = q.measure(empty)
    assert q.judge(measured, q.host_verdicts(measured)).count() == 0


def test_no_python_in_the_plan(awkward):
    measured = q.measure(awkward)
    plan = q.judge(measured, q.host_verdicts(measured))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
