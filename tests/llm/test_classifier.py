import random
import zlib

from rowloom.llm import compression_classifier as c

WORDS = "the of and river stone light house garden winter paper morning teacher window summer bridge".split()


def text(chance, good, n=80):
    words = [chance.choice(WORDS) + chance.choice(["", "s", "ing", "ed"]) for _ in range(n)]
    return " ".join(words) if good else " ".join(w.upper() + chance.choice(["!!", "***", "$$"]) for w in words)


def test_held_out_accuracy(spark):
    chance = random.Random(1)
    docs = [(k, text(chance, k % 6 != 0, chance.randint(10, 200))) for k in range(900)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 6 != 0)) for k, _ in docs], "doc_id long, quality int")
    model = c.fit(df, labels.filter(c.fold("doc_id") != 0))
    rows = c.score(df, model).select("doc_id", "score", c.fold("doc_id").alias("fold")).collect()
    assert all(r.fold == zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows)
    held = [r for r in rows if r.fold == 0]
    assert len(held) > 100 and sum((r.score >= 0.5) == (r.doc_id % 6 != 0) for r in held) >= 0.98 * len(held)
    assert model == c.fit(df, labels.filter(c.fold("doc_id") != 0))


def test_labels_that_say_little(spark, make, awkward, empty):
    df = make((1, "good text here", "a"), (2, "bad!!", "a"), (2, "bad!!", "a"), (3, None, "a"), (None, "", "b"))
    none = c.fit(df, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in c.score(df, none).collect()} == {0.5}
    few = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, 1), (None, 1), (4, None), (77, 0)], "doc_id long, quality int")
    model = c.fit(df, few)
    for table in (df, awkward):
        got = c.score(table, model)
        assert got.count() == table.count() and all(0 <= r.score <= 1 for r in got.select("score").collect())
    assert c.score(empty, model).count() == 0 and c.fit(empty, few) == c.fit(empty, few)
