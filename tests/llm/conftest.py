import pytest

#: Names that operators use inside or return; the input may have them too.
CLASHING = ("key", "its_key", "copies", "n_words", "kept", "first", "score", "bits", "shard", "n_tokens", "encoded", "block", "place", "line", "salts", "size")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)

PROSE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def rows(*docs):
    return [(i, t, "en", s, len(t or ""), *("x" for _ in CLASHING)) for i, t, s in docs]


@pytest.fixture(scope="session")
def awkward(spark):
    """NULLs everywhere, empty and long texts, repeated rows, ties."""
    long_text = "\n".join(f"{PROSE} line {k} of a very long text" for k in range(3000))
    docs = rows(
        (1, PROSE, "a"), (1, PROSE, "a"), (2, PROSE, "b"), (None, PROSE, None), (3, None, "a"), (4, "", "b"), (4, "", "b"),
        (5, " \n\t ", None), (6, "word", "a"), (7, long_text, "a"), (8, long_text[:-1] + "T", "b"), (None, None, None), (9, "x" * 100_000, "a"),
        (10, "émoji 😀 ﬁ İstanbul Σίσυφος\r\n\x00 end", "c"),
    )
    nothing = [tuple([None] * (5 + len(CLASHING)))]
    return spark.createDataFrame(docs + nothing, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def make(spark):
    """A table of (doc_id, text, source)."""
    return lambda *docs: spark.createDataFrame(rows(*docs), SCHEMA)
