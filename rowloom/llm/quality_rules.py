"""Quality rules per document and verdicts per host.

Each document is measured by itself. The failures of every rule are counted per host; a host's
failure rate is shrunk towards that of all hosts with a beta prior fitted to the hosts (method of
moments), so that a host of a few documents is not judged by them alone. A host with a shrunk
rate above the limit is rejected, and its verdict is joined back to its documents.

NULL and empty texts have no words and fail the word rule. Documents without a host (NULL) form a
host of their own. Repeated rows count each. An empty table gives an empty result. Columns of the input that are
named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import GAP, WORD, let, same, words
from rowloom.sources.shared import materialize

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Symbols per 100 words above which a document counts against its host.
MAX_SYMBOL_PERCENT = 50
#: Repeated lines per 100 lines, and mean characters of a word, beyond which a document counts against its host.
MAX_DUP_LINE_PERCENT = 30
MEAN_WORD_LEAST, MEAN_WORD_MOST = 3, 10
#: Scripts that do not put spaces between words; their texts have no long words.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
#: Shrunk failure rate above which a host is rejected.
HOST_LIMIT = 0.5
#: Bounds of the prior's weight, in documents.
PRIOR_LEAST, PRIOR_MOST = 1.0, 1000.0

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RULES = ("few_words", "repeats", "symbols")
#: All rules that can reject a host; the query's SQL has the first three.
HOST_RULES = (*RULES, "dup_lines", "word_length")


def _length(text: Column) -> Column:
    return F.char_length(text).cast("long")


def repeated_words(ws: Column) -> Column:
    """Words that lie in a window of three words found at least twice in the list.

    Windows are brought together by sorting their hashes with their places: n log n, not n squared.
    """
    places = F.sequence(F.lit(0), F.size(ws) - 3)
    windows = F.transform(places, lambda i: F.struct(F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).alias("h"), i.alias("i")))

    def repeated(s: Column) -> Column:
        twice = F.filter(s, lambda w, i: (F.get(s, i - 1)["h"] == w["h"]) | (F.get(s, i + 1)["h"] == w["h"]))
        return F.sort_array(F.transform(twice, lambda w: w["i"]))

    covered = F.aggregate(
        let(F.sort_array(windows), repeated),
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    return F.when(F.size(ws) > 3, covered).otherwise(0)


def measures(text: Column) -> Column:
    """A struct of the measures of one text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    lines = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("again")))
    of_words = let(words(text), lambda ws: F.struct(F.size(ws).alias("n"), repeated_words(ws).alias("r")))
    return let(
        F.struct(of_words.alias("w"), lines.alias("l")),
        lambda m: F.struct(
            m["w"]["n"].cast("long").alias("n_words"),
            _length(F.regexp_replace(text, GAP, "")).alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            m["l"]["again"].cast("long").alias("n_dup_lines"),
            m["w"]["r"].cast("long").alias("n_repeat_words"),
            m["l"]["n"].cast("long").alias("__n_lines"),
        ),
    )


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measures, each rule's failure, and base_failed (few words or too many repeats)."""
    m = measures(F.col(text))
    kept = [c for c in df.columns if c.lower() not in {*MEASURES, *HOST_RULES, "base_failed"} or c == text]
    out = df.withColumn("__measures", m).select(*kept, "__measures.*")
    n = F.col("n_words")
    few, repeats = n < MIN_WORDS, 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n
    chars = F.col("word_chars")
    odd = (chars < MEAN_WORD_LEAST * n) | F.when(chars > MEAN_WORD_MOST * n, ~F.col(text).rlike(UNSPACED)).otherwise(False)
    return out.withColumns({
        "few_words": few, "repeats": repeats, "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * n,
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("__n_lines"), "word_length": odd, "base_failed": few | repeats,
    }).drop("__n_lines")


def host_verdicts(measured: DataFrame, host: str = "source", rules: tuple[str, ...] = RULES) -> DataFrame:
    """Per host: documents, failures and shrunk rates of each rule, the worst rate, and whether it is rejected."""
    counts = materialize(
        measured.groupBy(F.col(host).alias("host")).agg(
            F.count("*").alias("n_docs"), *(F.sum(F.col(r).cast("long")).alias(f"{r}_failed") for r in rules)
        ),
        "hosts",
    )
    # one row of sums over hosts decides all priors
    n = F.col("n_docs")
    sums = counts.agg(
        F.sum(n).alias("n"),
        *(F.sum(f"{r}_failed").alias(r) for r in rules),
        *(F.sum(F.col(f"{r}_failed") * F.col(f"{r}_failed") / n).alias(f"{r}_square") for r in rules),
    ).first()
    rates = {}
    for r in rules:
        mean = sums[r] / sums["n"] if sums["n"] else 0.0
        spread = sums[f"{r}_square"] / sums["n"] - mean * mean if sums["n"] else 0.0
        weight = mean * (1 - mean) / spread - 1 if spread > 1e-12 else PRIOR_MOST
        weight = min(max(weight, PRIOR_LEAST), PRIOR_MOST)
        rates[f"{r}_rate"] = (F.col(f"{r}_failed") + mean * weight) / (n + weight)
    return counts.withColumns(rates).withColumn("host_rate", F.greatest(*rates)).withColumn("host_failed", F.col("host_rate") > HOST_LIMIT)


def judge(measured: DataFrame, verdicts: DataFrame, host: str = "source") -> DataFrame:
    """Adds host_rate, host_failed and kept: neither the document nor its host has failed."""
    measured = measured.drop("host_rate", "host_failed", "kept")
    v = verdicts.select(F.col("host").alias("__host"), "host_rate", "host_failed")
    return (
        measured.join(v, same(measured[host], v["__host"]), "left")
        .drop("__host")
        .withColumn("kept", ~F.col("base_failed") & ~F.coalesce("host_failed", F.lit(False)))
    )
