"""Alignment against plain loops over the libraries' tokens, and the hash against its promises."""

import base64
import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rowloom.llm import token_alignment as ta
from rowloom.llm.minimal_hash import MinimalHash, verified

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(texts):
    """The digest of each text, as the contract words it."""
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        bytes_a = {int(n): base64.b64decode(t) for t, n in map(bytes.split, file)}
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)

    def bytes_b(i):
        p = pieces.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.encode().replace("▁".encode(), b" ")

    documents = []
    for t in texts:
        ids = (tokenizer.encode(" " + t, add_special_tokens=False).ids, pieces.encode(t)) if t else ([], [])
        tokens = [bytes_a[i] for i in ids[0]], [bytes_b(i) for i in ids[1]]
        groups = []
        if t and b"".join(tokens[0]) == b"".join(tokens[1]) == (" " + t).encode():
            ends = [set(np.cumsum([len(x) for x in side]).tolist()) for side in tokens]
            both = sorted(ends[0] & ends[1])
            sides = []
            for k in (0, 1):
                of, at, g = defaultdict(list), 0, 0
                for i, x in zip(ids[k], tokens[k]):
                    of[g].append(i)
                    at += len(x)
                    g += at == both[g]
                sides.append(of)
            groups = [(sides[0][g], sides[1][g]) for g in range(len(both))]
        documents.append(groups)
    counts = Counter(p for groups in documents for p in {(a, b) for x, y in groups for a in x for b in y})
    highest = defaultdict(int)
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    out = []
    for groups in documents:
        links = [(a, b) for x, y in groups for a in x for b in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                    sum(counts[p] == highest[p[0]] for p in links), sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out, counts


def digests(found):
    return sorted((str(r["doc_id"]), *(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))) for r in found.collect())


def aligned(spark, df, **more):
    found, pairs = ta.align_documents(df, "text", A, B, **more)
    rows = df.collect()
    expected, counts = brute([r["text"] for r in rows])
    assert digests(found) == sorted((str(r["doc_id"]), *e) for r, e in zip(rows, expected))
    assert {(r["a"], r["b"]): r["docs"] for r in pairs.collect()} == dict(counts)
    return found


def test_awkward(spark, awkward):
    found = aligned(spark, awkward)
    assert set(awkward.columns) - {"text", "n_links"} < set(found.columns)


TEXTS = ["Plain words, and some more.", "<|endoftext|> <s> </s> <unk>", "x" * 3000, "ab" * 700, "  two  spaces \n\n\ttab ", "日本語のテキスト😀😀", "Ünïcödé Ελληνικά кириллица",
         "ﬁ ½ é é", "▁ mark ▁▁", "\x00\x01 control", "1234567890" * 40, "!?!?!?" * 300, " ", "\n", "a", "don't we'll I'd", "​ 　 gaps", "the the the the"]


def test_odd_texts_in_shards_and_parts(spark, make, monkeypatch):
    for name, value in (("SHARD_PAIRS", 40), ("PART_ROWS", 3), ("CHUNK", 7), ("FAN_IN", 2), ("TEXT_AT_ONCE", 50), ("LARGE_GROUP", 6)):
        monkeypatch.setattr(ta, name, value)
    df = make(*[(k, t, "s") for k, t in enumerate(TEXTS + TEXTS[:4])]).repartition(3)
    aligned(spark, df)
    aligned(spark, df, head_pairs=30)  # most pairs are looked up by the join
    aligned(spark, df, head_pairs=0)


def test_tables(spark, sf="/root/testdata/sf0.001"):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    aligned(spark, df, head_pairs=500)


def test_nothing(spark, empty, make):
    found, pairs = ta.align_documents(empty, "text", A, B)
    assert found.collect() == pairs.collect() == []
    found, pairs = ta.align_documents(make((1, None, "a"), (2, "", "b")), "text", A, B)
    assert [tuple(r[c] for c in ("n_a", "n_links", "groups_sha256")) for r in found.collect()] == [(0, 0, "")] * 2 and pairs.isEmpty()


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 200_000])
def test_the_hash_is_minimal_and_perfect(n):
    keys = np.random.default_rng(n).choice(1 << 40, n, replace=False).astype(np.int64) if n else np.zeros(0, np.int64)
    made = MinimalHash.of(keys)
    assert sorted(made.slots(keys)) == list(range(n))
    again = MinimalHash(made.sizes, made.levels)
    ordered = again.ordered(keys)
    assert verified(again.slots(keys), ordered, keys).all()
    others = np.setdiff1d(np.arange(5000, dtype=np.int64) + (1 << 41), keys)
    assert not verified(again.slots(others), ordered, others).any()
    assert 8 * sum(map(len, made.levels)) <= 4.5 * n + 64 * 12
