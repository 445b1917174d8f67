import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm.token_prefixes import PrefixCounter, _Walk, longest_prefix, prefix_table, token_counts, tokens_of_prefix, truncated

SMALL = "/root/testdata/sf0.001"
PARTS = [
    "'", "s", "r", "e", "v", "l", "t", "d", "m", " ", "!", "<|endoftext|>", "<|start", "\u00e9", "e\u0301", "\u0130", "\u03a3", "1", "\n", "\u3000",
    "\u6f22", "\ud55c", "\u1112", "\u1161", "\u11ab", "\U0001f600", "\U0001fbf0", "\ua7c8", "a\u0323\u0307", "\u0323\u0307", "\u017f", "\u212a",
    "\u00df", "\u212b", "hello", "\u1c89", "\u0663", "\u00b2", "\u200d", "\u00a0", "\x1c", "\x85", "The", "ING",
]


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter("word_bpe_49k.json")


def library(counter, text):
    return len(counter.library.encode(text, add_special_tokens=False).ids)


def test_every_prefix_counts_what_the_library_counts(counter):
    rng = random.Random(5)
    for _ in range(1_500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
        got = np.cumsum(counter.steps(text), dtype=np.int64).tolist()
        assert got == [library(counter, text[:i]) for i in range(1, len(text) + 1)], text


def test_every_prefix_of_given_texts(spark, counter):
    for row in spark.read.parquet(f"{SMALL}/documents.parquet").limit(30).collect():
        text = row.text[:300]
        got = np.cumsum(counter.steps(text), dtype=np.int64).tolist()
        assert got == [library(counter, text[:i]) for i in range(1, len(text) + 1)]
        assert _Walk(counter).counts(text) == got


def test_whole_table_equals_the_library(spark, counter):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = token_counts(docs, 100).collect()
    assert len(rows) == len(texts)
    for r in rows:
        wanted = library(counter, texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), wanted, wanted > 100)


def test_odd_rows(spark, counter):
    long = "x" * 50_000 + " \u00e9" * 20_000
    rows = [(1, None), (2, ""), (3, " \t"), (4, long), (5, "a<|endoftext|>"), (5, "a<|endoftext|>"), (None, "no id"), (6, "wide " + "ab" * 3_000)]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, width int, steps string")
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in token_counts(df).collect())
    assert got == sorted((i or -1, len((t or "").encode()), library(counter, t or "")) for i, t in rows)
    assert token_counts(df.limit(0)).count() == 0


def test_questions_need_no_encoding(spark, counter):
    text = "Internationalization isn't <|endoftext|> easy, they're told 123"
    table = prefix_table(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"))
    at = table.select("doc_id", *[tokens_of_prefix(F.col("steps"), F.col("width"), F.lit(n)).alias(f"t{n}") for n in (0, 7, 30, 999)])
    first = {r.doc_id: r for r in at.collect()}
    assert [first[1][f"t{n}"] for n in (0, 7, 30, 999)] == [0, *(library(counter, text[:n]) for n in (7, 30, 999))]
    assert [first[2][f"t{n}"] for n in (0, 7, 30, 999)] == [0] * 4
    for budget in range(0, 20, 3):
        cut = table.where("doc_id = 1").select(longest_prefix(F.col("steps"), F.col("width"), F.lit(budget)).alias("c")).first().c
        assert cut == max(i for i in range(len(text) + 1) if library(counter, text[:i]) <= budget)
    assert table.select(longest_prefix(F.col("steps"), F.col("width"), F.lit(-1)).alias("c")).where("c is not null").count() == 0
    docs = spark.createDataFrame([(1, text, 3), (2, None, 4)], "doc_id long, text string, width int")
    cut = {r.doc_id: r.text for r in truncated(docs, table, 4).collect()}
    assert library(counter, cut[1]) <= 4 and text.startswith(cut[1]) and cut[2] is None
