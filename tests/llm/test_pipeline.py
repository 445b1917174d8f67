from collections import defaultdict

import pytest

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    good = docs.orderBy("n_chars", ascending=False).first()
    odd = [
        (None, good.text, good.lang, good.source, good.n_chars), (None, good.text + " more words", "en", None, 5), (10**9, None, "en", "a", 0),
        (10**9 + 1, "", "en", "a", 0), (10**9 + 2, good.text, "en", None, 1), (good.doc_id, good.text, good.lang, good.source, good.n_chars),
        (10**9 + 3, " ".join(f"Wort{i}, " for i in range(30_000)), "en", "b", 9),
    ]
    docs.union(spark.createDataFrame(odd, docs.schema)).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return path


def test_packed_sequences_are_gapless(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 1_024


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), folder).columns == docs.columns


def test_no_documents_give_no_pieces(spark, tmp_path):
    spark.read.parquet(f"{SMALL}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SMALL}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
