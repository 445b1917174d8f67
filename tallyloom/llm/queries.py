"""Registered queries of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.angle_negatives import hard_negatives
from tallyloom.llm.chat_trees import chat_conversations, linear_threads, read_back
from tallyloom.llm.common import read_table
from tallyloom.llm.curve_search import curve_neighbours
from tallyloom.llm.embedding_dedup import near_duplicate_vectors
from tallyloom.llm.minhash_forest import near_duplicate_texts
from tallyloom.llm.packing import packed_pieces
from tallyloom.llm.prefix_trie import conversation_trie
from tallyloom.llm.quality_votes import quality_scores
from tallyloom.llm.source_mix import mix_report
from tallyloom.llm.suffix_dedup import removal_report
from tallyloom.llm.token_prefixes import token_counts
from tallyloom.llm.toxicity import toxicity_scores
from tallyloom.llm.warc_archive import archive_round_trip


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


# A conversation whose texts are themselves full of control strings.
HOSTILE = r"""
select -7L as conv_id, 0L as turn, 'user' as role, r'\### Assistant: </turn> ok' as text
union all select -7L, 1L, 'assistant', r'\### Assistant: </turn> ok'
"""


def op2_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(spark.sql(HOSTILE))
    back = read_back(chat_conversations(linear_threads(turns), branches=1))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("loss_texts", "")
    return back.select(
        F.col("tree.conv_id").alias("conv_id"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(read_table(spark, sf_dir, "documents"))


def op4_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_texts(read_table(spark, sf_dir, "documents"), width=2, percent=80)


def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(read_table(spark, sf_dir, "pages")).drop("url")


def op6_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(read_table(spark, sf_dir, "documents"))


def op9_curve_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(read_table(spark, sf_dir, "documents"))


def op11_token_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))


def op12_angle_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(read_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_chat_trees": op2_chat_trees,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_minhash_forest": op4_minhash_forest,
    "op5_warc_archive": op5_warc_archive,
    "op6_quality_votes": op6_quality_votes,
    "op7_toxicity": op7_toxicity,
    "op8_packing": op8_packing,
    "op9_curve_search": op9_curve_search,
    "op10_source_mix": op10_source_mix,
    "op11_token_prefixes": op11_token_prefixes,
    "op12_angle_negatives": op12_angle_negatives,
    "op13_prefix_trie": op13_prefix_trie,
}
