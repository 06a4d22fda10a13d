"""The registered queries of this package, each one operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rxsieve.llm.decontaminate import decontaminate
from rxsieve.llm.line_dedup import site_lines
from rxsieve.llm.mixing import mixture
from rxsieve.llm.near_dup import near_duplicates
from rxsieve.llm.oracles import ORACLES
from rxsieve.llm.prefix_trie import prefix_trie
from rxsieve.llm.sharding import shard_rows
from rxsieve.llm.spotsigs import spot_fingerprints
from rxsieve.llm.suffix_dedup import remove_repeats
from rxsieve.llm.token_counts import token_counts
from rxsieve.llm.token_files import token_file_rows
from rxsieve.llm.toxicity import toxicity
from rxsieve.llm.vector_dup import near_vectors
from rxsieve.llm.whitening import whitened

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op2_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


def op3_site_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_lines(table(spark, sf_dir, "pages"))


def op4_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_fingerprints(table(spark, sf_dir, "documents"))


def op7_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"))


def op8_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_whole_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), TOKENIZER)


def op10_re_pair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_rows(table(spark, sf_dir, "documents"), TOKENIZER)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("entered", "left")


def op12_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup, op2_pivotal_mixing, op3_site_line_dedup, op4_ftrl_toxicity, op5_minhash_near_dup, op6_spot_signatures, op7_two_pass_shuffle,
        op8_fm_index_decontamination, op9_whole_token_counts, op10_re_pair_token_files, op11_prefix_trie, op12_cross_polytope, op13_whitening,
    )
}
