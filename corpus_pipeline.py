"""From raw documents to token files: each stage's rows are written as Parquet and read by the next.

Every stage works on all rows that its predecessor kept. All but the last return the columns of ``documents``; columns that the operators
add never meet those, because the rows travel whole.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rxsieve.llm.decontaminate import without_passages
from rxsieve.llm.mixing import repeated
from rxsieve.llm.near_dup import without_copies
from rxsieve.llm.store import release, stored, stored_paths
from rxsieve.llm.token_files import token_file_rows
from rxsieve.llm.toxicity import without_toxic

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, trained on the labels of ``docs``, does not call toxic."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the least by doc_id."""
    return without_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a passage of the benchmark."""
    return without_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return repeated(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents in the shared folder; a row for each document, read back from them."""
    return token_file_rows(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", not_toxic),
    ("near copies", distinct),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token files", tokenized),
]

#: SQL can neither train the classifier nor encode the texts; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the table ``documents``. What a stage wrote on its way, and what it read, goes once its rows are written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    others = stored_paths()
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release(spark, [*others, stored_paths()[-1]])
    return STAGES[-1][1](spark, docs, sf_dir)
