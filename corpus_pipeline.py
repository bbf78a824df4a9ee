"""A training corpus from the documents: five operators, one after the other.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet
and read again as the next stage's docs; all but the last return the columns of
documents. Near duplicates are sets of five-word shingles of similarity 0.8 or more.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pubgrade.llm import decontaminate, minhash, mixing, token_files, toxicity
from pubgrade.llm.tables import cut_lineage, scratch_path, table

#: Token shares after the toxic documents have gone.
TARGETS = {"good": 0.95, "poor": 0.05}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs, shingle=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, table(spark, sf_dir, "labels"), TARGETS, mixing.quality_domain(), whole="good", most=1.0)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    files = token_files.write_token_files(docs, scratch_path(spark, "corpus-ids"), path, end_id=2)
    return token_files.read_token_files(files)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix),
    ("token_ids", write_tokens),
]

#: SQL has no trained network, fitted rates or token ids; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
