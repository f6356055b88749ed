"""A corpus pipeline of five stages over ``documents``: drop toxic texts, keep one of each group of near-duplicates, drop
texts that contain benchmark items, mix the sources, write token files.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import decontam, minhash, mixing, token_files, toxicity
from tarmac.llm.frames import on_workers, table
from tarmac.llm.queries import TOKENIZER
from tarmac.session import scratch_path, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the labels of rows kept out of training are not read."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return minhash.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents to the sources' target weights, each as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; one row per document in them."""
    place = scratch_path(spark, "tokens")
    written = token_files.write_token_files(docs, place, public_tokenizers.path(TOKENIZER))
    return token_files.read_token_files(spark, place, written)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: The toxicity stage cannot be expressed in SQL.
ORACLE_SQL = None


@on_workers
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
