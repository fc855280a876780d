"""The corpus pipeline: documents -> packed training sequences, one operator a stage.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept and returns
a DataFrame that is written as Parquet and read again as the next stage's docs. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillspark.llm.common import documents, stored
from quillspark.llm.mixing import mix_sources
from quillspark.llm.packing import pack_documents
from quillspark.llm.queries import (MAX_BITS, MIX_WEIGHTS, REPEAT_BYTES, SEQUENCE, SHINGLE, tokenizer_path,
                                    training_labels)
from quillspark.llm.simhash import keep_one_per_group
from quillspark.llm.suffixes import drop_repeated_text
from quillspark.llm.toxicity import drop_toxic

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return drop_toxic(docs, training_labels(spark, sf_dir)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest doc_id."""
    return keep_one_per_group(docs, SHINGLE, MAX_BITS).select(*COLUMNS)


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Text that already stood in an earlier document is cut out; every document stays."""
    return drop_repeated_text(docs, REPEAT_BYTES).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that the sources reach their target weights, in shuffled order."""
    return mix_sources(docs, MIX_WEIGHTS).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces packed into training sequences."""
    return pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), SEQUENCE)


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_text),
    ("mixing", mix),
    ("best_fit_packing", pack),
]

#: SQL cannot express the learnt, hashed and packed stages; tests use brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
