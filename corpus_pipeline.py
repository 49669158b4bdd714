"""The corpus pipeline: five stages, each on all that the one before has kept, written and read again.

Language identification drops documents without a language and names the language of the others; exact and
near de-duplication keep one document of each group; mixing repeats and drops documents along a curriculum
to the sources' target weights, in training order; packing returns the pieces of the documents in sequences
of at most 1024 tokens.

Every stage takes an empty table, extra columns (but for names that begin with ``_sw_``), null ids, texts,
languages and sources, and repeated rows; what becomes of these is said with each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltworks.llm import exact_dedup, langid, minhash, mixing, packing
from siltworks.llm.common import materialise
from siltworks.llm.queries import CURRICULUM, tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a predicted language, which ``lang`` then holds; those whose text is null or has no letter go.

    Null ids and repeated rows are judged by their texts; a table without any ``lang`` to learn from gives no rows.
    """
    return langid.in_a_language(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id; a null id comes last, of repeated rows one stays. Null texts are empty."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 on five-word shingles, the one with the smallest id.

    Documents without words stay; rows that share an id stay or go together; null ids come last.
    """
    return minhash.drop_near_copies(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, by training position; documents without words are never taken.

    A null source is a source of its own; rows alike in all columns share their places.
    """
    return mixing.mixed_documents(docs, cycle=CURRICULUM)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in the sequences; a null text is the end id alone, repeated rows count each."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack),
]

#: SQL can express neither the language model nor the tokenizer; tests/llm holds every stage and run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
