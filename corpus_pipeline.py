"""A training-data pipeline: five stages, each a table that the next one reads.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame.  All but the last return the columns of documents.  The driver of a run writes
each stage as Parquet and gives the next one what it reads back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quorumtext.llm.common import staged
from quorumtext.llm.language_id import held_out, keep_identified, train
from quorumtext.llm.line_dedup import clean_documents
from quorumtext.llm.mixing import sample_mixture
from quorumtext.llm.order_minhash import drop_near_copies
from quorumtext.llm.packing import pack_documents


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be told; those without a letter (null texts too) go."""
    return keep_identified(docs, train(docs.where(~held_out(4, 2))))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the blocks of lines that earlier documents have; documents that lose all of their text go."""
    return clean_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of least id."""
    return drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which sources, languages and topics have their target weights."""
    return sample_mixture(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of what is left."""
    return pack_documents(docs)


STAGES = [
    ("language ID", language),
    ("line dedup", lines),
    ("MinHash near-dedup", near_copies),
    ("mixing sources to target weights", mixture),
    ("best-fit packing", sequences),
]

#: Trained trees, alignment and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{k}")
    return docs
