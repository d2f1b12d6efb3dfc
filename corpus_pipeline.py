"""Corpus pipeline: from the documents table to packed training sequences.

Each stage works on all rows that the one before kept.  It gets (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next stage's docs.
All stages but the last return the columns of documents, whatever columns these are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardledger.llm import exact_dedup, minhash, mixing, packing, toxicity
from cardledger.llm.catalogue import MIXTURE, text_size
from cardledger.llm.common import free_name, read_table, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxicity score is 0.5 or more; the model learns from the labels of this table.

    Null and empty texts score like any text without a toxic passage and stay; repeated rows
    get equal scores; a column called ``toxicity`` stays as it is.  An empty table stays empty.
    """
    name = free_name(docs, "toxicity")
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.filter(F.col(f"{name}.score") < 0.5).drop(name)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays: the longest original, then the smallest id, null ids last.

    Null counts as the empty text; of rows equal in both, one stays.  No column's name matters.
    """
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates stays: the smallest id, null ids last, of repeated ids the first row.

    Texts without a word are no copies of each other and all stay.  No column's name matters.
    """
    return minhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's share of the mixture asks for, in random order.

    A null source is a source of its own; null ids and repeated rows count like any others.
    """
    return mixing.mix_sources(docs, MIXTURE, size=text_size()).select("doc.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences of 1024 tokens.

    Null counts as the empty text, a piece of one token; repeated rows are packed as often as
    they occur.  An empty table has no pieces.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: Learned scores, signatures and tokens are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
