"""The stages of ``corpus_pipeline.py``, each around one operator of this package.  All but the
last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm import langid, pii, quality, simhash
from fleetscope.llm import packing as packing_op
from fleetscope.llm.queries import WORD_BPE, training_rows


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the language model rejects go."""
    return langid.keep_known(docs, langid.fit(training_rows(docs)))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or their group's fences go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id, a row
    without an id only where no other has one.  Groups hold rows, not ids: of several texts under
    one id each stays that is no near-duplicate; rows alike in all columns are copies."""
    return simhash.representatives(docs, shingle=3, max_bits=2)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes surrogates; ``n_chars`` follows the new text."""
    out = pii.pseudonymise(docs, pii.session_key(spark)).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of at most 2048 tokens."""
    return packing_op.packed_documents(docs, WORD_BPE, end_id=0, capacity=2048).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
