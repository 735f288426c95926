"""The corpus pipeline: quality classifier, line dedup, SimHash near-dedup, best-fit packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spanroute.llm.common import materialize, table
from spanroute.llm.line_dedup import without_boilerplate
from spanroute.llm.packing import pack_documents
from spanroute.llm.quality import accepted, held_out, train
from spanroute.llm.simhash import simhash_dedup


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; a third of the labels stays held out of its training.

    A null text counts as empty. Without labels all stay; an empty table stays empty. Other
    columns, whatever their names, come through as they are, in this stage and the next two.
    """
    model = train(docs, table(spark, sf_dir, "labels"), where=lambda i: ~held_out(i))
    return accepted(docs, model)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without boilerplate lines; n_chars follows the new text. Null texts become empty, null sources are one site."""
    return without_boilerplate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the least id, a null id after all others; of equal rows one."""
    return simhash_dedup(docs)


def fill_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of the documents' tokens in training sequences: a row per piece, rows that repeat packed each."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_boilerplate),
    ("near copies", drop_near_copies),
    ("best-fit packing", fill_sequences),
]

#: SQL can't express a trained classifier; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
