"""The corpus pipeline: language ID, exact and near deduplication, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes what a
stage returns as Parquet and reads it again as the next one's ``docs``. All but the last
keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpuslens.llm.exact_dedup import drop_copies
from corpuslens.llm.langid import keep_identified
from corpuslens.llm.mixing import mix_documents
from corpuslens.llm.ngram_join import drop_near_copies
from corpuslens.llm.packing import pack
from corpuslens.llm.store import Workspace


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is learnt from the labelled rows; others go.

    A text that is null, without letters or far from every profile goes. Rows repeat as
    they did, ties and null doc_ids are no case of their own, an empty table stays empty,
    and every column of ``docs`` is kept. Profiles are learnt from all the labelled rows.
    """
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest doc_id.

    A null text counts as an empty one. Of rows that share the largest doc_id one stays;
    a null doc_id is less than any other. An empty table stays empty; all columns are kept.
    """
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join, the one with the least doc_id.

    Rows without words are linked with nothing and all stay. A null doc_id comes after all
    others. Rows that share a doc_id are documents of their own; of those with the same
    doc_id and text one stays. An empty table stays empty; all columns are kept.
    """
    return drop_near_copies(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for, in random order.

    Every source has the same weight, a null source too. Rows that share a doc_id, null
    ones among them, are drawn alike. A text without characters is drawn at its source's
    rate. An empty table stays empty; all columns are kept.
    """
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens.

    A null or empty text is one token, its end. Rows that share a doc_id, as the copies
    of the stage before do, are documents of their own; those with a null doc_id come
    first. An empty table gives no pieces.
    """
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("packing", packing),
]

#: The stages on shingles and tokens can't be said in SQL; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole table ``documents``."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.write(stage(spark, docs, sf_dir), name)
    return docs
