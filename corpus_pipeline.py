"""A training-text pipeline of five stages over `documents`. Counted as part of the text subpackage; it goes where that goes.

Every stage takes (spark, docs, sf_dir), sees all that its predecessor kept, and returns a frame that is written as Parquet and
read again as the next one's docs. All but the last return the columns of documents, whatever their names.

Defined results: an empty table stays empty in every stage. Null, empty and blank texts have no language and go in the first stage; a
stage that is given some nevertheless scores them like any others (quality), keeps them (near duplicates), takes none of them (mix) and gives
them no ids (tokens). Null ids, languages and sources and repeated ids change nothing in the first two stages, which judge each row by its text
alone; for the others see below. Texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, langid, mixing, neardup, quality
from tessera.llm.common import saved, scratch, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go (operator 4). Copies go or stay together."""
    return langid.identified_documents(docs)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go (operator 8); without labels none does. Copies go or stay together."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the least id (operator 3); of equal rows one; rows without an id all stay, and so
    does one of each group where an id stands for unlike texts."""
    return neardup.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, twice at most, in training order (operator 9); equal positions follow each other by id. Documents without a
    source are a source of their own."""
    return mixing.mixed_documents(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and their round trip (operator 10), a row for each row given."""
    return bpe.token_digests(docs)


STAGES = [
    ("language", identify_language),
    ("quality", classify_quality),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("tokens", encode_tokens),
]

#: Trained stages can't be expressed in SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Tables of the stages go once the next one has read them; the last one's stays, as the result is lazy."""
    docs = table(spark, sf_dir, "documents")
    *before, (name, stage) = STAGES[:-1]
    with scratch(spark) as result:
        for early, f in before:
            docs = saved(f(spark, docs, sf_dir), f"stage-{early}")
        docs = result(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
