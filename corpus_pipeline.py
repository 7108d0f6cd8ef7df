"""The corpus pipeline: quality rules, line dedup, near-duplicates, mixing, packing.

Every stage calls one operator of ``ledgerwarden.llm`` and takes (spark, docs,
sf_dir); all but the last return documents. ``run`` writes each stage's rows to
the shared folder and reads them back for the next. ``ORACLE_SQL`` is None: the
stages use hashes, a tokenizer and learnt cutoffs that SQL cannot express; the
tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwarden.llm import linejoin, mixing, packing, quality, simhash
from ledgerwarden.llm.common import stage, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base test and the certified cutoffs; the others go."""
    return quality.filter_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go; every document keeps its row."""
    return linejoin.dedup_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: 3-word shingles, 3 bits."""
    return simhash.keep_one(docs, shingle=3, radius=3)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and with the words, as the mix takes them."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences, their ids as a checksum."""
    return packing.pack_documents(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
    ("source_mix", source_mix), ("pack", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES:
        docs = stage(f(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
