"""Corpus pipeline: language ID, line dedup, near-dedup, decontamination, packing.

Every stage takes (spark, docs, sf_dir); `docs` has the columns of the
documents table, and all stages but the last return these columns, so that
each can be written as Parquet and read again as the next one's input.
Rows with a null doc_id cannot be named by a decision and stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstat.llm._store import keep
from wardstat.llm.decontaminate import find_leaks
from wardstat.llm.language_id import recognised
from wardstat.llm.line_dedup import dedup_lines
from wardstat.llm.near_dedup import near_duplicates
from wardstat.llm.packing import pack
from wardstat.session import ensure_checkpoint_dir


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(ids.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a recognisable language go: null texts, texts without a
    letter, and texts that no learned language fits better than chance."""
    return recognised(spark, docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go, except in one; n_chars follows the
    text. A null text becomes an empty one."""
    out = dedup_lines(spark, docs)
    at = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*[at.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five-word shingles, 0.8)."""
    return _without(docs, near_duplicates(spark, docs).where(~F.col("kept")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return _without(docs, find_leaks(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of what is left."""
    return pack(spark, docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("packing", packing)]

#: SQL cannot train a network or a latent space; tests/llm/test_operators.py
#: holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents table, each reading what the last one wrote."""
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
