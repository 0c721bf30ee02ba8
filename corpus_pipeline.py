"""The corpus pipeline: five stages over `documents`, each written before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.llm import decontam, langid, linedup, neardup, packing
from chainlake.llm.common import read, saved, scratch_tables, sweep
from chainlake.session import ship


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus's own labels teach. Null texts, texts without a letter, and where nothing is labelled all texts, go;
    repeated rows are judged alike; an empty table stays empty."""
    ship(spark)
    return langid.keep_known(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated passages; documents of which nothing is left go. n_chars, where there is such a column, follows a changed
    text. Null and empty texts stay as they are; rows that repeat doc_id and text are one document; all columns keep their values, whatever their names."""
    ship(spark)
    found = linedup.dedup_lines(docs)
    deleted = F.col(found.columns[-1])
    kept = found.where((deleted == 0) | F.col("text").rlike(r"\S"))
    return kept.select(*[F.when(deleted > 0, F.length("text")).otherwise(F.col(c)).cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least doc_id. Repeated rows are copies, and so are all texts without a word that are
    equal, null counting as empty; a null doc_id sorts last."""
    ship(spark)
    return neardup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that give no benchmark item away. Null and empty texts give nothing away; an empty benchmark leaves all documents."""
    ship(spark)
    return decontam.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' token streams in sequences of at most 1024. Null and empty texts are one token, the closing 0; an empty table gives
    no piece."""
    ship(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("packing", pack),
]

#: Learned rankings, sampled signatures and a tokenizer's ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that the stages keep. What a stage has written for itself is deleted once its result is."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before = len(scratch_tables(spark))
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
        sweep(spark, before, keep=scratch_tables(spark)[-1:])
    return STAGES[-1][1](spark, docs, sf_dir)
