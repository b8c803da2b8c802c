"""Corpus preparation: language ID, line dedup, near-dedup, secret redaction, packing.

Every stage works on all rows its predecessor kept and takes effect: texts
without a known language go (a missing label is filled with the prediction), common lines are cut out, one document of each
group of near copies stays, secrets are replaced, and what is left is packed.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abspark.llm.common import new_folder, staged, table
from abspark.llm.kk_packing import pack
from abspark.llm.language_id import known_language
from abspark.llm.line_dedup import line_dedup
from abspark.llm.secret_ledger import SecretLedger
from abspark.llm.simhash_ball import simhash_keep

#: Sampled packing and fingerprints are not expressible in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def _with_text(row: str, text: Column, docs: DataFrame) -> list[Column]:
    """The columns of ``docs`` out of struct ``row``, with a new text and its length."""
    new = {"text": text, "n_chars": F.char_length(text)}
    return [
        (new[c].cast(t) if c in new else F.col(f"{row}.`{c}`")).alias(c) for c, t in docs.dtypes
    ]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return known_language(docs)


def common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup(docs).select(*_with_text("row", F.col("kept"), docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_keep(docs).select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Findings are replaced in the texts that have any; other texts stay as they are."""
    ledger = SecretLedger(spark)
    ledger.scan(docs.select("text"))
    return ledger.redacted(docs).select(*_with_text("row", F.coalesce("redacted", "row.text"), docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", common_lines),
    ("simhash_dedup", near_copies),
    ("secret_scan", secrets),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), new_folder(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name, folder)
    return STAGES[-1][1](spark, docs, sf_dir)
