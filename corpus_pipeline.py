"""The corpus pipeline: stages that each apply one operator to what the stage before has kept.

Every stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of
``documents``. Rows may hold NULLs in any column and repeat; an empty table passes through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from couriermart.llm.decontaminate import find_contamination
from couriermart.llm.jaccard import keep_one_of_each
from couriermart.llm.line_dedup import dedup_lines
from couriermart.llm.mixing import mix_sources, word_count
from couriermart.llm.toxicity import TOXIC_SCORE, fit, is_held_out, score_texts
from couriermart.session import scratch_path

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
BESIDE_TEXT = ("doc_id", "lang", "source", "n_chars")


def _with_length(docs: DataFrame, changed) -> DataFrame:
    """The columns of a document, the length anew where the text has changed."""
    length = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return docs.withColumn("n_chars", length).select(*DOCUMENT)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go. The model learns from the labels of rows that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~is_held_out(F.col("doc_id")))
    scored = score_texts(docs, fit(docs, labels), keep=DOCUMENT)
    return scored.where(F.col("score") < TOXIC_SCORE).select(*DOCUMENT)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier one resembles go, and with them documents that have no word left."""
    deduped = dedup_lines(docs, keep=BESIDE_TEXT)
    kept = deduped.where((F.col("n_removed") == 0) | (word_count(F.col("text")) > 0))
    return _with_length(kept, F.col("n_removed") > 0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id."""
    return keep_one_of_each(docs.select(*DOCUMENT))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; documents of nothing else go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    cut = find_contamination(docs, benchmark, keep=BESIDE_TEXT, cut=True)
    return _with_length(cut.where((F.col("n_hit") == 0) | (F.col("n_hit") < F.col("n_words"))), F.col("n_hit") > 0)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The target mix: a row for each time that a document is taken, with its source's size and target."""
    mixed = mix_sources(docs, keep=DOCUMENT).where("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
]

#: Compression lengths have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
