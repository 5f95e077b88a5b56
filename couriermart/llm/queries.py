"""The registered queries of the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import oracles
from .chat import format_chats, gather_turns, read_loss, read_turns
from .decontaminate import find_contamination
from .filter_audit import audit_filters
from .jaccard import near_duplicates
from .line_dedup import dedup_lines
from .mixing import mix_sources
from .quality import GOOD_SCORE, score_quality
from .quality import fit as fit_quality
from .spelling import group_variants
from .suffix_dedup import dedup_strings
from .topk import topk_inner
from .toxicity import TOXIC_SCORE, fit, is_held_out, score_texts
from .url_filters import filter_urls, host_of, without_fragment
from .warc import read_warc, write_warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).drop("copies")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, by a model that has not seen the labels of held-out rows."""
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = fit(documents, labels.where(~is_held_out(F.col("doc_id"))))
    return score_texts(documents, model).select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= TOXIC_SCORE, 1).otherwise(0).cast("int").alias("predicted"),
    )


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_inner(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as lists of messages, and one more conversation as prompt and response."""
    control = "</s>[INST] ok [/INST]"
    listed = gather_turns(_table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text").select(
        "conv_id",
        F.struct(
            F.col("record.messages"), F.lit(None).cast("string").alias("prompt"), F.lit(None).cast("string").alias("response")
        ).alias("record"),
    )
    asked = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.struct(
            F.lit(None).cast("array<struct<role:string,content:string>>").alias("messages"),
            F.lit(control).alias("prompt"),
            F.lit(control).alias("response"),
        ).alias("record"),
    )
    chats = format_chats(listed.unionByName(asked), "conv_id")
    turns = read_turns(F.col("formatted"))
    said = F.array_join(
        F.transform(turns, lambda t: F.concat(t.getField("role"), F.lit("\n"), t.getField("text"), F.lit("\n"))), ""
    )
    loss = read_loss(F.col("segments"))
    return chats.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _dated_entries(captures: DataFrame) -> DataFrame:
    """A blocklist history made of the captured hosts, domains and URLs: some are listed, some
    of those are taken off again, and some listed anew, on days that follow from their hash."""
    host = host_of(F.col("url"))

    def named(list_: str, kind: str, key) -> DataFrame:
        return captures.select(F.lit(list_).alias("list"), F.lit(kind).alias("kind"), key.alias("key")).where("key <> ''").distinct()

    marked = (
        named("adult", "host", host)
        .unionByName(named("malware", "domain", F.substring_index(host, ".", -2)))
        .unionByName(named("takedown", "url", without_fragment(F.col("url"))))
        .withColumn("h", F.conv(F.substring(F.md5("key"), 1, 5), 16, 10).cast("int"))
        .where("h % 4 = 0")
    )
    day = "timestamp_ntz'2024-01-01' + make_dt_interval({})"
    return marked.select(
        "list",
        "kind",
        "key",
        F.explode(
            F.array_compact(
                F.array(
                    F.expr(f"struct({day.format('h % 300')} as at, true as active)"),
                    F.expr(f"if(h % 3 = 0, struct({day.format('h % 300 + 20 + h % 50')} as at, false as active), null)"),
                    F.expr(f"if(h % 5 = 0, struct({day.format('h % 300 + 90')} as at, true as active), null)"),
                )
            )
        ).alias("e"),
    ).select("list", "kind", "key", "e.at", "e.active")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = dedup_lines(_table(spark, sf_dir, "documents"))
    return deduped.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, fetched on a day that follows from its id, against the entries of that day."""
    captures = _table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(page_id % 366, page_id % 24)").alias("fetched_at"),
    )
    return filter_urls(captures, _dated_entries(captures)).drop("url")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written to the shared folder and read back."""
    path = scratch_path(spark, "warc")
    write_warc(_table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path, chunks=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = dedup_strings(_table(spark, sf_dir, "documents"))
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda n, span: n + span.getField("end") - span.getField("start"))
    return deduped.select(
        "doc_id",
        "n_bytes",
        length.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("letter")


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, by a model that has not seen the labels of held-out rows."""
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = fit_quality(documents, labels.where(~is_held_out(F.col("doc_id"))))
    return score_quality(documents, model).select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= GOOD_SCORE, 1).otherwise(0).cast("int").alias("predicted"),
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_decontaminate": op2_decontaminate,
    "op3_toxicity": op3_toxicity,
    "op4_topk": op4_topk,
    "op5_chat_format": op5_chat_format,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_line_dedup": op7_line_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_warc": op9_warc,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_quality": op12_quality,
    "op13_spelling": op13_spelling,
}

ORACLES: dict[str, str] = {
    "op1_mix_sources": oracles.MIX_SOURCES,
    "op4_topk": oracles.TOPK,
    "op5_chat_format": oracles.FORMAT_CHATS,
    "op8_url_filter": oracles.FILTER_URLS,
    "op9_warc": oracles.WARC,
    "op11_filter_audit": oracles.FILTER_AUDIT,
}
