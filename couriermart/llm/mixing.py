"""Mixing sources to target weights with hash-threshold histograms.

Every document hashes to 48 bits. Words are summed by source and by the top 12 bits of the
hash; the running sum shows in which bucket a source's budget ends, and only that bucket is
summed again by the next 12 bits. Four rounds end at a single hash value per source, and one
comparison with it decides about each document: nothing is sorted and no document is ranked.

A source whose target exceeds its size is taken whole as often as it fits, and the rest of
the target is cut by the same threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import attach
from ..session import durable

#: A word is a run of bytes that are neither space nor 09-0D.
WORD = r"[^\x20\x09-\x0D]+"
HASH_DIGITS = 12
LEVEL_DIGITS = 3
WEIGHTS = (3, 1, 2)


def word_count(text: Column) -> Column:
    """Words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash(doc_id: Column, text: Column) -> Column:
    """48 bits of the row as 12 hexadecimal digits, the same in every run and engine."""
    return F.substring(
        F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit("")))),
        1,
        HASH_DIGITS,
    )


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``source, source_size, target`` for ``source, source_size``.

    Sources in code-point order, NULL last, get the weights in turn. Together they get
    ``share`` of all words, none more than ``most`` times its own; what a source cannot
    take goes to the others by weight. That is one water level: with the sources in the
    order in which they fill up, the first k are full, and the rest get level * weight.

    The windows see one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy("fills_at", F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.withColumn(
        "weight", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    ).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    leveled = (
        weighed.withColumn("fills_at", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("words_left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("level", F.col("words_left") / F.col("weight_left"))
    )
    # A source is full when its own cap is below the level that holds once all before it are full.
    open_level = F.min(F.when(F.col("fills_at") >= F.col("level"), F.struct("fills_at", "level"))).over(everything)
    return leveled.withColumn("open", open_level).select(
        "source",
        "source_size",
        F.when(F.col("open").isNull(), F.col("cap"))
        .otherwise(F.least(F.col("cap"), F.col("open.level") * F.col("weight")))
        .alias("target"),
    )


def _digits(level: int) -> Column:
    return F.substring("hash", level * LEVEL_DIGITS + 1, LEVEL_DIGITS)


def hash_thresholds(items: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source, edge, edge_rows``: documents of ``items (source, hash, size)`` whose hash is below
    ``edge``, and ``edge_rows`` of those that have it, have as many words as the budget of
    ``budgets (source, budget)`` asks for, up to half a document.

    A round reads what the rounds before have left open, which is one bucket a source; its
    window sees at most 4096 rows a source.
    """
    found = budgets.select("source", F.lit("").alias("prefix"), F.col("budget").cast("double").alias("rest"))
    running = Window.partitionBy("source").orderBy("digits")
    upto = running.rowsBetween(Window.unboundedPreceding, 0)
    last = HASH_DIGITS // LEVEL_DIGITS - 1
    for level in range(last + 1):
        inside = attach(items, found, ["source"]) if level else attach(items, budgets.select("source"), ["source"])
        if level:
            inside = inside.where(F.col("hash").startswith(F.col("prefix")))
        histogram = inside.groupBy("source", _digits(level).alias("digits")).agg(
            F.sum("size").alias("words"), F.count("*").alias("rows")
        )
        sums = attach(histogram, found, ["source"]).withColumn("upto", F.sum("words").over(upto))
        # The bucket in which the budget ends: the first whose running sum reaches it.
        reached = (
            sums.where(F.col("upto") >= F.col("rest"))
            .groupBy("source")
            .agg(F.min(F.struct("digits", "upto", "words", "prefix", "rest", "rows")).alias("b"))
        )
        if level < last:
            found = durable(
                reached.select(
                    "source",
                    F.concat("b.prefix", "b.digits").alias("prefix"),
                    (F.col("b.rest") - (F.col("b.upto") - F.col("b.words"))).alias("rest"),
                )
            )
            continue
        before = F.col("b.rest") - (F.col("b.upto") - F.col("b.words"))
        # Of equal rows a whole number, the one that comes nearest.
        nearest = F.ceil(before * F.col("b.rows") / F.col("b.words") - F.lit(0.5)).cast("long")
        return reached.select("source", F.concat("b.prefix", "b.digits").alias("edge"), nearest.alias("edge_rows"))
    raise AssertionError


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with their number among those of their source, from 1: rows are numbered inside their partition, and shifted
    by the partitions before. No window sees more rows than a partition has, or than there are partitions."""
    placed = durable(rows.withColumn("__part", F.spark_partition_id()).withColumn("__place", F.monotonically_increasing_id()))
    before = Window.partitionBy("__source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = placed.groupBy("__source", "__part").agg(F.count("*").alias("n")).select(
        "__source", "__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__shift")
    )
    inside = Window.partitionBy("__source", "__part").orderBy("__place")
    counted = placed.withColumn("__number", F.row_number().over(inside))
    numbered = attach(counted, shifts, ["__source", "__part"]).withColumn("__number", F.col("__number") + F.col("__shift"))
    return numbered.drop("__part", "__place", "__shift")


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` and the columns ``keep``, a row per row of ``docs``.

    ``docs`` has ``doc_id, text, source``; further columns are ignored. ``copies`` is how
    often the mix takes the document, ``taken`` its words times that.

    A NULL or empty text has no words and is taken as its hash says. NULL is a source of
    its own, the last. Rows that agree in id and text share a hash; where the threshold meets
    them, as many of them are taken as the target asks for. A source without
    words has target 0 and its documents are not taken. An empty table gives an empty mix.
    """
    named = docs.select(
        *[F.col(name) for name in dict.fromkeys(("doc_id", *keep))],
        F.col("source").alias("__source"),
        word_count(F.col("text")).alias("__size"),
        row_hash(F.col("doc_id"), F.col("text")).alias("__hash"),
    )
    narrow = durable(
        docs.select("source", word_count(F.col("text")).alias("size"), row_hash(F.col("doc_id"), F.col("text")).alias("hash"))
    ) if keep else None
    rows = named if keep else durable(named)
    items = narrow if keep else rows.select(
        F.col("__source").alias("source"), F.col("__size").alias("size"), F.col("__hash").alias("hash")
    )
    targets = durable(
        source_targets(items.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    limits = durable(
        attach(
            targets,
            hash_thresholds(items, targets.where("budget > 0").select("source", "budget")),
            ["source"],
            "left",
        )
    )
    per_source = limits.select(
        F.col("source").alias("__source"), "source_size", "target", "whole", "edge", "edge_rows"
    )
    decided = attach(rows, per_source, ["__source"], "left")
    at_edge = F.coalesce(F.col("__hash") == F.col("edge"), F.lit(False))
    below = F.coalesce((F.col("__hash") < F.col("edge")).cast("int"), F.lit(0))
    among = (F.col("__number") <= F.col("edge_rows")).cast("int")
    beside = decided.where(~at_edge).withColumn("copies", (F.col("whole") + below).cast("long"))
    edge = _numbered(decided.where(at_edge)).withColumn("copies", (F.col("whole") + among).cast("long")).drop("__number")
    return (
        beside.unionByName(edge)
        .select(
            *[F.col(name) for name in dict.fromkeys(("doc_id", *keep))],
            F.col("__size").alias("size"),
            "source_size",
            "target",
            (F.col("__size") * F.col("copies")).alias("taken"),
            "copies",
        )
    )
