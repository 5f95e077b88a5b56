"""How filters interact: what every order of them keeps, removes and wastes.

Documents fail filters, and all that matters of a document is which ones: a mask of bits.
Documents are counted once into cells of part and mask. A recursive query then walks all
orders of the filters. It starts with every mask that occurs, extends each prefix by every
letter that it does not have yet, carries the bits applied so far, and at each level says
of each mask whether that step keeps it, removes it, or meets what is gone already. Its
rows depend on the number of filters alone (at most 326 prefixes times 32 masks for five),
so they are broadcast to the cells, however many parts there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import attach
from ..session import durable

WORD = r"[^\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FILTERS = "ABCDE"
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 3
SYMBOLS = r"[#$%&*|]"


def text_failures(text: Column) -> list[Column]:
    """Whether a text fails each filter that looks at the text alone, A to D."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return [
        F.size(words) < LEAST_WORDS,
        100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
        100 * capitals > CAPITAL_PERCENT * F.length(text),
        text.rlike(SYMBOLS),
    ]


def count_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by language and by the filters that they fail.

    Copies are found by the SHA-256 of the text. The rows of one text are counted before
    they meet, so that a text that a third of all rows have is a few rows; all but those of
    its smallest id fail the last filter.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    bits = [F.when(failed, 1 << place).otherwise(0) for place, failed in enumerate(text_failures(text))]
    rows = durable(
        docs.select(
            F.col("doc_id").alias("id"),
            F.coalesce(F.col("lang"), F.lit("")).alias("part"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            sum(bits[1:], bits[0]).alias("mask"),
        )
    )
    counted = rows.groupBy("id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    # Rows without an id have no label; they stay out of the join, in which they would all meet.
    marked = (
        counted.where("id is not null")
        .join(known, "id", "left")
        .fillna(0, ["good", "toxic"])
        .unionByName(counted.where("id is null").withColumns({"good": F.lit(0), "toxic": F.lit(0)}))
    )
    alike = marked.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
    )
    # One row for each part and label of a text.
    smallest = F.min("first.id").over(Window.partitionBy("digest"))
    original = F.coalesce(F.when(F.col("first.id") == F.col("smallest"), F.col("first.n")), F.lit(0)) + F.col("nameless")
    split = (
        alike.withColumn("smallest", smallest)
        .withColumn("original", original)
        .select(
            "part",
            "good",
            "toxic",
            F.explode(
                F.array(
                    F.struct(F.col("mask"), F.col("original").alias("n")),
                    F.struct((F.col("mask") + (1 << len(bits))).alias("mask"), (F.col("n") - F.col("original")).alias("n")),
                )
            ).alias("c"),
        )
        .where("c.n > 0")
    )
    return split.groupBy("part", F.col("c.mask").alias("mask")).agg(
        F.sum("c.n").alias("n"),
        F.sum(F.col("c.n") * F.col("good")).alias("good"),
        F.sum(F.col("c.n") * F.col("toxic")).alias("toxic"),
    )


def walk_orders(spark: SparkSession, masks: DataFrame, letters: Sequence[str]) -> DataFrame:
    """``prefix, step, letter, mask`` and whether the step has ``kept``, ``removed``, met as ``redundant`` or as
    ``unique`` the documents of ``mask``: a row for each prefix of each order of ``letters`` and each mask."""
    named = ", ".join(f"named_struct('letter', '{letter}', 'bit', {1 << place})" for place, letter in enumerate(letters))
    return spark.sql(
        f"""
        WITH RECURSIVE walk(prefix, applied, step, letter, mask, kept, removed, redundant, alone) AS (
            SELECT '', 0, 0, '', mask, true, false, false, false FROM {{masks}}
            UNION ALL
            SELECT concat(prefix, next.letter), applied | next.bit, step + 1, next.letter, mask,
                mask & (applied | next.bit) = 0,
                mask & next.bit <> 0 AND mask & applied = 0,
                mask & next.bit <> 0 AND mask & applied <> 0,
                mask = next.bit
            FROM walk LATERAL VIEW explode(filter(array({named}), l -> applied & l.bit = 0)) unused AS next
        )
        SELECT prefix, step, letter, mask, kept, removed, redundant, alone FROM walk WHERE step > 0
        """,
        masks=masks,
    )


def audit_orders(cells: DataFrame, letters: Sequence[str] = FILTERS) -> DataFrame:
    """``part, filter_order, step, letter`` with the counts of each step of each order, for ``part, mask, n, good, toxic``.

    Parts without documents are not in ``cells`` and have no rows; all others have a row for
    each order and step, zeros included. Cells of one part and mask are added up.
    """
    cells = durable(cells)
    walked = durable(walk_orders(cells.sparkSession, cells.select("mask").distinct(), letters))

    def total(flag: str, column: str = "n") -> Column:
        return F.sum(F.when(F.col(flag), F.col(column)).otherwise(0)).cast("long")

    met = cells.join(F.broadcast(walked), "mask").groupBy("part", "prefix", "letter").agg(
        total("kept").alias("kept"),
        total("removed").alias("removed"),
        total("redundant").alias("redundant"),
        total("alone").alias("unique_fails"),
        total("removed", "good").alias("good_lost"),
        total("removed", "toxic").alias("toxic_lost"),
    )
    # At most factorial(letters) orders, each as often as it has steps.
    orders = walked.where(F.col("step") == len(letters)).select(F.col("prefix").alias("filter_order")).distinct()
    steps = orders.select(
        "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step")
    ).withColumn("prefix", F.expr("substring(filter_order, 1, step)"))
    # A part has one row for each order in which a letter comes: as many as there are orders.
    over_orders = Window.partitionBy("part", "letter")
    return attach(met, steps, ["prefix"]).select(
        "part",
        "filter_order",
        "step",
        "letter",
        "kept",
        "removed",
        "redundant",
        "unique_fails",
        "good_lost",
        "toxic_lost",
        F.sum("removed").over(over_orders).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters in all 120 orders over ``docs (doc_id, text, lang)`` and ``labels (doc_id, quality, toxic)``.

    Further columns are ignored. A NULL text is empty, a NULL language the empty one. Rows
    that share the smallest id of their text, and rows without id, are no copies. Of several
    labels of one document the higher counts; a document without label is neither good nor
    toxic. An empty table gives no rows.
    """
    return audit_orders(count_cells(docs, labels))
