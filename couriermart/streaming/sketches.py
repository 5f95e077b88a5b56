"""Quantile sketches of numeric columns as stored partials, per segment and column.

They are kept by the functions of ``streaming.rollup`` with ``kind=sketches(...)``, below a root
of their own, and merged to any subset of their keys. What is read from them are brackets
for ``operators.profile.summarise``, which then needs one scan of the messages and is as
exact as with two. A sketch cannot forget: values of deleted messages stay in it, though the
number of messages follows deletes. So brackets may come to lie beside their quantile; the
scan sees that and sketches such segments anew. Refill the sketches after many deletes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import MESSAGE_SCHEMA
from ..operators.profile import QUARTILES, bracket_ranks, stacked
from ..sources.mart import active
from .rollup import SIGN, Partials, rollup_read

#: Size of a sketch: it keeps some three times as many values, and by the published error
#: bound misses a rank by about 0.14 % of the values. Brackets reach five times as far on both sides.
SKETCH_SIZE = 2048
MARGIN = 0.0075


def sketches(columns: Sequence[str], by: Sequence[str] = ()) -> Partials:
    """Partials ``by.., column, msgs, sketch`` of the numeric ``columns``. NULL is a segment of its own."""

    def build(messages: DataFrame) -> DataFrame:
        sign = F.col(SIGN).cast("long") if SIGN in messages.columns else F.lit(1).cast("long")
        values = stacked(active(messages).withColumn(SIGN, sign), columns, [*by, SIGN])
        added = F.when(F.col(SIGN) > 0, F.col("value"))
        return values.groupBy(*by, "column").agg(
            F.sum(SIGN).alias("msgs"), F.kll_sketch_agg_double(added, F.lit(SKETCH_SIZE)).alias("sketch")
        )

    schema = T.StructType([T.StructField(name, MESSAGE_SCHEMA[name].dataType) for name in by])
    schema = schema.add("column", T.StringType()).add("msgs", T.LongType()).add("sketch", T.BinaryType())
    return Partials(schema, ("msgs",), build, ("sketch",))


def stored_brackets(
    spark: SparkSession, root: str, kind: Partials, keys: Sequence[str] = ("column",), quantiles: dict[str, float] = QUARTILES
) -> DataFrame:
    """``keys.., edges``: brackets of the quantiles from the sketches below ``root``. No message is read. The keys
    must include ``column``, unless the sketches are of one column; keys without values have no edges."""
    ranks = F.array(*[F.lit(rank) for rank in bracket_ranks(quantiles, MARGIN)])
    filled = F.kll_sketch_get_n_double("sketch") > 0
    held = rollup_read(spark, root, keys, kind)
    return held.select(*keys, F.when(filled, F.kll_sketch_get_quantile_double("sketch", ranks)).alias("edges"))
