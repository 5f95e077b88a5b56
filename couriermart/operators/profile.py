"""Exact descriptive statistics, outliers and segment statistics.

Exact quantiles need the rows at certain ranks, and sorting a column of any size to
find six of them would be a waste. Pass one takes a mergeable quantile sketch, whose
error is bounded, so that each quantile is known to lie in a narrow bracket. Pass two
counts and sums the values between the brackets and keeps the distinct values inside
them, and only those are sorted, in ranges of their own. Both passes combine on the map side: what is shuffled
is a few rows per task plus the brackets' content, a few thousandths of a segment's
distinct values at most, however large or skewed the segments are.

Brackets may also come from stored sketches (``streaming.sketches``), which spares pass one.
They need not be right: pass two counts anew, and sees when a quantile lies elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..contract import OUTLIER_REACH, SENTINEL, SKEW_TOLERANCE
from ..functions.scalars import fraction
from ..session import durable
from .joins import attach

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
MEDIAN = {"median": 0.5}
# The sketch misses a rank by at most count/ACCURACY; a bracket reaches further than that
# on both sides. Columns of fewer rows than ACCURACY are sketched without error, where
# the neighbours of a bracket are at most one rank away.
ACCURACY = 10000
BRACKET_MARGIN = 4
# Per-key tables of up to so many bytes, written out as text, are broadcast.
BROADCAST_BYTES = 8 * 2**20
SALTS = 32

STATISTICS = [
    "count", "mean", "median", "min", "max", "range", "std_sample", "std_pop", "q1", "q3", "iqr",
]
OUTLIER_STATISTICS = ["low_fence", "high_fence", "n_outliers", "share"]


def stacked(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per row and column of ``df``: the ``by`` columns, ``column`` and ``value``."""
    # NaN is no value: it would make every sum and mean NaN.
    numbers = [F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double")).alias(f"__{name}") for name in columns]
    values = df.select(*by, *numbers)
    long = values.unpivot(list(by), [f"__{name}" for name in columns], "column", "value")
    return long.withColumn("column", F.substring("column", 3, 1000))


def bracket_ranks(quantiles: dict[str, float], margin: float) -> list[float]:
    """The shares of the values below the two edges of each quantile's bracket."""
    return [edge for q in quantiles.values() for edge in (max(0.0, q - margin), min(1.0, q + margin))]


def _sketch(values: DataFrame, keys: list[str], quantiles: dict[str, float], accuracy: int) -> DataFrame:
    """Pass one, per key: the number of values, and for each quantile its bracket."""
    edges = bracket_ranks(quantiles, BRACKET_MARGIN / accuracy)
    return values.groupBy(*keys).agg(
        F.count("value").alias("count"), F.percentile_approx("value", edges, accuracy).alias("edges")
    )


def _attach_sized(rows: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with the columns of a stored per-key table.

    The table is broadcast only when its measured size is small. Beyond that both
    sides are shuffled by key and input partition, so that the rows of a key, however
    many, are spread over ``SALTS`` tasks.
    """
    size = small.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes")).first().bytes or 0
    if size <= BROADCAST_BYTES:
        return attach(rows, F.broadcast(small), keys, how)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = rows.withColumn("salt", F.spark_partition_id() % SALTS)
    return attach(salted, small.withColumn("salt", salts), [*keys, "salt"], how).drop("salt")


def _position(q: float) -> Column:
    """Zero-based fractional rank of a quantile, for linear interpolation."""
    return F.lit(q) * (F.col("count") - 1)


def _zones(values: DataFrame, brackets: DataFrame, keys: list[str], n_quantiles: int, how: str = "inner") -> DataFrame:
    """Pass two: values between the brackets are only counted and summed, per zone; those
    inside are kept apart, one row per distinct value. Zones follow the values' order.
    NULL values are in a zone of their own, as are the values of keys without brackets."""
    value, edge = F.col("value"), [F.element_at("edges", i + 1) for i in range(2 * n_quantiles)]
    pairs = list(zip(edge[::2], edge[1::2]))
    zone = reduce(add, [(value >= low).cast("int") + (value > high).cast("int") for low, high in pairs])
    inside = reduce(or_, [value.between(low, high) for low, high in pairs])
    off = value - edge[n_quantiles]  # from a value near the middle, which keeps the sums accurate
    placed = _attach_sized(values, brackets, keys, how)
    return placed.groupBy(*keys, zone.alias("zone"), F.when(inside, value).alias("kept")).agg(
        F.count("value").alias("n"),
        F.sum("value").alias("total"),
        F.min("value").alias("smallest"),
        F.max("value").alias("largest"),
        F.sum(off).alias("off"),
        F.sum(off * off).alias("off2"),
        F.max("count").alias("count"),
    )


def _ranked(zones: DataFrame, keys: list[str]) -> DataFrame:
    """``zones`` with the ranks ``first`` and ``last`` that each row spans within its key.

    The rows are cut into ranges by key and value; a range is ranked by one task, then
    shifted by the rows of its key in the ranges before. The window over ranges sees as
    many rows as there are partitions.
    """
    ranges = durable(
        zones.repartitionByRange(*keys, "zone", "kept").withColumn("slice", F.spark_partition_id())
    )
    before = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy(*keys, "slice").agg(F.sum("n").alias("rows"))
    shifts = sizes.select(*keys, "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy(*keys, "slice").orderBy("zone", "kept")
    upto = F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        attach(ranges, shifts, [*keys, "slice"])
        .withColumn("last", upto + F.col("shift"))
        .withColumn("first", F.col("last") - F.col("n"))
    )


def summarise(
    values: DataFrame,
    keys: Sequence[str],
    quantiles: dict[str, float] = QUARTILES,
    accuracy: int = ACCURACY,
    brackets: DataFrame | None = None,
) -> DataFrame:
    """Per key of stacked ``values``: ``count total mean min max std_sample std_pop`` and
    exact quantiles, interpolated linearly between neighbours.

    ``brackets`` of the same quantiles, per key a row of the ``edges`` that ``bracket_ranks``
    names, spare the first pass. Keys without any, and those whose quantiles turn out to lie
    elsewhere, are sketched after all; keys that have no rows any more are left out.
    """
    keys = list(keys)
    if brackets is None:
        sketch = durable(_sketch(values, keys, quantiles, accuracy))
        zones = _zones(values.where(F.col("value").isNotNull()), sketch, keys, len(quantiles))
        missing = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")
        return _summary(sketch.drop("edges"), zones, keys, quantiles, missing)
    # The count only marks keys that have brackets; it is counted below.
    marked = durable(brackets.where(F.col("edges").isNotNull()).select(*keys, "edges", F.lit(1).alias("count")))
    zones = durable(_zones(values, marked, keys, len(quantiles), "left"))
    counts = zones.groupBy(*keys).agg(F.sum("n").alias("count"), F.max("count").isNotNull().alias("bracketed"))
    zones = attach(zones.drop("count"), counts.drop("bracketed"), keys)
    result = durable(_summary(counts, zones, keys, quantiles, F.lit(None).cast("double"), ["bracketed"]))
    found = reduce(and_, [F.col(name).isNotNull() for name in quantiles]) & F.col("bracketed") | (F.col("count") == 0)
    missed = durable(result.where(~found).select(*keys))
    result = result.where(found).drop("bracketed")
    if missed.isEmpty():
        return result
    return result.unionByName(summarise(_attach_sized(values, missed, keys).select(*values.columns), keys, quantiles, accuracy))


def _summary(
    counts: DataFrame, zones: DataFrame, keys: list[str], quantiles: dict[str, float], missing: Column, also: Sequence[str] = ()
) -> DataFrame:
    """The statistics of ``summarise`` per key of ``counts``, from the zones; ``missing`` stands for ranks in the midst of a zone."""
    ranked = _ranked(zones, keys)

    def at(rank: Column) -> Column:
        rank = rank.cast("long")
        found = (
            F.when(F.col("kept").isNotNull(), F.col("kept"))
            .when(rank == F.col("first"), F.col("smallest"))
            .when(rank == F.col("last") - 1, F.col("largest"))
            .otherwise(missing)
        )
        return F.max(F.when((rank >= F.col("first")) & (rank < F.col("last")), found))

    neighbours = {
        f"{name}__{side}": at(end(_position(q)))
        for name, q in quantiles.items()
        for side, end in (("low", F.floor), ("high", F.ceil))
    }
    found = ranked.groupBy(*keys).agg(
        F.sum("total").alias("total"),
        F.min("smallest").alias("min"),
        F.max("largest").alias("max"),
        (F.sum("off2") - F.sum("off") * F.sum("off") / F.sum("n")).alias("squares"),
        *[column.alias(name) for name, column in neighbours.items()],
    )
    squares = F.greatest(F.col("squares"), F.lit(0.0))
    beyond_one = F.nullif(F.col("count") - 1, F.lit(0))
    return attach(counts, found, keys, "left").select(
        *keys, "count", "total",
        F.try_divide("total", "count").alias("mean"),
        "min", "max",
        F.when(F.col("squares").isNotNull(), F.sqrt(F.try_divide(squares, beyond_one))).alias("std_sample"),
        F.when(F.col("squares").isNotNull(), F.sqrt(F.try_divide(squares, F.col("count")))).alias("std_pop"),
        *[
            (
                F.col(f"{name}__low")
                + (F.col(f"{name}__high") - F.col(f"{name}__low")) * (_position(q) - F.floor(_position(q)))
            ).alias(name)
            for name, q in quantiles.items()
        ],
        *also,
    )


def _statistics(values: DataFrame, brackets: DataFrame | None = None) -> DataFrame:
    return (
        summarise(values, ["column"], brackets=brackets)
        .withColumns({"range": F.col("max") - F.col("min"), "iqr": F.col("q3") - F.col("q1")})
        .select("column", *STATISTICS)
    )


def describe(df: DataFrame, columns: Sequence[str], brackets: DataFrame | None = None) -> DataFrame:
    """Eleven statistics of each numeric column, one row per column. NULLs are ignored.
    ``brackets`` per column, see ``summarise``, spare a scan."""
    return _statistics(stacked(df, columns), brackets)


def _outliers(values: DataFrame, statistics: DataFrame, reach: float) -> DataFrame:
    fences = durable(
        statistics.select(
            "column", "count",
            (F.col("q1") - reach * F.col("iqr")).alias("low_fence"),
            (F.col("q3") + reach * F.col("iqr")).alias("high_fence"),
        )
    )
    value = F.col("value")
    outside = (value < F.col("low_fence")) | (value > F.col("high_fence"))
    counted = (
        _attach_sized(values, fences, ["column"])
        .groupBy("column", "count", "low_fence", "high_fence")
        .agg(F.count_if(outside).alias("n_outliers"))
    )
    share = F.coalesce(F.try_divide("n_outliers", "count"), F.lit(0.0))
    return counted.select("column", "low_fence", "high_fence", "n_outliers", share.alias("share"))


def iqr_outliers(df: DataFrame, columns: Sequence[str], k: float = OUTLIER_REACH) -> DataFrame:
    """Fences ``k`` interquartile ranges beyond the quartiles, and the count and share of
    values outside them, one row per column."""
    values = stacked(df, columns)
    return _outliers(values, _statistics(values), k)


def numeric_summary(df: DataFrame, columns: Sequence[str], k: float = OUTLIER_REACH) -> DataFrame:
    """``describe`` and ``iqr_outliers`` side by side, outlier columns prefixed."""
    values = stacked(df, columns)
    statistics = durable(_statistics(values))
    outliers = _outliers(values, statistics, k)
    prefixed = outliers.select("column", *[F.col(name).alias(f"outlier_{name}") for name in OUTLIER_STATISTICS])
    return attach(statistics, prefixed, ["column"])


def segment_stats(df: DataFrame, by: str, value: str = "price", brackets: DataFrame | None = None) -> DataFrame:
    """Count, average, median and total of ``value`` per segment, largest first. NULL is a
    segment of its own. ``brackets`` of the median per segment, see ``summarise``, spare a scan."""
    stats = summarise(stacked(df, [value], [by]), [by], MEDIAN, brackets=brackets)
    return stats.select(by, "count", F.col("mean").alias("avg"), "median", "total").orderBy(
        F.desc("count"), F.asc_nulls_last(by)
    )


def skew_class(statistics: DataFrame, tolerance: float = SKEW_TOLERANCE) -> DataFrame:
    """``right`` or ``left`` when the mean is more than ``tolerance`` away from the median,
    else ``symmetric``; a zero median is ``symmetric``."""
    mean, median = F.col("mean"), F.col("median")
    skew = (
        F.when((median != 0) & (mean > median * (1 + tolerance)), "right")
        .when((median != 0) & (mean < median * (1 - tolerance)), "left")
        .otherwise("symmetric")
    )
    return statistics.select("column", "mean", "median", skew.alias("skew"))


def share_columns(columns: Sequence[str], sentinel: str = SENTINEL) -> list[Column]:
    """The aggregates that ``shares_as_rows`` turns into rows."""
    return [
        *[fraction(F.col(name).isNull()).alias(f"{name}__null") for name in columns],
        *[fraction(F.col(name) == sentinel).alias(f"{name}__sentinel") for name in columns],
        fraction(F.col("deleted_at").isNotNull()).alias("deleted_share"),
    ]


def shares_as_rows(shares: DataFrame, columns: Sequence[str]) -> DataFrame:
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.col(f"{name}__null").alias("null_share"),
                F.col(f"{name}__sentinel").alias("not_defined_share"),
            )
            for name in columns
        ]
    )
    return shares.select(F.inline(rows), "deleted_share")


def dq_metrics(messages: DataFrame, columns: Sequence[str], sentinel: str = SENTINEL) -> DataFrame:
    """Share of real NULLs and of the sentinel per column, and the share of deleted rows.

    Meant for the base table. One wide aggregate, turned into rows afterwards.
    """
    return shares_as_rows(messages.agg(*share_columns(columns, sentinel)), columns)


def grouped(df: DataFrame, columns: Sequence[str], segments: Sequence[str], value: str) -> DataFrame:
    """One row per row of ``df`` and subject: each of ``columns`` with its own value, and the row's segment of each of
    ``segments`` with its ``value``. ``kind`` is empty for columns, else the segment's name; ``subject`` is text."""

    def number(name: str) -> Column:
        return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double")).alias("value")

    subjects = [F.struct(F.lit("").alias("kind"), F.lit(name).alias("subject"), number(name)) for name in columns]
    subjects += [F.struct(F.lit(name).alias("kind"), F.col(name).cast("string").alias("subject"), number(value)) for name in segments]
    return df.select(F.inline(F.array(*subjects)))


def report_frames(
    messages: DataFrame, columns: Sequence[str], segments: Sequence[str], value: str, checked: Sequence[str], k: float = OUTLIER_REACH
) -> dict[str, DataFrame]:
    """``numeric_summary`` of ``columns``, ``segment_stats`` of ``value`` by each of ``segments``, both of rows that are
    not deleted, and ``dq_metrics`` of ``checked`` over all rows, under the names ``""``, the segments', and ``dq``.

    Three scans of ``messages`` make all of them: two give the statistics of every subject
    together, and one counts what lies beyond the fences, which are two numbers for each
    column, along with the shares.
    """
    kept = messages.where(F.col("deleted_at").isNull())
    stats = durable(summarise(grouped(kept, columns, segments, value), ["kind", "subject"]))
    summary = stats.where("kind = ''").withColumns({"range": F.col("max") - F.col("min"), "iqr": F.col("q3") - F.col("q1")})
    fences = {
        row.subject: (row.q1 - k * row.iqr, row.q3 + k * row.iqr)
        for row in summary.where("q1 is not null").select("subject", "q1", "q3", "iqr").collect()
    }

    def beyond(name: str) -> Column:
        low, high = fences[name]
        number = F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
        return F.count_if(F.col("deleted_at").isNull() & ((number < low) | (number > high))).alias(f"{name}__beyond")

    counted = durable(messages.agg(*share_columns(checked), *[beyond(name) for name in fences]))
    outliers = [
        F.struct(F.lit(name).alias("column"), F.lit(low).alias("outlier_low_fence"), F.lit(high).alias("outlier_high_fence"),
                 F.col(f"{name}__beyond").alias("outlier_n_outliers"))
        for name, (low, high) in fences.items()
    ]
    named = summary.select(F.col("subject").alias("column"), *STATISTICS)
    if outliers:
        named = attach(named, counted.select(F.inline(F.array(*outliers))), ["column"], "left")
    else:
        empty = {"low_fence": "double", "high_fence": "double", "n_outliers": "long"}
        named = named.withColumns({f"outlier_{name}": F.lit(None).cast(kind) for name, kind in empty.items()})
    share = F.coalesce(F.try_divide("outlier_n_outliers", "count"), F.lit(0.0))
    frames = {"": named.withColumn("outlier_n_outliers", F.coalesce("outlier_n_outliers", F.lit(0))).withColumn("outlier_share", share)}
    for by in segments:
        segment = F.col("subject").cast(messages.schema[by].dataType).alias(by)
        own = stats.where(F.col("kind") == by).select(segment, "count", F.col("mean").alias("avg"), "median", "total")
        frames[by] = own.orderBy(F.desc("count"), F.asc_nulls_last(by))
    return {**frames, "dq": shares_as_rows(counted, checked)}
