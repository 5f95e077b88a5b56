"""Equi-joins that keep NULL keys together and add no duplicate key columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` with the columns of ``right`` for the same keys, NULL matching NULL.

    Null-safe equality is still a hash or merge join key in Spark.
    """
    renamed = right.select(
        *[F.col(key).alias(f"__{key}") for key in keys],
        *[F.col(name) for name in right.columns if name not in keys],
    )
    matches = reduce(and_, [F.col(key).eqNullSafe(F.col(f"__{key}")) for key in keys])
    return left.join(renamed, matches, how).drop(*[f"__{key}" for key in keys])
