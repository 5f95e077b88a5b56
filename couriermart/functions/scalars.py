"""Small scalar expressions shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contract import DELIVERED, IN_FLIGHT, NULL_LABEL

# Fixed value: the RFC 4122 namespace for DNS names.
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def percent(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole, rounded; NULL when ``whole`` is zero."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole), digits)


def fraction(predicate: Column) -> Column:
    """Share of all rows for which ``predicate`` is true; NULL counts as false."""
    return F.avg(F.when(predicate, 1.0).otherwise(0.0))


def known_fraction(predicate: Column) -> Column:
    """Share among the rows for which ``predicate`` is not NULL."""
    return F.avg(predicate.cast("double"))


def clip(value: Column, low: float, high: float) -> Column:
    """``value`` held inside [low, high]; NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def label_null(column: str | Column) -> Column:
    """The value, or a visible label for NULL."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(NULL_LABEL))


def status_class(status: str) -> Column:
    """``delivered``, ``in_flight`` or ``failed``; a NULL status is ``failed``."""
    return (
        F.when(F.col(status) == DELIVERED, "delivered")
        .when(F.col(status).isin(IN_FLIGHT), "in_flight")
        .otherwise("failed")
    )


def named_uuid(name: str | Column, namespace: str = DNS_NAMESPACE) -> Column:
    """The version-5 UUID of ``name``: the same name always gives the same id."""
    text = F.col(name) if isinstance(name, str) else name
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(text, "UTF-8")))
    variant = F.substring(F.lit("89ab89ab89ab89ab"), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") + 1, F.lit(1))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
