"""URL filters as they stood when a page was fetched.

Dated entries ("this host is listed from", "is listed no more from") become validity
intervals, and an as-of join looks up, for every capture, the entries active at its time.
Captures and intervals are joined by key and calendar month, so that a key with many
captures or a long history is spread over the months; within a month the interval must
hold the time of the capture.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import attach

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]*)"


def host_of(url: Column) -> Column:
    """The host in lower case; empty without one."""
    return F.lower(F.regexp_extract(url, HOST, 1))


def without_fragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)


def domain_labels(entries: DataFrame) -> list[int]:
    """The numbers of labels that listed domains have."""
    labels = F.size(F.split("key", r"\."))
    return [row.n for row in entries.where((F.col("kind") == "domain") & F.col("key").isNotNull()).select(labels.alias("n")).distinct().collect()]


def url_keys(url: Column, n_labels: list[int]) -> Column:
    """What a URL may be listed by: ``host``, each ``domain`` of ``n_labels`` labels it lies in, and the ``url``
    without fragment. Other domains are not listed, so that the keys of a long host are few as well."""

    def key(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("key"))

    host = host_of(url)
    labels = F.split(host, r"\.")
    listed = F.filter(F.lit(np.array(sorted(n_labels), np.int32)), lambda n: n <= F.size(labels))
    domains = F.transform(
        listed, lambda n: key("domain", F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))
    )
    return F.concat(F.array(key("host", host), key("url", without_fragment(url))), domains)


def validity(entries: DataFrame) -> DataFrame:
    """``list, kind, key, valid_from, valid_to`` of ``list, kind, key, at, active``.

    An entry holds from its date up to the next dated entry of the same list and key, or
    for good. Of several entries of one instant, a listing wins. Entries without a key or
    a date say nothing.
    """
    history = Window.partitionBy("list", "kind", "key").orderBy("at")
    return (
        entries.where(F.col("key").isNotNull() & F.col("at").isNotNull())
        .groupBy("list", "kind", "key", "at")
        .agg(F.bool_or("active").alias("active"))
        .withColumn("valid_to", F.lead("at").over(history))
        .where("active")
        .select("list", "kind", "key", F.col("at").alias("valid_from"), "valid_to")
    )


def _month(at: Column) -> Column:
    return F.year(at) * 12 + F.month(at)


def filter_urls(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` with ``host, n_entries, lists, blocked``.

    ``captures`` has ``url, fetched_at``; columns named like the new ones are replaced.
    ``n_entries`` counts the entries active at the time of the fetch, ``lists`` names their
    lists, sorted and comma-joined, ``blocked`` says that there are any.

    A NULL URL or time matches nothing and stays. Repeated captures get the same verdict;
    each distinct URL and time is looked up once. No captures give no rows, no entries
    block nothing.
    """
    asked = captures.select("url", "fetched_at").where(F.col("url").isNotNull() & F.col("fetched_at").isNotNull()).distinct()
    keys = asked.select("url", "fetched_at", F.explode(F.array_distinct(url_keys(F.col("url"), domain_labels(entries)))).alias("k")).select(
        "url", "fetched_at", "k.kind", "k.key", _month(F.col("fetched_at")).alias("month")
    )
    span = captures.agg(F.min("fetched_at").alias("lo"), F.max("fetched_at").alias("hi")).first()
    first = F.lit(span.lo.year * 12 + span.lo.month if span.lo else 1)
    last = F.lit(span.hi.year * 12 + span.hi.month if span.hi else 0)
    begin = F.greatest(_month(F.col("valid_from")), first)
    end = F.least(F.coalesce(_month(F.col("valid_to")), last), last)
    intervals = validity(entries).where(begin <= end).withColumn("month", F.explode(F.sequence(begin, end)))
    active = (F.col("fetched_at") >= F.col("valid_from")) & (
        F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to"))
    )
    verdicts = (
        keys.join(intervals, ["kind", "key", "month"])
        .where(active)
        .groupBy("url", "fetched_at")
        .agg(F.count("*").alias("n_entries"), F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"))
    )
    kept = captures.drop("host", "n_entries", "lists", "blocked")
    return attach(kept, verdicts, ["url", "fetched_at"], "left").select(
        *kept.columns,
        host_of(F.col("url")).alias("host"),
        F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
        F.coalesce("lists", F.lit("")).alias("lists"),
        F.col("n_entries").isNotNull().alias("blocked"),
    )
