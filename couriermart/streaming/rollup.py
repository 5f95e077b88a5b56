"""The daily rollup: mergeable partial aggregates per day, country, status and currency.

Other partials can be kept in the same way, see ``Partials`` and ``streaming.receivers``.

The rollup is a set of runs, each a folder of partials; the sum of all runs is the rollup.
One commit (see ``sources.commits``) names everything that counts:

``runs``     folders of partials, each with its level
``batches``  per stream, which micro-batches have been counted
``covered``  lists of mart files that a backfill, reload or rebuild has counted, wholly or
             for some days; a stream of the same mart leaves those rows out
``pending``  what replaces ``runs`` and ``covered`` once the mart has the generation it names

Every writer adds one commit, after all its data, so one that dies has changed nothing and
can be repeated: a batch is counted once, a backfill and its list of files appear together,
and mart and rollup change generation at the same moment.

A changed message adds minus its old and plus its new state, so that deletes reach the
rollup as any other row does. Nothing is watermarked: a row that arrives late adds to its
own day, however old. Runs are merged by levels, so a reader opens few of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..contract import DELIVERED, ROLLUP_KEYS, ROLLUP_SCHEMA
from ..functions.dates import day
from ..operators.charts import Filters, apply_filters
from ..session import release_shuffles, source_files
from ..sources import commits
from ..sources.mart import active

BACKFILL_BATCH = -1
ROLLUP_INPUTS = ["sent_date", "country", "delivery_status", "currency", "price", "deleted_at"]
# Streams that name the file of each row in this column are held against ``covered``. Its
# metadata may name the mart; then rows of other generations than its current one are left out.
SOURCE_FILE = "source_file"
SOURCE_MART = "mart"
GENERATION = "generation"
# 1 for a message or its new state, -1 for a state that it no longer has.
SIGN = "change_sign"
# Runs of one level that are merged into one of the next.
MERGED_RUNS = 8
_COVERED = T.StructType([T.StructField("file", T.StringType()), T.StructField("days", T.ArrayType(T.DateType()))])

State = commits.State


def rollup_build(messages: DataFrame) -> DataFrame:
    """Partial aggregates of the messages that are not deleted. A NULL status counts as
    not delivered. With the column ``change_sign``, rows are added or taken away; a price
    that is not a number cannot be taken away again but by ``rollup_rebuild``."""
    kept = active(messages).groupBy(day("sent_date").alias("day"), *ROLLUP_KEYS[1:])
    delivered, price = F.col("delivery_status") == DELIVERED, F.col("price").cast("double")
    if SIGN not in messages.columns:
        return kept.agg(F.count("*").alias("msgs"), F.count_if(delivered).alias("delivrd"), F.sum(price).alias("revenue"))
    sign = F.col(SIGN).cast("long")
    return kept.agg(
        F.sum(sign).alias("msgs"),
        F.sum(F.when(delivered, sign).otherwise(0)).alias("delivrd"),
        F.sum(price * sign).alias("revenue"),
    )


@dataclass(frozen=True)
class Partials:
    """What a rollup keeps: its columns, of which ``msgs`` counts messages, those that are added up, how messages
    become partials, and columns of quantile sketches, which are merged. Signed rows must count with their sign."""

    schema: T.StructType
    measures: tuple[str, ...]
    build: Callable[[DataFrame], DataFrame]
    sketches: tuple[str, ...] = ()

    @property
    def keys(self) -> list[str]:
        return [name for name in self.schema.names if name not in {*self.measures, *self.sketches}]


DAILY = Partials(ROLLUP_SCHEMA, ("msgs", "delivrd", "revenue"), rollup_build)


def rollup_merge(partials: DataFrame, keys: Sequence[str] | None = None, kind: Partials = DAILY) -> DataFrame:
    """Partials of the same ``keys`` combined. Any subset of the keys will do; all, if none are named."""
    return partials.groupBy(*(kind.keys if keys is None else keys)).agg(
        *[F.sum(name).alias(name) for name in kind.measures],
        *[F.kll_merge_agg_double(name).alias(name) for name in kind.sketches],
    )


# --- what is stored ---------------------------------------------------------


def _settled(spark: SparkSession, state: State) -> State:
    """The state in force: what is pending replaces the rest once the mart has changed generation."""
    state = {"runs": [], "covered": [], "batches": {}, "pending": None, **state}
    pending = state["pending"]
    if pending and commits.generation(spark, pending["mart"]) == pending["generation"]:
        state = {**state, "runs": pending["runs"], "covered": pending["covered"], "pending": None}
    return state


def _state(spark: SparkSession, root: str) -> State:
    return _settled(spark, commits.newest(spark, root)[1])


def _update(spark: SparkSession, root: str, change) -> State | None:
    return commits.update(spark, root, lambda state: change(_settled(spark, state)))


def _read_runs(spark: SparkSession, root: str, runs: Sequence[Sequence], kind: Partials = DAILY) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], kind.schema)
    return spark.read.schema(kind.schema).parquet(*[f"{root}/{path}" for path, _ in runs])


def rollup_read(spark: SparkSession, root: str, keys: Sequence[str] | None = None, kind: Partials = DAILY) -> DataFrame:
    """The rollup as stored below ``root``, merged once, to one row per combination of ``keys``."""
    return rollup_merge(_read_runs(spark, root, _state(spark, root)["runs"], kind), keys, kind).where(F.col("msgs") > 0)


def write_run(partials: DataFrame, root: str, level: int = 0, kind: Partials = DAILY) -> list:
    """Store ``partials`` as a run that counts as soon as a commit names it."""
    path = f"runs/{commits.new_name()}"
    partials.select(*kind.schema.names).write.option("compression", "zstd").parquet(f"{root}/{path}")
    release_shuffles(partials.sparkSession)
    return [path, level]


def write_covered(messages: DataFrame, root: str, days: Sequence[date] | None = None) -> list[str]:
    """Store the files that ``messages`` are read from as counted, wholly or for ``days``, once a commit names the list.
    The list is the one that Spark's scan holds on the driver anyway."""
    files = source_files(messages)
    if not files:
        return []
    path = f"covered/{commits.new_name()}"
    chosen = list(days) if days is not None else None
    messages.sparkSession.createDataFrame([(name, chosen) for name in files], _COVERED).write.parquet(f"{root}/{path}")
    return [path]


def _counted(ranges: Sequence[Sequence[int]], batch_id: int) -> bool:
    return any(first <= batch_id <= last for first, last in ranges)


def _with_batch(ranges: Sequence[Sequence[int]], batch_id: int) -> list[list[int]]:
    """Ranges of counted batches, one more included; neighbours become one range."""
    merged: list[list[int]] = []
    for first, last in sorted([*map(list, ranges), [batch_id, batch_id]]):
        if merged and first <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], last)
        else:
            merged.append([first, last])
    return merged


def _not_counted(messages: DataFrame, root: str, state: State) -> DataFrame:
    """Of a stream's messages those that no backfill, reload or rebuild has counted, and that the mart still has."""
    if SOURCE_FILE not in messages.columns:
        return messages
    spark = messages.sparkSession
    mart = messages.schema[SOURCE_FILE].metadata.get(SOURCE_MART)
    if mart:
        messages = messages.where(F.col(GENERATION) == F.lit(commits.generation(spark, mart)))
    if not state["covered"]:
        return messages
    covered = spark.read.schema(_COVERED).parquet(*[f"{root}/{path}" for path in state["covered"]])
    whole_or_day = covered["days"].isNull() | F.array_contains(covered["days"], day("sent_date"))
    return messages.join(covered, (messages[SOURCE_FILE] == covered["file"]) & whole_or_day, "left_anti")


# --- writers ----------------------------------------------------------------


def rollup_add(messages: DataFrame, root: str, batch_id: int, stream: str = "", kind: Partials = DAILY) -> None:
    """Count ``messages`` as batch ``batch_id`` of ``stream``; repeating it changes nothing. Rows that name
    their file are left out if that file has been counted."""

    def add(state: State) -> State | None:
        done = state["batches"].get(stream, [])
        if _counted(done, batch_id):
            return None
        run = write_run(kind.build(_not_counted(messages, root, state)), root, kind=kind)
        return {**state, "runs": [*state["runs"], run], "batches": {**state["batches"], stream: _with_batch(done, batch_id)}}

    _update(messages.sparkSession, root, add)
    _merge_levels(messages.sparkSession, root, kind)


def _merge_levels(spark: SparkSession, root: str, kind: Partials) -> None:
    """Merge the runs of every level that has ``MERGED_RUNS``: n batches leave at most that many runs for each
    power of it, and each partial is rewritten once a level."""

    def merge(state: State) -> State | None:
        counts: dict[int, int] = {}
        for _, level in state["runs"]:
            counts[level] = counts.get(level, 0) + 1
        full = [level for level, count in sorted(counts.items()) if count >= MERGED_RUNS]
        if not full:
            return None
        chosen = [run for run in state["runs"] if run[1] == full[0]]
        merged = write_run(rollup_merge(_read_runs(spark, root, chosen, kind), kind=kind), root, full[0] + 1, kind)
        return {**state, "runs": [run for run in state["runs"] if run not in chosen] + [merged]}

    while _update(spark, root, merge) is not None:
        pass


def rollup_backfill(messages: DataFrame, root: str, kind: Partials = DAILY) -> bool:
    """Fill an empty rollup from the messages that are already there. Leaves a rollup that
    has rows alone. Returns whether rows were added. The files they are read from are
    recorded by the same commit, so that a stream of the same mart goes on with what comes later."""
    spark = messages.sparkSession

    def fill(state: State) -> State | None:
        if not rollup_merge(_read_runs(spark, root, state["runs"], kind), kind=kind).where(F.col("msgs") > 0).isEmpty():
            return None
        run = write_run(kind.build(messages), root, kind=kind)
        return {**state, "runs": [*state["runs"], run], "covered": state["covered"] + write_covered(messages, root)}

    return _update(spark, root, fill) is not None and not rollup_read(spark, root, kind=kind).isEmpty()


def rollup_stream(
    messages: DataFrame, root: str, checkpoint: str, available_now: bool = False, kind: Partials = DAILY
) -> StreamingQuery:
    """Maintain the rollup from a stream of messages, one commit per micro-batch.

    ``checkpoint`` keeps the stream's progress and must outlive it. A stream of the stored
    mart (``layout.stream_mart``) leaves out what a backfill, a reload or a rebuild has counted.
    """
    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: rollup_add(batch, root, batch_id, checkpoint, kind)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def rollup_replace(messages: DataFrame, root: str, mart: str, generation: str, kind: Partials = DAILY) -> None:
    """Have the rollup of ``messages``, read from a generation of ``mart`` that is not current yet, take the
    place of the present one at the moment that generation becomes current."""
    run, covered = write_run(kind.build(messages), root, kind=kind), write_covered(messages, root)
    pending = {"mart": mart, "generation": generation, "runs": [run], "covered": covered}
    _update(messages.sparkSession, root, lambda state: {**state, "pending": pending})


def _on_days(column: Column, days: Sequence[date]) -> Column:
    return F.coalesce(column.isin(list(days)), F.lit(False))


def rollup_rebuild(messages: DataFrame, root: str, days: Sequence[date]) -> None:
    """Recompute whole days from the messages.

    ``messages`` must include everything the rollup has seen; what it includes beyond that,
    a stream that comes to it later leaves out. All runs become one, without the days' old
    rows and with their new ones: the rollup has few rows beside the messages.
    """
    spark, days = messages.sparkSession, sorted(set(days))
    span = Filters(sent_from=datetime.combine(days[0], time.min), sent_to=datetime.combine(days[-1], time.max))

    def rebuild(state: State) -> State:
        others = rollup_merge(_read_runs(spark, root, state["runs"])).where(~_on_days(F.col("day"), days))
        fresh = rollup_build(apply_filters(messages, span)).where(_on_days(F.col("day"), days))
        run = write_run(others.unionByName(fresh), root, _next_level(state))
        return {**state, "runs": [run], "covered": state["covered"] + write_covered(messages, root, days)}

    _update(spark, root, rebuild)


def _next_level(state: State) -> int:
    return max((level for _, level in state["runs"]), default=0)


def rollup_compact(spark: SparkSession, root: str, kind: Partials = DAILY) -> int:
    """Merge all runs into one, and all lists of covered files into one. Rows that have come to nothing stay, as a
    delete may be counted before its message. Returns the last batch that has been counted, of any stream."""

    def compact(state: State) -> State | None:
        if len(state["runs"]) <= 1 and len(state["covered"]) <= 1:
            return None
        merged = rollup_merge(_read_runs(spark, root, state["runs"], kind), kind=kind)
        covered = state["covered"]
        if len(covered) > 1:
            path = f"covered/{commits.new_name()}"
            lists = spark.read.schema(_COVERED).parquet(*[f"{root}/{name}" for name in covered])
            lists.groupBy("file").agg(
                F.when(F.count("days") == F.count("*"), F.array_distinct(F.flatten(F.collect_list("days")))).alias("days")
            ).write.parquet(f"{root}/{path}")
            covered = [path]
        return {**state, "runs": [write_run(merged, root, _next_level(state), kind)], "covered": covered}

    _update(spark, root, compact)
    counted = [ranges[-1][1] for ranges in _state(spark, root)["batches"].values() if ranges]
    return max([BACKFILL_BATCH, *counted])


def rollup_expire(spark: SparkSession, root: str, keep_commits: int = 10, older_than_s: float = 86_400) -> list[str]:
    """Delete the runs and lists that none of the last ``keep_commits`` commits names, unless they are younger than
    ``older_than_s``, which must exceed the time that any reader or writer takes. Returns what was deleted."""

    def named(state: State) -> set[str]:
        held = [state, state.get("pending") or {}]
        return {path for part in held for path, _ in part.get("runs", [])} | {path for part in held for path in part.get("covered", [])}

    return commits.expire(spark, root, ["runs", "covered"], named, keep_commits, older_than_s)


def open_runs(spark: SparkSession, root: str) -> int:
    """How many folders a reader of the rollup opens."""
    return len(_state(spark, root)["runs"])
