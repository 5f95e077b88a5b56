"""The stored mart: Parquet by month, sorted, with bloom filters on the ids.

Readers by time skip months (``ym``). Inside a month the rows are ordered by customer
and time across files, so row-group statistics serve a customer's messages in a period.
Lookups by message go through an index (``sources.ids``), by application through bloom filters.

Below the mart's path lie

``generation=G``  the messages. Replacing the mart writes a new generation; a commit (see
                  ``sources.commits``) says which one is current
``_changes``      soft deletes, a row for each message that was deleted after it was stored:
                  its state at that time, and when it was deleted. Readers apply them
``_ids``          the index of ids

Appends and deletes are files added to the current generation. Both leave out what is there
already, so that repeating one that died half way finishes it.
"""

from __future__ import annotations

import math
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import MESSAGE_COLUMNS, MESSAGE_SCHEMA
from ..functions.dates import year_month
from ..operators.charts import Filters, apply_filters
from ..operators.checks import load_metrics
from ..session import release_shuffles, source_bytes
from ..streaming.rollup import GENERATION, SIGN, SOURCE_FILE, SOURCE_MART, rollup_replace
from . import commits, ids

PARTITION = "ym"
SORT = ["customer_id", "sent_date", "country", "delivery_status", "message_id"]
STORED_SCHEMA = T.StructType([*MESSAGE_SCHEMA, T.StructField(PARTITION, T.IntegerType())])
CHANGES = "_changes"
LOADED = "loaded"
NEW_DELETED_AT = "new_deleted_at"
_CHANGE_SCHEMA = T.StructType([*STORED_SCHEMA, T.StructField(NEW_DELETED_AT, T.TimestampNTZType())])
_GENERATION_FIELD = T.StructField(GENERATION, T.StringType())

# Fixed value: the share of lookups a bloom filter may let through in vain.
BLOOM_FPP = "0.01"
# Enough for the ids of a full row group at that rate; smaller ones get smaller filters.
BLOOM_MAX_BYTES = str(4 * 2**20)
# Messages per file, at most: about half a gigabyte.
FILE_ROWS = 10_000_000
# Half the bytes of the default, and no slower to write or read.
COMPRESSION = "zstd"
# Bytes of files from which a slice of months is derived: a load shuffles the messages of one slice at a time.
SLICE_BYTES = 2**30


def _with_month(messages: DataFrame) -> DataFrame:
    return messages.select(*MESSAGE_COLUMNS).withColumn(PARTITION, year_month("sent_date").cast("int"))


def _starting(month: int) -> Column:
    """Whether a message was sent in ``month`` or later, in forms that prune months and row groups."""
    start = F.make_timestamp_ntz(F.lit(month // 100), F.lit(month % 100), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return (F.col(PARTITION) >= month) & (F.col("sent_date") >= start)


def _before(month: int) -> Column:
    start = F.make_timestamp_ntz(F.lit(month // 100), F.lit(month % 100), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return (F.col(PARTITION).isNull() | (F.col(PARTITION) < month)) & (F.col("sent_date").isNull() | (F.col("sent_date") < start))


def month_slices(messages: DataFrame, calendar: DataFrame | None = None, slice_bytes: int | None = None) -> list[DataFrame]:
    """``messages``, which have a month column, in slices of neighbouring months, one for each ``slice_bytes`` of the files they
    are read from. They are all of the messages, once each; those without a month are in the first slice. A month is
    never split. ``calendar`` has the months, if asking the messages for them is dear."""
    calendar = messages if calendar is None else calendar
    slices = math.ceil(source_bytes(calendar) / (slice_bytes or SLICE_BYTES))
    if slices <= 1:
        return [messages]
    # One value per calendar month.
    months = sorted(row[0] for row in calendar.select(PARTITION).distinct().collect() if row[0] is not None)
    slices = max(1, min(slices, len(months)))
    firsts = [months[len(months) * i // slices] for i in range(1, slices)]
    parts, rest = [], messages
    for first in firsts:
        parts.append(rest.where(_before(first)))
        rest = messages.where(_starting(first))
    return [*parts, rest]


def _write(stored: DataFrame, path: str, partitions: int | None, calendar: DataFrame | None = None) -> dict[str, int]:
    """Write the messages, a slice of months after the other, so that the disks hold the shuffle of one. Returns what the
    tasks that wrote them have seen: their number, and how many had a value that the contract does not allow. It is counted
    on the way, without another scan."""
    seen: dict[str, int] = {}
    for part in [stored] if partitions else month_slices(stored, calendar):
        for name, n in _write_slice(part, path, partitions).items():
            seen[name] = seen.get(name, 0) + n
        release_shuffles(stored.sparkSession)
    return seen


def _write_slice(stored: DataFrame, path: str, partitions: int | None) -> dict[str, int]:
    # A range over (month, customer, time, id) has no hot key: a month or a customer with
    # a third of all rows is spread over a third of the tasks.
    key = [PARTITION, "customer_id", "sent_date", "message_id"]
    ranged = stored.repartitionByRange(partitions, *key) if partitions else stored.repartitionByRange(*key)
    seen = Observation()
    (
        ranged.sortWithinPartitions(PARTITION, *SORT)
        .observe(seen, *load_metrics())
        .write.mode("append")
        .partitionBy(PARTITION)
        .option("maxRecordsPerFile", FILE_ROWS)
        .option("compression", COMPRESSION)
        .option("parquet.bloom.filter.enabled#message_id", "true")
        .option("parquet.bloom.filter.enabled#application_uuid", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .option("parquet.bloom.filter.max.bytes", BLOOM_MAX_BYTES)
        .option("parquet.bloom.filter.candidates.number", "8")
        .option("parquet.bloom.filter.fpp", BLOOM_FPP)
        .parquet(path)
    )
    return dict(seen.get)


def _folder(path: str, generation: str) -> str:
    return f"{path}/{GENERATION}={generation}"


def _changes_folder(path: str, generation: str) -> str:
    return f"{path}/{CHANGES}/{GENERATION}={generation}"


def _make_generation(spark: SparkSession, path: str) -> str:
    generation = commits.new_name()
    for folder in (_folder(path, generation), _changes_folder(path, generation)):
        commits.make_folder(spark, folder)
    return generation


def _current(spark: SparkSession, path: str) -> str:
    generation = commits.generation(spark, path)
    if generation is None:
        raise FileNotFoundError(f"no mart at {path}")
    return generation


def _stored(spark: SparkSession, path: str, generation: str, files: list[str] | None = None) -> DataFrame:
    """The messages as they were written; only those of ``files``, if given."""
    folder = _folder(path, generation)
    if files is None:
        return spark.read.schema(STORED_SCHEMA).parquet(folder)
    return spark.read.schema(STORED_SCHEMA).option("basePath", folder).parquet(*files)


def _with_changes(spark: SparkSession, path: str, generation: str, stored: DataFrame) -> DataFrame:
    """``stored``, rows of the generation, with the deletes that came later. Without any there is nothing to join."""
    folder = _changes_folder(path, generation)
    if not any(not name.startswith(("_", ".")) for name, _ in commits.children(spark, folder)):
        return stored
    changes = spark.read.schema(_CHANGE_SCHEMA).parquet(folder)
    # Named apart, as both sides come from one schema.
    deletes = changes.groupBy(F.col(PARTITION).alias("__ym"), F.col("message_id").alias("__id")).agg(
        F.min(NEW_DELETED_AT).alias(NEW_DELETED_AT)
    )
    same = (stored[PARTITION] == deletes["__ym"]) & (stored["message_id"] == deletes["__id"])
    return (
        stored.join(deletes, same, "left")
        .withColumn("deleted_at", F.coalesce("deleted_at", NEW_DELETED_AT))
        .select(*STORED_SCHEMA.names)
    )


def open_mart(spark: SparkSession, path: str) -> DataFrame:
    """The stored mart, with its month column."""
    generation = _current(spark, path)
    return _with_changes(spark, path, generation, _stored(spark, path, generation))


def _write_generation(messages: DataFrame, path: str, partitions: int | None) -> tuple[str, dict]:
    """A new generation and the state that makes it current."""
    spark = messages.sparkSession
    generation = _make_generation(spark, path)
    seen = _write(_with_month(messages), _folder(path, generation), partitions)
    stored = _stored(spark, path, generation)
    buckets = ids.buckets_for(stored)
    ids.add(stored, path, generation, buckets)
    return generation, {GENERATION: generation, "id_buckets": buckets, "ids_complete": True, LOADED: seen}


def write_mart(messages: DataFrame, path: str, partitions: int | None = None) -> None:
    """Replace the stored mart. ``partitions`` is the number of write tasks; unset, it is
    ``spark.sql.shuffle.partitions``, with small ones merged at run time. Readers see the
    old messages until all new ones are there."""
    _, state = _write_generation(messages, path, partitions)
    commits.update(messages.sparkSession, path, lambda old: {**old, **state})


def stream_mart(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The stored mart as a stream: what is there, then every append and every soft delete, with
    the file of each row. A delete comes as the message's old state with ``change_sign`` -1 and its
    new one with 1. Feeding ``rollup_stream`` from it keeps the rollup up to date with both."""

    def source(schema: T.StructType, folder: str) -> DataFrame:
        reader = spark.readStream.schema(T.StructType([*schema, _GENERATION_FIELD]))
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.parquet(folder)

    ensure_mart(spark, path)
    columns = [*STORED_SCHEMA.names, GENERATION, SOURCE_FILE, SIGN]
    file = F.col("_metadata.file_path").alias(SOURCE_FILE)
    stored = source(STORED_SCHEMA, path).select(*STORED_SCHEMA.names, GENERATION, file, F.lit(1).alias(SIGN))
    states = F.explode(
        F.array(
            F.struct(F.col("deleted_at"), F.lit(-1).alias(SIGN)),
            F.struct(F.col(NEW_DELETED_AT).alias("deleted_at"), F.lit(1).alias(SIGN)),
        )
    )
    changed = source(_CHANGE_SCHEMA, f"{path}/{CHANGES}").select("*", file).withColumn("state", states)
    changed = changed.withColumn("deleted_at", F.col("state.deleted_at")).withColumn(SIGN, F.col(f"state.{SIGN}"))
    return stored.select(*columns).unionByName(changed.select(*columns)).withMetadata(SOURCE_FILE, {SOURCE_MART: path})


def ensure_mart(spark: SparkSession, path: str, id_buckets: int = 1) -> DataFrame:
    """The stored mart, created empty if it is not there, then with ``id_buckets`` folders of its id index."""
    if commits.generation(spark, path) is None:
        state = {GENERATION: _make_generation(spark, path), "id_buckets": id_buckets, "ids_complete": True, LOADED: {}}
        # Whoever comes second takes the first one's mart.
        commits.update(spark, path, lambda old: None if old.get(GENERATION) else {**old, **state})
    return open_mart(spark, path)


def unseen(messages: DataFrame, path: str) -> DataFrame:
    """The messages whose id the stored mart does not have.

    A message keeps its sending time, so a copy of it lies in the same month; only the months
    that are stored and that ``messages`` touches are compared, by ids alone. Whole messages meet
    the stored ids only in months of which some are stored and some are not.
    """
    spark = messages.sparkSession
    incoming = _with_month(messages)
    generation = commits.generation(spark, path)
    if generation is None:
        return incoming
    stored = _stored(spark, path, generation).select(PARTITION, "message_id")
    # One value per calendar month: known before planning, they prune the stored files.
    months, there = ({row[0] for row in rows.select(PARTITION).distinct().collect()} for rows in (incoming, stored))

    def of(chosen: set[int]) -> Column:
        """Whether a row is of the ``chosen`` months; one without a month is not."""
        return F.coalesce(F.col(PARTITION).isin(sorted(chosen)), F.lit(False))

    shared = (months & there) - {None}
    if not shared:
        return incoming
    held = stored.where(F.col(PARTITION).isin(sorted(shared))).distinct().withColumn("held", F.lit(True))
    compared = incoming.where(of(shared)).select(PARTITION, "message_id").join(held, [PARTITION, "message_id"], "left")
    counts = compared.groupBy(PARTITION).agg(F.count("*").alias("n"), F.count("held").alias("held")).collect()
    stored_months = {row[PARTITION] for row in counts if row.held == row.n}
    mixed = {row[PARTITION] for row in counts if 0 < row.held < row.n}
    fresh = incoming.where(~of(stored_months | mixed))
    if not mixed:
        return fresh
    known = stored.where(F.col(PARTITION).isin(sorted(mixed)))
    late = incoming.where(of(mixed)).join(known, [PARTITION, "message_id"], "left_anti").select(*STORED_SCHEMA.names)
    return fresh.unionByName(late) if months - stored_months - mixed else late


def _mark_ids(spark: SparkSession, path: str, generation: str, complete: bool, seen: dict[str, int] | None = None) -> None:
    """Say whether the index is complete, and add what a load has ``seen`` to what the loads before it have."""

    def mark(state: dict) -> dict | None:
        if state.get(GENERATION) != generation or (state["ids_complete"] == complete and not seen):
            return None
        before = state.get(LOADED, {})
        return {**state, "ids_complete": complete, LOADED: {**before, **{k: before.get(k, 0) + n for k, n in (seen or {}).items()}}}

    commits.update(spark, path, mark)


def append_new(messages: DataFrame, path: str, partitions: int | None = None) -> None:
    """Append the messages that are not stored yet. Repeating a load adds nothing, also
    after one that failed half way, whose ids are then indexed too."""
    spark = messages.sparkSession
    ensure_mart(spark, path)
    generation = _current(spark, path)
    _mark_ids(spark, path, generation, False)
    fresh = unseen(messages, path)
    release_shuffles(spark)
    seen = _write(fresh, _folder(path, generation), partitions, _with_month(messages))
    ids.add(_stored(spark, path, generation), path, generation, commits.newest(spark, path)[1]["id_buckets"])
    _mark_ids(spark, path, generation, True, seen)


def soft_delete(messages: DataFrame, path: str, deleted_at: datetime) -> None:
    """Mark the stored messages whose ``message_id`` is in ``messages`` as deleted. Those that are deleted
    already stay as they are, so repeating it changes nothing. One delete runs at a time."""
    spark = messages.sparkSession
    generation = _current(spark, path)
    wanted = messages.select("message_id").where(F.col("message_id").isNotNull()).distinct()
    found = lookup_many(spark, path, wanted).where(F.col("deleted_at").isNull())
    changes = found.withColumn(NEW_DELETED_AT, F.lit(deleted_at).cast("timestamp_ntz")).select(*_CHANGE_SCHEMA.names)
    release_shuffles(spark)
    # The messages of a slice of months meet the ids at a time. Both were listed above, so a slice does not see another's changes.
    for part in month_slices(changes, _stored(spark, path, generation)):
        part.write.mode("append").option("compression", COMPRESSION).parquet(_changes_folder(path, generation))
        release_shuffles(spark)


def reload(messages: DataFrame, path: str, rollup_root: str, partitions: int | None = None) -> None:
    """Replace the mart and its rollup at one moment: the new rollup waits for the generation
    that the mart's commit makes current. The new files are recorded as counted: a stream of the mart goes
    on without counting them again."""
    spark = messages.sparkSession
    generation, state = _write_generation(messages, path, partitions)
    rollup_replace(_stored(spark, path, generation), rollup_root, path, generation)
    commits.update(spark, path, lambda old: {**old, **state})


def expire_mart(spark: SparkSession, path: str, keep_commits: int = 10, older_than_s: float = 86_400) -> list[str]:
    """Delete generations, with their changes and index, that none of the last ``keep_commits`` commits names and
    that are older than ``older_than_s``. Returns what was deleted."""

    def named(state: dict) -> set[str]:
        folder = f"{GENERATION}={state.get(GENERATION)}"
        return {f"./{folder}", f"{CHANGES}/{folder}", f"{ids.FOLDER}/{folder}", *(f"./{name}" for name in hidden)}

    hidden = {name for name, _ in commits.children(spark, path) if not name.startswith(f"{GENERATION}=")}
    return commits.expire(spark, path, [".", CHANGES, ids.FOLDER], named, keep_commits, older_than_s)


def lookup_many(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The stored messages whose id is in the column ``message_id`` of ``wanted``. The index names the files
    to open; while an append has yet to complete it, all files are searched."""
    state = commits.newest(spark, path)[1]
    generation, files = _current(spark, path), None
    if state["ids_complete"]:
        files = ids.files_of(wanted, path, generation, state["id_buckets"])
    if files == []:
        return open_mart(spark, path).where(F.lit(False))
    rows = _stored(spark, path, generation, files).join(wanted.select("message_id").distinct(), "message_id", "left_semi")
    # Only the rows that were found meet the deletes.
    return _with_changes(spark, path, generation, rows).select(*STORED_SCHEMA.names)


def lookup(spark: SparkSession, path: str, message_id: str) -> DataFrame:
    """The stored message, or messages, with this id. Inside the files that the index names, row groups are
    skipped by bloom filters."""
    state = commits.newest(spark, path)[1]
    generation, files = _current(spark, path), None
    if state["ids_complete"]:
        wanted = spark.createDataFrame([(message_id,)], "message_id string")
        files = ids.files_of(wanted, path, generation, state["id_buckets"])
    if files == []:
        return open_mart(spark, path).where(F.lit(False))
    rows = _with_changes(spark, path, generation, _stored(spark, path, generation, files))
    return rows.where(F.col("message_id") == message_id)


def application_slice(spark: SparkSession, path: str, application_uuid: str) -> DataFrame:
    """An application's messages."""
    return open_mart(spark, path).where(F.col("application_uuid") == application_uuid)


def customer_period(
    spark: SparkSession,
    path: str,
    customer_id: int,
    sent_from: datetime | None = None,
    sent_to: datetime | None = None,
    application_uuid: str | None = None,
) -> DataFrame:
    """A customer's messages in a period, both ends included; optionally one application's."""
    equals = {"application_uuid": application_uuid} if application_uuid else {}
    return apply_filters(
        open_mart(spark, path), Filters((customer_id,), sent_from, sent_to, equals)
    )


def load_record(spark: SparkSession, path: str) -> dict[str, int]:
    """What the loads of the current generation have seen. A load that died before its end is not in it."""
    return dict(commits.newest(spark, path)[1].get(LOADED, {}))


def stored_rows(spark: SparkSession, path: str) -> int:
    """The rows of the current generation's files, by their footers."""
    return _stored(spark, path, _current(spark, path)).count()


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns and types of the stored files, read from all their footers and merged; None if two files
    disagree on a type."""
    folder = _folder(path, _current(spark, path))
    try:
        return spark.read.option("mergeSchema", "true").parquet(folder).schema
    except (PySparkException, Py4JJavaError):
        return None


def month_counts(stored: DataFrame) -> DataFrame:
    """Messages per stored month."""
    return stored.groupBy(PARTITION).agg(F.count("*").alias("messages")).orderBy(PARTITION)
