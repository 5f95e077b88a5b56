"""An index of message ids: which file of the mart holds an id.

Entries are the hash of an id, its month and its file, in folders by hash and sorted across the
files inside, so that a lookup opens one folder of the index, of which it reads the row groups around
the hash, and then the files it names. Entries come before the list of the files they cover;
what dies in between is indexed again, and double entries do no harm.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import as_paths, path_exists, release_shuffles, source_files

FOLDER = "_ids"
BUCKET = "bucket"
# Ids per folder: at 20 bytes each, some files of a gigabyte.
BUCKET_IDS = 250_000_000
# Ids that a task sorts and writes: with the names of their files, a quarter of a gigabyte of memory.
TASK_IDS = 1_000_000
# Ids that are shuffled at a time: some gigabyte of shuffle files.
PASS_IDS = 50_000_000
_ENTRIES = T.StructType(
    [
        T.StructField("id_hash", T.LongType()),
        T.StructField("file", T.StringType()),
        T.StructField(BUCKET, T.IntegerType()),
    ]
)
_FILES = T.StructType([T.StructField("file", T.StringType())])


def _root(path: str, generation: str) -> str:
    return f"{path}/{FOLDER}/generation={generation}"


def buckets_for(stored: DataFrame) -> int:
    """Folders for the ids of ``stored``, counted from the files' footers."""
    return max(1, math.ceil(stored.count() / BUCKET_IDS))


def _bucket(id_hash: Column, buckets: int) -> Column:
    return F.pmod(id_hash, F.lit(buckets)).cast("int")


def add(stored: DataFrame, path: str, generation: str, buckets: int) -> None:
    """Index the files of ``stored`` that are not indexed yet. An id that many rows of a file repeat is one entry."""
    spark, root = stored.sparkSession, _root(path, generation)
    present = source_files(stored)
    known = set()
    if path_exists(spark, f"{root}/files"):
        # Of the file names that Spark's scan holds on the driver anyway.
        known = {row.file for row in spark.read.schema(_FILES).parquet(f"{root}/files").collect()}
    new = [name for name in present if name not in known]
    if not new:
        return
    fresh = stored if not known else spark.read.schema(stored.schema).option("basePath", f"{path}/generation={generation}").parquet(*as_paths(new))
    # Names are long and few: their hashes are shuffled. Files that shared one would each get the other's ids too.
    listed = spark.createDataFrame([(name,) for name in new], _FILES).coalesce(1)
    names = listed.withColumn("file_hash", F.xxhash64("file"))
    entries = fresh.select(
        F.xxhash64("message_id").alias("id_hash"), F.xxhash64("_metadata.file_path").alias("file_hash")
    ).distinct()
    # The rows are counted from the files' footers. A range of hashes is shuffled after the other; a folder is written by as
    # many tasks as its ids need.
    rows = fresh.count()
    passes = max(1, math.ceil(rows / PASS_IDS))
    tasks = max(1, math.ceil(rows / passes / TASK_IDS))
    bounds = [-(2**63) + 2**64 * i // passes for i in range(passes + 1)]
    for low, end in zip(bounds, bounds[1:]):
        (
            entries.where(F.col("id_hash").between(low, end - 1))
            .withColumn(BUCKET, _bucket(F.col("id_hash"), buckets))
            .repartitionByRange(tasks, BUCKET, "id_hash")
            .join(F.broadcast(names), "file_hash")
            .drop("file_hash")
            .sortWithinPartitions(BUCKET, "id_hash")
            .write.mode("append")
            .partitionBy(BUCKET)
            .option("compression", "zstd")
            .parquet(f"{root}/entries")
        )
        release_shuffles(spark)
    listed.write.mode("append").parquet(f"{root}/files")


def _asked(wanted: DataFrame, path: str, generation: str, buckets: int) -> tuple[DataFrame, DataFrame] | None:
    """The entries among which those for the ids of ``wanted (message_id)`` are, and the hashes of these ids; None if nothing
    is indexed. Only the folders and, inside them, the row groups that the hashes fall into are read."""
    spark, root = wanted.sparkSession, _root(path, generation)
    if not path_exists(spark, f"{root}/entries"):
        return None
    hashes = wanted.select(F.xxhash64("message_id").alias("id_hash")).distinct()
    # At most a number for each folder, and the two ends.
    asked = hashes.agg(
        F.collect_set(_bucket(F.col("id_hash"), buckets)).alias("folders"), F.min("id_hash").alias("low"), F.max("id_hash").alias("high")
    ).first()
    entries = spark.read.schema(_ENTRIES).parquet(f"{root}/entries")
    return entries.where(F.col(BUCKET).isin(asked.folders) & F.col("id_hash").between(asked.low, asked.high)), hashes


def entries_of(wanted: DataFrame, path: str, generation: str, buckets: int) -> DataFrame | None:
    """The entries for the ids of ``wanted (message_id)``; None if nothing is indexed."""
    asked = _asked(wanted, path, generation, buckets)
    return None if asked is None else asked[0].join(asked[1], "id_hash", "left_semi")


def files_of(wanted: DataFrame, path: str, generation: str, buckets: int) -> list[str]:
    """The files of the mart in which the ids of ``wanted`` may lie: at most all that the mart has."""
    asked = _asked(wanted, path, generation, buckets)
    if asked is None:
        return []
    # Names are long: as in ``add``, their hashes are shuffled.
    within, hashes = asked
    found = within.select("id_hash", F.xxhash64("file").alias("file_hash")).join(hashes, "id_hash", "left_semi")
    chosen = found.select("file_hash").distinct()
    listed = wanted.sparkSession.read.schema(_FILES).parquet(f"{_root(path, generation)}/files").distinct()
    named = listed.join(chosen, F.xxhash64(listed["file"]) == chosen["file_hash"], "left_semi")
    return sorted(as_paths(row.file for row in named.collect()))
