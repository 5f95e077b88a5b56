"""What similarity joins of sets share: postings in compact rows, bounded filters, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable, scratch_path
from .words import mix

#: Bytes of text whose postings one task holds, which sets the number of tasks.
TEXT_BYTES_PER_PART = 16 << 20
BLOOM_BITS = 1 << 25
BLOOM_PIECE = 1 << 15

POSTINGS = "part int, tokens binary, owner binary, nodes binary, sizes binary"


def settled(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder as a table, and read from it.

    What was shuffled for it is not needed again. Spark deletes those files when the driver
    no longer holds their plan, so the driver is asked to look now: the steps of a long
    operator then take the disk of the largest, not of all together.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of ``settled`` tables whose last reader has ended."""
    for table in tables:
        folders = {name.rsplit("/", 1)[0] for name in table.inputFiles()}
        context = table.sparkSession
        for folder in folders:
            location = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(folder))
            location.getFileSystem(context._jsc.hadoopConfiguration()).delete(location, True)


def parts_of(texts: DataFrame, column: str = "text") -> int:
    """How many parts keep the postings of a part at a bounded size."""
    size = texts.agg(F.sum(F.octet_length(column)).alias("n")).first().n or 0
    return max(4, -(-size // TEXT_BYTES_PER_PART))


def pack_postings(
    tokens: list[np.ndarray], nodes: np.ndarray, sizes: np.ndarray, parts: int
) -> pa.RecordBatch | None:
    """Postings of some nodes: a row for each part of the tokens' range, with tokens in order.

    ``owner`` points into ``nodes`` and ``sizes``, two bytes a posting, so at most 65,536
    nodes may be packed at once.
    """
    counts = np.array([len(own) for own in tokens])
    if not counts.sum():
        return None
    flat, owner = np.concatenate(tokens), np.repeat(np.arange(len(tokens), dtype=np.uint16), counts)
    order = np.argsort(flat)
    flat, owner = flat[order], owner[order]
    width = (1 << 64) // parts + 1
    cuts = np.searchsorted(flat, np.array([width * i for i in range(1, parts)], np.uint64))
    rows = {name: [] for name in ("part", "tokens", "owner", "nodes", "sizes")}
    for part, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(flat)], strict=True)):
        if a == b:
            continue
        used, local = np.unique(owner[a:b], return_inverse=True)
        rows["part"].append(part)
        rows["tokens"].append(flat[a:b].tobytes())
        rows["owner"].append(local.astype(np.uint16).tobytes())
        rows["nodes"].append(nodes[used].astype(np.int64).tobytes())
        rows["sizes"].append(sizes[used].astype(np.int32).tobytes())
    return pa.RecordBatch.from_pydict(
        {name: pa.array(values, pa.int32() if name == "part" else pa.binary()) for name, values in rows.items()}
    )


def shared_tokens(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``node, size, token, frequency`` of the postings of a part whose token more than one node has."""
    tokens, node, size = [], [], []
    for row in table.to_batches():
        for i in range(row.num_rows):
            owner = np.frombuffer(row.column("owner")[i].as_buffer(), np.uint16)
            tokens.append(np.frombuffer(row.column("tokens")[i].as_buffer(), np.uint64))
            node.append(np.frombuffer(row.column("nodes")[i].as_buffer(), np.int64)[owner])
            size.append(np.frombuffer(row.column("sizes")[i].as_buffer(), np.int32)[owner])
    token, node, size = np.concatenate(tokens), np.concatenate(node), np.concatenate(size)
    order = np.argsort(token, kind="stable")
    token, node, size = token[order], node[order], size[order]
    # Only tokens that come twice are looked at closely: equal sets are one node.
    twice = np.zeros(len(token), bool)
    twice[1:] = token[1:] == token[:-1]
    twice[:-1] |= twice[1:].copy()
    token, node, size = token[twice], node[twice], size[twice]
    order = np.lexsort((node, token))
    token, node, size = token[order], node[order], size[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
    token, node, size = token[new], node[new], size[new]
    first = np.ones(len(token), bool)
    first[1:] = token[1:] != token[:-1]
    run = np.cumsum(first) - 1
    frequency = np.bincount(run)[run] if len(token) else np.zeros(0, np.int64)
    several = frequency > 1
    return node[several], size[several], token[several], frequency[several]


def pack_by_node(node: np.ndarray, buckets: int, **columns: np.ndarray) -> pa.Table:
    """Values of nodes as a row for each bucket of nodes, so that few rows go from each part to each bucket."""
    bucket = (mix(node.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1), len(bucket)] if len(bucket) else [0]
    pieces = list(zip(cuts[:-1], cuts[1:], strict=True))
    return pa.table(
        {"bucket": pa.array([int(bucket[a]) for a, _ in pieces], pa.int32())}
        | {name: pa.array([v[order][a:b].tobytes() for a, b in pieces], pa.binary()) for name, v in {"node": node, **columns}.items()}
    )


def unpack(table: pa.Table, **kinds: type) -> list[np.ndarray]:
    """The packed columns as arrays."""
    return [np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(name)]) for name, kind in kinds.items()]


def _bloom_places(values: np.ndarray) -> list[np.ndarray]:
    values = values.astype(np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        other = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
        return [((values + np.uint64(i) * other) >> np.uint64(20)) & np.uint64(BLOOM_BITS - 1) for i in range(4)]


def build_filter(values: DataFrame) -> np.ndarray:
    """A Bloom filter of a column of longs: bytes of a fixed number, whatever the number of values.

    It only saves work: what it lets through is joined with the values afterwards.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BLOOM_BITS // 8, np.uint8)
        for batch in batches:
            for places in _bloom_places(batch.column(0).to_numpy(zero_copy_only=False)):
                np.bitwise_or.at(bits, (places >> np.uint64(3)).astype(np.int64), np.uint8(1) << (places & np.uint64(7)).astype(np.uint8))
        for piece in range(0, len(bits), BLOOM_PIECE):
            if bits[piece : piece + BLOOM_PIECE].any():
                yield pa.RecordBatch.from_pydict(
                    {"piece": pa.array([piece], pa.int32()), "bits": pa.array([bits[piece : piece + BLOOM_PIECE].tobytes()], pa.binary())}
                )

    def merge(table: pa.Table) -> pa.Table:
        found = np.zeros(BLOOM_PIECE, np.uint8)
        for bits in table.column("bits"):
            found |= np.frombuffer(bits.as_buffer(), np.uint8)
        return pa.table({"piece": table.column("piece")[:1], "bits": pa.array([found.tobytes()], pa.binary())})

    schema = "piece int, bits binary"
    bits = np.zeros(BLOOM_BITS // 8, np.uint8)
    for row in values.coalesce(8).mapInArrow(fill, schema).groupBy("piece").applyInArrow(merge, schema).collect():
        bits[row.piece : row.piece + BLOOM_PIECE] = np.frombuffer(row.bits, np.uint8)
    return bits


def may_hold(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    found = np.ones(len(values), bool)
    for places in _bloom_places(values):
        found &= (bits[(places >> np.uint64(3)).astype(np.int64)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``: the smallest node it can reach.

    Each round gives a node the smallest root among its neighbours' and its own, then the
    root of that root, so paths halve; rounds end when nothing changes. Every round is
    written to the shared folder.
    """
    both = durable(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    roots = durable(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("root")))
    while True:
        near = both.join(roots.select(F.col("node").alias("b"), F.col("root").alias("near")), "b").groupBy(
            F.col("a").alias("node")
        ).agg(F.min("near").alias("near"))
        nearer = roots.join(near, "node").select("node", F.least("root", "near").alias("root"), F.col("root").alias("was"))
        hops = nearer.select(F.col("node").alias("root"), F.col("root").alias("hop"))
        jumped = durable(nearer.join(hops, "root", "left").select("node", F.least("hop", "root").alias("root"), "was"))
        moved = jumped.where(F.col("root") != F.col("was")).limit(1).count()
        roots = jumped.select("node", "root")
        if not moved:
            return roots
