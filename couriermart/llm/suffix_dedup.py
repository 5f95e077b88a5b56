"""Removing long repeated strings: prefix-free parsing, distributed by rolling-hash triggers.

A byte goes if some string of 400 bytes that covers it starts anywhere else too. Strings of
400 bytes are found by where they start, and starts are dealt out by triggers: the trigger
of a start is where, of the 128 places from it on, a rolling hash is smallest. Equal strings
have equal triggers, and equal text behind them up to where the first of them may end. So
starts with one trigger form a run, and only runs whose triggers are followed by the same
text can hold equal strings.

1. Texts that are equal as a whole go as a whole; one of them stands for them in what
   follows, so that copies do not crowd at their triggers.
2. Of each run two hashes travel: of the text behind the trigger, and of all that its
   strings cover. Runs that are alone with the first are done; runs that share the second
   are repeated as a whole, which settles most of near copies without looking at a byte again.
3. The other runs meet with their text, in buckets by the first hash. A bucket is parsed
   into phrases that end at places a second rolling hash picks; overlapping runs and near
   copies have most of them in common. The suffix array of the distinct phrases and that of
   the parse, combined, give the starts in corpus order, where equal strings are neighbours.
4. Where too many different runs share a trigger's text, as at the edges of a passage that
   a share of all documents quotes, the strings themselves are counted by their hashes,
   which splits the crowd.

Strings are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import attach
from ..session import durable
from .fm_index import suffix_order
from .setjoin import build_filter, may_hold, parts_of
from .words import _powers, mix, slices

LENGTH = 400
#: Places among which the trigger of a start is chosen, a power of two, and bytes of a rolling hash.
REACH = 128
GRAM = 16
#: Starts that are handled at once.
PART_STARTS = 1 << 20
#: Different runs behind one trigger text that meet in one bucket at most.
MOST_RUNS = 2048
#: Rows of eight bytes that are sent to every executor at most.
MOST_BROADCAST = 1 << 19
#: Phrases of a bucket end where the hash of so many bytes leaves 0 when divided by the second number.
PHRASE_GRAM = 8
PHRASE_EVERY = 32

_PLACE_BITS = 22
_RUNS = "part int, behind binary, whole binary, doc binary, low binary, high binary"
_FOUND = "doc long, low long, high long, behind long, runs int"


@dataclass
class Runs:
    """Runs of starts with one trigger: the text, first and last start in it, hashes, and the bytes they are in."""

    text: np.ndarray
    low: np.ndarray
    high: np.ndarray
    behind: np.ndarray
    whole: np.ndarray


class Rolling:
    """Hashes of any stretch of some bytes."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = _powers(max(PART_STARTS, 1 << max(len(data) - 1, 1).bit_length()))
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[start + length] - self.sums[start]) * self.down[start])


def find_runs(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[Runs, np.ndarray, np.ndarray]]:
    """The runs of all starts in some texts, with the bytes of the part they lie in and each run's first byte there."""
    for begin in range(0, max(len(data) - LENGTH + 1, 0), PART_STARTS):
        stop = min(begin + PART_STARTS, len(data) - LENGTH + 1)
        part = data[begin : stop + LENGTH - 1]
        starts = np.arange(stop - begin)
        text = np.searchsorted(bounds, starts + begin, side="right") - 1
        starts = starts[starts + begin + LENGTH <= bounds[text + 1]]
        if not len(starts):
            continue
        text = text[starts]
        rolling = Rolling(part)
        grams = np.arange(len(part) - GRAM + 1)
        # The hash above, the place below: the smallest is the leftmost of equal hashes.
        least = (rolling.of(grams, GRAM) >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | grams.astype(np.uint64)
        step = 1
        while step < REACH:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        trigger = (least[starts] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        new = np.ones(len(starts), bool)
        new[1:] = (trigger[1:] != trigger[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(starts)) - 1
        low, high, at = starts[first], starts[last], trigger[first]
        shape = ((at - low) * REACH + (at - high)).astype(np.uint64)
        with np.errstate(over="ignore"):
            whole = mix(rolling.of(low, high - low + LENGTH) ^ mix(shape + np.uint64(1)))
        behind = rolling.of(at, LENGTH - REACH + 1)
        base = begin - bounds[text[first]]
        yield Runs(text[first], low + base, high + base, behind, whole), part, low


def _runs_of(column: pa.Array) -> Iterator[tuple[int, Runs, np.ndarray, np.ndarray]]:
    for begin, _, data, bounds in slices(column):
        for runs, part, low in find_runs(data, bounds):
            yield begin, runs, part, low


def _packed(part: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(part, kind="stable")
    part = part[order]
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)]
    pieces = list(zip(cuts[:-1], cuts[1:], strict=True))
    return pa.RecordBatch.from_pydict(
        {"part": pa.array([int(part[a]) for a, _ in pieces], pa.int32())}
        | {name: pa.array([values[order][a:b].tobytes() for a, b in pieces], pa.binary()) for name, values in columns.items()}
    )


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _columns(table: pa.Table, **kinds) -> list[np.ndarray]:
    return [np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(name)]) for name, kind in kinds.items()]


def match_runs(behind, whole, doc, low, high) -> pa.Table:
    """Runs that are repeated as a whole, with ``behind`` NULL; and, without a run, each ``behind`` that has
    different runs, and how many."""
    order = np.lexsort((whole, behind))
    behind, whole, doc, low, high = (x[order] for x in (behind, whole, doc, low, high))
    fresh = np.ones(len(behind), bool)
    fresh[1:] = behind[1:] != behind[:-1]
    other = fresh.copy()
    other[1:] |= whole[1:] != whole[:-1]
    again = ~other
    again[:-1] |= ~other[1:]
    group = np.cumsum(fresh) - 1
    kinds = np.bincount(group, other).astype(np.int64) if len(group) else np.zeros(0, np.int64)
    several = np.flatnonzero(kinds > 1)
    texts = behind[fresh][several].view(np.int64)
    count, more = int(again.sum()), len(several)
    return pa.table(
        {
            "doc": pa.array([*doc[again].tolist(), *[None] * more], pa.int64()),
            "low": pa.array([*low[again].tolist(), *[None] * more], pa.int64()),
            "high": pa.array([*high[again].tolist(), *[None] * more], pa.int64()),
            "behind": pa.array([*[None] * count, *texts.tolist()], pa.int64()),
            "runs": pa.array([*[None] * count, *kinds[several].tolist()], pa.int32()),
        }
    )


def repeated_starts(texts: list[np.ndarray]) -> list[np.ndarray]:
    """For each text, which of its starts have a string that starts elsewhere too, by prefix-free parsing."""
    sizes = np.array([len(t) for t in texts])
    data = np.concatenate(texts)
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)
    end = (begin + sizes)[owner]
    rolling = Rolling(data)
    place = np.arange(len(data))
    inside = place + PHRASE_GRAM <= end
    ends = np.zeros(len(data), bool)
    ends[inside] = rolling.of(place[inside], PHRASE_GRAM) % np.uint64(PHRASE_EVERY) == 0
    ends[begin] = True
    # A phrase begins with the bytes that end the one before.
    head = np.flatnonzero(ends)
    tail = np.append(head[1:], len(data)) + PHRASE_GRAM
    tail = np.minimum(tail, end[head])
    named = rolling.of(head, tail - head) ^ mix((tail - head).astype(np.uint64))
    _, example, phrase = np.unique(named, return_index=True, return_inverse=True)
    lengths = (tail - head)[example]
    home = np.cumsum(lengths + 1) - (lengths + 1)
    dictionary = np.zeros(int((lengths + 1).sum()), np.int64)
    source = np.arange(len(dictionary)) - np.repeat(home - head[example], lengths + 1)
    filled = np.ones(len(dictionary), bool)
    filled[home + lengths] = False
    dictionary[filled] = data[source[filled]].astype(np.int64) + 1
    _, suffix = suffix_order(dictionary, 256)
    _, rank = np.unique(suffix[home], return_inverse=True)
    # The parse: phrases by rank, text by text, each closed by a 0.
    of_text = owner[head]
    at = np.arange(len(head)) + of_text
    parse = np.zeros(len(head) + len(texts), np.int64)
    parse[at] = rank[phrase] + 1
    _, rest = suffix_order(parse, int(rank.max()) + 1)
    counts = np.maximum(sizes - LENGTH + 1, 0)
    starts = np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    mine = np.searchsorted(head, starts, side="right") - 1
    first = suffix[home[phrase[mine]] + starts - head[mine]]
    then = rest[at[mine] + 1]
    order = np.lexsort((then, first))
    strings = rolling.of(starts[order], LENGTH)
    same = strings[1:] == strings[:-1]
    again = np.zeros(len(starts), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    return np.split(again, np.cumsum(counts)[:-1])


def _intervals(doc: np.ndarray, start: np.ndarray) -> pa.Table:
    """Starts of documents as ``doc, low, high`` of starts in a row."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)
    first = np.flatnonzero(new) if len(doc) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(doc)) - 1 if len(doc) else first
    return pa.table({"doc": doc[first].astype(np.int64), "low": start[first].astype(np.int64), "high": start[last].astype(np.int64)})


def repeated_strings(docs: DataFrame) -> DataFrame:
    """``doc, low, high``: ranges of starts, for ``docs (doc, text)``, of strings that start elsewhere too."""
    parts = parts_of(docs)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_ = batch.column("doc").to_numpy()
            for begin, runs, _, _ in _runs_of(batch.column("text")):
                yield _packed(
                    _part_of(runs.behind, parts), behind=runs.behind, whole=runs.whole, doc=docs_[begin + runs.text],
                    low=runs.low.astype(np.int32), high=runs.high.astype(np.int32),
                )

    def match(table: pa.Table) -> pa.Table:
        return match_runs(*_columns(table, behind=np.uint64, whole=np.uint64, doc=np.int64, low=np.int32, high=np.int32))

    matched = durable(docs.mapInArrow(post, _RUNS).groupBy("part").applyInArrow(match, _FOUND))
    whole = matched.where(F.col("behind").isNull()).select("doc", "low", "high")
    mixed = matched.where(F.col("behind").isNotNull())
    few, many = build_filter(mixed.where(F.col("runs") <= MOST_RUNS).select("behind")), build_filter(mixed.where(F.col("runs") > MOST_RUNS).select("behind"))
    buckets = parts * 4

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_ = batch.column("doc").to_numpy()
            for begin, runs, part, low in _runs_of(batch.column("text")):
                own = np.flatnonzero(may_hold(few, runs.behind.view(np.int64)))
                # Runs that are repeated as a whole are needed once, to compare others with.
                own = own[np.unique(runs.whole[own], return_index=True)[1]]
                if len(own):
                    size = runs.high[own] - runs.low[own] + LENGTH
                    yield pa.RecordBatch.from_pydict(
                        {
                            "part": pa.array(_part_of(runs.behind[own], buckets), pa.int32()),
                            "doc": pa.array([x.tobytes() for x in docs_[begin + runs.text[own]]], pa.binary()),
                            "low": pa.array([x.tobytes() for x in runs.low[own].astype(np.int32)], pa.binary()),
                            "bytes": pa.array([part[a : a + n].tobytes() for a, n in zip(low[own], size, strict=True)], pa.binary()),
                        }
                    )
                own = np.flatnonzero(may_hold(many, runs.behind.view(np.int64)))
                if len(own):
                    count = runs.high[own] - runs.low[own] + 1
                    step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                    string = Rolling(part).of(np.repeat(low[own], count) + step, LENGTH)
                    yield _packed(
                        _part_of(string, parts) + buckets, doc=np.repeat(docs_[begin + runs.text[own]], count),
                        low=(np.repeat(runs.low[own], count) + step).astype(np.int32), bytes=string,
                    )

    def compare(table: pa.Table) -> pa.Table:
        if table.column("part")[0].as_py() >= buckets:
            return count_strings(*_columns(table, doc=np.int64, low=np.int32, bytes=np.uint64))
        doc, low = _columns(table, doc=np.int64, low=np.int32)
        again = repeated_starts([np.frombuffer(x.as_buffer(), np.uint8) for chunk in table.column("bytes").chunks for x in chunk])
        found = [np.flatnonzero(hits) + a for hits, a in zip(again, low, strict=True)]
        return _intervals(np.repeat(doc, [len(x) for x in found]), np.concatenate(found))

    fetched = docs.mapInArrow(fetch, "part int, doc binary, low binary, bytes binary")
    return whole.unionByName(fetched.groupBy("part").applyInArrow(compare, "doc long, low long, high long"))


def count_strings(doc: np.ndarray, start: np.ndarray, string: np.ndarray) -> pa.Table:
    """Ranges of the starts whose string, told by its hash, comes again."""
    order = np.argsort(string, kind="stable")
    same = string[order[1:]] == string[order[:-1]]
    again = np.zeros(len(string), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    return _intervals(doc[again], start[again].astype(np.int64))


def equal_texts(docs: DataFrame) -> DataFrame:
    """``doc, low, high, first``: rows of ``docs (doc, text)`` whose whole text, of a string at least, others have too,
    with the range of all its starts, and whether the row stands for them. Only hashes and sizes are shuffled, and counted
    before, so a text that a third of all rows have is a few rows in the one group it makes."""
    sized = docs.where(F.octet_length("text") >= LENGTH).select(
        "doc", F.xxhash64("text").alias("text_hash"), F.crc32("text").alias("text_check"), F.octet_length("text").alias("size")
    )
    text = ["text_hash", "text_check", "size"]
    groups = sized.groupBy(*text).agg(F.count("*").alias("n"), F.min("doc").alias("least")).where("n > 1")
    return sized.join(groups, text).select(
        "doc", F.lit(0).cast("long").alias("low"), (F.col("size") - LENGTH).cast("long").alias("high"), (F.col("doc") == F.col("least")).alias("first")
    )


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``doc`` is in ``gone``, which is broadcast if it has been counted to be small."""
    few = gone.count() <= MOST_BROADCAST
    return docs.join(F.broadcast(gone) if few else gone, "doc", "left_anti")


def dedup_strings(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ``n_bytes, removed, kept``, a row per row of ``docs (doc_id, text)``.

    ``removed`` are the byte ranges that go, in order, not touching each other; ``kept`` is
    what remains, as binary, since a range may begin or end within a character. Texts are
    judged as they are given, not as they look once others are cut; strings do not reach
    from one text into another. NULL and empty texts have no bytes; repeated rows repeat
    each other. Other columns are ignored; ``keep`` may not name the new ones. An empty
    table gives no rows. Rows are told apart by a 64-bit hash of id and text.
    """
    key = F.xxhash64("doc_id", "text")
    texts = docs.select(key.alias("doc"), "text")
    copies = durable(equal_texts(texts))
    single = without(texts, copies.where(~F.col("first")).select("doc").distinct())
    found = copies.select("doc", "low", "high").unionByName(repeated_strings(single))
    ranges = found.groupBy(F.col("doc").alias("__key")).agg(F.collect_set(F.struct("low", "high")).alias("__found"))
    wide = docs.select(*keep, F.col("text").alias("__text"), key.alias("__key"))
    joined = attach(wide, ranges, ["__key"], "left").select(*keep, "__text", "__found")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, kept = [], [], []
            for text, own in zip(batch.column("__text"), batch.column("__found"), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                spans: list[dict] = []
                for low, high in sorted((x["low"], x["high"]) for x in own.as_py() or ()):
                    if spans and low <= spans[-1]["end"]:
                        spans[-1]["end"] = max(spans[-1]["end"], high + LENGTH)
                    else:
                        spans.append({"start": low, "end": high + LENGTH})
                edges = [0, *[x for span in spans for x in (span["start"], span["end"])], len(raw)]
                sizes.append(len(raw))
                removed.append(spans)
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            columns = {name: batch.column(name) for name in keep}
            spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_pydict(
                columns | {"n_bytes": pa.array(sizes, pa.int64()), "removed": pa.array(removed, spans_type), "kept": pa.array(kept, pa.binary())}
            )

    schema = docs.select(
        *keep,
        F.lit(0).cast("long").alias("n_bytes"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("removed"),
        F.lit(b"").alias("kept"),
    ).schema
    return joined.mapInArrow(cut, schema)
