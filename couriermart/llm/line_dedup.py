"""Near-duplicate lines: an exact set-similarity join, after which only the first of similar lines stays.

A line is the set of its words. Equal sets are one class, which keeps its first occurrence.
The words of a set are ordered by rarity: words below a share of the corpus by hash, the
others, of which that share allows only so many, by their counts. Sets of Jaccard 0.8 or
more share a word among their |x| - ceil(0.8 |x|) + 1 rarest.

1. The lists of lines with a prefix word in common show, by length, by the places of that
   word, and by parities of word hashes, which lines have any plausible partner.
2. Only those are fetched with all their words. Those of long lists are first compared with the earliest
   line there, so that a crowd of variants takes as many comparisons as it has
   members. Then each line that is left looks through the list of its rarest word, where it
   is, for an earlier one that passes the filters, and is compared with that one. Lines that
   this does not settle look through all their lists; only lines that do not resemble what
   they find there either are compared with every other that passes.
3. Lines that are not the first of their class, or whose class has an earlier similar one,
   are cut out of their documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import attach
from .setjoin import build_filter, discard, may_hold, parts_of, settled
from .words import SPACED, lowered_words, mix, slices

#: Two lines are similar when DENOMINATOR * intersection >= NUMERATOR * union.
NUMERATOR, DENOMINATOR = 4, 5
#: Words are ranked by count from one in so many words of the corpus on, so there are at most as many.
RANKED = 1 << 20
#: Bytes of text that are split into lines and words at once.
LINE_SLICE = 1 << 20
#: Postings of a group, about, and lines of one list that meet in a group.
GROUP_POSTINGS = 200_000
LIST_BLOCK = 4096
#: Sets of fewer words are only similar to equal ones.
LEAST_WORDS = 4
#: Sizes and places from here on are one in postings, which hold two bytes of each.
LONG = (1 << 16) - 1

#: Longs of a line's parities. Postings hold them folded to two; with fewer bits than the words in which two lines
#: may differ, all long lines would pass. Records have a second set by other bits of the hashes: of two words more
#: than lines may differ in, one set now and then sees only those allowed, both sets hardly ever do.
PARITIES = 4
SETS = 2
PARITY = [f"parity{i}" for i in range(SETS * PARITIES)]

POSTINGS = "part int, token binary, line binary, parity binary, other binary, size binary, place binary"


@dataclass(frozen=True)
class Ranks:
    """The frequent words' hashes, in order, and their numbers: from 1, the rarest first. Other words have number 0."""

    hash: np.ndarray
    number: np.ndarray

    @cached_property
    def _slots(self) -> tuple[np.uint64, np.ndarray, np.ndarray]:
        """A table, half of it empty at least, of hashes and numbers. A hash lies at the slot of its upper bits, of which
        the first element is the shift, or in the run of taken slots from there."""
        bits = len(self.hash).bit_length() + 1
        shift, order = np.uint64(64 - bits), np.arange(len(self.hash))
        at = np.maximum.accumulate((self.hash >> shift).astype(np.int64) - order) + order
        hashes, numbers = np.zeros((1 << bits) + len(at) + 1, np.uint64), np.zeros((1 << bits) + len(at) + 1, np.int32)
        hashes[at], numbers[at] = self.hash, self.number
        return shift, hashes, numbers

    def of(self, hashes: np.ndarray) -> np.ndarray:
        shift, held, numbers = self._slots
        at = (hashes >> shift).astype(np.int64)
        found = numbers[at]
        other = held[at] != hashes
        open_ = np.flatnonzero(other & (found > 0))
        found[other] = 0
        while len(open_):
            at[open_] += 1
            there = numbers[at[open_]]
            same = held[at[open_]] == hashes[open_]
            found[open_[same]] = there[same]
            open_ = open_[~same & (there > 0)]
        return found


@dataclass
class Lines:
    """The lines of some texts; line i has the distinct words ``token[first[i]:first[i + 1]]``, rarest first."""

    row: np.ndarray
    number: np.ndarray
    start: np.ndarray
    id: np.ndarray  # of the set of words; -1 without words
    size: np.ndarray
    parity: np.ndarray  # ``parities`` folded to one
    parities: np.ndarray  # a column for each of ``PARITY``
    token: np.ndarray
    first: np.ndarray
    rank: np.ndarray  # the words' numbers


def prefix_length(size):
    return size - (NUMERATOR * size + DENOMINATOR - 1) // DENOMINATOR + 1


def line_starts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, row, number`` of each line; a line ends with its line break, and an empty text has none."""
    start = np.unique(np.concatenate([bounds[:-1], np.flatnonzero(data == 10) + 1]))
    start = start[start < len(data)]
    row = np.searchsorted(bounds, start, side="right") - 1
    return start, row, np.arange(len(start)) - np.searchsorted(row, row)


def first_of(ids: np.ndarray) -> np.ndarray:
    """Whether each of the ``ids`` is the first of its value."""
    first = np.zeros(len(ids), bool)
    first[np.unique(ids, return_index=True)[1]] = True
    return first


def differences(one: list, other: list, count: Callable) -> list:
    """By each set of parities, in how many words two lines differ at least; ``count`` gives the bits that two longs differ in."""
    bits = [count(a, b) for a, b in zip(one, other, strict=True)]
    return [reduce(add, bits[first : first + PARITIES]) for first in range(0, len(bits), PARITIES)]


def line_order(line: np.ndarray, hashes: np.ndarray, lines: int) -> np.ndarray:
    """The order of words by line and hash."""
    # Numbers are sorted several times faster than places of numbers: the line above, then as much of the hash as
    # there is room for, the place below.
    above, below = lines.bit_length(), len(hashes).bit_length()
    if above + below < 64:
        shift, room = np.uint64(below), np.uint64(above + below)
        key = (line.astype(np.uint64) << np.uint64(64 - above)) | ((hashes >> room) << shift) | np.arange(len(hashes), dtype=np.uint64)
        key.sort()
        order = (key & np.uint64((1 << below) - 1)).astype(np.int64)
        near = (key[1:] >> shift) == (key[:-1] >> shift)
        # Where that much of the hash does not tell two words apart, all of it has to.
        if not (near & (hashes[order[1:]] != hashes[order[:-1]])).any():
            return order
    return np.lexsort((hashes, line))


def find_lines(
    data: np.ndarray,
    bounds: np.ndarray,
    ranks: Ranks | None = None,
    wanted: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
    sets: int = SETS,
) -> Lines:
    """The lines of some texts; without ``ranks`` their words are in order of hashes and they have no parities.

    ``wanted`` tells from ids and sizes which lines keep their words and get ``sets`` of parities; all, if it is not given.
    """
    start, row, number = line_starts(data, bounds)
    words = lowered_words(data, np.append(start, len(data)), SPACED)
    line = np.repeat(np.arange(len(start)), words.counts())
    order = line_order(line, words.hash, len(start))
    token, line = words.hash[order], line[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (line[1:] != line[:-1])
    token, line = token[new], line[new]
    size = np.bincount(line, minlength=len(start))
    first = np.concatenate([[0], np.cumsum(size)])
    ids, parities = np.full(len(start), -1, np.int64), np.zeros((len(start), sets * PARITIES), np.uint64)
    filled = np.flatnonzero(size)
    if len(filled):
        with np.errstate(over="ignore"):
            spread = mix(token)
            sums = np.add.reduceat(spread, first[filled])
            ids[filled] = (mix(sums ^ size[filled].astype(np.uint64)) >> np.uint64(1)).astype(np.int64)
        if wanted is not None:
            kept = wanted(ids, size) & (size > 0)
            held, filled = kept[line], np.flatnonzero(kept)
            token, line, spread = token[held], line[held], spread[held]
            first = np.concatenate([[0], np.cumsum(np.where(kept, size, 0))])
        if ranks is not None and len(filled):
            for part in range(sets):
                # A byte of the hash for each set: six bits choose the bit, two the long.
                byte = spread >> np.uint64(56 - 8 * part)
                bit, long = np.uint64(1) << ((byte >> np.uint64(2)) & np.uint64(63)), byte % np.uint64(PARITIES)
                for i in range(PARITIES):
                    parities[filled, part * PARITIES + i] = np.bitwise_xor.reduceat(np.where(long == i, bit, np.uint64(0)), first[filled])
    ranked = np.zeros(len(token), np.int32)
    if ranks is not None and len(token):
        # By number within a line; words without one stay in the order of their hashes, before the others.
        ranked = ranks.of(token)
        order = np.argsort((line.astype(np.uint64) << np.uint64(40)) | ranked.astype(np.uint64), kind="stable")
        token, ranked = token[order], ranked[order]
    return Lines(row, number, start, ids, size, np.bitwise_xor.reduce(parities[:, :PARITIES], axis=1), parities, token, first, ranked)


def frequent_words(docs: DataFrame) -> Ranks:
    """Counts of the frequent words. Words that a batch has once, or too seldom to be ranked by it, are not counted:
    an order of tokens may be any, as long as it is the same for all lines."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lowered_words(data, bounds, SPACED).hash for _, _, data, bounds in slices(batch.column("text"), LINE_SLICE)]
            hashes, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64),) * 2
            several = counts > max(1, counts.sum() // RANKED)
            yield pa.RecordBatch.from_pydict({"word": hashes[several].view(np.int64), "n": counts[several].astype(np.int64)})

    counts = settled(docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = counts.agg(F.sum("n").alias("n")).first().n or 0
    table = counts.where(F.col("n") > total // RANKED).toArrow()
    hashes = table.column("word").to_numpy().view(np.uint64)
    number = np.empty(len(hashes), np.int32)
    # Words of one count are numbered in the order of their hashes.
    number[np.lexsort((hashes, table.column("n").to_numpy()))] = np.arange(1, len(hashes) + 1)
    order = np.argsort(hashes)
    return Ranks(hashes[order], number[order])


def _occurrences(keyed: DataFrame) -> DataFrame:
    """``line, doc_id, key, number`` of every line that has words."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, _, data, bounds in slices(batch.column("text"), LINE_SLICE):
                lines = find_lines(data, bounds)
                worded = np.flatnonzero(lines.id >= 0)
                if len(worded):
                    at = pa.array(begin + lines.row[worded])
                    yield pa.RecordBatch.from_pydict(
                        {
                            "line": lines.id[worded], "doc_id": batch.column("doc_id").take(at),
                            "key": batch.column("key").take(at), "number": lines.number[worded].astype(np.int64),
                        }
                    )

    kind = keyed.schema["doc_id"].dataType.simpleString()
    return keyed.mapInArrow(place, f"line long, doc_id {kind}, key long, number long")


def _place() -> Column:
    """By what occurrences are ordered; NULL ids come last."""
    return F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "key", "number")


def _classes(occurrences: DataFrame) -> DataFrame:
    """``line, place, n``: the first occurrence of each class, and how many there are."""
    return occurrences.groupBy("line").agg(F.min(_place()).alias("place"), F.count("*").alias("n"))


def _candidates(docs: DataFrame, ranks: Ranks, parts: int) -> DataFrame:
    """``line``: classes that have a plausible partner."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, bounds in slices(batch.column("text"), LINE_SLICE):
                lines = find_lines(data, bounds, ranks, lambda ids, size: first_of(ids) & (size >= LEAST_WORDS), sets=1)
                own = np.flatnonzero(np.diff(lines.first))
                if not len(own):
                    continue
                length = prefix_length(lines.size[own])
                line = np.repeat(own, length)
                place = np.arange(len(line)) - np.repeat(np.cumsum(length) - length, length)
                token = mix(lines.token[lines.first[line] + place])
                order = np.argsort(token)
                token, line, place = token[order], line[order], place[order]
                # The part takes the upper half of a token, the rest is enough to tell its tokens apart.
                part = ((token >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
                cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(token)]
                low = (token >> np.uint64(4)).astype(np.uint32)
                columns = {"token": low, "line": lines.id[line], "parity": (lines.parities[:, 0] ^ lines.parities[:, 1])[line], "other": (lines.parities[:, 2] ^ lines.parities[:, 3])[line], "size": np.minimum(lines.size[line], LONG).astype(np.uint16), "place": np.minimum(place, LONG).astype(np.uint16)}
                pieces = list(zip(cuts[:-1], cuts[1:], strict=True))
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array([int(part[a]) for a, _ in pieces], pa.int32())}
                    | {name: pa.array([values[a:b].tobytes() for a, b in pieces], pa.binary()) for name, values in columns.items()}
                )

    def match(table: pa.Table) -> pa.Table:
        kinds = {"token": np.uint32, "line": np.int64, "parity": np.uint64, "other": np.uint64, "size": np.uint16, "place": np.uint16}
        values = {name: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(name)]) for name, kind in kinds.items()}
        return pa.table({"line": plausible(**values)})

    return docs.select("text").mapInArrow(post, POSTINGS).groupBy("part").applyInArrow(match, "line long").distinct()


def plausible(token, line, parity, size, place, other=None) -> np.ndarray:
    """Lines that may be similar to another one of the same token, by length, place and parity, or both parities."""
    order = np.lexsort((line, size, token))
    token, line, size, place = (x[order] for x in (token, line, size, place))
    parities = [x[order] for x in (parity, other) if x is not None]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (line[1:] != line[:-1])
    token, line, parities = token[new], line[new], [x[new] for x in parities]
    size, place = size[new].astype(np.int64), place[new].astype(np.int64)
    found = np.zeros(len(token), bool)
    alive, distance = np.arange(len(token)), 0
    while len(alive):
        distance += 1
        alive = alive[alive + distance < len(token)]
        near_by = alive + distance
        # By size within a token: what is too long now is so for all that follow.
        near = (token[alive] == token[near_by]) & (size[near_by] * NUMERATOR <= size[alive] * DENOMINATOR)
        alive, near_by = alive[near], near_by[near]
        both = size[alive] + size[near_by]
        needed = -(-NUMERATOR * both // (NUMERATOR + DENOMINATOR))
        behind = np.minimum(size[alive] - place[alive], size[near_by] - place[near_by])
        ahead = np.minimum(place[alive], place[near_by])
        apart = sum(np.bitwise_count(x[alive] ^ x[near_by]).astype(np.int64) for x in parities)
        fits = (ahead + behind >= needed) & (apart <= both - 2 * needed)
        # Of the very longest lines the postings do not tell the size.
        fits = (fits | (size[near_by] >= LONG)) & (line[alive] != line[near_by])
        found[alive[fits]] = found[near_by[fits]] = True
    return np.unique(line[found])


def _lists(bounds: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))


def _words_of(side: str = "") -> Column:
    """The number of words of a record."""
    return F.size(f"rare{side}") + F.size(f"tokens{side}")


def _records(docs: DataFrame, ranks: Ranks, candidates: DataFrame, classes: DataFrame) -> DataFrame:
    """``line, at``, parities, ``rare, tokens`` of the candidates; ``at`` numbers them by their first occurrence.

    Of the frequent words, which most are, ``tokens`` holds the numbers, of the others ``rare`` holds the hashes.
    """
    passing = build_filter(candidates)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, bounds in slices(batch.column("text"), LINE_SLICE):
                lines = find_lines(data, bounds, ranks, lambda ids, size: first_of(ids) & may_hold(passing, ids))
                own = np.flatnonzero(np.diff(lines.first))
                if len(own):
                    size = lines.size[own]
                    end = np.cumsum(size)
                    word = np.arange(end[-1]) + np.repeat(lines.first[own] - end + size, size)
                    number = lines.rank[word]
                    known = np.concatenate([[0], np.cumsum(number > 0)[end - 1]])
                    yield pa.RecordBatch.from_pydict(
                        {
                            "line": lines.id[own],
                            **{name: lines.parities[own, i].view(np.int64) for i, name in enumerate(PARITY)},
                            "rare": _lists(np.concatenate([[0], end]) - known, lines.token[word[number == 0]].view(np.int64)),
                            "tokens": _lists(known, number[number > 0]),
                        }
                    )

    # Sorted by ranges, so that numbers rise with places from partition to partition.
    placed = candidates.join(classes, "line").orderBy("place").select("line", F.monotonically_increasing_id().alias("at"))
    placed = settled(placed, "line-places")
    fetched = docs.select("text").mapInArrow(fetch, f"line long, {', '.join(f'{name} long' for name in PARITY)}, rare array<long>, tokens array<int>")
    return settled(fetched.join(placed, "line").dropDuplicates(["line"]), "line-records")


def _similar(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """The ``later`` of the pairs that are similar to their ``earlier``, once each."""

    def named(at: str, side: str) -> DataFrame:
        return records.select(F.col("at").alias(at), *[F.col(name).alias(f"{name}{side}") for name in (*PARITY, "rare", "tokens")])

    common = F.size(F.array_intersect("rare_e", "rare_l")) + F.size(F.array_intersect("tokens_e", "tokens_l"))
    both, smaller = _words_of("_e") + _words_of("_l"), F.least(_words_of("_e"), _words_of("_l"))
    apart = F.greatest(*differences(*([F.col(name + side) for name in PARITY] for side in ("_e", "_l")), lambda a, b: F.bit_count(a.bitwiseXOR(b))))
    needed = F.ceil(both * NUMERATOR / (NUMERATOR + DENOMINATOR))
    return (
        pairs.join(named("earlier", "_e"), "earlier")
        .join(named("later", "_l"), "later")
        .where((smaller >= needed) & (apart <= both - needed * 2))
        # What the union asks for, with the common words named once: they are counted for each time they are named.
        .where(common * (NUMERATOR + DENOMINATOR) >= both * NUMERATOR)
        .select("later")
        .distinct()
    )


def _search(every: bool):
    """A function of a group of postings that returns, of each line that asks, the nearest earlier line of a common
    list that the filters let through, or ``every`` such line."""

    def search(table: pa.Table) -> pa.Table:
        token, at, size, place, asks, *parities = (table.column(name).to_numpy() for name in ("token", "at", "size", "place", "asks", *PARITY))
        order = np.lexsort((~asks, at, token))
        token, at, size, place, asks = (x[order] for x in (token, at, size.astype(np.int64), place, asks))
        parities = [x[order].view(np.uint64) for x in parities]
        later, earlier, distance = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        open_ = np.flatnonzero(asks)
        while len(open_):
            distance += 1
            open_ = open_[open_ >= distance]
            other = open_ - distance
            same = token[open_] == token[other]
            open_, other = open_[same], other[same]
            both = size[open_] + size[other]
            needed = -(-NUMERATOR * both // (NUMERATOR + DENOMINATOR))
            behind = np.minimum(size[open_] - place[open_], size[other] - place[other])
            ahead = np.minimum(place[open_], place[other])
            apart = differences(*([x[lines] for x in parities] for lines in (open_, other)), lambda a, b: np.bitwise_count(a ^ b).astype(np.int64))
            fits = (at[other] < at[open_]) & (np.minimum(size[open_], size[other]) >= needed)
            fits &= (ahead + behind >= needed) & (np.maximum.reduce(apart) <= both - 2 * needed)
            later.append(at[open_[fits]])
            earlier.append(at[other[fits]])
            if not every:
                open_ = open_[~fits]
        later, earlier = np.concatenate(later), np.concatenate(earlier)
        order = np.lexsort((earlier, later))
        later, earlier = later[order], earlier[order]
        last = np.ones(len(later), bool)
        last[:-1] = later[1:] != later[:-1]
        if every:
            last[:-1] |= earlier[1:] != earlier[:-1]
        return pa.table({"later": later[last], "earlier": earlier[last]})

    return search


def _offers(postings: DataFrame, lists: DataFrame, asks: Column, every: bool) -> DataFrame:
    """``later, earlier``: for the lines of the postings that ``asks`` an earlier line of their lists, or ``every`` one.

    Lists are dealt to groups by their word. A long list is cut into blocks, and every block
    of lines that ask meets every block of the list, each pair of blocks in a group of its
    own, so that no group grows with a list.
    """
    marked = postings.withColumn("asks", asks)
    asked = marked.where("asks").select("token").distinct()
    used = marked.join(lists.join(asked, "token", "left_semi").select("token", "blocks"), "token")
    total = lists.agg(F.sum("n").alias("n")).first().n or 0
    spread = F.lit(max(4, -(-total // GROUP_POSTINGS)))
    own = F.pmod(F.xxhash64("at"), F.col("blocks").cast("long"))
    others = F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)
    key = lambda a, b: F.xxhash64(F.col("token"), a, b)
    one = F.array(F.struct(F.pmod(F.xxhash64("token"), spread).alias("group"), F.col("asks")))
    as_listed = F.transform(others, lambda other: F.struct(key(other, own).alias("group"), F.lit(False).alias("asks")))
    as_asking = F.transform(others, lambda other: F.struct(key(own, other).alias("group"), F.lit(True).alias("asks")))
    several = F.when(F.col("asks"), F.concat(as_listed, as_asking)).otherwise(as_listed)
    dealt = used.withColumn("to", F.explode(F.when(F.col("blocks") == 1, one).otherwise(several)))
    dealt = dealt.select("to.group", "token", "at", "size", *PARITY, "place", "to.asks")
    found = dealt.groupBy("group").applyInArrow(_search(every), "later long, earlier long")
    return settled(found.distinct() if every else found.groupBy("later").agg(F.max("earlier").alias("earlier")), "line-pairs")


def _dead_classes(records: DataFrame) -> DataFrame:
    """``line, dead``: classes that have a similar class which occurs earlier.

    Parities tell almost surely whether two lines are similar, so a line needs one candidate, which
    the list of its rarest word mostly has. Lines whose candidates turn out not to be similar meet all
    that the filters let through.
    """
    size = _words_of()
    length = size - F.ceil(size * NUMERATOR / DENOMINATOR).cast("int") + 1
    # Rarest first. Lists that a number and a hash shared would only offer more lines.
    prefix = F.posexplode(F.slice(F.concat("rare", F.col("tokens").cast("array<long>")), F.lit(1), length))
    postings = settled(records.select("at", *PARITY, size.alias("size"), prefix.alias("place", "token")), "line-postings")
    lists = postings.groupBy("token").agg(F.count("*").alias("n"), F.min("at").alias("lead")).where("n > 1")
    lists = settled(lists.withColumn("blocks", F.ceil(F.col("n") / LIST_BLOCK).cast("int")), "line-lists")
    # The earliest line of a long list, which most of a crowd of variants resemble: they need not ask all others.
    offers = (
        postings.join(lists.where("blocks > 1").select("token", F.col("lead").alias("earlier")), "token").where(F.col("earlier") < F.col("at"))
        .groupBy(F.col("at").alias("later"), "earlier").agg(F.count("*").alias("n"))
    )
    leading = settled(offers.groupBy("later").agg(F.max_by("earlier", F.struct("n", "earlier")).alias("earlier")), "line-leads")
    dead = [settled(_similar(leading, records), "lines-similar")]

    def flagged(lines: DataFrame) -> DataFrame:
        return postings.join(lines.select(F.col("later").alias("at"), F.lit(True).alias("flag")), "at", "left")

    # In the list of its rarest word most similar lines are met already. All its lists, which lie in many groups,
    # would each offer a line the same one, so only lines that this list does not settle ask them.
    homes = postings.join(lists.select("token"), "token", "left_semi").groupBy(F.col("at").alias("later")).agg(F.min("place").alias("home"))
    homes = settled(homes.join(dead[0], "later", "left_anti"), "line-homes")
    at_home = postings.join(homes.withColumnRenamed("later", "at"), "at", "left")
    chosen = _offers(at_home, lists, F.coalesce(F.col("place") == F.col("home"), F.lit(False)), every=False)
    dead.append(settled(_similar(chosen, records), "lines-similar"))
    open_ = settled(homes.join(dead[1], "later", "left_anti").select("later"), "lines-open")
    others = _offers(flagged(open_), lists, F.col("flag").isNotNull(), every=False)
    compared = chosen.unionByName(others)
    dead.append(settled(_similar(others.join(chosen, ["later", "earlier"], "left_anti"), records), "lines-similar"))
    # Whoever was offered a line that is not similar may still have another one.
    again = settled(others.join(dead[2], "later", "left_anti").select("later"), "lines-again")
    offered = _offers(flagged(again), lists, F.col("flag").isNotNull(), every=True)
    discard(postings, lists, leading, homes, open_, again)
    rest = settled(offered.join(compared, ["later", "earlier"], "left_anti"), "line-rest")
    # As tables, so that Spark knows how small they are and leaves the other lines where they lie.
    met = settled(rest.select(F.explode(F.array("later", "earlier")).alias("at")).distinct(), "lines-met")
    few = settled(records.join(met, "at", "left_semi"), "line-records-met")
    dead.append(settled(_similar(rest, few), "lines-similar"))
    found = reduce(DataFrame.unionByName, dead).distinct()
    lines = settled(
        records.select("line", F.col("at").alias("later")).join(found, "later", "left_semi").select("line", F.lit(True).alias("dead")),
        "lines-dead",
    )
    discard(chosen, others, offered, rest, met, few, *dead)
    return lines


def dedup_lines(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ``text, n_lines, n_removed``, a row per row of ``docs (doc_id, text)``.

    Lines go by doc_id, then by a hash of the text, then by number; NULL ids come last. A
    line goes if an earlier one, kept or not, has the same words or words of a Jaccard of at
    least 0.8. Words lie between spaces, A-Z in lower case. Lines without words stay.
    NULL texts stay NULL and have no lines. Rows that repeat both id and text are one
    document: they keep the same lines. Columns that ``keep`` does not name are ignored; it
    may not name ``text``, ``n_lines`` or ``n_removed``. Words are compared by 64-bit hashes.
    """
    ranks, parts = frequent_words(docs), parts_of(docs)
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    occurrences = settled(_occurrences(keyed), "line-occurrences")
    classes = settled(_classes(occurrences), "line-classes")
    candidates = settled(_candidates(docs, ranks, parts), "line-candidates")
    records = _records(docs, ranks, candidates, classes)
    discard(candidates)
    dead = _dead_classes(records)
    discard(records)
    marked = settled(
        classes.join(dead, "line", "left").where("n > 1 or dead").select("line", "place", F.coalesce("dead", F.lit(False)).alias("dead")),
        "lines-marked",
    )
    removed = (
        occurrences.join(marked, "line")
        .where(F.col("dead") | ~_place().eqNullSafe(F.col("place")))
        .groupBy(F.col("doc_id").alias("__id"), F.col("key").alias("__key"))
        .agg(F.sort_array(F.collect_set("number")).alias("__numbers"))
    )
    wide = docs.select(*keep, F.col("text").alias("__text"), F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__key"))
    joined = attach(wide, removed, ["__id", "__key"], "left").select(*keep, "__text", "__numbers")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, numbers = batch.column("__text"), batch.column("__numbers")
            kept, counts, gone = [], [], []
            for text, remove in zip(texts, numbers, strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                lines = raw.split(b"\n")
                count = len(lines) - (lines[-1] == b"")
                counts.append(count)
                gone.append(len(remove.as_py()) if remove.is_valid else 0)
                if remove.is_valid:
                    drop = set(remove.as_py())
                    ends = [*[b"\n"] * (len(lines) - 1), b""]
                    raw = b"".join(a + b for i, (a, b) in enumerate(zip(lines, ends, strict=True)) if i not in drop)
                kept.append(raw.decode("utf-8", "replace") if text.is_valid else None)
            columns = {name: batch.column(name) for name in keep}
            yield pa.RecordBatch.from_pydict(
                columns | {"text": pa.array(kept, texts.type), "n_lines": pa.array(counts, pa.int64()), "n_removed": pa.array(gone, pa.int64())}
            )

    zero = F.lit(0).cast("long")
    schema = docs.select(*keep, "text", zero.alias("n_lines"), zero.alias("n_removed")).schema
    return joined.mapInArrow(cut, schema)
