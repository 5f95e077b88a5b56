"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

One edit changes few letter counts. Replacing a letter raises one count by one and lowers
another, inserting raises one: the vectors of two near words are at most 2 apart in L1
distance. So words of one length are the points of a k-d tree over their counts, and a word
looks for its near words in those boxes alone that lie within one step up and one down (for
the tree of its own length) or one step up (for the tree of words one letter longer).

The upper levels of the trees are cut on a bounded sample and shared out by Spark: each
leaf is a group, each word lives in one group and visits the leaves within reach. Inside a
group a deeper tree with tight boxes prunes further, counts are compared in blocks, and
only words whose counts fit are compared letter by letter. Of two words of one length the
one that lives in the lower group visits the other, so each pair is found once, and each
group sends one row per word: the number of near words and the best of them.

Letters are a to z and what À to ÿ holds in either case: one byte each in Latin-1. The
latter share a few dimensions, which only makes the distance smaller, never larger.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable

RUN = re.compile("[a-zÀ-ÿ]+")
NOT_RUN = re.compile("[^a-zÀ-ÿ]")
LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_RATIO = 10
#: One of so many runs of a document loses a letter.
DELETE_ONE_OF = 31
#: Characters that are split into words at once, and different words that a task counts before it sends them on.
PIECE = 1 << 20
COUNTED_WORDS = 200_000

DIMENSIONS = 32
_SHARED = DIMENSIONS - 26
#: The dimension of each letter.
DIMENSION = np.zeros(256, np.int64)
DIMENSION[97:123] = np.arange(26)
DIMENSION[192:] = 26 + np.arange(64) % _SHARED
#: Counts beyond it are taken as it, which keeps distances from growing.
MOST_COUNT = 30_000

#: Words whose letter counts cut the upper levels of the trees, at most (by the odds of a hash).
SAMPLE_WORDS = 1 << 16
#: Words of a group: a share of all, within these bounds.
GROUPS = 128
GROUP_WORDS = (512, 16_384)
#: Points of a leaf inside a group, and queries and letters that are compared at once.
LEAF_POINTS = 256
QUERIES_AT_ONCE = 1 << 14
LETTERS_AT_ONCE = 1 << 22

_COUNTED = "word string, n long"
_DEALT = "leaf long, home boolean, word string, n long"
_FOUND = "word string, n long, n_near long, form_n long, form string"


# --- words ------------------------------------------------------------------


def _pieces(text: str) -> Iterator[str]:
    """``text`` in parts that end between runs."""
    begin = 0
    while len(text) - begin > PIECE:
        cut = NOT_RUN.search(text, begin + PIECE)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:] if begin else text


def misspelt(run: str, start: int) -> str:
    """The run, or, for one of ``DELETE_ONE_OF``, the run without one letter. ``start`` is the checksum of the document's id."""
    check = zlib.crc32(run.encode(), start)
    if check % DELETE_ONE_OF:
        return run
    place = check % len(run)
    return run[:place] + run[place + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, int] = {}

    def sent() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    for batch in batches:
        ids, texts = batch.column("id"), batch.column("text")
        for row in range(batch.num_rows):
            text = texts[row].as_py()
            if not text:
                continue
            start = zlib.crc32(f"{ids[row].as_py() or ''}:".encode())
            # Bytes are lowered in ASCII only.
            for piece in _pieces(text.encode().lower().decode()):
                for run, n in Counter(RUN.findall(piece)).items():
                    if len(run) >= LEAST_LENGTH:
                        word = misspelt(run, start)
                        if len(word) >= LEAST_LENGTH:
                            counts[word] = counts.get(word, 0) + n
                if len(counts) > COUNTED_WORDS:
                    yield sent()
                    counts.clear()
    yield sent()


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n``: the words of ``docs (doc_id, text)`` of at least 7 letters that occur at least twice in all."""
    counted = docs.select(F.col("doc_id").cast("string").alias("id"), "text").mapInArrow(_count, _COUNTED)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# --- letter counts and trees ------------------------------------------------


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length the places of its words, and their letters as rows of bytes."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for places in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else []:
        length = int(lengths[places[0]])
        raw = "".join([words[i] for i in places.tolist()]).encode("latin-1")
        yield length, places, np.frombuffer(raw, np.uint8).reshape(len(places), length)


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """A row of ``DIMENSIONS`` counts for each row of letters."""
    counts = np.zeros((len(letters), DIMENSIONS), np.int16)
    step = max(1, LETTERS_AT_ONCE // max(1, letters.shape[1]))
    for begin in range(0, len(letters), step):
        part = letters[begin : begin + step]
        cells = np.arange(len(part))[:, None] * DIMENSIONS + DIMENSION[part]
        found = np.bincount(cells.ravel(), minlength=len(part) * DIMENSIONS)
        counts[begin : begin + step] = np.minimum(found, MOST_COUNT).reshape(-1, DIMENSIONS)
    return counts


@dataclass
class Tree:
    """A k-d tree. Node i is split at ``cut[i]`` of ``axis[i]`` into the nodes ``child[i]``, or is
    leaf ``leaf[i]``. All its points are inside ``low[i]`` to ``high[i]``."""

    axis: list[int]
    cut: list[int]
    child: list[tuple[int, int]]
    leaf: list[int]
    low: np.ndarray
    high: np.ndarray
    points: list[np.ndarray]

    def home(self, counts: np.ndarray) -> np.ndarray:
        """The leaf in which each row of counts lies."""
        found = np.zeros(len(counts), np.int64)
        open_ = [(0, np.arange(len(counts)))]
        while open_:
            node, rows = open_.pop()
            if self.leaf[node] >= 0:
                found[rows] = self.leaf[node]
                continue
            left = counts[rows, self.axis[node]] <= self.cut[node]
            for child, inside in zip(self.child[node], (rows[left], rows[~left]), strict=True):
                if len(inside):
                    open_.append((child, inside))
        return found

    def reach(self, counts: np.ndarray, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves, each with the rows of counts that come within its box by raising one count by one and lowering ``down``."""
        open_ = [(0, np.arange(len(counts)))]
        while open_:
            node, rows = open_.pop()
            own = counts[rows]
            above = np.maximum(self.low[node] - own, 0).sum(axis=1, dtype=np.int32)
            below = np.maximum(own - self.high[node], 0).sum(axis=1, dtype=np.int32)
            rows = rows[(above <= 1) & (below <= down)]
            if not len(rows):
                continue
            if self.leaf[node] >= 0:
                yield self.leaf[node], rows
            else:
                open_.extend((child, rows) for child in self.child[node])


def grow(counts: np.ndarray, most: int, tight: bool) -> Tree:
    """A tree whose leaves have at most ``most`` rows of ``counts``, or only equal ones.

    Tight boxes are those of the points. Others are bounded by the cuts, for points that are not here.
    """
    tree = Tree([], [], [], [], np.zeros(0), np.zeros(0), [])
    lows, highs = [], []

    def add(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> int:
        own = counts[rows]
        if tight and len(rows):
            low, high = own.min(axis=0), own.max(axis=0)
        lows.append(low)
        highs.append(high)
        for part, value in ((tree.axis, -1), (tree.cut, 0), (tree.child, (-1, -1)), (tree.leaf, -1)):
            part.append(value)
        waiting.append((len(tree.axis) - 1, rows, low, high))
        return len(tree.axis) - 1

    waiting: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
    add(np.arange(len(counts)), np.zeros(DIMENSIONS, np.int16), np.full(DIMENSIONS, MOST_COUNT, np.int16))
    while waiting:
        node, rows, low, high = waiting.pop()
        own = counts[rows]
        axis = int(own.var(axis=0).argmax()) if len(rows) else 0
        if len(rows) <= most or own[:, axis].min() == own[:, axis].max():
            tree.leaf[node] = len(tree.points)
            tree.points.append(rows)
            continue
        middle = int(np.median(own[:, axis]))
        # Of the cuts on both sides of the median the more even one.
        cut = min((middle - 1, middle), key=lambda c: abs(int((own[:, axis] <= c).sum()) * 2 - len(rows)))
        left = own[:, axis] <= cut
        upto, beyond = high.copy(), low.copy()
        upto[axis], beyond[axis] = cut, cut + 1
        tree.axis[node], tree.cut[node] = axis, cut
        tree.child[node] = (add(rows[left], low, upto), add(rows[~left], beyond, high))
    tree.low, tree.high = np.array(lows, np.int16), np.array(highs, np.int16)
    return tree


# --- dealing words to groups ------------------------------------------------


@dataclass
class Plan:
    """The upper levels of the tree of each length, with the first group and the number of groups of each leaf. A
    leaf that cannot be cut further has several groups. Lengths without a tree are one group."""

    trees: dict[int, Tree]
    first: dict[int, np.ndarray]
    groups: dict[int, np.ndarray]


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for length, places, letters in by_length(batch.column("word").to_pylist()):
            rows = [row.tobytes() for row in letter_counts(letters)]
            yield pa.RecordBatch.from_pydict({"length": pa.array([length] * len(places), pa.int64()), "counts": pa.array(rows, pa.binary())})


def plan_groups(vocabulary: DataFrame) -> Plan:
    """Trees from a sample. Only the letter counts of about ``SAMPLE_WORDS`` words come to the driver, 64 bytes each."""
    total = vocabulary.count()
    share = min(1.0, SAMPLE_WORDS / max(1, total))
    chosen = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < math.ceil(share * (1 << 20))
    sample: dict[int, list[bytes]] = {}
    for row in vocabulary.where(chosen).select("word").mapInArrow(_sampled, "length long, counts binary").collect():
        sample.setdefault(row.length, []).append(bytes(row.counts))
    most = min(GROUP_WORDS[1], max(GROUP_WORDS[0], total // GROUPS))
    plan, next_group = Plan({}, {}, {}), 0
    for length in sorted(sample):
        counts = np.frombuffer(b"".join(sample[length]), np.int16).reshape(-1, DIMENSIONS)
        tree = grow(counts, max(1, int(most * share)), tight=False)
        sizes = np.array([len(points) for points in tree.points]) / share
        tree.points = []
        groups = np.maximum(1, np.ceil(sizes / (2 * most))).astype(np.int64)
        plan.trees[length], plan.groups[length] = tree, groups
        plan.first[length] = next_group + np.cumsum(groups) - groups
        next_group += int(groups.sum())
    return plan


def deal(vocabulary: DataFrame, plan: Plan) -> DataFrame:
    """``leaf, home, word, n``: every word in its own group, and as a query in the groups within its reach."""

    def visits(length: int, counts: np.ndarray, down: int) -> Iterator[tuple[int, np.ndarray]]:
        if length not in plan.trees:
            yield -length, np.arange(len(counts))
            return
        for leaf, rows in plan.trees[length].reach(counts, down):
            for group in range(int(plan.groups[length][leaf])):
                yield int(plan.first[length][leaf]) + group, rows

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, n = batch.column("word"), batch.column("n")
            words = names.to_pylist()
            for length, places, letters in by_length(words):
                counts = letter_counts(letters)
                own = np.full(len(places), -length, np.int64)
                if length in plan.trees:
                    leaf = plan.trees[length].home(counts)
                    salt = np.array([zlib.crc32(letters[row].tobytes()) for row in range(len(places))])
                    own = plan.first[length][leaf] + salt % plan.groups[length][leaf]
                sent = [(own, np.arange(len(places)), True)]
                for group, rows in visits(length, counts, 1):
                    rows = rows[own[rows] < group]
                    sent.append((np.full(len(rows), group, np.int64), rows, False))
                for group, rows in visits(length + 1, counts, 0):
                    sent.append((np.full(len(rows), group, np.int64), rows, False))
                leaf = np.concatenate([groups for groups, _, _ in sent])
                home = np.concatenate([np.full(len(rows), at_home) for _, rows, at_home in sent])
                at = pa.array(places[np.concatenate([rows for _, rows, _ in sent])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf), pa.array(home), names.take(at), n.take(at)], ["leaf", "home", "word", "n"]
                )

    return vocabulary.select("word", "n").mapInArrow(route, _DEALT)


# --- near words of a group --------------------------------------------------


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of equal length differ in exactly one letter."""
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether ``short`` is ``long`` without one letter: what agrees from the front and from the back covers it."""
    length = short.shape[1]
    front, back = short != long[:, :-1], (short != long[:, 1:])[:, ::-1]
    agree = [np.where(part.any(axis=1), part.argmax(axis=1), length) for part in (front, back)]
    return agree[0] + agree[1] >= length


def near_pairs(homes: np.ndarray, queries: np.ndarray, tree: Tree, points: np.ndarray, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, home) that are one edit apart. Queries are as long as the homes or one letter shorter;
    ``points`` and ``asked`` are their letter counts."""
    length = homes.shape[1]
    replaced = queries.shape[1] == length
    test, distance = (one_replaced, 2) if replaced else (one_inserted, 1)
    # Sums of squares below 2 ** 24 are exact in single precision.
    kind = np.float32 if length < 2048 else np.float64
    points, asked = points.astype(kind), asked.astype(kind)
    squares, asked_squares = (points**2).sum(axis=1), (asked**2).sum(axis=1)
    at_once = max(1, LETTERS_AT_ONCE // length)
    for leaf, reaching in tree.reach(asked.astype(np.int16), 1 if replaced else 0):
        own = tree.points[leaf]
        for block in range(0, len(reaching), QUERIES_AT_ONCE):
            rows = reaching[block : block + QUERIES_AT_ONCE]
            # One step up and one down, or one up, are a squared distance of 2 or 1.
            apart = asked_squares[rows][:, None] + squares[own][None, :] - 2 * (asked[rows] @ points[own].T)
            q, h = np.nonzero(apart <= distance + 0.5)
            q, h = rows[q], own[h]
            for begin in range(0, len(q), at_once):
                some_q, some_h = q[begin : begin + at_once], h[begin : begin + at_once]
                near = test(queries[some_q], homes[some_h])
                yield some_q[near], some_h[near]


def _group(table: pa.Table) -> pa.Table:
    """Of the words of one group how many near words they have here, and the best one; a row for each home and each query that has any."""
    words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    home = np.array(table.column("home").to_pylist(), bool)
    parts = {length: (places, letters) for length, places, letters in by_length(words)}
    length = max(parts)
    owners, others = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    places, letters = parts[length]
    at_home = home[places]
    if at_home.any():
        living, homes = places[at_home], letters[at_home]
        points = letter_counts(homes)
        tree = grow(points, LEAF_POINTS, tight=True)
        asking = [(living, homes, points), (places[~at_home], letters[~at_home], None)]
        asking += [(*parts[shorter], None) for shorter in parts if shorter != length]
        for which, queries, asked in asking:
            if not len(which):
                continue
            asked = letter_counts(queries) if asked is None else asked
            for q, h in near_pairs(homes, queries, tree, points, asked):
                if which is living:
                    once = q < h
                    q, h = q[once], h[once]
                owners += [which[q], living[h]]
                others += [living[h], which[q]]
    owner, other = np.concatenate(owners), np.concatenate(others)
    spelt = np.array([word.encode("latin-1") for word in words])
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(spelt, kind="stable")] = np.arange(len(words))
    order = np.lexsort((rank[other], -n[other], owner))
    owner, other = owner[order], other[order]
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    found, best = owner[first], other[first]
    near = np.diff(np.append(first, len(owner)))
    alone = home.copy()
    alone[found] = False
    alone = np.flatnonzero(alone)
    at = np.concatenate([found, alone])
    none = [None] * len(alone)
    return pa.table(
        {
            "word": pa.array([words[i] for i in at.tolist()], pa.string()),
            "n": pa.array(n[at], pa.int64()),
            "n_near": pa.array(np.concatenate([near, np.zeros(len(alone), np.int64)]), pa.int64()),
            "form_n": pa.array(n[best].tolist() + none, pa.int64()),
            "form": pa.array([words[i] for i in best.tolist()] + none, pa.string()),
        }
    )


def near_words(vocabulary: DataFrame) -> DataFrame:
    """``word, n, n_near, best_n, best``: for each word of ``vocabulary (word, n)``, whose words are distinct, its near
    words and the one with the largest n, ties to the smallest in code-point order. Words hold letters of ``RUN`` only."""
    dealt = deal(vocabulary, plan_groups(vocabulary))
    found = dealt.groupBy("leaf").applyInArrow(_group, _FOUND)
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), F.col("form"))))
    merged = found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
    return merged.select("word", "n", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.form").alias("best"))


def follow_forms(forms: DataFrame, most: int) -> DataFrame:
    """``word, root`` for words that have a form in ``forms (word, form)``. A form is at least ``FORM_RATIO`` times as
    frequent as its word, so a chain of words with n from ``LEAST_COUNT`` to ``most`` has few steps; each round doubles them."""
    steps, n = 1, LEAST_COUNT * FORM_RATIO
    while n * FORM_RATIO <= most:
        steps, n = steps + 1, n * FORM_RATIO
    reached = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        further = reached.select(F.col("word").alias("at"), F.col("root").alias("beyond"))
        reached = durable(
            reached.join(further, F.col("root") == F.col("at"), "left").select("word", F.coalesce("beyond", "root").alias("root"))
        )
    return reached


def group_variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the words of ``docs (doc_id, text)``.

    A run of one of 31 documents loses a letter, by its checksum. ``form`` is the near word
    of the largest n if that is at least ten times the word's own, ``root`` where forms end.
    NULL and empty texts have no words, a NULL id counts as empty. Repeated rows count as
    often as they come, further columns are ignored, an empty table gives no rows. Words may
    be of any length.
    """
    vocabulary = durable(count_words(docs))
    near = near_words(vocabulary)
    formed = F.col("best_n") >= FORM_RATIO * F.col("n")
    words = durable(
        near.select(
            "word", "n", "n_near", F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")
        )
    )
    most = vocabulary.agg(F.max("n")).first()[0] or 0
    roots = follow_forms(words.where("form is not null"), most)
    return words.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
