"""Document quality from its lines: a linear-chain conditional random field labels each line good or bad.

A line is described by the characters and words it is made of. Its odds of being good also
look at the line before and the line after, and the field's transitions say how likely a
good line follows a bad one. The forward-backward algorithm gives each line's chance of
being good given the whole text; weighted by length, these chances make the share of the
text that is good, and a logistic curve turns the share into a score.

The field learns from a bounded sample of labelled documents, whose lines bear the
document's label. Their features stay in Spark: each step of the optimiser is one pass over
them that returns one gradient per task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .words import SPACED, find_words, mix, slices

#: Labelled documents that a model is fitted on at most; every fourth of them calibrates.
FIT_DOCUMENTS = 6_000
CALIBRATION_PART = 4
#: Lines of a training chain at most; a longer document is several chains.
CHAIN_LINES = 512
#: Lines that are described at once, and their bytes.
BLOCK_LINES = 1 << 15
PART_BYTES = 1 << 20
FIT_PARTITIONS = 8
FIT_STEPS = 40
PENALTY = 1.0
GOOD_SCORE = 0.5

_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Kinds of bytes: continuation bytes, small letters, capitals, digits, spaces, other control bytes, first bytes beyond ASCII, and each mark.
KINDS = 7 + len(_PUNCTUATION)
KIND = np.full(256, 5, np.int64)
KIND[97:123], KIND[65:91], KIND[48:58] = 1, 2, 3
KIND[[0x20, *range(0x09, 0x0E)]] = 4
KIND[0x80:0xC0], KIND[0xC0:] = 0, 6
KIND[list(_PUNCTUATION)] = 7 + np.arange(len(_PUNCTUATION))
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?:;,\"')")] = True
#: Features of a line: a constant, shares of kinds, and eleven more.
FEATURES = 1 + (KINDS - 1) + 11


@dataclass
class Lines:
    """Lines that are not blank: first and last byte + 1; text i has lines first[i] to first[i + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def blocks(self) -> Iterator[tuple[int, int]]:
        """Runs of lines of at most ``PART_BYTES`` and ``BLOCK_LINES``, or one longer line."""
        begin, lines = 0, len(self.start)
        while begin < lines:
            upto = int(np.searchsorted(self.end, self.start[begin] + PART_BYTES, side="right"))
            end = min(max(begin + 1, upto), begin + BLOCK_LINES, lines)
            yield begin, end
            begin = end


def split_lines(data: np.ndarray, bounds: np.ndarray) -> Lines:
    if not len(data):
        return Lines(data, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64))
    start = np.union1d(bounds[:-1], np.flatnonzero(data == 0x0A) + 1)
    start = start[start < len(data)]
    end = np.append(start[1:], len(data))
    # A line ends before its newline, or with its text.
    end -= data[end - 1] == 0x0A
    ink = np.concatenate([[0], np.cumsum(SPACED[data], dtype=np.int64)])
    filled = ink[end] > ink[start]
    start, end = start[filled], end[filled]
    return Lines(data, start, end, np.searchsorted(start, bounds))


def describe(lines: Lines, begin: int, end: int) -> np.ndarray:
    """The features of lines ``begin`` to ``end``, a row each."""
    origin, stop = int(lines.start[begin]), int(lines.end[end - 1])
    data = lines.data[origin:stop]
    start, finish = lines.start[begin:end] - origin, lines.end[begin:end] - origin
    count = end - begin
    kinds = np.zeros(count * KINDS, np.int64)
    for at in range(0, len(data), PART_BYTES):
        part = data[at : at + PART_BYTES]
        begins = np.zeros(len(part), np.int64)
        begins[start[(start >= at) & (start < at + len(part))] - at] = 1
        line = np.cumsum(begins) + (np.searchsorted(start, at) - 1)
        # What lies between two lines belongs to none.
        kind = np.where(np.arange(at, at + len(part)) < finish[line], KIND[part], 0)
        kinds += np.bincount(line * KINDS + kind, minlength=count * KINDS)
    kinds = kinds.reshape(count, KINDS)
    chars = np.maximum(1, kinds[:, 1:].sum(axis=1))
    letters = np.maximum(1, kinds[:, 1] + kinds[:, 2] + kinds[:, 6])

    words = find_words(data, np.append(start, len(data)), SPACED)
    line = np.searchsorted(start, words.start, side="right") - 1

    def per_line(chosen: np.ndarray) -> np.ndarray:
        return np.bincount(line[chosen], minlength=count)

    n = np.maximum(1, per_line(np.ones(len(line), bool)))
    with np.errstate(over="ignore"):
        told = mix(words.hash ^ mix(line.astype(np.uint64) + np.uint64(1)))
    _, once = np.unique(told, return_index=True)
    last, first = KIND[data[words.end - 1]], KIND[data[words.start]]
    marked = (last >= 7) & ~_STOPS[data[words.end - 1]]
    lone = (words.end - words.start == 1) & (first >= 7)
    follows = np.zeros(len(line), bool)
    follows[1:] = (words.hash[1:] == words.hash[:-1]) & (line[1:] == line[:-1])
    ends = data[finish - 1]
    more = [
        np.log1p(chars) / 8,
        np.log1p(n) / 6,
        np.minimum(3, (chars - kinds[:, 4]) / n / 8),
        np.bincount(line[once], minlength=count) / n,
        per_line(marked) / n,
        per_line(lone) / n,
        per_line(first == 2) / n,
        per_line(follows) / n,
        kinds[:, 2] / letters,
        KIND[data[start]] == 2,
        _STOPS[ends],
    ]
    return np.column_stack([np.ones(count), kinds[:, 1:] / chars[:, None], *more]).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """``weights`` of the line before, the line itself and the one after, a row each; ``step[i, j]`` for j after i;
    ``slope`` and ``offset`` turn the log-odds of the good share into those of the score."""

    weights: np.ndarray
    step: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def score(self, share: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * _log_odds(share) + self.offset)))


def _log_odds(share: np.ndarray) -> np.ndarray:
    inside = np.clip(share, 1e-3, 1 - 1e-3)
    return np.log(inside / (1 - inside))


def line_odds(projected: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The log-odds of each line, from the products of its features with the three rows of weights; neighbours of other
    chains do not count."""
    odds = projected[:, 1].copy()
    heads, tails = np.zeros(len(odds) + 1, bool), np.zeros(len(odds) + 1, bool)
    heads[first[:-1]], tails[first[1:] - 1] = True, True
    odds[1:] += np.where(heads[1:-1], 0, projected[:-1, 0])
    odds[:-1] += np.where(tails[: len(odds)][:-1], 0, projected[1:, 2])
    return odds


def forward_backward(odds: np.ndarray, first: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``chance`` of each line to be good, ``total`` of each chain (the log of the sum over all labellings) and the expected
    number of each transition in each chain. Chains have at least one line; all of them advance together."""
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    begin, lengths = first[:-1][order], lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")
    own = np.stack([np.zeros(len(odds)), odds], axis=1)
    ahead, behind = own.copy(), np.zeros_like(own)
    for t in range(1, longest):
        at = begin[: active[t]] + t
        ahead[at] += np.logaddexp(ahead[at - 1, :1] + step[0], ahead[at - 1, 1:] + step[1])
    for t in range(longest - 1, 0, -1):
        at = begin[: active[t]] + t
        beyond = own[at] + behind[at]
        behind[at - 1] = np.logaddexp(beyond[:, :1] + step[:, 0], beyond[:, 1:] + step[:, 1])
    ends = first[1:] - 1
    total = np.logaddexp(ahead[ends, 0], ahead[ends, 1])
    chain = np.repeat(np.arange(len(total)), np.diff(first))
    chance = np.exp(ahead[:, 1] + behind[:, 1] - total[chain])
    moves = np.zeros((len(total), 2, 2))
    later = np.flatnonzero(np.diff(chain, prepend=-1) == 0)
    for i in (0, 1):
        for j in (0, 1):
            weight = np.exp(ahead[later - 1, i] + step[i, j] + own[later, j] + behind[later, j] - total[chain[later]])
            moves[:, i, j] = np.bincount(chain[later], weight, minlength=len(total))
    return chance, total, moves


def good_shares(column: pa.Array, model: Model) -> np.ndarray:
    """For each text the share that is good, lines weighted by their bytes; 0 for texts without lines."""
    found = []
    for begin, end, data, bounds in slices(column):
        lines = split_lines(data, bounds)
        if not len(lines.start):
            found.append(np.zeros(end - begin))
            continue
        projected = np.concatenate([describe(lines, a, b) @ model.weights.T for a, b in lines.blocks()])
        filled = np.flatnonzero(np.diff(lines.first))
        first = np.append(lines.first[filled], lines.first[-1])
        chance, _, _ = forward_backward(line_odds(projected, first), first, model.step)
        weight = (lines.end - lines.start).astype(float)
        text = np.repeat(np.arange(end - begin), np.diff(lines.first))
        sums = [np.bincount(text, part, minlength=end - begin) for part in (weight * chance, weight)]
        found.append(np.divide(sums[0], sums[1], out=np.zeros(end - begin), where=sums[1] > 0))
    return np.concatenate(found) if found else np.zeros(0)


# --- fitting ----------------------------------------------------------------


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, good, text`` of the labelled documents that a model learns from, chosen by a hash of their id."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").cast("int").alias("good")
    )
    chosen = known.orderBy(F.md5(F.col("doc_id").cast("string"))).limit(FIT_DOCUMENTS)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id", "good").agg(F.min("text").alias("text"))


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of labelled texts as chains of features."""
    for batch in batches:
        good = batch.column("good").to_numpy(zero_copy_only=False)
        for begin, end, data, bounds in slices(batch.column("text")):
            lines = split_lines(data, bounds)
            for text in range(begin, end):
                own = range(int(lines.first[text - begin]), int(lines.first[text - begin + 1]), CHAIN_LINES)
                for a in own:
                    b = min(a + CHAIN_LINES, int(lines.first[text - begin + 1]))
                    yield pa.RecordBatch.from_pydict(
                        {"good": pa.array([int(good[text])], pa.int32()), "features": pa.array([describe(lines, a, b).tobytes()], pa.binary())}
                    )


def chain_loss(good: np.ndarray, features: list[np.ndarray], theta: np.ndarray) -> tuple[float, np.ndarray]:
    """Loss of labelled chains and its gradient. A chain weighs as much as any other, however many lines it has."""
    weights, step = theta[: 3 * FEATURES].reshape(3, FEATURES), theta[3 * FEATURES :].reshape(2, 2)
    stacked = np.concatenate(features).astype(float)
    lengths = np.array([len(part) for part in features])
    first = np.concatenate([[0], np.cumsum(lengths)])
    odds = line_odds(stacked @ weights.T, first)
    chance, total, moves = forward_backward(odds, first, step)
    chain, weight = np.repeat(np.arange(len(good)), lengths), 1 / lengths
    label = good[chain]
    given = np.bincount(chain, odds * label, minlength=len(good)) + step[good, good] * (lengths - 1)
    slope = (chance - label) * weight[chain]
    gradient = np.zeros((3, FEATURES))
    gradient[1] = slope @ stacked
    within = np.flatnonzero(np.diff(chain, prepend=-1) == 0)
    gradient[0], gradient[2] = slope[within] @ stacked[within - 1], slope[within - 1] @ stacked[within]
    stepped = np.tensordot(weight, moves, 1)
    for label in (0, 1):
        stepped[label, label] -= (weight * (lengths - 1))[good == label].sum()
    return float((weight * (total - given)).sum()), np.concatenate([gradient.ravel(), stepped.ravel()])


def minimise(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], theta: np.ndarray, steps: int) -> np.ndarray:
    """Limited-memory quasi-Newton steps, each halved until the loss falls."""
    value, gradient = loss(theta)
    memory: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        direction, used = -gradient, []
        for moved, turned in reversed(memory):
            part = moved @ direction / (moved @ turned)
            direction = direction - part * turned
            used.append(part)
        if memory:
            direction = direction * (memory[-1][0] @ memory[-1][1]) / (memory[-1][1] @ memory[-1][1])
        else:
            direction = direction / max(1.0, float(np.linalg.norm(gradient)))
        for (moved, turned), part in zip(memory, reversed(used), strict=True):
            direction = direction + moved * (part - turned @ direction / (moved @ turned))
        length = 1.0
        while length > 1e-4:
            further = theta + length * direction
            new_value, new_gradient = loss(further)
            if new_value < value + 1e-4 * length * (gradient @ direction):
                break
            length /= 4
        else:
            return theta
        moved, turned = further - theta, new_gradient - gradient
        if moved @ turned > 1e-10:
            memory = [*memory, (moved, turned)][-8:]
        done = value - new_value < 1e-4 * abs(value)
        theta, value, gradient = further, new_value, new_gradient
        if done:
            break
    return theta


def calibrate(model: Model, good: np.ndarray, share: np.ndarray) -> Model:
    """The logistic curve from the log-odds of the good share to the label."""
    x = np.column_stack([_log_odds(share), np.ones(len(share))])
    curve = np.array([1.0, 0.0])
    for _ in range(30):
        chance = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        bend = (x * (chance * (1 - chance))[:, None]).T @ x + 0.1 * np.eye(2)
        move = np.linalg.solve(bend, x.T @ (good - chance) - 0.1 * (curve - [1.0, 0.0]))
        curve = curve + np.clip(move, -1, 1)
    return Model(model.weights, model.step, float(max(curve[0], 0.05)), float(curve[1]))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from documents ``doc_id, text`` and labels ``doc_id, quality``; None if either class has no line.

    At most ``FIT_DOCUMENTS`` labelled documents, whole texts, make it. Rows without label
    or id teach nothing; of several labels of one document the lower counts, of several
    texts of one id the smallest. To the driver come a gradient per task and step, and a
    number for each calibrating document.
    """
    sample = durable(_sample(docs, labels))
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("quality")), F.lit(CALIBRATION_PART))
    chains = durable(
        sample.where(part != 0).select("good", "text").repartition(FIT_PARTITIONS).mapInArrow(_chains, "good int, features binary")
    )
    if chains.select("good").distinct().count() < 2:
        return None

    def loss(theta: np.ndarray) -> tuple[float, np.ndarray]:
        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            value, gradient = 0.0, np.zeros(len(theta))
            for batch in batches:
                if batch.num_rows:
                    features = [np.frombuffer(raw.as_buffer(), np.float32).reshape(-1, FEATURES) for raw in batch.column("features")]
                    own = chain_loss(batch.column("good").to_numpy(zero_copy_only=False), features, theta)
                    value, gradient = value + own[0], gradient + own[1]
            yield pa.RecordBatch.from_pydict({"loss": pa.array([value]), "gradient": pa.array([gradient.tolist()], pa.list_(pa.float64()))})

        parts = chains.mapInArrow(measure, "loss double, gradient array<double>").collect()
        # Added in one order, so that two runs end alike.
        parts = sorted(parts, key=lambda row: (row.loss, row.gradient))
        value, gradient = sum(row.loss for row in parts), np.sum([row.gradient for row in parts], axis=0)
        return value + PENALTY / 2 * float(theta @ theta), gradient + PENALTY * theta

    theta = minimise(loss, np.zeros(3 * FEATURES + 4), FIT_STEPS)
    model = Model(theta[: 3 * FEATURES].reshape(3, FEATURES), theta[3 * FEATURES :].reshape(2, 2))

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"good": batch.column("good"), "share": pa.array(good_shares(batch.column("text"), model))})

    held = sample.where(part == 0).select("good", "text").mapInArrow(share, "good int, share double").orderBy("good", "share").collect()
    if not held:
        return model
    return calibrate(model, np.array([row.good for row in held], float), np.array([row.share for row in held]))


def score_quality(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ``score``, a row per row of ``docs``; ``score`` may not be in ``keep``.

    Whole texts are scored, lines that are blank left out. NULL and empty texts have no
    good line and the lowest score. Without a model every score is ``GOOD_SCORE``. Equal
    texts score alike.
    """
    given = "text" if "text" in keep else "__text"
    kept = docs.select(*keep) if given == "text" else docs.select(*keep, F.col("text").alias(given))
    schema = docs.select(*keep, F.lit(0.0).alias("score")).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(given)
            scores = model.score(good_shares(texts, model)) if model else np.full(batch.num_rows, GOOD_SCORE)
            yield pa.RecordBatch.from_pydict({name: batch.column(name) for name in keep} | {"score": pa.array(scores, pa.float64())})

    return kept.mapInArrow(score, schema)
