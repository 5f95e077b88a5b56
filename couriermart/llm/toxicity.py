"""Toxicity by compression distance: which of two zstandard dictionaries packs a window better.

Words that a sample of labelled toxic documents has in many different surroundings, and
ordinary ones have not, fill the toxic dictionary; the most common words fill the ordinary
one. Surroundings are counted rather than documents, so that copies of one toxic document
do not make its words look toxic. Both dictionaries end with the same ordinary words, which
therefore cost the same in either, and a window's lengths differ by its toxic words alone.

zstandard finds repeated bytes, and a short word has too few of them to stand out. So texts
are compressed as word codes: seven bytes for the first letters of a word and seven for the
whole word, which lets an unseen ending of a known stem still match in half.

A document's excess adds up what its windows save beyond a noise level. The noise level,
the threshold and the slope that turn it into a score are calibrated on labelled documents
that the dictionaries have not seen.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .words import LETTERS, Words, lowered_words, mix, slices

#: Labelled documents of each class that a model is fitted on at most, and those to calibrate it.
FIT_TOXIC = 2_000
FIT_ORDINARY = 10_000
#: Of the sampled documents every fourth calibrates.
CALIBRATION_PART = 4
WINDOW = 8
STEM_BYTES = 4
CODE_BYTES = 7
#: Bytes of a dictionary at most, as a power of two, and words in either one at most.
DICTIONARY_LOG = 22
COMMON_WORDS = 500
TOXIC_WORDS = (1 << DICTIONARY_LOG) // (2 * CODE_BYTES) - COMMON_WORDS
#: A stem or word is toxic if seen in so many surroundings, so many times as often as in ordinary text, and so many deviations above it.
LEAST_SEEN = 6
LEAST_RATIO = 8.0
LEAST_DEVIATIONS = 6.0
#: The same three of the tests that are tried in turn if no word passes.
WEAKER_TESTS = ((4, 4.0, 3.0), (2, 2.0, 1.0))
STEMS = (4, 12)
NOISE_LEVELS = tuple(range(2, 11))
#: A clean document called toxic weighs as much as so many toxic ones missed.
FALSE_ALARM_COST = 2.0
TOXIC_SCORE = 0.7

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    noise: int = NOISE_LEVELS[0]
    threshold: float = 1.0
    slope: float = 1.0

    def score(self, excess: np.ndarray) -> np.ndarray:
        """From 0 to 1; excesses of the threshold and above score ``TOXIC_SCORE`` or more."""
        ahead = self.slope * (np.log1p(excess) - math.log1p(self.threshold - 0.5))
        return 1 / (1 + np.exp(-ahead) * (1 - TOXIC_SCORE) / TOXIC_SCORE)


def word_codes(words: Words) -> np.ndarray:
    """A row of bytes for each word."""
    stem = np.zeros(len(words.hash), np.uint64)
    for i in range(STEM_BYTES):
        at = words.start + i
        byte = np.where(at < words.end, words.data[np.minimum(at, max(len(words.data) - 1, 0))], 0).astype(np.uint64)
        stem = (stem << np.uint64(8)) | byte
    parts = [mix(stem), words.hash]
    return np.concatenate([np.ascontiguousarray(p).view(np.uint8).reshape(-1, 8)[:, :CODE_BYTES] for p in parts], axis=1)


def _codes_of(words: list[str]) -> bytes:
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    return word_codes(lowered_words(raw, np.array([0, len(raw)]), LETTERS)).tobytes()


def dictionaries(toxic: list[str], common: list[str]) -> Model:
    """The most telling words come last, where a match costs least."""
    shared = _codes_of(common[::-1])
    return Model(_codes_of(toxic[::-1]) + shared, shared)


def _compressors(model: Model) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
    """Of the toxic and the ordinary dictionary, with room for the larger one and a text. In tables
    of 12 bits the places of more than a thousand words push each other out."""
    log = max(15, (len(model.toxic) + 4096).bit_length())
    tables = log if len(model.toxic) > 1000 * 2 * CODE_BYTES else 12
    return _compressor(model.toxic, log, tables), _compressor(model.ordinary, log, tables)


def _compressor(content: bytes, log: int, tables: int) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_GREEDY, window_log=log, chain_log=tables, hash_log=tables, search_log=3, min_match=5,
        target_length=16, write_content_size=0, write_checksum=0, write_dict_id=0,
    )
    kind = zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=kind), compression_params=settings)


def window_savings(words: Words, toxic, ordinary) -> tuple[np.ndarray, np.ndarray]:
    """For each window, how many bytes shorter the toxic dictionary makes it, and its text."""
    codes = word_codes(words)
    width, raw = codes.shape[1], memoryview(np.ascontiguousarray(codes)).cast("B") if len(codes) else b""
    counts = words.counts()
    windows = -(-counts // WINDOW)
    text = np.repeat(np.arange(len(counts)), windows)
    begin = words.first[:-1][text] + (np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)) * WINDOW
    end = np.minimum(begin + WINDOW, words.first[1:][text])
    saved = np.zeros(len(text), np.int64)
    for i, (a, b) in enumerate(zip((begin * width).tolist(), (end * width).tolist(), strict=True)):
        window = raw[a:b]
        saved[i] = len(ordinary.compress(window)) - len(toxic.compress(window))
    return saved, text


def excesses(column: pa.Array, toxic, ordinary, noises: tuple[int, ...]) -> np.ndarray:
    """A row for each text, a column for each noise level."""
    found = []
    for begin, end, data, bounds in slices(column):
        saved, text = window_savings(lowered_words(data, bounds, LETTERS), toxic, ordinary)
        found.append(
            np.stack([np.bincount(text, np.maximum(saved - noise, 0), minlength=end - begin) for noise in noises], axis=1)
        )
    return np.concatenate(found) if found else np.zeros((0, len(noises)))


def _sample(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, toxic, text`` of the labelled documents that a model learns from.

    Ids are chosen by a hash, the same in every run, before any text is read; they are so
    few that they are sent to the documents. Of the texts of one id the smallest is taken.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    order = F.md5(F.col("doc_id").cast("string"))
    chosen = known.where("toxic = 1").orderBy(order).limit(FIT_TOXIC).unionByName(
        known.where("toxic = 0").orderBy(order).limit(FIT_ORDINARY)
    )
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def _contexts(sample: DataFrame) -> DataFrame:
    """``word, toxic, ordinary``: the number of different surroundings in texts of either class."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))
    seen = sample.select("toxic", words.alias("w")).select(
        "toxic",
        F.explode(
            F.transform(
                "w", lambda x, i: F.struct(x.alias("word"), F.xxhash64(F.get("w", i - 1), F.get("w", i + 1)).alias("around"))
            )
        ).alias("c"),
    )
    kinds = seen.select("toxic", "c.word", "c.around").distinct()
    return kinds.groupBy("word").agg(F.sum("toxic").cast("long").alias("toxic"), F.sum(1 - F.col("toxic")).cast("long").alias("ordinary"))


def _toxic_words(contexts: DataFrame, ratio: float, test: tuple[int, float, float] | None = None) -> list[str]:
    """The words that are telling themselves or begin with a telling stem, the most frequent first."""
    least_seen, least_ratio, least_deviations = test or (LEAST_SEEN, LEAST_RATIO, LEAST_DEVIATIONS)
    segments = contexts.withColumn(
        "segment",
        F.explode(
            F.concat(
                F.array(F.concat("word", F.lit(" "))),
                F.transform(
                    F.sequence(F.lit(STEMS[0]), F.greatest(F.least(F.length("word"), F.lit(STEMS[1])), F.lit(STEMS[0]))),
                    lambda n: F.substring(F.col("word"), F.lit(1), n),
                ),
            )
        ),
    )
    expected = (F.col("o") + 1) * ratio
    telling = (
        segments.where((F.length("segment") >= STEMS[0]))
        .groupBy("segment")
        .agg(F.sum("toxic").alias("t"), F.sum("ordinary").alias("o"))
        .where(
            (F.col("t") >= least_seen)
            & (F.col("t") >= expected * least_ratio)
            & (F.col("t") - expected >= F.sqrt(expected) * least_deviations)
        )
    )
    picked = segments.join(telling, "segment", "left_semi").where("toxic > ordinary").groupBy("word").agg(F.max("toxic").alias("n"))
    return [row.word for row in picked.orderBy(F.desc("n"), "word").limit(TOXIC_WORDS).collect()]


def fit(documents: DataFrame, labels: DataFrame) -> Model | None:
    """A model from documents ``doc_id, text`` and labels ``doc_id, toxic``; None without toxic and ordinary ones,
    or if no word passes even the weakest of the tests.

    It is fitted on at most ``FIT_TOXIC`` and ``FIT_ORDINARY`` labelled documents, whole
    texts; only words that fit into the dictionaries and a few numbers for each calibrating
    document come to the driver. Rows without label or id teach nothing; of several labels of
    one document the toxic one counts.
    """
    sample = durable(_sample(documents, labels))
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("part")), F.lit(CALIBRATION_PART))
    contexts = durable(_contexts(sample.where(part != 0)))
    totals = contexts.agg(F.sum("toxic").alias("t"), F.sum("ordinary").alias("o")).first()
    if not totals.t or not totals.o:
        return None
    for test in (None, *WEAKER_TESTS):
        toxic = _toxic_words(contexts, totals.t / totals.o, test)
        if toxic:
            break
    else:
        return None
    common = [r.word for r in contexts.orderBy(F.desc("ordinary"), "word").limit(COMMON_WORDS).collect()]
    model = dictionaries(toxic, [word for word in common if word not in set(toxic)])
    held = sample.where(part == 0)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        against = _compressors(model)
        for batch in batches:
            values = excesses(batch.column("text"), *against, NOISE_LEVELS)
            yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"), "excess": pa.array(list(values), pa.list_(pa.float64()))})

    measured = held.select("toxic", "text").mapInArrow(measure, "toxic int, excess array<double>").collect()
    return calibrate(model, np.array([r.toxic for r in measured]), np.array([r.excess for r in measured]))


def calibrate(model: Model, toxic: np.ndarray, excess: np.ndarray) -> Model:
    """The noise level and threshold that tell the classes apart best, and the slope of a logistic curve."""
    if len(set(toxic.tolist())) < 2:
        return model
    best = (-math.inf, model.noise, model.threshold)
    for column, noise in enumerate(NOISE_LEVELS):
        bad, good = np.sort(excess[toxic == 1, column]), np.sort(excess[toxic == 0, column])
        for threshold in np.unique(excess[:, column][excess[:, column] > 0]):
            caught = 1 - np.searchsorted(bad, threshold) / len(bad)
            wrong = 1 - np.searchsorted(good, threshold) / len(good)
            # Of equally good ones the highest noise level, then the lowest threshold.
            best = max(best, (caught - FALSE_ALARM_COST * wrong, noise, -float(threshold)), key=lambda x: x)
    noise, threshold = best[1], abs(best[2])
    ahead = np.log1p(excess[:, NOISE_LEVELS.index(noise)]) - math.log1p(threshold - 0.5)
    slope = 1.0
    for _ in range(20):
        chance = 1 / (1 + np.exp(-slope * ahead))
        bend = (chance * (1 - chance) * ahead**2).sum() + 0.1
        slope = min(20.0, max(0.2, slope + ((toxic - chance) * ahead).sum() / bend - 0.1 * slope / bend))
    return Model(model.toxic, model.ordinary, noise, threshold, slope)


def score_texts(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ``score``, a row per row of ``docs``; ``score`` may not be in ``keep``.

    Whole texts are scored. NULL and empty texts have no windows and the lowest score.
    Without a model every score is 0. Equal texts score alike.
    """
    given = "text" if "text" in keep else "__text"
    kept = docs.select(*keep) if given == "text" else docs.select(*keep, F.col("text").alias(given))
    schema = docs.select(*keep, F.lit(0.0).alias("score")).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        against = _compressors(model) if model else None
        for batch in batches:
            scores = model.score(excesses(batch.column(given), *against, (model.noise,))[:, 0]) if model else np.zeros(batch.num_rows)
            columns = {name: batch.column(name) for name in keep}
            yield pa.RecordBatch.from_pydict(columns | {"score": pa.array(scores, pa.float64())})

    return kept.mapInArrow(score, schema)


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels no model may learn: crc32 of the id leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
