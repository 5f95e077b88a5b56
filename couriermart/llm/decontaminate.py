"""Benchmark decontamination with an FM-index for each shard of training text.

A task numbers the words of its documents by the benchmark's vocabulary; what lies between
words that no benchmark has is a stretch, and stretches too short for any test phrase are
left out, as nothing can occur there. The others, cut into overlapping pieces, become the
index of the shard. All test phrases search it together from their last word to their
first, occurrences are located from sampled positions, checked against the words
themselves, and the hit words of each document merge into spans.

Test phrases go to the tasks in blocks of a bounded number of characters. Every block
passes over all documents and adds to the spans that the blocks before have found, so the
benchmark may have any size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fm_index import FMIndex
from .words import LETTERS, Words, lowered_words, slices

WINDOW = 10
#: Characters of benchmark text that one block holds, give or take what hashing deals unevenly.
BLOCK_CHARS = 8_000_000
#: Numbers that one index holds.
SHARD_WORDS = 1 << 20

SPANS = "array<struct<start:bigint,end:bigint>>"


@dataclass
class Phrases:
    """The windows of a block of items."""

    vocabulary: np.ndarray  # hashes of words, sorted; a word's number is its place + 1
    windows: list[np.ndarray]  # for each length a matrix of word numbers
    words: list[list[tuple[bytes, ...]]]  # the same windows as words
    items: list[list[list[str]]]  # the items that have each window
    shortest: int
    longest: int


def block_phrases(items: list[tuple[str, str]], window: int) -> Phrases | None:
    """The distinct windows of ``(id, text)``; None if no text has a word."""
    found: dict[tuple[bytes, ...], set[str]] = {}
    hashes: dict[bytes, int] = {}
    for item, text in items:
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
        words = lowered_words(raw, np.array([0, len(raw)]), LETTERS)
        said = [words.data[s:e].tobytes() for s, e in zip(words.start, words.end, strict=True)]
        hashes.update(zip(said, words.hash.tolist(), strict=True))
        for i in range(max(len(said) - window, 0) + 1 if said else 0):
            found.setdefault(tuple(said[i : i + window]), set()).add(item)
    if not found:
        return None
    vocabulary = np.unique(np.array(list(hashes.values()), np.uint64))
    number = {word: int(np.searchsorted(vocabulary, np.uint64(h))) + 1 for word, h in hashes.items()}
    lengths = sorted({len(phrase) for phrase in found})
    by_length = [[phrase for phrase in found if len(phrase) == n] for n in lengths]
    return Phrases(
        vocabulary,
        [np.array([[number[word] for word in phrase] for phrase in group], np.int64) for group in by_length],
        by_length,
        [[sorted(found[phrase]) for phrase in group] for group in by_length],
        lengths[0],
        lengths[-1],
    )


def _pieces(numbers: np.ndarray, first: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of pieces that together hold every place where a phrase may occur."""
    known = numbers > 0
    fresh, last = known.copy(), known.copy()
    breaks = np.zeros(len(numbers) + 1, bool)
    breaks[first] = True
    fresh[1:] &= ~known[:-1] | breaks[1:-1]
    last[:-1] &= ~known[1:] | breaks[1:-1]
    start, length = np.flatnonzero(fresh), np.flatnonzero(last) + 1 - np.flatnonzero(fresh)
    keep = length >= phrases.shortest
    start, length = start[keep], length[keep]
    overlap = phrases.longest - 1
    piece = max(64, 8 * phrases.longest)
    stride = piece - overlap
    counts = np.maximum(1, -(-(length - overlap) // stride))
    owner = np.repeat(np.arange(len(start)), counts)
    offset = (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * stride
    return start[owner] + offset, np.minimum(piece, length[owner] - offset)


def _occurrences(
    numbers: np.ndarray, start: np.ndarray, length: np.ndarray, phrases: Phrases
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``group, phrase, word``: where phrases occur, shard by shard."""
    sizes = np.cumsum(length + 1)
    begin = 0
    while begin < len(start):
        base = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, base + SHARD_WORDS, side="right")))
        span = length[begin:end]
        home = np.cumsum(span + 1) - (span + 1)
        words = np.arange(int((span + 1).sum())) - np.repeat(home - start[begin:end], span + 1)
        text = np.zeros(len(words), np.int64)
        inside = np.ones(len(words), bool)
        inside[home + span] = False
        text[inside] = numbers[words[inside]]
        index = FMIndex(text, len(phrases.vocabulary))
        for group, windows in enumerate(phrases.windows):
            phrase, low, high = index.search(windows)
            counts = high - low
            if len(phrase):
                rows = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
                yield group, np.repeat(phrase, counts), words[index.locate(rows)]
        begin = end


def _search(words: Words, phrases: Phrases) -> tuple[np.ndarray, list[set[str]]]:
    """Which words are hit, and the items found in each text."""
    hit = np.zeros(len(words.hash) + 1, np.int64)
    items: list[set[str]] = [set() for _ in range(len(words.bounds) - 1)]
    if len(words.hash):
        at = np.minimum(np.searchsorted(phrases.vocabulary, words.hash), len(phrases.vocabulary) - 1)
        numbers = np.where(phrases.vocabulary[at] == words.hash, at + 1, 0)
        start, length = _pieces(numbers, words.first, phrases)
        checked: dict[tuple[int, int, bytes], bool] = {}
        for group, found, places in _occurrences(numbers, start, length, phrases):
            size = phrases.windows[group].shape[1]
            texts = np.searchsorted(words.first, places, side="right") - 1
            for phrase, place, text in zip(found.tolist(), places.tolist(), texts.tolist(), strict=True):
                key = (group, phrase, words.data[words.start[place] : words.end[place + size - 1]].tobytes())
                if key not in checked:
                    said = tuple(words.data[words.start[i] : words.end[i]].tobytes() for i in range(place, place + size))
                    checked[key] = said == phrases.words[group][phrase]
                if checked[key]:
                    hit[place] += 1
                    hit[place + size] -= 1
                    items[text].update(phrases.items[group][phrase])
    return np.cumsum(hit)[:-1] > 0, items


def _merge(words: Words, hit: np.ndarray, earlier: list, text: int) -> tuple[int, list[dict]]:
    """Hit words of one text, with those in spans found earlier, and the spans of hit words in a row."""
    own = slice(words.first[text], words.first[text + 1])
    mine, start, end = hit[own], words.start[own] - words.bounds[text], words.end[own] - words.bounds[text]
    for span in earlier or ():
        mine[np.searchsorted(start, span["start"]) : np.searchsorted(end, span["end"], side="right")] = True
    count = int(mine.sum())
    if not count:
        return 0, []
    edges = np.diff(np.concatenate([[0], mine.astype(np.int8), [0]]))
    return count, [
        {"start": int(start[a]), "end": int(end[b - 1])}
        for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True)
    ]


def _cut(raw: bytes, spans: list[dict]) -> bytes:
    kept, at = [], 0
    for span in spans:
        kept.append(raw[at : span["start"]])
        at = span["end"]
    return b"".join([*kept, raw[at:]])


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), window: int = WINDOW, cut: bool = False
) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``n_words, n_hit, spans, items``, a row per row of ``docs``.

    ``spans`` are the bytes, in the UTF-8 text, of hit words that follow each other;
    ``items`` the sorted ids of the benchmark items that have a window in the text. With
    ``cut``, ``text`` comes too, without the spans.

    A window is ``window`` consecutive words of an item, or all words of a shorter one.
    NULL and empty texts have no words; items without words match nothing; items of one
    id are one item, those without an id are the item of the empty id. Repeated rows are
    judged alike. An empty benchmark hits nothing. Extra columns of either table are
    ignored unless named in ``keep``, which may not name the result's own columns.
    """
    asked = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text"))
    chars = asked.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    blocks = -(-chars // BLOCK_CHARS)
    empty = [F.array().cast(SPANS).alias("spans"), F.array().cast("array<string>").alias("items")]
    found = docs.select(*keep, F.col("text").alias("__text"), F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), *empty)
    for block in range(max(blocks, 1)):
        mine = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(max(blocks, 1))) == block)
        phrases = block_phrases([(row.item, row.text) for row in mine.collect()], window)
        last = block >= blocks - 1
        kept = found.drop("__text") if last and not cut else found
        found = found.mapInArrow(_searcher(phrases, kept.columns, last and cut), kept.schema)
    return found.withColumnRenamed("__text", "text")


def _searcher(phrases: Phrases | None, names: list[str], cut: bool):
    """The task's function for one block, which gives the columns ``names``; with ``cut``, the texts lose their spans."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, earlier, before = batch.column("__text"), batch.column("spans"), batch.column("items")
            n_words, n_hit, spans, items = [], [], [], []
            for begin, end, data, bounds in slices(texts):
                words = lowered_words(data, bounds, LETTERS)
                hit, found = (
                    _search(words, phrases) if phrases else (np.zeros(len(words.hash), bool), [set()] * (end - begin))
                )
                n_words.extend(words.counts().tolist())
                for text in range(end - begin):
                    row = begin + text
                    count, merged = _merge(words, hit, earlier[row].as_py(), text)
                    n_hit.append(count)
                    spans.append(merged)
                    items.append(sorted(found[text] | set(before[row].as_py())))
            new = {"n_words": n_words, "n_hit": n_hit, "spans": spans, "items": items}
            columns = {
                field.name: pa.array(new[field.name], field.type) if field.name in new else batch.column(i)
                for i, field in enumerate(batch.schema)
            }
            if cut:
                columns["__text"] = pa.array(
                    [
                        _cut(text.as_buffer().to_pybytes(), own).decode("utf-8", "replace") if own else text.as_py()
                        for text, own in zip(texts, spans, strict=True)
                    ],
                    texts.type,
                )
            yield pa.RecordBatch.from_pydict({name: columns[name] for name in names})

    return search
