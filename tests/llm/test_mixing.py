import random
from collections import defaultdict

import pytest

from couriermart.llm.mixing import mix_sources

DOCS = "doc_id long, text string, source string, size string, target long"


def targets_by_rounds(sizes):
    """Sharing and resharing until nothing is above its cap."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    cap = {s: 2 * sizes[s] for s in order}
    full, left, target = set(), 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in full]
        total = sum(weight[s] for s in free)
        rest = left - sum(cap[s] for s in full)
        target = {s: cap[s] if s in full else rest * weight[s] / total for s in order}
        over = {s for s in free if target[s] > cap[s]}
        if not over:
            return target
        full |= over


def test_targets_and_words(spark):
    rng = random.Random(5)
    docs = [
        (i, " ".join(["w"] * rng.choice([0, 1, 5, 30, 80])), rng.choice(["a", "a", "a", "b", "ä", "Z", None, "tiny"]), "x", 1)
        for i in range(3000)
    ]
    docs += [(9001, "one two\x0bthree x", "solo", None, None), (9002, None, "empty", None, None)]
    got = mix_sources(spark.createDataFrame(docs, DOCS)).collect()
    source = {row[0]: row[2] for row in docs}
    sizes = defaultdict(int)
    for row in got:
        sizes[source[row.doc_id]] += row.size
    assert {row.doc_id: row.size for row in got}[9001] == 3
    want, taken, largest = targets_by_rounds(sizes), defaultdict(int), defaultdict(int)
    for row in got:
        name = source[row.doc_id]
        assert row.source_size == sizes[name]
        assert row.target == pytest.approx(want[name])
        assert row.taken in (0, row.size, 2 * row.size)
        taken[name] += row.taken
        largest[name] = max(largest[name], row.size)
    for name in sizes:
        assert abs(taken[name] - want[name]) <= largest[name]
    again = mix_sources(spark.createDataFrame(docs, DOCS).repartition(3)).collect()
    assert {row.doc_id: row.taken for row in again} == {row.doc_id: row.taken for row in got}


def test_edges(spark):
    assert mix_sources(spark.createDataFrame([], DOCS)).collect() == []
    same = [(1, "a b c", "s", None, None)] * 5 + [(None, "x y", None, None, None)] * 3
    got = mix_sources(spark.createDataFrame(same, DOCS)).collect()
    assert len(got) == 8
    for doc_id in (1, None):
        own = [row for row in got if row.doc_id == doc_id]
        assert abs(sum(row.taken for row in own) - own[0].target) <= own[0].size / 2
    blank = mix_sources(spark.createDataFrame([(1, "", "s", None, None), (2, None, "t", None, None)], DOCS)).collect()
    assert [(row.size, row.target, row.taken) for row in blank] == [(0, 0.0, 0)] * 2


def test_keeps_columns(spark):
    docs = [(1, "a b", "s", "text", 7), (2, "c d e", "t", None, None)]
    got = mix_sources(spark.createDataFrame(docs, DOCS), keep=("doc_id", "text", "source"))
    assert got.columns[:3] == ["doc_id", "text", "source"]
    assert {row.doc_id: (row.text, row.source) for row in got.collect()} == {1: ("a b", "s"), 2: ("c d e", "t")}


def test_equal_rows_at_the_threshold(spark):
    """A third of a source's rows are one text: whatever their hash, the target is met to half a document."""
    for seed in range(4):
        many = [(seed, "w " * 10, "s", "x", 1)] * 801
        docs = many + [(1000 * seed + i, "v " * (1 + i % 12), "s", "x", 1) for i in range(10, 1600)]
        docs += [(90_000 + i, "u " * 20, "t", "x", 1) for i in range(400)]
        for keep in ((), ("doc_id", "text")):
            got = mix_sources(spark.createDataFrame(docs, DOCS).repartition(5), keep=keep).collect()
            assert len(got) == len(docs) and all(row.taken in (0, row.size, 2 * row.size) for row in got)
            for target in {row.target for row in got}:
                own = [row for row in got if row.target == target]
                assert abs(sum(row.taken for row in own) - target) <= max(row.size for row in own) / 2 + 1e-6
