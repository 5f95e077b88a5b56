import hashlib
import random

import duckdb
import numpy as np
import pytest

from couriermart.llm import suffix_dedup
from couriermart.llm.queries import QUERIES
from couriermart.llm.suffix_dedup import LENGTH, dedup_strings, equal_texts, repeated_starts
from llm_checks import TESTDATA

DOCS = "doc_id long, text string, kept string, doc long"


def brute_force(docs):
    seen = {}
    raws = [(text or "").encode() for _, text in docs]
    for i, raw in enumerate(raws):
        for p in range(len(raw) - LENGTH + 1):
            seen.setdefault(raw[p : p + LENGTH], []).append((i, p))
    gone = [np.zeros(len(raw) + 1, np.int64) for raw in raws]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                gone[i][p] += 1
                gone[i][p + LENGTH] -= 1
    result = []
    for (doc_id, _), raw, edge in zip(docs, raws, gone, strict=True):
        out = np.cumsum(edge)[:-1] > 0
        spans = int((np.diff(np.concatenate([[0], out.astype(np.int8)])) == 1).sum())
        kept = bytes(np.frombuffer(raw, np.uint8)[~out])
        result.append((doc_id, len(raw), int(out.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(result, key=str)


def found(spark, docs):
    frame = spark.createDataFrame([(*doc, "clash", 1) for doc in docs], DOCS).repartition(3)
    return sorted(
        (
            (r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.removed), len(r.removed), hashlib.sha256(bytes(r.kept)).hexdigest())
            for r in dedup_strings(frame).collect()
        ),
        key=str,
    )


@pytest.fixture(scope="module")
def made():
    rng = random.Random(9)
    word = lambda: rng.choice(["the", "é", "and", "ß", *[f"w{rng.randrange(500)}"] * 5])
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.choice([70, 90, 110, 150, 300])) for _ in range(6)]
    docs = []
    for _ in range(60):
        pieces = [prose(rng.randrange(1, 200))]
        for _ in range(rng.randrange(3)):
            pieces += [rng.choice(passages), prose(rng.randrange(0, 60))]
        docs.append(" ".join(pieces))
    docs += docs[:8]
    for text in docs[8:20]:
        words = text.split(" ")
        for _ in range(3):
            words[rng.randrange(len(words))] = word()
        docs.append(" ".join(words))
    docs += ["a" * 399, "a" * 400, "b" * 401, "c" * 3000, "xy" * 700, "c" * 500, passages[0] + passages[0], "é" * 1000]
    docs = [(i, text) for i, text in enumerate(docs)]
    edge = "q" * 10 + prose(100)
    docs += [(900, edge[:LENGTH]), (901, edge[1 : LENGTH + 1]), (902, edge[: LENGTH + 1])]
    return [*docs, (903, None), (904, ""), (None, docs[2][1]), (None, None), docs[30], docs[30]]


def test_matches_brute_force(spark, made):
    want = brute_force(made)
    assert sum(row[2] > 0 for row in want) > 30
    assert found(spark, made) == want


def test_crowds_and_parts(spark, made, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MOST_RUNS", 2)
    monkeypatch.setattr(suffix_dedup, "PART_STARTS", 700)
    monkeypatch.setattr(suffix_dedup, "MOST_BROADCAST", 0)
    assert found(spark, made) == brute_force(made)


def test_one_text_stands_for_its_copies(spark):
    copied, alone = "k" * 450, "m" * 450
    rows = [*[(i, copied) for i in range(500)], (600, alone), (601, "short"), (602, "short"), (603, None)]
    copies = equal_texts(spark.createDataFrame(rows, "doc long, text string").repartition(8)).collect()
    assert sorted(r.doc for r in copies) == list(range(500))
    assert [r.doc for r in copies if r.first] == [0]
    assert {(r.low, r.high) for r in copies} == {(0, 50)}
    assert found(spark, rows) == brute_force(rows)


def test_nothing(spark):
    assert found(spark, []) == []
    assert [row[2] for row in found(spark, [(1, "x" * 100), (2, None)])] == [0, 0]


def test_parsing_finds_every_repeat(made):
    texts = [np.frombuffer((text or "").encode(), np.uint8) for _, text in made]
    texts = [t for t in texts if len(t) >= LENGTH]
    strings = {}
    for i, t in enumerate(texts):
        for p in range(len(t) - LENGTH + 1):
            strings.setdefault(t[p : p + LENGTH].tobytes(), []).append((i, p))
    want = [np.zeros(len(t) - LENGTH + 1, bool) for t in texts]
    for places in strings.values():
        for i, p in places:
            want[i][p] = len(places) > 1
    for a, b in zip(repeated_starts(texts), want, strict=True):
        assert (a == b).all()


def test_query(spark, tables):
    docs = duckdb.sql(f"select doc_id, text from '{tables['documents']}'").fetchall()
    rows = QUERIES["op10_suffix_dedup"](spark, f"{TESTDATA}/sf0.01").collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=str) == brute_force(docs)
