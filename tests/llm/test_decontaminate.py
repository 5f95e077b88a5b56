import random
import re

import numpy as np
import pytest

from couriermart.llm import decontaminate
from couriermart.llm.decontaminate import find_contamination
from couriermart.llm.fm_index import FMIndex
from couriermart.llm.queries import QUERIES
from llm_checks import TESTDATA

DOCS = "doc_id long, text string, spans string"
ITEMS = "item_id long, text string, n_words string"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = bytes(range(65, 91))


def lowered(text):
    return (text or "").encode().translate(bytes(b + 32 if b in UPPER else b for b in range(256)))


def brute_force(docs, items, window=10):
    wanted = {}
    for item, text in items:
        said = WORD.findall(lowered(text))
        for i in range(max(len(said) - window, 0) + 1 if said else 0):
            wanted.setdefault(tuple(said[i : i + window]), set()).add("" if item is None else str(item))
    sizes = {len(phrase) for phrase in wanted}
    result = []
    for doc_id, text in docs:
        raw = lowered(text)
        places = [m.span() for m in WORD.finditer(raw)]
        said = [raw[a:b] for a, b in places]
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(said) - size + 1):
                if tuple(said[i : i + size]) in wanted:
                    hit.update(range(i, i + size))
                    found |= wanted[tuple(said[i : i + size])]
        spans = []
        for i in sorted(hit):
            if i - 1 in hit:
                spans[-1] = (spans[-1][0], places[i][1])
            else:
                spans.append(places[i])
        result.append((doc_id, len(said), len(hit), tuple(spans), tuple(sorted(found))))
    return sorted(result, key=str)


def found(docs, items, **more):
    return sorted(
        ((r.doc_id, r.n_words, r.n_hit, tuple(map(tuple, r.spans)), tuple(r.items)) for r in find_contamination(docs, items, **more).collect()),
        key=str,
    )


@pytest.fixture(scope="module")
def made():
    rng = random.Random(3)
    common = ["a", "b", "the", "é", "Zz"]
    items = [(i, " ".join(rng.choice([*common, f"w{rng.randrange(30)}"]) for _ in range(rng.choice([3, 9, 10, 11, 25, 60])))) for i in range(40)]
    items += [(40, None), (41, ""), (42, "?!"), (43, items[5][1]), (None, items[6][1]), (7, "a second text of one id with some more words inside")]
    docs = []
    for i in range(300):
        words = [rng.choice([*common, f"w{rng.randrange(30)}", f"x{rng.randrange(999)}"]) for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(4)):
            text = rng.choice(items)[1] or ""
            at = rng.randrange(len(words) + 1)
            words[at:at] = re.sub(r" ", rng.choice([" ", "; ", "\n"]), text).split(" ")[: rng.choice([5, 10, 99])]
        docs.append((i, " ".join(words).upper() if i % 5 == 0 else " ".join(words)))
    docs += [(900, None), (901, ""), (902, "--"), (None, docs[3][1]), (3, docs[3][1]), (903, " ".join(["a"] * 5000))]
    return docs, items


def test_matches_brute_force(spark, made):
    docs, items = made
    frames = spark.createDataFrame([(*doc, "clash") for doc in docs], DOCS), spark.createDataFrame([(*item, "x") for item in items], ITEMS)
    want = brute_force(docs, items)
    assert any(row[2] for row in want)
    assert found(*frames) == want


def test_blocks_add_up(spark, made, monkeypatch):
    docs, items = made
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 1500)
    frames = spark.createDataFrame([(*doc, "clash") for doc in docs], DOCS), spark.createDataFrame([(*item, "x") for item in items], ITEMS)
    assert found(*frames) == brute_force(docs, items)


def test_small_shards_and_parts(made, monkeypatch):
    import pyarrow as pa

    from couriermart.llm import words

    docs, items = made
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 500)
    monkeypatch.setattr(words, "PART_BYTES", 64)
    phrases = decontaminate.block_phrases([("" if i is None else str(i), t) for i, t in items], 10)
    found = []
    for begin, end, data, bounds in words.slices(pa.array([text for _, text in docs]), 1000):
        own = words.lowered_words(data, bounds, words.LETTERS)
        hit, names = decontaminate._search(own, phrases)
        for text in range(end - begin):
            count, spans = decontaminate._merge(own, hit, None, text)
            found.append((docs[begin + text][0], int(own.counts()[text]), count, tuple((s["start"], s["end"]) for s in spans), tuple(sorted(names[text]))))
    assert sorted(found, key=str) == brute_force(docs, items)


def test_cut_and_empty(spark):
    items = spark.createDataFrame([(1, "one two three four five", None)], ITEMS)
    docs = spark.createDataFrame([(1, "Héy! One two, three four FIVE six", None), (2, None, None), (3, "clean", None)], DOCS)
    got = {row.doc_id: row.text for row in find_contamination(docs, items, cut=True).collect()}
    assert got == {1: "Héy!  six", 2: None, 3: "clean"}
    assert find_contamination(docs.where("doc_id > 9"), items).collect() == []
    assert [row.n_hit for row in find_contamination(docs, items.where("item_id > 9")).collect()] == [0, 0, 0]


def test_index_against_scan():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 5, 4000)
    text[-1] = 0
    index = FMIndex(text, 4)
    for size in (1, 2, 5):
        phrases = rng.integers(1, 5, (50, size))
        got = {i: set() for i in range(50)}
        for i, low, high in zip(*index.search(phrases), strict=True):
            got[i] = set(index.locate(np.arange(low, high)).tolist())
        for i, phrase in enumerate(phrases):
            assert got[i] == {p for p in range(len(text) - size) if (text[p : p + size] == phrase).all()}


def test_query(spark, tables):
    import duckdb

    docs = duckdb.sql(f"select doc_id, text from '{tables['documents']}'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{tables['benchmark']}'").fetchall()
    want = {row[0]: (row[1], row[2], len(row[4]), row[2] > 0) for row in brute_force(docs, items)}
    rows = QUERIES["op2_decontaminate"](spark, f"{TESTDATA}/sf0.01").collect()
    assert {row.doc_id: (row.n_words, row.n_hit, row.n_items, row.contaminated) for row in rows} == want
    assert any(row.contaminated for row in rows)
