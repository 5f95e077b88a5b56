import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from couriermart.llm import line_dedup
from couriermart.llm.line_dedup import dedup_lines
from couriermart.llm.queries import QUERIES
from llm_checks import TESTDATA

DOCS = "doc_id long, text string, line string, key string"
UPPER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words(line):
    return frozenset(re.findall(rb"[^\x20\x09-\x0D]+", line.translate(UPPER)))


def brute_force(spark, docs):
    keys = dict(enumerate(
        row.k for row in spark.createDataFrame([(i, text) for i, (_, text) in enumerate(docs)], "i long, text string")
        .select("i", F.xxhash64("text").alias("k")).orderBy("i").collect()
    ))
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0, keys[i]))
    by_word, sets, result, done = {}, [], [], {}
    for i in order:
        doc_id, text = docs[i]
        if (doc_id, text) in done:
            result.append(done[doc_id, text])
            continue
        kept, removed = [], 0
        lines = re.findall(rb"[^\n]*\n|[^\n]+", (text or "").encode())
        for line in lines:
            own = words(line)
            near = set().union(*[by_word.get(w, set()) for w in own]) if own else set()
            if any(5 * len(own & sets[j]) >= 4 * len(own | sets[j]) for j in near):
                removed += 1
            else:
                kept.append(line)
            if own:
                for w in own:
                    by_word.setdefault(w, set()).add(len(sets))
                sets.append(own)
        done[doc_id, text] = (doc_id, None if text is None else b"".join(kept).decode(), len(lines), removed)
        result.append(done[doc_id, text])
    return sorted(result, key=str)


def found(spark, docs):
    frame = spark.createDataFrame([(*doc, "clash", "clash") for doc in docs], DOCS).repartition(4)
    return sorted((tuple(row) for row in dedup_lines(frame).collect()), key=str)


@pytest.fixture(scope="module")
def made():
    rng = random.Random(2)
    word = lambda: rng.choice(["the", "of", "and", "to", *[f"w{rng.randrange(400)}"] * 4])
    pool = [[word() for _ in range(rng.choice([1, 2, 3, 4, 5, 8, 10, 20, 40]))] for _ in range(60)]
    docs = []
    for i in range(120):
        lines = []
        for _ in range(rng.randrange(8)):
            line = list(rng.choice(pool)) if rng.random() < 0.7 else [word() for _ in range(rng.randrange(1, 25))]
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                line[rng.randrange(len(line))] = word()
            lines.append(rng.choice([" ", "  ", "\t"]).join(line))
        docs.append((i * 37 % 121, "\n".join(lines) + rng.choice(["", "\n", "\n\n"])))
    crowd = [f"c{i}" for i in range(30)]
    for i in range(100):
        copy = list(crowd)
        copy[rng.randrange(30)] = f"edit{i}"
        docs.append((1000 + i, "Head " + " ".join(copy) + "\nunique%d line%d here%d now%d" % (i, i, i, i)))
    docs += [(500, None), (501, ""), (502, "\n"), (503, "\n\n --- \n"), (504, " --- "), (None, docs[4][1]), (None, "z y x w\nZ Y x w"), docs[5], docs[5]]
    return [*docs, (505, "long " * 20_000 + "\n" + "x\n" * 5_000)]


def test_matches_brute_force(spark, made):
    want = brute_force(spark, made)
    assert sum(row[3] for row in want) > 100
    assert found(spark, made) == want


def test_order_of_words_only_saves_work(spark, made, monkeypatch):
    monkeypatch.setattr(line_dedup, "RANKED", 8)
    assert found(spark, made) == brute_force(spark, made)


def test_long_lists_meet_in_blocks(spark, made, monkeypatch):
    monkeypatch.setattr(line_dedup, "LIST_BLOCK", 7)
    monkeypatch.setattr(line_dedup, "GROUP_POSTINGS", 100)
    assert found(spark, made) == brute_force(spark, made)


def test_nothing_to_do(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, "only one\nother text"), (2, None)]) == [(1, "only one\nother text", 2, 0), (2, None, 0, 0)]


def test_plausible_keeps_every_similar_pair():
    rng = np.random.default_rng(4)
    ranks = line_dedup.Ranks(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 12, rng.integers(4, 12))) for _ in range(300)]
    raw = np.frombuffer("\n".join(texts).encode(), np.uint8)
    lines = line_dedup.find_lines(raw, np.array([0, len(raw)]), ranks)
    rows = []
    for i in range(len(texts)):
        own = lines.token[lines.first[i] : lines.first[i + 1]]
        for place in range(line_dedup.prefix_length(len(own))):
            rows.append((int(own[place] & np.uint64(0xFFFFFFFF)), lines.id[i], lines.parity[i], len(own), place))
    token, line, parity, size, place = (np.array(x) for x in zip(*rows, strict=True))
    got = set(line_dedup.plausible(token.astype(np.uint32), line, parity.astype(np.uint64), size, place).tolist())
    sets = {int(lines.id[i]): frozenset(t.split()) for i, t in enumerate(texts)}
    for a, x in sets.items():
        if any(a != b and 5 * len(x & y) >= 4 * len(x | y) for b, y in sets.items()):
            assert a in got


def test_query(spark, tables):
    docs = duckdb.sql(f"select doc_id, text from '{tables['documents']}'").fetchall()
    want = sorted(((i, n, gone, hashlib.sha256(text.encode()).hexdigest()) for i, text, n, gone in brute_force(spark, docs)), key=str)
    assert sorted((tuple(row) for row in QUERIES["op7_line_dedup"](spark, f"{TESTDATA}/sf0.01").collect()), key=str) == want


def test_long_lines_of_other_words_are_no_candidates(spark):
    rng = random.Random(5)
    texts = [" ".join(["shared", *(f"w{rng.randrange(3000)}" for _ in range(120))]) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate([*texts, texts[0] + " more"])), "doc_id long, text string")
    found = line_dedup._candidates(docs, line_dedup.Ranks(np.zeros(0, np.uint64), np.zeros(0, np.int32)), 2)
    assert found.count() == 2


def test_records_hold_frequent_words_by_number(spark):
    docs = spark.createDataFrame([(1, "a a b b c c d e\na b c d e f"), (2, "A b c d f")], "doc_id long, text string").coalesce(1)
    ranks = line_dedup.frequent_words(docs)
    classes = line_dedup._classes(line_dedup._occurrences(docs.withColumn("key", F.xxhash64("text"))))
    rows = line_dedup._records(docs, ranks, classes.select("line"), classes).collect()
    assert sorted(len(row.rare) + len(row.tokens) for row in rows) == [5, 5, 6]
    assert all(row.tokens == sorted(row.tokens) and set(row.tokens) <= set(ranks.number.tolist()) for row in rows)
    assert sum(len(row.tokens) for row in rows) >= 9
    assert not {h for row in rows for h in row.rare} & set(ranks.hash.view(np.int64).tolist())


def test_lines_that_share_many_words_are_offered_in_few_groups(spark, monkeypatch):
    made, search = [], line_dedup._offers
    rng = random.Random(8)
    shared = [[f"s{i}x{j}" for j in range(60)] for i in range(12)]
    docs = [(i, " ".join([*shared[i % 12][:56], *(f"e{rng.randrange(10**6)}" for _ in range(4))])) for i in range(120)]
    want = brute_force(spark, docs)

    def counted(postings, lists, asks, every):
        made.append(postings.where(asks).join(lists, "token", "left_semi").count())
        return search(postings, lists, asks, every)

    monkeypatch.setattr(line_dedup, "_offers", counted)
    assert found(spark, docs) == want and sum(row[3] for row in want) == 108
    # The first question is asked once by each line; the next ones by the twelve that have no earlier line.
    assert made[0] <= 120 and made[1] <= 12 * 13


def test_a_second_set_of_parities_sees_what_the_first_misses():
    rng = np.random.default_rng(6)
    texts = [" ".join([f"s{i}" for i in range(16)] + [f"e{n}" for n in rng.integers(0, 10**9, 2)]) for _ in range(400)]
    raw = np.frombuffer("\n".join(texts).encode(), np.uint8)
    lines = line_dedup.find_lines(raw, np.array([0, len(raw)]), line_dedup.Ranks(np.zeros(0, np.uint64), np.zeros(0, np.int32)))
    a, b = np.triu_indices(400, 1)
    pairs = [[lines.parities[x, i] for i in range(len(line_dedup.PARITY))] for x in (a, b)]
    apart = line_dedup.differences(*pairs, lambda x, y: np.bitwise_count(x ^ y).astype(np.int64))
    # Every two differ in four words, two more than similar lines may.
    assert len(apart) == 2 and all((x <= 4).all() for x in apart)
    assert all((x <= 2).sum() > 1000 for x in apart) and (np.maximum(*apart) <= 2).sum() < 200


def test_numbers_of_words_whose_slots_meet():
    random = np.random.default_rng(3)
    near = np.uint64(5 << 60) + np.arange(40, dtype=np.uint64)  # one slot for all
    hashes = np.unique(np.concatenate([near, random.integers(0, 1 << 63, 500, dtype=np.uint64), np.array([0, (1 << 64) - 1], np.uint64)]))
    number = random.permutation(len(hashes)).astype(np.int32) + 1
    ranks = line_dedup.Ranks(hashes, number)
    assert ranks.of(hashes).tolist() == number.tolist()
    others = np.setdiff1d(np.concatenate([hashes + np.uint64(1), random.integers(0, 1 << 63, 500, dtype=np.uint64)]), hashes)
    assert not ranks.of(others).any()


def test_order_of_words_whose_hashes_begin_alike():
    hashes = np.array([7, 3, 7, 3, 1 << 63, 7, 2], np.uint64)
    line = np.array([0, 0, 0, 0, 1, 1, 1])
    order = line_dedup.line_order(line, hashes, 2)
    assert hashes[order].tolist() == [3, 3, 7, 7, 2, 7, 1 << 63] and line[order].tolist() == [0] * 4 + [1] * 3


def test_common_words_are_counted_once(spark):
    columns = ", ".join(f"{name} long" for name in line_dedup.PARITY)
    records = spark.createDataFrame([], f"line long, at long, {columns}, rare array<long>, tokens array<int>")
    plan = line_dedup._similar(spark.createDataFrame([], "later long, earlier long"), records)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_intersect(") <= 2
