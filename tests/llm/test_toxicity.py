import math
import random
import re

import duckdb
import numpy as np
from pyspark.sql import functions as F

from couriermart.llm import toxicity
from couriermart.llm.queries import QUERIES
from couriermart.llm.toxicity import Model, fit, score_texts
from llm_checks import TESTDATA

DOCS = "doc_id long, text string, __score double, toxic string"
BAD = ["scoundrel", "nitwit", "blockheads", "blockheaded", "wretch", "buffoon"]


def made(n, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "and", *[f"w{rng.randrange(900)}x"] * 4])
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(20, 200))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randrange(3, 8)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((seed * 100_000 + i, " ".join(words), int(toxic)))
    return rows


def test_learns_and_tells_apart(spark):
    train, other = made(1500, 1), made(600, 2)
    frame = spark.createDataFrame([(i, text, 0.5, "clash") for i, text, _ in train], DOCS)
    labels = spark.createDataFrame([(i, t) for i, _, t in train] + [(None, 1), (7, None), (8, 3)], "doc_id long, toxic int")
    model = fit(frame, labels)
    rows = [*other, (90, None, 0), (91, "", 0), (92, "?!\n", 0), (None, other[1][1], 0), (93, "fine words " * 30_000, 0), other[0]]
    docs = spark.createDataFrame([(i, text, 0.5, "clash") for i, text, _ in rows], DOCS)
    scores = score_texts(docs, model, keep=("doc_id", "toxic")).collect()
    assert len(scores) == len(rows) and all(0 <= row.score <= 1 for row in scores)
    by_id = {row.doc_id: row.score for row in scores}
    truth = {i: t for i, _, t in other}
    caught = np.mean([by_id[i] >= 0.7 for i, t in truth.items() if t])
    wrong = np.mean([by_id[i] >= 0.7 for i, t in truth.items() if not t])
    assert caught > 0.9 and wrong < 0.02
    assert by_id[90] == by_id[91] == by_id[92] == min(by_id.values())
    assert by_id[None] == by_id[other[1][0]]
    again = fit(frame.repartition(5), labels)
    assert again == model


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "some text", 0.1, None)], DOCS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert fit(docs, none) is None
    assert [row.score for row in score_texts(docs, None).collect()] == [0.0]
    assert score_texts(docs.where("doc_id > 1"), None).collect() == []


def test_score_rises_with_excess():
    scores = Model(b"", b"", 4, 6.0, 2.0).score(np.array([0, 1, 5, 6, 7, 100]))
    assert (np.diff(scores) > 0).all() and scores[2] < toxicity.TOXIC_SCORE <= scores[3]


def test_query_on_held_out_rows(spark, tables):
    path = f"{TESTDATA}/sf0.1"
    found = QUERIES["op3_toxicity"](spark, path)
    labels = spark.read.parquet(f"{path}/labels.parquet")
    held = found.join(labels, "doc_id").where("held_out").groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()
    rates = {row.toxic: row.p for row in held}
    assert rates[1] > 0.85 and rates[0] < 0.03
    assert found.count() == spark.read.parquet(f"{path}/documents.parquet").count()


def test_many_toxic_words(spark):
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}vile{i}" for i in range(1500)]
    contexts = spark.createDataFrame([(w, 40, 0) for w in words] + [("ordinary", 10, 60_000)], "word string, toxic long, ordinary long")
    assert sorted(toxicity._toxic_words(contexts, 1.0)) == sorted(words)


def test_weaker_test_if_no_word_passes(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST_SEEN", 10**6)
    train, other = made(900, 1), made(300, 2)
    frame = spark.createDataFrame([(i, text, 0.5, "") for i, text, _ in train + other], DOCS)
    model = fit(frame, spark.createDataFrame([(i, t) for i, _, t in train], "doc_id long, toxic int"))
    scores = {row.doc_id: row.score for row in score_texts(frame, model).collect()}
    assert np.mean([scores[i] >= 0.7 for i, _, t in other if t]) > 0.8
    assert np.mean([scores[i] >= 0.7 for i, _, t in other if not t]) < 0.1


def test_every_word_of_a_large_dictionary_saves():
    named = lambda i, end: f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}{end}"
    words = [named(i, "vile") for i in range(1500)]
    texts = [" ".join([word, *(named(7 * i + n, "mild") for n in range(7))]) for i, word in enumerate(words)]
    model = toxicity.dictionaries(words, ["the", "of"])
    saved = toxicity.excesses(toxicity.pa.array(texts), *toxicity._compressors(model), (2,))
    assert (saved > 0).mean() > 0.99


def spread(value):
    """64-bit mixing, on Python's own integers."""
    factor, top = 0xD6E8FEB86659FD93, (1 << 64) - 1
    value = (value ^ value >> 32) * factor & top
    value = (value ^ value >> 29) * factor & top
    return value ^ value >> 32


def plain_code(word):
    raw, base = word.encode(), 0x9E3779B97F4A7C15
    stem = int.from_bytes(raw[:4].ljust(4, b"\0"), "big")
    whole = sum((byte + 1) * pow(base, i, 1 << 64) for i, byte in enumerate(raw)) % (1 << 64)
    return b"".join(spread(value).to_bytes(8, "little")[:7] for value in (stem, whole))


def plain_score(text, model, toxic, ordinary):
    """One text, word by word and window by window."""
    lowered = re.sub("[A-Z]", lambda found: found[0].lower(), text or "")
    words = re.findall(toxicity.WORD, lowered)
    excess = 0
    for begin in range(0, len(words), toxicity.WINDOW):
        window = b"".join(plain_code(word) for word in words[begin : begin + toxicity.WINDOW])
        excess += max(0, len(ordinary.compress(window)) - len(toxic.compress(window)) - model.noise)
    odds = math.exp(model.slope * (math.log1p(excess) - math.log1p(model.threshold - 0.5))) * toxicity.TOXIC_SCORE / (1 - toxicity.TOXIC_SCORE)
    return odds / (1 + odds)


def test_query_equals_a_plain_scorer(spark, tables):
    path = f"{TESTDATA}/sf0.01"
    documents, labels = (spark.read.parquet(f"{path}/{name}.parquet") for name in ("documents", "labels"))
    model = fit(documents, labels.where(~toxicity.is_held_out(F.col("doc_id"))))
    against = toxicity._compressors(model)
    texts = dict(duckdb.sql(f"select doc_id, text from '{tables['documents']}'").fetchall())
    found = {row.doc_id: row for row in QUERIES["op3_toxicity"](spark, path).collect()}
    assert set(found) == set(texts) and any(row.predicted for row in found.values())
    for doc_id, text in texts.items():
        assert math.isclose(found[doc_id].score, plain_score(text, model, *against), rel_tol=1e-9)
        assert found[doc_id].predicted == int(found[doc_id].score >= toxicity.TOXIC_SCORE)


def test_odd_texts_equal_a_plain_scorer(spark):
    train = made(900, 1)
    frame = spark.createDataFrame([(i, text, 0.5, "") for i, text, _ in train], DOCS)
    model = fit(frame, spark.createDataFrame([(i, t) for i, _, t in train], "doc_id long, toxic int"))
    odd = [None, "", "?!", "NITWIT " * 9, "Ünwörter Blockheads, \u00c0\u0100 wretch42", "scoundrel\x00nitwit_buffoon" * 50, "a b c " * 40_000]
    scores = score_texts(spark.createDataFrame([(i, t, 0.5, "") for i, t in enumerate(odd)], DOCS), model).collect()
    against = toxicity._compressors(model)
    for row in scores:
        assert math.isclose(row.score, plain_score(odd[row.doc_id], model, *against), rel_tol=1e-9)
