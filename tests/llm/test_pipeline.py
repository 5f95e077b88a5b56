"""The pipeline, stage by stage, against brute-force versions of its operators."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
import test_decontaminate as phrases
import test_jaccard as pairs_of_sets
import test_line_dedup as lines
from couriermart.llm.mixing import word_count
from llm_checks import TESTDATA

SF = f"{TESTDATA}/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def kept(spark):
    """What goes into each stage, and what comes out at the end."""
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        found[name] = docs.cache()
        docs = stage(spark, docs, SF).cache()
    return found | {"end": docs}


def pairs(frame):
    return [(row.doc_id, row.text) for row in frame.select("doc_id", "text").collect()]


def test_stages_return_documents(kept):
    for name, _ in corpus_pipeline.STAGES:
        assert kept[name].columns == list(corpus_pipeline.DOCUMENT)
    assert contract.queries()["pipeline"] is corpus_pipeline.run


def test_toxic_documents_go(spark, kept):
    before, after = dict(pairs(kept["toxicity"])), dict(pairs(kept["line_dedup"]))
    assert after.items() <= before.items()
    toxic = dict(duckdb.sql(f"select doc_id, toxic from '{SF}/labels.parquet'").fetchall())
    gone = set(before) - set(after)
    assert sum(toxic.get(i, 0) == 0 for i in gone if i in toxic) <= 0.03 * len(toxic)


def test_line_dedup(spark, kept):
    want = lines.brute_force(spark, pairs(kept["line_dedup"]))
    left = {i: text for i, text, _, removed in want if not removed or (text or "").split()}
    assert dict(pairs(kept["near_duplicates"])) == left
    for row in kept["near_duplicates"].collect():
        assert row.n_chars == len(row.text)


def test_near_duplicates(kept):
    before = pairs(kept["near_duplicates"])
    want = {i for i, _, component in pairs_of_sets.brute_force(before) if i == component}
    assert dict(pairs(kept["decontamination"])) == {i: text for i, text in before if i in want}


def test_decontamination(kept):
    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    before = pairs(kept["decontamination"])
    want = {}
    for doc_id, words, hit, spans, _ in phrases.brute_force(before, items):
        raw, at, left = (dict(before)[doc_id] or "").encode(), 0, b""
        for start, end in spans:
            left, at = left + raw[at:start], end
        if not hit or hit < words:
            want[doc_id] = (left + raw[at:]).decode()
    assert dict(pairs(kept["mix"])) == want


def test_mix(kept):
    docs = {row.doc_id: row for row in kept["mix"].withColumn("words", word_count(F.col("text"))).collect()}
    rows = kept["end"].collect()
    taken = {}
    for row in rows:
        assert row.text == docs[row.doc_id].text and row.size == docs[row.doc_id].words
        taken.setdefault(row.source, 0)
        taken[row.source] += row.size
    assert len({(row.doc_id, row.copy) for row in rows}) == len(rows) and {row.copy for row in rows} <= {1, 2}
    largest = {s: max(d.words for d in docs.values() if d.source == s) for s in taken}
    for row in rows:
        assert abs(taken[row.source] - row.target) <= largest[row.source]


def test_edge_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "one line of words here", None, None, 22),
            (2, "one line of words here", None, None, 22), (3, "x " * 50_000, "en", "s", 100_000)]
    docs = spark.createDataFrame(rows, DOCS)
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, SF).cache()
        assert {row.doc_id for row in docs.collect()} <= {None, 1, 2, 3}
    assert [row.doc_id for row in docs.where("doc_id = 2").select("doc_id").distinct().collect()] in ([], [2])
    empty = spark.createDataFrame([], DOCS)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.collect() == []
