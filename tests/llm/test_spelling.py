"""Spelling variants against a search by wildcards, and the trees against all distances."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq

from couriermart.llm import spelling
from couriermart.llm.queries import op13_spelling
from couriermart.llm.spelling import by_length, group_variants, grow, letter_counts, near_words, plan_groups
from llm_checks import TESTDATA

DOCS = "doc_id long, text string, word string, n long, form string"


def vocabulary_of(rows):
    counts = Counter()
    for doc_id, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= 7 and n >= 2}


def near_of(words):
    """Words that share a pattern with one letter open, or of which one has the other among those with a letter left out."""
    patterns, near = defaultdict(list), defaultdict(set)
    for word in words:
        for i in range(len(word)):
            patterns[word[:i], word[i + 1 :]].append(word)
            shorter = word[:i] + word[i + 1 :]
            if shorter in words:
                near[word].add(shorter)
                near[shorter].add(word)
    for alike in patterns.values():
        for word in alike:
            near[word].update(other for other in alike if other != word)
    return near


def brute(rows):
    counts = vocabulary_of(rows)
    near = near_of(counts)
    forms = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda other: (-counts[other], other), default=None)
        if best and counts[best] >= 10 * n:
            forms[word] = best
    expected = set()
    for word, n in counts.items():
        root = word
        while root in forms:
            root = forms[root]
        expected.add((word, forms.get(word), root, n, len(near[word]), counts[forms[word]] if word in forms else None))
    return expected


def check(got, rows):
    found = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == brute(rows)
    return found


def frame(spark, rows):
    return spark.createDataFrame([(*row, "clash", 1, "clash") for row in rows], DOCS).repartition(3)


def test_whole_table(spark):
    table = pq.read_table(f"{TESTDATA}/sf0.01/documents.parquet", columns=["doc_id", "text"])
    found = check(op13_spelling(spark, f"{TESTDATA}/sf0.01"), list(zip(*table.to_pydict().values(), strict=True)))
    assert sum(row[1] is not None for row in found) > 100


def test_chains_ties_and_letters(spark):
    text = {
        "separate": 400, "seperate": 40, "seperat": 4, "sepperate": 3, "separäte": 2, "sepärate": 2, "separatè": 3,
        "Àlphabet": 30, "Èlphabet": 3, "ælphabet": 3, "alphabets": 30, "betalpha": 2, "aaaaaaaa": 20, "aaaaaaab": 2, "aaaaaaa": 2,
        "short": 50, "sixsix": 9, "multi×ply": 2, "multiply": 20, "zzzzzzzz": 20, "zzzzzzzx": 20, "zzzzzzzy": 2, "UPPERCASE": 20, "uppercasE": 2,
    }
    rows = [(10_000 + i, " ".join([word] * n)) for i, (word, n) in enumerate(text.items())]
    rows += [(None, "separate, nothing"), (None, None), (None, "nothing"), (5, ""), (6, None), (7, "separate " * 50), (7, "separate " * 50)]
    rows += [(20, "w" * 3000 + " " + "w" * 3000), (21, "w" * 2999 + "ÿ"), (22, "w" * 2999 + "ÿ"), (23, ("lengthy" + "y" * 40 + "-") * 30_000)]
    rows += [(24, "Łódźłłł Straße-straße Ĥstrasse" * 2), (25, "\U0001f600separate\U0001f600seperate" * 2)]
    found = {row[0]: row for row in check(group_variants(frame(spark, rows)), rows)}
    assert found["seperat"][2] == "separate" and found["seperat"][1] == "seperate"


def test_nothing(spark):
    for rows in ([], [(1, None)], [(1, "no word is long")], [(1, "onceonly here")]):
        assert group_variants(frame(spark, rows)).isEmpty()


def test_words_with_equal_letters_have_several_groups(spark, monkeypatch):
    """Many words of few letters: the trees cannot cut them, and groups and blocks are small."""
    draw = random.Random(3)
    words = {"".join(draw.choices("acgt", k=9)) for _ in range(3000)} | {"".join(draw.sample("abcdefgh", 8)) for _ in range(3000)}
    words |= {"".join(draw.choices("aàáâæèéü", k=7)) for _ in range(1000)}
    monkeypatch.setattr(spelling, "GROUP_WORDS", (16, 16))
    monkeypatch.setattr(spelling, "GROUPS", 1000)
    monkeypatch.setattr(spelling, "LEAF_POINTS", 8)
    monkeypatch.setattr(spelling, "QUERIES_AT_ONCE", 64)
    counts = {word: draw.choice([2, 2, 3, 30, 400]) for word in words}
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    plan = plan_groups(vocabulary)
    assert max(int(groups.max()) for groups in plan.groups.values()) > 1
    near = near_of(counts)
    got = {r.word: (r.n, r.n_near, r.best_n, r.best) for r in near_words(vocabulary).collect()}
    for word, n in counts.items():
        best = min(near[word], key=lambda other: (-counts[other], other), default=None)
        assert got.pop(word) == (n, len(near[word]), counts.get(best), best)
    assert not got


def test_a_sample_plans_for_all(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SAMPLE_WORDS", 300)
    monkeypatch.setattr(spelling, "GROUP_WORDS", (100, 100))
    table = pq.read_table(f"{TESTDATA}/sf0.001/documents.parquet", columns=["doc_id", "text"])
    rows = list(zip(*table.to_pydict().values(), strict=True))
    check(group_variants(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_reach_loses_no_leaf():
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdeèé", k=8)) for _ in range(2000)]
    ((_, _, letters),) = by_length(words)
    counts = letter_counts(letters)
    for tight in (False, True):
        tree = grow(counts[:1500], 20, tight)
        home = tree.home(counts[:1500])
        reached = {(leaf, int(row)) for leaf, rows in tree.reach(counts, 1) for row in rows}
        steps = counts[:1500][None].astype(int) - counts[:, None]
        for query, point in np.argwhere((np.maximum(steps, 0).sum(2) <= 1) & (np.maximum(-steps, 0).sum(2) <= 1)):
            assert (int(home[point]), int(query)) in reached
        assert len(reached) < 2000 * len(tree.points) / 2


def test_pieces_end_between_runs(monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 10)
    for text in ("", "a" * 50, "ab cdef " * 20, "abcdefghi " * 3 + "x" * 30):
        pieces = list(spelling._pieces(text))
        assert "".join(pieces) == text
        assert [run for piece in pieces for run in spelling.RUN.findall(piece)] == spelling.RUN.findall(text)
