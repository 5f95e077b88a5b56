"""The audit of filter orders against a walk of every order over every row."""

import re
from itertools import permutations

from couriermart.llm.filter_audit import audit_filters, audit_orders, walk_orders

DOCS = "doc_id long, text string, lang string, part string, mask int, n string"
LABELS = "doc_id long, quality int, toxic int, prefix string"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")

LONG = " ".join(f"w{i}" for i in range(250))
ROWS = [
    (1, LONG, "en"), (2, LONG, "en"), (2, LONG, "en"), (3, LONG, "de"), (4, LONG + " $", "en"), (5, "same " * 300, "en"),
    (6, "LOUD " * 300, "de"), (7, None, "en"), (8, "", None), (9, " \t\n", "en"), (10, "few words", None), (None, LONG, "en"),
    (None, None, "en"), (11, "few words", "fr"), (12, LONG.replace(" ", "\x0b") + " Ä", "de"), (13, "x" * 200_000, "fr"),
    (1, "few words", "fr"), (14, LONG.upper(), "de"), (0, "few words", "de"), (14, None, "en"), (15, "a|b " * 400, "en"),
]
KNOWN = [(1, 1, 0), (2, 0, 1), (2, 1, None), (4, 1, 1), (6, None, 1), (7, 1, 0), (99, 1, 1), (None, 1, 1), (15, 1, 0)]


def failures(rows):
    first = {}
    for id_, text, _ in rows:
        if id_ is not None:
            first[text or ""] = min(id_, first.get(text or "", id_))
    for id_, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        yield "".join(
            letter
            for letter, failed in zip(
                "ABCDE",
                (
                    len(words) < 200,
                    100 * len(set(words)) < 50 * len(words),
                    100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                    re.search(r"[#$%&*|]", text) is not None,
                    id_ is not None and id_ > first[text],
                ),
                strict=True,
            )
            if failed
        )


def brute(rows, known):
    good = {id_ for id_, quality, _ in known if quality == 1 and id_ is not None}
    toxic = {id_ for id_, _, mark in known if mark == 1 and id_ is not None}
    marked = [(lang or "", id_, fails) for (id_, _, lang), fails in zip(rows, failures(rows), strict=True)]
    expected, shapley = {}, {}
    for part in {part for part, _, _ in marked}:
        for order in map("".join, permutations("ABCDE")):
            left = [(id_, fails) for p, id_, fails in marked if p == part]
            gone = []
            for step, letter in enumerate(order, 1):
                out = [row for row in left if letter in row[1]]
                redundant = sum(letter in fails for _, fails in gone)
                unique = sum(fails == letter for _, fails in left + gone)
                left = [row for row in left if letter not in row[1]]
                gone += out
                lost = [sum(id_ in marks for id_, _ in out) for marks in (good, toxic)]
                expected[part, order, step] = (len(left), len(out), redundant, unique, *lost)
                shapley[part, letter] = shapley.get((part, letter), 0) + len(out)
    return {key: (*counts, shapley[key[0], key[1][key[2] - 1]]) for key, counts in expected.items()}


def found(df):
    return {(r.part, r.filter_order, r.step): tuple(r[name] for name in (*COUNTS, "shapley")) for r in df.collect()}


def frames(spark, rows, known):
    docs = spark.createDataFrame([(*row, "clash", 3, "n") for row in rows], DOCS)
    return docs.repartition(3), spark.createDataFrame([(*row, "clash") for row in known], LABELS)


def test_every_order(spark):
    docs, labels = frames(spark, ROWS, KNOWN)
    got = audit_filters(docs, labels)
    expected = brute(ROWS, KNOWN)
    assert len(expected) == 4 * 120 * 5 and found(got) == expected
    assert got.count() == len(expected)
    assert all(r.letter == r.filter_order[r.step - 1] for r in got.collect())


def test_without_labels(spark):
    docs, labels = frames(spark, ROWS[:6], [])
    assert found(audit_filters(docs, labels)) == brute(ROWS[:6], [])


def test_no_documents(spark):
    assert audit_filters(*frames(spark, [], KNOWN)).isEmpty()


def test_one_text_is_most_rows(spark):
    rows = [(i, LONG if i % 3 else "few words", "en" if i % 2 else None) for i in range(900)]
    assert found(audit_filters(*frames(spark, rows, KNOWN))) == brute(rows, KNOWN)


def test_any_number_of_filters(spark):
    cells = spark.createDataFrame([("p", 0, 4, 1, 0), ("p", 3, 2, 2, 1), ("p", 1, 1, 0, 0), ("q", 2, 5, 0, 5), ("q", 2, 1, 0, 0)],
                                  "part string, mask int, n long, good long, toxic long")
    got = found(audit_orders(cells, "xy"))
    assert got == {
        ("p", "xy", 1): (4, 3, 0, 1, 2, 1, 4), ("p", "xy", 2): (4, 0, 2, 0, 0, 0, 2),
        ("p", "yx", 1): (5, 2, 0, 0, 2, 1, 2), ("p", "yx", 2): (4, 1, 2, 1, 0, 0, 4),
        ("q", "xy", 1): (6, 0, 0, 0, 0, 0, 0), ("q", "xy", 2): (0, 6, 0, 6, 0, 5, 12),
        ("q", "yx", 1): (0, 6, 0, 6, 0, 5, 12), ("q", "yx", 2): (0, 0, 0, 0, 0, 0, 0),
    }


def test_a_prefix_comes_once(spark):
    walked = walk_orders(spark, spark.range(2).selectExpr("cast(id as int) as mask"), "ABCDE")
    assert walked.count() == 2 * (5 + 20 + 60 + 120 + 120)
    assert walked.select("prefix", "mask").distinct().count() == walked.count()
