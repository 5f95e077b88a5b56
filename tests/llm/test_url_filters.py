from datetime import datetime

from couriermart.llm.url_filters import filter_urls

CAPTURES = "page_id long, url string, fetched_at timestamp_ntz, host string, list string, month int"
ENTRIES = "list string, kind string, key string, at timestamp_ntz, active boolean, month int"


def day(n, month=1, year=2024):
    return datetime(year, month, n)


def test_as_of(spark):
    entries = spark.createDataFrame([
        ("adult", "domain", "bad.org", day(10), True, 0), ("adult", "domain", "bad.org", day(20), False, 0),
        ("adult", "domain", "bad.org", day(1, 3), True, 0), ("adult", "domain", "bad.org", day(1, 3), False, 0),
        ("spam", "host", "www.bad.org", day(15), True, 0), ("spam", "host", "www.bad.org", day(15), True, 0),
        ("gone", "url", "http://www.bad.org/x", day(1, year=2020), True, 0),
        ("adult", "domain", None, day(1), True, 0), ("adult", "host", "nodate.org", None, True, 0),
    ], ENTRIES)
    captures = spark.createDataFrame([
        (1, "http://www.BAD.org/y", day(9), "clash", "clash", 1), (2, "http://www.bad.org/y", day(10), None, None, None),
        (3, "http://www.bad.org/y", day(16), None, None, None), (4, "http://www.bad.org:80/y", day(20), None, None, None),
        (5, "http://u@bad.org", day(5, 7, 2031), None, None, None), (6, "http://notbad.org/", day(16), None, None, None),
        (7, "http://www.bad.org/x#top", day(9), None, None, None), (8, None, day(16), None, None, None),
        (9, "http://bad.org", None, None, None, None), (10, "no url", day(16), None, None, None), (11, "", day(16), None, None, None),
        (3, "http://www.bad.org/y", day(16), None, None, None), (12, "http://" + "a." * 5000 + "bad.org/", day(16), None, None, None),
    ], CAPTURES)
    got = filter_urls(captures, entries)
    found = sorted((row.page_id, row.n_entries, row.lists, row.blocked) for row in got.collect())
    assert found == sorted([
        (1, 0, "", False), (2, 1, "adult", True), (3, 2, "adult,spam", True), (3, 2, "adult,spam", True),
        (4, 1, "spam", True), (5, 1, "adult", True), (6, 0, "", False), (7, 1, "gone", True), (8, 0, "", False),
        (9, 0, "", False), (10, 0, "", False), (11, 0, "", False), (12, 1, "adult", True),
    ])
    assert {row.page_id: row.host for row in got.collect()}[4] == "www.bad.org"
    assert filter_urls(captures.where("page_id > 99"), entries).collect() == []
    assert filter_urls(captures, entries.where("list = 'none'")).where("blocked").collect() == []


def test_long_hosts(spark):
    deep = "x." * 300 + "deep.org"
    entries = spark.createDataFrame([
        ("adult", "domain", "bad.org", day(1), True, 0), ("adult", "domain", deep, day(1), True, 0), ("spam", "domain", "org", day(1), True, 0),
    ], ENTRIES)
    hosts = ["a." * 5000 + "bad.org", "a." * 124 + "bad.org", "y." + deep, deep, "y." + deep[2:], "a." * 5000 + "notbad.com", "bad.org.com"]
    captures = spark.createDataFrame([(i, f"http://{host}/", day(16), None, None, None) for i, host in enumerate(hosts)], CAPTURES)
    found = {row.page_id: (row.n_entries, row.lists) for row in filter_urls(captures, entries).collect()}
    assert found == {0: (2, "adult,spam"), 1: (2, "adult,spam"), 2: (2, "adult,spam"), 3: (2, "adult,spam"), 4: (1, "spam"), 5: (0, ""), 6: (0, "")}
