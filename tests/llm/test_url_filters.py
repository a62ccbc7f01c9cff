from datetime import date

import pytest
from pyspark.sql import functions as F

from areaday.llm import url_filters as uf


def brute(captures, entries):
    strict = {"clear": 1, "allow": 2, "block": 3}
    listed = {}
    for key, action, day in entries:
        if key is not None and action in strict and day is not None:
            days = listed.setdefault(key.lower(), {})
            days[day] = max(days.get(day, "clear"), action, key=strict.get)
    out = []
    for url, day in captures:
        host = None
        if url and "://" in url:
            host = url.lower().split("://", 1)[1].split("/")[0].split("?")[0].split("#")[0].split("@")[-1].split(":")[0].rstrip(".") or None
        verdict = ("pass", None, None)
        labels = host.split(".") if host else []
        for i in range(len(labels)):
            days = {d: a for d, a in listed.get(".".join(labels[i:]), {}).items() if day and d <= day}
            if days and days[max(days)] != "clear":
                verdict = (days[max(days)], ".".join(labels[i:]), max(days))
                break
        out.append((url, host, *verdict))
    return sorted(out, key=repr)


D = [date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 29), date(2024, 7, 1), date(2025, 3, 1)]
ENTRIES = [
    ("example.com", "block", D[0]), ("blog.example.com", "allow", D[1]), ("blog.example.com", "clear", D[3]),
    ("Example.COM", "clear", D[3]), ("org", "block", D[2]), ("good.org", "allow", D[2]), ("good.org", "block", D[2]),
    (None, "block", D[0]), ("x.org", None, D[0]), ("x.org", "odd", D[0]), ("x.org", "allow", None), ("1.2.3.4", "block", D[0]),
]
URLS = [
    "http://example.com/a", "https://BLOG.example.com:80/?q#f", "http://u:p@a.blog.example.com", "http://good.org./x", "ftp://x.org",
    "http://1.2.3.4/", "no url", "", None, "http:///path", "http://example.com.evil.net/", "http://com",
]


@pytest.fixture
def tables(spark):
    def make(captures, entries):
        return (
            spark.createDataFrame(captures, "url string, fetched date"),
            spark.createDataFrame(entries, "key string, action string, day date"),
        )

    return make


def test_every_capture_by_the_list_of_its_day(tables, rows):
    captures = [(url, day) for url in URLS for day in [date(2023, 1, 1), *D, None]] * 2
    found = uf.judge(*tables(captures, ENTRIES))
    assert rows(found, "url", "host", "verdict", "matched", "since") == brute(captures, ENTRIES)


def test_empty_tables_extra_columns_and_no_python(tables, rows):
    captures, entries = tables([(URLS[0], D[3])], ENTRIES)
    none, nothing = tables([], [])
    assert uf.judge(none, entries).collect() == []
    assert rows(uf.judge(captures, nothing), "verdict") == [("pass",)]
    odd = captures.withColumn("key", F.lit(1)).withColumn("month", F.lit(2)).withColumn("verdict", F.lit("old")).withColumn("day", F.lit(0))
    found = uf.judge(odd, entries)
    assert rows(found, "key", "month", "day", "verdict") == [(1, 2, 0, "pass")]
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_hot_host_with_an_entry_on_every_day(tables, rows):
    days = [date.fromordinal(date(2024, 1, 1).toordinal() + i) for i in range(400)]
    entries = [("hot.net", ["block", "allow", "clear"][i % 3], day) for i, day in enumerate(days)] * 2
    captures = [("http://a.hot.net/1", day) for day in days[::3]] * 5
    found = uf.judge(*tables(captures, entries))
    assert rows(found, "url", "host", "verdict", "matched", "since") == brute(captures, entries)
