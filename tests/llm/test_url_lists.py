import datetime as dt
import random
import re

import duckdb
import pytest

from shelfwise.llm import queries, url_lists

ENTRIES, CAPTURES = "key string, action string, since timestamp_ntz", "id int, url string, fetched timestamp_ntz, key string, month int, n int"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)


def brute(url, at, entries):
    match = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@\[\]]+)(?::[0-9]*)?([^?#]*)", url or "")
    if not match or at is None:
        return "none", None, None, 0
    host = match[1].lower().removesuffix(".")
    labels, parts = host.split("."), [p for p in match[2].split("/") if p]
    keys = [".".join(labels[-n:]) for n in range(1, len(labels) + 1)]
    keys += [host + "/" + "/".join(parts[:n]) for n in range(1, len(parts) + 1)]
    found, number = ("none", None, None), 0
    for key in keys:
        past = [e for e in entries if e[0] == key and e[1] in url_lists.ACTIONS and e[2] is not None and e[2] <= at]
        if past:
            last = max(e[2] for e in past)
            action = min((e[1] for e in past if e[2] == last), key=url_lists.ACTIONS.index)
            if action != "remove":
                found, number = (action, key, last), number + 1
    return *found, number


def run(spark, captures, entries):
    df = spark.createDataFrame([(i, url, at, "x", 1, 2) for i, url, at in captures], CAPTURES)
    found = url_lists.judge_captures(df, spark.createDataFrame(entries, ENTRIES))
    assert found.columns == [*df.columns, "listing"]
    rows = found.select("id", "listing.decision", "listing.key", "listing.valid_from", "listing.n_in_force").collect()
    return sorted(map(tuple, rows), key=repr)


def test_against_brute_force(spark):
    chooser = random.Random(8)
    hosts = ["a.example.com", "example.com", "b.example.com", "x.test"]
    keys = [*hosts, "com", "a.example.com/p", "a.example.com/p/q", "example.com/p", "unused.org"]
    entries = [(chooser.choice(keys), chooser.choice(url_lists.ACTIONS), day(chooser.randrange(4000))) for _ in range(120)]
    entries += entries[:10] + [(None, "block", day(1)), ("x.test", None, day(2)), ("x.test", "block", None), ("x.test", "odd", day(0))]
    entries += [("com", "allow", day(500)), ("com", "remove", day(500)), ("com", "block", day(500))]
    urls = [f"{scheme}://{chooser.choice(['', 'u:p@'])}{host}{end}" for scheme in ("http", "HTTPS") for host in [*hosts, "A.Example.COM.", "x.test:80"]
            for end in ("", "/", "/p", "/p/q/r?x=/z#y", "//p//q", "?p")]
    captures = [(i, chooser.choice(urls), day(chooser.randrange(4200))) for i in range(600)]
    captures += [(1000, "http://a.example.com/p", day(500))] * 3 + [(1001, None, day(5)), (1002, "no url", day(5)), (1003, "http://x.test", None), (None, "", None)]
    expected = [(i, *brute(url, at, entries)) for i, url, at in captures]
    assert run(spark, captures, entries) == sorted(expected, key=repr)


def test_empty_tables(spark):
    assert run(spark, [], [("com", "block", day(0))]) == []
    assert run(spark, [(1, "http://a.com", day(0))], []) == [(1, "none", None, None, 0)]


@pytest.fixture()
def engine(testdata):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{testdata}/pages.parquet'")
    return connection


def test_query_against_sql(spark, testdata, engine):
    names = ["page_id", "fetched", "decision", "key", "valid_from", "n_in_force"]
    expected = engine.execute(f"SELECT {', '.join(names)} FROM ({queries.oracle_sql()['op9_url_lists']})").fetchall()
    rows = queries.op9_url_lists(spark, testdata).select(names).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, expected))
    assert {row.decision for row in rows} == {"block", "allow", "none"}
