"""Single texts and captures that must not kill or hang a task."""

import datetime as dt
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import pii, secrets, url_lists
from shelfwise.llm.spans import SPAN, apart, spans

SECONDS = 60  # generous on a slow machine; what grew with the square took hours


@pytest.fixture(autouse=True)
def quick():
    begin = time.perf_counter()
    yield
    assert time.perf_counter() - begin < SECONDS


def test_a_million_labels(make_docs):
    text = "x@" + "a." * 1_000_000 + "com"
    rows = pii.pseudonyms(make_docs((1, text), (2, "mail to x.y@mail.example.com... or a@b.c1, z@q.co.uk")), "k").select("doc_id", "pii.*").collect()
    found = {row.doc_id: [(span.start, span.end, span.kind) for span in row.found] for row in rows}
    assert found == {1: [], 2: [(8, 28, "email"), (43, 52, "email")]}


def test_a_hundred_thousand_addresses(make_docs):
    text = "someone@example.org, " * 100_000
    row = pii.pseudonyms(make_docs((1, text)), "k").select("pii.*").first()
    assert len(row.found) == 100_000 and row.found[-1].end == len(text) - 2


def test_a_run_of_a_megabyte(make_docs):
    chars = np.random.default_rng(1).choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"), 1_000_000)
    row = secrets.scan_secrets(make_docs((1, "".join(chars))), np.full((128, 128), 1.0), min_ratio=0.5).select("secrets.*").first()
    assert [(span.start, span.end) for span in row.markov] == [(0, 1_000_000)]


def test_a_hundred_thousand_secrets(make_docs):
    text = "token=abcdefgh0123 ABCDEFGHIJKLMNOPQRST " * 100_000
    row = secrets.scan_secrets(make_docs((1, text)), np.full((128, 128), 1.0), min_ratio=0.5).select("secrets.*").first()
    assert len(row.assign) == len(row.markov) == 100_000
    assert row.assign[-1].end == len(text) - 22 and row.markov[-1].end == len(text) - 1


def test_a_capture_of_the_year_9999(spark):
    captures = spark.createDataFrame(
        [("http://h1.org/", dt.datetime(2024, 5, 1)), ("http://h2.org/", dt.datetime(9999, 12, 1)), ("http://h3.org/", None)],
        "url string, fetched timestamp_ntz",
    )
    entries = spark.createDataFrame(
        [(f"h{i}.org", "block", dt.datetime(2020, 1, 1)) for i in range(2000)], "key string, action string, since timestamp_ntz"
    )
    rows = url_lists.judge_captures(captures, entries).select("url", "listing.decision").collect()
    assert dict(map(tuple, rows)) == {"http://h1.org/": "block", "http://h2.org/": "block", "http://h3.org/": "none"}


def test_overlaps_against_brute_force(spark):
    draw = np.random.default_rng(2)
    rows = []
    for number in range(200):
        some, others = (
            sorted((int(s), rank, int(s + n), kind) for s, n in zip(draw.integers(0, 60, k), draw.integers(1, 9, k)))
            for rank, kind, k in ((3, "markov", draw.integers(0, 8)), (0, "assign", draw.integers(0, 8)))
        )
        rows.append((number, some, others))
    df = spark.createDataFrame(rows, f"n int, some {SPAN}, others {SPAN}")
    for number, kept in df.select("n", apart(F.col("some"), F.col("others"))).collect():
        _, some, others = rows[number]
        assert [tuple(s) for s in kept] == [s for s in some if not any(o[0] < s[2] and s[0] < o[2] for o in others)]


def test_spans_across_parts(spark):
    text = " ".join(f"ab{'c' * (i % 5)}" for i in range(2000))
    df = spark.createDataFrame([(text,)], "text string")
    import re

    found = df.select(spans(F.col("text"), "abc*", "k", 1, lambda m: F.char_length(m) > 3)).first()[0]
    assert [(s.start, s.end) for s in found] == [m.span() for m in re.finditer("abc*", text) if len(m[0]) > 3]
