import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import pii
from shelfwise.llm.queries import DEMONSTRATION_KEY, op7_pii

VALUES = {
    "email": ["jane.doe42@mail.example.com", "x@example.org"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
    "date": ["1984-02-29", "31/12/1999", "01.01.2001"],
    "ip": ["192.168.0.1", "8.8.8.8"],
    "ssn": ["123-45-6789"],
    "phone": ["+1 (555) 555-7209", "415-555-2671", "+49 30 1234567"],
    "card": ["4111111111111111", "5500 0000 0000 0004", "378282246310005"],
}
INVALID = ["4111111111111112", "DE88370400440532013000", "1985-02-29", "256.1.1.1", "01.2.3.4", "000-12-3456", "1.2.3.4.5", "12345678"]


def luhn(digits):
    return sum(sum(divmod(int(d) * 2, 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def run(df, **options):
    return pii.pseudonyms(df, "k1", **options).select("doc_id", "pii.*").orderBy("doc_id").collect()


def test_each_kind_keeps_its_format(make_docs):
    values = [(kind, value) for kind, listed in VALUES.items() for value in listed]
    df = make_docs(*[(i, f"é😀 before {value} after, {value}.") for i, (_, value) in enumerate(values)])
    rows = run(df)
    for (kind, value), row in zip(values, rows):
        assert [s.kind for s in row.found] == [kind] * 2, (value, row)
        assert (row.found[0].start, row.found[0].end) == (10, 10 + len(value))
        fresh = re.fullmatch(r"é😀 before (.*) after, (.*)\.", row.text)
        assert fresh[1] == fresh[2] != value
        shape = re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "9", value)))
        if kind != "ip":
            assert re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "9", fresh[1]))) == shape
        if kind == "card":
            assert luhn(re.sub(r"\D", "", fresh[1]))
        if kind == "iban":
            plain = fresh[1].replace(" ", "")
            assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
        if kind == "ip":
            assert all(0 <= int(part) <= 255 for part in fresh[1].split("."))
        if kind == "date":
            day = fresh[1] if "-" in fresh[1] else "-".join(reversed(re.split("[./]", fresh[1])))
            assert 1800 <= dt.date.fromisoformat(day).year < 2200
    again = pii.pseudonyms(df, "k2").select("pii.text").collect()
    assert all(row.text != other.text for row, other in zip(rows, again))


def test_invalid_values_stay(make_docs):
    rows = run(make_docs(*enumerate(INVALID)))
    assert [row.text for row in rows] == INVALID and not any(row.found for row in rows)


def test_cards_beside_other_digits(make_docs):
    card, rest = "4111 1111 1111 1111", "6304 0000 0000 0001"
    longer = next(f"{rest} {i:03}" for i in range(1000) if luhn(f"{rest}{i:03}".replace(" ", "")))
    around = [("", " 123"), ("", " 12/26"), ("1 ", ""), ("12 3 ", " 456"), ("", " 192.168.0.1"), ("", " 123-45-6789"), ("1234567 ", " 9")]
    texts = [f"{before}{value}{after}" for before, after in around for value in (card, "4111111111111111", "3782 822463 10005")]
    kept = [value for _ in around for value in (card, "4111111111111111", "3782 822463 10005")]
    df = make_docs(*enumerate([*texts, longer, *[f"{card} {i:03}" for i in range(30)]]))
    rows = run(df)
    for text, value, row in zip(texts, kept, rows):
        begin = text.index(value)
        assert (begin, begin + len(value), "card") in map(tuple, row.found), (text, row)
        assert value not in row.text and luhn(re.sub(r"\D", "", row.text[begin : begin + len(value)]))
    assert [tuple(span) for span in rows[len(texts)].found] == [(0, len(longer), "card")]
    moved = pii.pseudonyms(df.select("doc_id", "text"), "k1").select("doc_id", "pii.text")
    assert [row.text for row in run(moved, inverse=True)] == [row.text for row in df.orderBy("doc_id").collect()]


@pytest.mark.parametrize("size", [1, 2, 3])
def test_permutation_of_all_digits(spark, size):
    df = spark.range(10**size).select(F.lpad(F.col("id").cast("string"), size, "0").alias("digits"))
    moved = df.select("digits", pii.permuted_digits(F.col("digits"), "k", "t", False).alias("moved"))
    back = moved.select("digits", "moved", pii.permuted_digits(F.col("moved"), "k", "t", True).alias("back")).collect()
    assert len({row.moved for row in back}) == 10**size and all(row.digits == row.back for row in back)


def test_round_trip_of_whole_documents(spark, larger):
    docs = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "text")
    moved = op7_pii(spark, larger).cache()
    back = pii.pseudonyms(moved.select("doc_id", F.col("text")), DEMONSTRATION_KEY, inverse=True)
    assert back.select("doc_id", "pii.text").exceptAll(docs).count() == 0
    texts = {row.doc_id: row.text for row in docs.collect()}
    found = 0
    for row in moved.collect():
        for span in filter(None, row.spans.split(",")):
            kind, start, end = span.split(":")
            value = texts[row.doc_id][int(start) : int(end)]
            assert value not in row.text.split()
            found += 1
    assert found > 20 and len(texts) == moved.count()


def test_awkward_rows(make_docs, awkward):
    df = make_docs(*awkward)
    rows = pii.pseudonyms(df, "k").select("text", "pii.text").collect()
    assert len(rows) == len(awkward) and all(row[0] == row[1] for row in rows)
    assert pii.pseudonyms(df, "k").columns == [*df.columns, "pii"]
    assert pii.pseudonyms(make_docs(), "k").count() == 0
