import hashlib
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shelfwise.llm.fill_in_middle import Blocks, fill_in_middle, restored

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, text, text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text)
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text)


def found(df):
    result = fill_in_middle(df)
    back = restored(F.col("fim.output"), F.col("fim.form")).alias("back")
    return sorted(map(tuple, result.select("doc_id", "fim.*", back).collect()), key=repr)


def test_awkward_rows(make_docs, awkward):
    docs = awkward + [(9, "a <M> in it"), (10, "<P"), (11, "x" * 300_000), (12, " " * 50_000 + "tail"), (13, "\n\n"), (14, "\0<S<P")]
    docs += [(100 + i, f"def f{i}(x):\n    return <S x * {i} <P\n" * (i % 5)) for i in range(200)]
    df = make_docs(*docs)
    assert found(df) == sorted([brute(*doc) for doc in docs], key=repr)
    assert set(fill_in_middle(df).columns) == {*df.columns, "fim"}
    assert {row[2] for row in found(df)} == {"plain", "spm", "psm"}


def test_empty_table(make_docs):
    assert found(make_docs()) == []


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aZ \né😀<P"), max_size=60), st.sampled_from([1, 2, 3, 7, 1024]))
def test_places(text, block):
    """Every cut lies where the units before it end, at any size of blocks."""
    units, blocks = UNIT.findall(text), Blocks(text, block)
    assert blocks.n_units == len(units)
    for i in range(len(units) + 1):
        assert blocks.place(i) == len("".join(units[:i]))


def test_long_text_in_several_steps():
    text = "word, " * 200_000 + "x" * 700_000
    units, blocks = UNIT.findall(text), Blocks(text)
    assert blocks.n_units == len(units)
    for i in (0, 1, 300_000, len(units) - 1, len(units)):
        assert blocks.place(i) == len("".join(units[:i]))


@pytest.mark.parametrize("form, output, text", [
    ("psm", "<P>a<<S>b<S<M>c<P", "a<c<Pb<S"), ("spm", "<S>b<M<P>a<S<M><P", "a<S<Pb<M"), ("plain", "<P>", "<P>"),
])
def test_restored(spark, form, output, text):
    df = spark.createDataFrame([(output, form)], "output string, form string")
    assert df.select(restored(F.col("output"), F.col("form"))).first()[0] == text
