import hashlib
import random

import numpy as np
import pytest

from shelfwise.llm.line_dedup import LineIndex, dedup_lines
from shelfwise.llm.queries import op1_line_dedup

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs):
    """(doc_id, n_lines, n_dropped, kept text) of every row."""
    holders = {}
    split = [(i, (text or "").split("\n")) for i, text in docs]
    for i, lines in split:
        for key in {line.strip(WHITE).translate(LOWER) for line in lines}:
            holders.setdefault(key, []).append(-1 << 63 if i is None else i)
    result = []
    for i, lines in split:
        kept = []
        for line in lines:
            key = line.strip(WHITE).translate(LOWER)
            drop = len(key) >= 20 and len(holders[key]) >= 3 and max(holders[key]) != (-1 << 63 if i is None else i)
            if not drop:
                kept.append(line)
        result.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(result, key=repr)


def found(df, **options):
    rows = dedup_lines(df, **options).select("doc_id", "line_dedup.*").collect()
    return sorted(map(tuple, rows), key=repr)


def test_query_against_brute_force(spark, testdata):
    docs = [tuple(row) for row in spark.read.parquet(f"{testdata}/documents.parquet").select("doc_id", "text").collect()]
    expected = [(i, n, gone, hashlib.sha256(text.encode()).hexdigest()) for i, n, gone, text in brute(docs)]
    rows = op1_line_dedup(spark, testdata).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)
    assert any(gone for _, _, gone, _ in expected)


def test_awkward_rows(make_docs, awkward):
    docs = awkward + [(9, "A line that is long enough"), (10, " a LINE that is long enough\t\nmine"), (11, "a line that is long enough\r")]
    docs += [(None, "a line that is long enough")] * 2
    df = make_docs(*docs)
    assert found(df) == brute(docs)
    assert set(dedup_lines(df).columns) == {*df.columns, "line_dedup"}


def test_empty_table(make_docs):
    assert found(make_docs()) == []


def test_hot_and_cold_keys_in_many_shards(make_docs):
    lines = [f"this is shared line number {i}" for i in range(6000)]
    chooser = random.Random(5)
    docs = [(i, "\n".join([*chooser.sample(lines, 40), "every document has this very line", f"own line {i}"])) for i in range(700)]
    assert found(make_docs(*docs), keys_per_shard=300) == brute(docs)


@pytest.mark.parametrize("size", [0, 1, 2, 1000, 30000])
def test_perfect_hash(size):
    draw = np.random.default_rng(size)
    high, low = draw.integers(0, 2**63, size + 500, dtype=np.uint64), draw.integers(0, 9, size + 500, dtype=np.uint64)
    counts = np.arange(size)
    index = LineIndex.from_bytes(LineIndex(high[:size], low[:size], counts, counts + 7).to_bytes())
    at = index.probe(high, low)
    assert sorted(at[:size]) == list(range(size)) and (at[size:] == -1).all()
    assert (index.counts[at[:size]] == counts).all() and (index.keepers[at[:size]] == counts + 7).all()
