import random

import pytest

from shelfwise.llm import decontamination as dc
from shelfwise.llm.queries import op4_decontamination

ITEMS = "item_id long, text string, score double, row1 long"


def shingled(words, size):
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(docs, items):
    """Pairs that fulfil the overlaps, whatever their BM25 score."""
    found = []
    for i, text in docs:
        words = dc.plain_words(text)
        for item, item_text in items:
            if len(dc.plain_words(item_text)) < dc.MIN_WORDS:
                continue
            shares = []
            for part in dc.question_and_answer(item_text):
                size = min(5, len(part))
                own = shingled(part, size) if size else set()
                shares.append(len(own & shingled(words, size)) / len(own) if own else 0.0)
            if shares[0] >= 0.8 or (shares[0] >= 0.5 and shares[1] >= 0.8):
                found.append((i, item, round(shares[0], 9), round(shares[1], 9)))
    return sorted(found, key=repr)


def pairs(df):
    return sorted([(r.doc_id, r.item_id, round(r.question_overlap, 9), round(r.answer_overlap, 9)) for r in df.collect()], key=repr)


def test_query_against_brute_force(spark, larger):
    docs = [tuple(row) for row in spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(row) for row in spark.read.parquet(f"{larger}/benchmark.parquet").collect()]
    expected = brute(docs, items)
    assert len(expected) > 5 and pairs(op4_decontamination(spark, larger)) == expected


def make_index(seed, n):
    chooser = random.Random(seed)
    vocabulary = [f"w{int(chooser.paretovariate(0.6)) % 400}".encode() for _ in range(4000)]
    units = [[chooser.choice(vocabulary) for _ in range(chooser.randint(3, 64))] for _ in range(n)]
    frequency = {word: sum(word in unit for unit in units) for word in {w for unit in units for w in unit}}
    return chooser, vocabulary, units, dc.BlockMaxIndex(units, frequency, n, 30)


@pytest.mark.parametrize("least", [0.2, 0.5, 0.9])
def test_block_max_wand_finds_all(least):
    chooser, vocabulary, units, index = make_index(3, 150)
    hits = 0
    for _ in range(300):
        words = {chooser.choice(vocabulary) for _ in range(60)} | set(chooser.choice(units)[: chooser.randint(0, 64)])
        terms = sorted({index.number[word] for word in words if word in index.number})
        scores = {}
        for term in terms:
            for unit, impact in zip(index.units[term], index.impacts[term]):
                scores[unit] = scores.get(unit, 0) + impact
        expected = {unit for unit, score in scores.items() if score >= least - 1e-9}
        assert {unit for unit, _ in index.search(terms, least)} == expected
        import numpy as np

        passes = index.promising(np.array(terms, np.int64), np.zeros(len(terms), np.int64), 1, least)
        assert len(passes) or not expected
        hits += len(expected)
    assert hits > 100


@pytest.mark.parametrize("index_words", [dc.INDEX_WORDS, 300])
def test_planted_passages(spark, make_docs, index_words):
    chooser = random.Random(9)
    vocabulary = [f"w{i}" for i in range(500)] + ["the"] * 60

    def text(n):
        return " ".join(chooser.choice(vocabulary) for _ in range(n))

    items = [(i, text(chooser.choice([12, 40, 64, 65, 200])) + chooser.choice(["", "\nanswer " + text(6)])) for i in range(40)]
    docs = []
    for i in range(120):
        body = text(chooser.randint(0, 400)).split()
        if i % 2:
            planted = items[i % 40][1].split()
            if i % 3 == 0:
                planted[len(planted) // 2] = "changed"
            if i % 7 == 0:
                planted = planted[: len(planted) // 2]
            at = chooser.randint(0, len(body))
            body[at:at] = planted
        docs.append((i, ", ".join(body).upper()))
    df = spark.createDataFrame([(i, t, 0.1, 2) for i, t in items], ITEMS)
    expected = brute(docs, items)
    assert len(expected) > 30 and pairs(dc.leaks(make_docs(*docs), df, index_words=index_words)) == expected


def test_awkward_rows(spark, make_docs, awkward):
    items = [(1, None), (2, ""), (None, "a text without an id"), (3, "one"), (4, dict(awkward)[7][:200]), (4, dict(awkward)[7][:200])]
    df = spark.createDataFrame([(i, t, 0.1, 2) for i, t in items], ITEMS)
    expected = brute(awkward, [(i, t or "") for i, t in items])
    assert expected and pairs(dc.leaks(make_docs(*awkward), df)) == expected
    assert dc.leaks(make_docs(), df).count() == 0
    assert dc.leaks(make_docs(*awkward), df.limit(0)).count() == 0
