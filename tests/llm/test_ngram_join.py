import random
import re

import pytest

from shelfwise.llm import ngram_join
from shelfwise.llm.queries import op5_ngram_join

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))) if words else frozenset()


def brute(docs):
    """(doc_id, set size, smallest reachable doc_id), comparing all pairs of different sets."""
    sets = [shingles(text) for _, text in docs]
    distinct = sorted(set(sets) - {frozenset()}, key=len)
    label = {one: one for one in distinct}

    def root(one):
        while label[one] is not one:
            one = label[one]
        return one

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if 100 * len(a) < 90 * len(b):
                break
            if root(a) is not root(b) and 100 * len(a & b) >= 90 * len(a | b):
                label[root(b)] = root(a)
    least = {}
    for (i, _), one in zip(docs, sets):
        if one and i is not None:
            least[root(one)] = min(i, least.get(root(one), i))
    return sorted([(i, len(one), least.get(root(one)) if one else i) for (i, _), one in zip(docs, sets)], key=repr)


def found(df, **options):
    return sorted(map(tuple, ngram_join.jaccard_components(df, **options).collect()), key=repr)


def test_query_against_brute_force(spark, larger):
    docs = [tuple(row) for row in spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "text").collect()]
    rows = sorted(map(tuple, op5_ngram_join(spark, larger).collect()), key=repr)
    assert rows == brute(docs)
    assert sum(row[0] != row[2] for row in rows) > 20


@pytest.mark.parametrize("options", [{}, {"heavy": 3, "chunk": 7}])
def test_near_copies_and_common_passages(make_docs, options):
    chooser = random.Random(6)
    vocabulary = [f"w{i}" for i in range(3000)]
    common = [chooser.choice(vocabulary) for _ in range(40)]

    def text(n):
        return [chooser.choice(vocabulary) for _ in range(n)]

    docs = []
    for n in (1, 2, 3, 4, 8, 11, 13, 21, 22, 29, 33, 45, 60, 60, 120, 400):
        base = text(n)
        for _ in range(12):
            copy = list(base)
            for _ in range(chooser.choice([0, 1, 1, 2, 3])):
                at = chooser.randrange(len(copy) + 1)
                kind = chooser.randrange(3)
                copy[at : at + (kind != 0)] = [chooser.choice(vocabulary)] * (kind != 1)
            docs.append(copy)
    docs += [text(chooser.randint(20, 90)) + common + text(chooser.randint(0, 90)) for _ in range(60)]
    docs += [common + [f"end{i}"] for i in range(30)] + [common] * 3
    chooser.shuffle(docs)
    pairs = [(i, " ".join(words).upper() if i % 5 == 0 else "\n".join(words)) for i, words in enumerate(docs)]
    assert found(make_docs(*pairs), **options) == brute(pairs)


def test_chain_of_links(make_docs):
    words = [f"w{i}" for i in range(260)]
    pairs = [(100 - i, " ".join(words[2 * i : 2 * i + 60])) for i in range(100)]
    assert found(make_docs(*pairs)) == brute(pairs)
    assert len({row[2] for row in brute(pairs)}) < 10


def test_awkward_rows(make_docs, awkward):
    docs = [*awkward, (None, "same text"), (2, "another text with the same id"), (2, "another text with the same id")]
    assert found(make_docs(*docs)) == brute(docs)
    assert found(make_docs()) == []


def test_small_sets_share_their_intersection():
    import numpy as np

    draw = np.random.default_rng(1)
    for n in (1, 9, 10, 19, 25):
        base = draw.integers(0, 2**63, n + 3, dtype=np.uint64)
        a, b = np.unique(base[:n]), np.unique(np.concatenate([base[ngram_join.slack(n, 90) :][: n - ngram_join.slack(n, 90)]]))
        assert set(ngram_join.subset_keys(a, 90)) & set(ngram_join.subset_keys(b, 90))


@pytest.mark.parametrize("n", [10, 57, 300])
def test_linked_sets_share_a_list(n):
    import numpy as np

    draw = np.random.default_rng(n)
    for i in range(400):
        base = np.unique(draw.integers(0, 2**63, n, dtype=np.uint64))
        cut = draw.choice(len(base), draw.integers(0, ngram_join.slack(n, 90) + 1), replace=False)
        extra = draw.integers(0, 2**63, draw.integers(0, 3), dtype=np.uint64)
        other = np.unique(np.concatenate([np.delete(base, cut), extra]))
        hot = np.sort(draw.choice(base, int(len(base) * draw.choice([0, 0.1, 0.5, 0.8, 1.0])), replace=False))
        common = len(base) - len(cut)
        if 100 * common >= 90 * (len(base) + len(other) - common):
            keys = [
                ngram_join.list_keys(one[: ngram_join.kept(len(one), 90)], len(one), hot, 90) for one in (base, other)
            ]
            assert set(keys[0]) & set(keys[1]), i


@pytest.mark.parametrize("percent", [50, 80, 90, 100])
def test_lists_hold_sets_of_sizes_that_may_link(percent):
    import numpy as np

    elements = np.arange(1, 40, dtype=np.uint64)

    def lists(n):
        keys = ngram_join.sized_keys(elements, n, percent)
        return keys[: len(elements)], keys

    for n in (1, 2, 9, 10, 50, 99, 100, 101, 1000, 12345):
        least = -(-percent * n // 100)
        for m in {least, (least + n) // 2, n}:
            own, all_ = lists(n)
            assert len(np.intersect1d(own, lists(m)[1])) == len(elements)  # at home in the list of the larger one
        assert not len(np.intersect1d(all_, lists(5 * n)[1]))


def test_long_lists_do_not_make_sets_enumerate_hundreds_of_subsets(spark):
    classes = spark.range(1000).selectExpr("id % 20 + 10 AS n_shingles")
    lists = spark.range(1000).selectExpr("1000L AS n")
    bound = ngram_join.boundary(classes, lists, 90)
    assert max(ngram_join.subsets(n, 90) for n in range(1, max(2, bound))) <= 20


@pytest.mark.parametrize("block", [7, 100, 10_000])
def test_heavy_elements_are_found_from_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    chooser = random.Random(block)
    often = {element: chooser.choice([1, 2, 5, 6, 11, 12, 40]) for element in range(-30, 300)}
    held = [element for element, n in often.items() for _ in range(n)]
    chooser.shuffle(held)
    rows = [(held[i : i + 9],) for i in range(0, len(held), 9)]
    df = spark.createDataFrame(rows, "elements array<long>").repartition(3)
    hot = set(ngram_join.heavy_elements(df, 5).view("int64").tolist())
    assert {element for element, n in often.items() if n > 10} <= hot
    assert hot <= {element for element, n in often.items() if n > 5}
