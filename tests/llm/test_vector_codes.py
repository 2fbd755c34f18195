import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm.vector_codes import Cells, codebooks_text, compressed, decoded, trained, with_label_error

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, word string"


@pytest.fixture(scope="module")
def make_vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, vector, label, "x", 1, "w") for i, vector, label in rows], SCHEMA)

    return make


def brute(rows, parts=8, entries=16, rounds=6):
    """({vec_id: (code, error)}, codebooks) by plain loops."""
    kept = [(i, v) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = [(i, [math.floor(4096 * float(np.float32(x))) for x in v]) for i, v in kept]
    width = len(ints[0][1]) // parts
    cut = [(i, [tuple(v[p * width : (p + 1) * width]) for p in range(parts)]) for i, v in ints]
    first = sorted(cut, key=lambda row: (row[0] is None, row[0] or 0, row[1]))[:entries]
    books = [[v[p] for _, v in first] for p in range(parts)]

    def nearest(point, book):
        return min((sum((a - b) ** 2 for a, b in zip(point, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = {}
            for _, v in cut:
                members.setdefault(nearest(v[p], book)[1], []).append(v[p])
            for e, points in members.items():
                book[e] = tuple(sum(column) // len(points) for column in zip(*points))
    found = []
    for i, v in cut:
        best = [nearest(v[p], books[p]) for p in range(parts)]
        found.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    return sorted(found, key=repr), ",".join(str(x) for book in books for entry in book for x in entry)


def found(df):
    books = trained(df, "vec_id", "embedding")
    rows = compressed(df, books, into="_pq").select("vec_id", "_pq.*").collect()
    return sorted(map(tuple, rows), key=repr), codebooks_text(books)


def drawn(n, dim=16, seed=1):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 0.3, (5, dim))
    return [(i, [float(x) for x in centres[i % 5] + draw.normal(0, 0.05, dim)], i % 3 or None) for i in range(n)]


def test_against_brute_force(make_vectors):
    rows = drawn(400) + [(1000 + i, [0.25] * 16, 7) for i in range(200)]  # a third of all vectors alike
    rows += [(2000, None, 1), (2001, [None] + [0.0] * 15, 1), (2002, [math.nan] * 16, 1), (2003, [-math.inf] + [0.0] * 15, 1)]
    rows += [(None, [0.1] * 16, None), (3, [-0.3] * 16, 2), (3, [-0.3] * 16, 2)]
    df = make_vectors(rows).repartition(5)
    assert found(df) == brute(rows)
    columns = compressed(df, trained(df, "vec_id", "embedding"), into="Code").columns
    assert columns == ["vec_id", "embedding", "label", "error", "word", "Code"]


@pytest.mark.parametrize("n", [1, 5, 16])
def test_few_vectors(make_vectors, n):
    rows = drawn(n)
    assert found(make_vectors(rows)) == brute(rows)


def test_empty_table(make_vectors):
    assert found(make_vectors([])) == ([], "")
    assert found(make_vectors([(1, None, 1)])) == ([], "")


def test_wrong_lengths_and_sizes_fail(make_vectors):
    for vectors in ([[0.0] * 16, [0.0] * 8], [[0.0] * 12], [[1e9] * 16]):
        with pytest.raises(Exception, match="vectors must have|no exact distances"):
            found(make_vectors([(i, vector, 1) for i, vector in enumerate(vectors)]))


def test_label_errors(make_vectors):
    df = make_vectors([(i, None, (None, 1, 1, 2)[i % 4]) for i in range(40)]).withColumn("error", F.col("vec_id"))
    rows = with_label_error(df.select("vec_id", "label", "error"), "label", "error", "total").collect()
    expected = {label: sum(i for i in range(40) if (None, 1, 1, 2)[i % 4] == label) for label in (None, 1, 2)}
    assert len(rows) == 40 and all(row.total == expected[row.label] for row in rows)


@pytest.mark.parametrize("side", [0, 4, 9, 13])
def test_cells_never_lose_the_nearest_entry(side):
    """At any side, with ties, and when the cache is emptied again and again."""
    import shelfwise.llm.vector_codes as module

    draw = np.random.default_rng(side)
    book = np.concatenate([draw.integers(-900, 900, (14, 4)), [[0, 0, 0, 0], [0, 0, 0, 0]]])
    points = np.concatenate([draw.integers(-1000, 1000, (3000, 4)), np.zeros((5, 4), np.int64)])
    cells = Cells(book, side, cells=np.zeros((module.CELLS, 4), np.int64), masks=np.zeros(module.CELLS, np.int64))
    for part in np.array_split(points, 9):
        if side == 4:
            cells.place.clear()
        nearest, best = cells.assign(part)
        exact = ((part[:, None, :] - book) ** 2).sum(2)
        assert (best == exact.min(1)).all() and (nearest == exact.argmin(1)).all()


def test_decoded():
    books = np.arange(2 * 3 * 2).reshape(2, 3, 2) * 4096
    assert decoded("0201", books).tolist() == [4, 5, 8, 9]
