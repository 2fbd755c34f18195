import hashlib
import random

import numpy as np
import pytest

from shelfwise.llm.exact_dedup import ENTRY, ExtendibleHash, Pages, check_equal, exact_dedup, without_copies
from shelfwise.llm.texts import spread


def brute(docs):
    """(doc_id, keep_id, group_size, sha256) of every row."""
    groups = {}
    for i, text in docs:
        groups.setdefault(text or "", []).append(i)
    rows = []
    for i, text in docs:
        ids = groups[text or ""]
        keep = max((x for x in ids if x is not None), default=None)
        rows.append((i, keep, len(ids), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(rows, key=repr)


def found(df, **options):
    rows = exact_dedup(df, **options).select("doc_id", "exact_dedup.*").collect()
    kept = [row for row in rows if row.kept]
    assert len(kept) == len({row.sha256 for row in rows}) == len({row.sha256 for row in kept})
    assert all(row.doc_id == row.keep_id for row in kept)
    return sorted(((row.doc_id, row.keep_id, row.group_size, row.sha256) for row in rows), key=repr)


def test_awkward_rows(make_docs, awkward):
    docs = awkward + [(9, "same text "), (10, "Same text"), (None, "same text"), (11, "ab"), (11, "ab"), (11, "cd"), (None, "ef"), (None, "ef")]
    df = make_docs(*docs)
    assert found(df) == brute(docs)
    assert set(exact_dedup(df).columns) == {*df.columns, "exact_dedup"} - {"text"}
    assert set(exact_dedup(df, with_text=True).columns) == {*df.columns, "exact_dedup"}
    kept = without_copies(df)
    assert kept.columns == df.columns
    assert sorted(row.text or "" for row in kept.collect()) == sorted({text or "" for _, text in docs})


def test_empty_table(make_docs):
    assert found(make_docs()) == []


def test_clashing_names(spark):
    df = spark.createDataFrame(
        [(1, "a", 5, "x", "y", 7), (2, "a", 6, "x", "y", 8)], "doc_id long, text string, hash int, digest string, owner string, tag int"
    )
    rows = sorted(exact_dedup(df).collect())
    assert [(row.doc_id, row.hash, row.tag, row.exact_dedup.kept) for row in rows] == [(1, 5, 7, False), (2, 6, 8, True)]


@pytest.mark.parametrize("bits", [64, 6])
def test_hot_group_small_pages_and_chains(make_docs, bits):
    """A third of all rows in one group; with 6 bits of hash every chain has some ten texts, with pages of 4 entries."""
    chooser = random.Random(3)
    docs = [(i, "the hot text " * 20 if i % 3 == 0 else f"text {chooser.randrange(900)}") for i in range(2400)]
    df = make_docs(*docs).repartition(12)
    assert found(df, bits=bits, room=4, keys_per_owner=150) == brute(docs)
    if bits == 6:
        assert max(row.exact_dedup.chain for row in exact_dedup(df, bits=6).collect()) > 5


def test_a_lasting_difference_behind_equal_digests_fails():
    import pyarrow as pa

    hashes, digests = pa.array([1, 1, 1]), pa.array([b"x" * 32] * 3)
    check_equal(hashes, digests, pa.array([None, "a", "a"]))
    with pytest.raises(ValueError):
        check_equal(hashes, digests, pa.array([None, "a", "b"]))


@pytest.mark.parametrize("size", [0, 1, 3000])
def test_directory(size):
    """Every bucket is within its room, holds the addresses its depth says, and every entry is found again."""
    draw = np.random.default_rng(size)
    index, all_ = ExtendibleHash(8), []
    for part in np.array_split(draw.integers(-(2**62), 2**62, size), 7):
        entries = np.zeros(len(part), ENTRY)
        entries["hash"], entries["address"] = part, spread(part.view(np.uint64), 11)
        entries["digest"][:, 0] = part.view(np.uint64)
        index.insert(entries)
        all_.append(entries)
    assert len(index.pointers) == 1 << index.depth and max(index.depths) == index.depth
    pages = Pages(index.pointers.tobytes())
    pages.pages = {i: index.page(i) for i in range(len(index.buckets))}
    assert all(len(page) <= 8 for page in pages.pages.values())
    for slot, bucket in enumerate(index.pointers):
        mask = np.uint64((1 << index.depths[bucket]) - 1)
        assert ((pages.pages[bucket]["address"] & mask) == (np.uint64(slot) & mask)).all()
    entries = np.concatenate(all_)
    assert (pages.find(entries["hash"], entries["digest"])["hash"] == entries["hash"]).all()
