"""N-gram Jaccard join: a size-aware heavy-light join over sets of word shingles.

Equal sets form one class, and only classes are joined. With a share ``t`` in percent, two linked sets have at least
``t`` percent of either set in common, so at most ``slack = n - ceil(t n / 100)`` elements of each lie outside the
intersection.

* **Small sets** enumerate their subsets of each size from ``n - slack`` to ``n``. Linked sets have the same subset, their
  intersection, among these.
* **Large sets** go into inverted lists of the first ``slack + 1`` elements of a common order (linked sets share one of
  these), which are scanned. Sets just below the boundary are in these lists too. A list holds sets of two neighbouring
  classes of sizes only, as others cannot link.
* **Heavy elements**, common to very many sets, such as those of a boilerplate line, come last in that order; the others
  are ordered by their hashes. They are found by the counts of blocks of elements, where a frequent one is frequent in
  some block, so that elements are not shuffled for it. A set keeps its elements with the smallest hashes, some more than the lists need. Where
  so many of these are heavy that the rest is too short, the set is crowded: it enters the lists of all light elements
  that it kept, and those of its first ``slack + 1`` by hash whatever they are. With the number kept (see ``kept``), a
  crowded set meets linked ones of either kind. Lists of heavy elements hold crowded sets only.
* **The boundary** between small and large is the one with the least cost: subsets enumerated against list entries, with
  the comparisons in lists of the mean length they stand in, of which many take the time of a row.

Within a list no pairs are enumerated for groups of near copies. Each set is compared with the leaders of the list by
parity sketches, whose differing bits never outnumber the differing elements, so that no link is lost; it
becomes a candidate of each leader it may link with, or else a leader. Candidates are verified on whole sets. After the
components of round one, a second round compares those pairs of a list that may link and still have different labels, and
verifies them. What is not found has no effect on the components. Long lists are cut into chunks of bounded size.

Entries are dealt by element once, and only those of elements in several sets go into lists. Lists are stored without
sketches, which are added where lists are compared, to a share of them at a time, as they take most of the room.

Defined results: a null, empty or blank text has an empty set, is linked with nothing and is its own component. Every row
is a document; a null doc_id counts only where a component has no other. Sets are told apart by 128-bit, shingles by
64-bit hashes. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.shared import discard, materialized, release_shuffles
from .components import connected_components
from .texts import folded, row_key, shingle_hashes, spread, word_hashes, words_of

SHINGLE, PERCENT = 3, 90
HEAVY = 1000  # a heavy element is in more sets than this, and than a millionth of all entries; one in twice as many is heavy
BLOCK = 2_000_000  # elements that are counted in one go
COMPARED = 100  # sketches that are compared in the time of one row
PASSES = 3  # shares of the lists that are made, and compared, one after the other
CHUNK = 2000  # entries of a list that are compared in one go
BITS = 512
BOUNDARIES = (1, 10, 20, 30)  # the number of subsets jumps at multiples of 100 / (100 - PERCENT)


def slack(n: int, percent: int) -> int:
    """Elements of a set of ``n`` that a linked set may lack."""
    return n - -(-percent * n // 100)


def subsets(n: int, percent: int) -> int:
    return sum(math.comb(n, k) for k in range(slack(n, percent) + 1))


def reach(n: int, percent: int) -> int:
    """Elements, by hash, among which a set that is not crowded has ``slack + 1`` light ones."""
    return slack(n, percent) * 3 // 2 + 8


def kept(n: int, percent: int) -> int:
    """Elements, by hash, that a set keeps. A light element within reach of a linked set is among them: sets differ in
    size by the factor at most, and no more than ``slack`` other elements can come before it."""
    return min(n, reach(100 * n // percent, percent) + slack(n, percent) + 1)


def list_keys(elements: np.ndarray, n: int, hot: np.ndarray, percent: int) -> np.ndarray:
    """The elements whose lists a set of size ``n`` with these kept elements enters. ``hot`` is sorted."""
    at = np.minimum(np.searchsorted(hot, elements), max(0, len(hot) - 1))
    light = hot[at] != elements if len(hot) else np.ones(len(elements), bool)
    first = slack(n, percent) + 1
    near = elements[: reach(n, percent)][light[: reach(n, percent)]]
    if len(near) >= first:
        return near[:first]
    light[:first] = True
    return elements[light]


def size_class(n: int, percent: int) -> int:
    """Linked sets are in the same class of sizes, or in neighbouring ones."""
    return math.floor(math.log(n) / max(1.000001 * math.log(100 / percent), 1e-6))


def sized_keys(keys: np.ndarray, n: int, percent: int) -> np.ndarray:
    """The lists of these elements for the class of a set of size ``n``, then those for the class above it."""
    own = size_class(n, percent)
    return np.concatenate([spread(keys, 100 + one) for one in (own, own + 1)])


def subset_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Keys of all subsets that an intersection with a linked set may be: sums of hashes, less those left out."""
    mixed = spread(shingles, 21)
    whole, found = mixed.sum(dtype=np.uint64), []
    for left_out in range(slack(len(shingles), percent) + 1):
        for chosen in itertools.combinations(range(len(mixed)), left_out):
            found.append((int(whole) - int(mixed[list(chosen)].sum(dtype=np.uint64))) % 2**64 if chosen else int(whole))
    return spread(np.array(found, np.uint64), 22)


def sketch(shingles: np.ndarray, bits: int = BITS) -> bytes:
    """The parity of the number of elements on each of ``bits`` places, a power of two."""
    places = (spread(shingles, 31) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=bits) & 1).tobytes()


def long_sketch(shingles: np.ndarray) -> bytes | None:
    """For sets that would fill the short sketch, one of as many bits as elements, at least."""
    return sketch(shingles, 1 << (len(shingles) - 1).bit_length()) if 2 * len(shingles) > BITS else None


def long_may_link(n: int, one: bytes | None, m: int, other: bytes | None, percent: int) -> bool:
    """Whether the long sketches leave room for a link; the longer one is folded to the size of the shorter."""
    if one is None or other is None:
        return True
    a, b = np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8)
    while len(a) != len(b):
        a, b = (a, b) if len(a) > len(b) else (b, a)
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return (100 + percent) * int(np.bitwise_count(a ^ b).sum(dtype=np.int64)) <= (100 - percent) * (n + m)


def shingle_set(text: str | None, size: int, known: dict[bytes, int]) -> np.ndarray:
    return np.unique(shingle_hashes(word_hashes(words_of(folded(text)), known), size))


MOST_HOT = 1_000_000  # no more elements can be heavy, as each has more than this share of all entries
SETS = "doc_id long, node binary, n_shingles long, bits binary, more binary, elements array<long>, row1 long, row2 long"
ENTRY = "key long, node binary, n_shingles long"


def longs(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.array([], np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def described(docs: DataFrame, doc_id: str, text: str, shingle: int, percent: int) -> DataFrame:
    """A row for each document with what the join needs of its set; only small sets are kept whole."""
    most = max(BOUNDARIES)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            sets = [shingle_set(one.as_py(), shingle, known) for one in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()),
                pa.array([xxhash.xxh3_128_digest(one.tobytes()) if len(one) else None for one in sets], pa.binary()),
                pa.array([len(one) for one in sets], pa.int64()),
                pa.array([sketch(one) if len(one) else None for one in sets], pa.binary()),
                pa.array([long_sketch(one) for one in sets], pa.binary()),
                longs([one if len(one) < most else one[: kept(len(one), percent)] for one in sets]),
                batch.column(2), batch.column(3),
            ], names=[field.split()[0] for field in SETS.split(", ")])

    return docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`"), *row_key(doc_id, text)).toDF("id", "text", "row1", "row2").mapInArrow(describe, SETS)


def heavy_elements(rows: DataFrame, heavy: int) -> np.ndarray:
    """The heavy elements, sorted. Each block of elements counts those that take more of it than the limit is of all; what
    an element is in other blocks is less than the limit in all, so one in twice as many sets is always found."""
    total = rows.agg(F.coalesce(F.sum(F.size("elements")), F.lit(0))).first()[0]
    limit = max(heavy, total / MOST_HOT)

    def counted(block: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(block), return_counts=True)
        often = n * total > limit * sum(map(len, block))
        return pa.RecordBatch.from_arrays([pa.array(keys[often]), pa.array(n[often])], names=["key", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = []
        for batch in batches:
            block.append(batch.column(0).flatten().to_numpy())
            if sum(map(len, block)) >= BLOCK:
                yield counted(block)
                block = []
        if block:
            yield counted(block)

    found = rows.select("elements").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    hot = found.filter(F.col("n") > limit).select("key").toArrow().column("key").to_numpy()  # no more than MOST_HOT
    return np.sort(hot.view(np.uint64))


def elements_of(batch: pa.RecordBatch) -> list[tuple[int, np.ndarray]]:
    """Size and elements of each set."""
    flat, ends = batch.column("elements").values.to_numpy().view(np.uint64), batch.column("elements").offsets.to_numpy()
    return [(n, flat[ends[i] : ends[i + 1]]) for i, n in enumerate(batch.column("n_shingles").to_pylist())]


def entries_of(
    batch: pa.RecordBatch, keys: list[np.ndarray], chosen: Callable[[np.ndarray], np.ndarray] | None = None
) -> pa.RecordBatch:
    owner = np.repeat(np.arange(len(keys)), [len(one) for one in keys])
    flat = np.concatenate(keys) if keys else np.array([], np.uint64)
    if chosen:
        keep = chosen(flat)
        owner, flat = owner[keep], flat[keep]
    return pa.RecordBatch.from_arrays(
        [pa.array(flat.view(np.int64)), batch.column("node").take(pa.array(owner)), batch.column("n_shingles").take(pa.array(owner))],
        names=["key", "node", "n_shingles"],
    )


def list_entries(rows: DataFrame, hot: np.ndarray, percent: int, share: int | None = None) -> DataFrame:
    """(key, node, n_shingles): the elements by which each document's set enters lists, the heavy ones or a share of the
    others."""
    known = rows.sparkSession.sparkContext.broadcast(hot)  # at most MOST_HOT numbers

    def chosen(keys: np.ndarray) -> np.ndarray:
        heavy = np.zeros(len(keys), bool)
        if len(known.value):
            heavy = known.value[np.minimum(np.searchsorted(known.value, keys), len(known.value) - 1)] == keys
        return heavy if share is None else ~heavy & (keys % np.uint64(PASSES) == share)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [list_keys(one[: kept(n, percent)], n, known.value, percent) for n, one in elements_of(batch)]
            yield entries_of(batch, keys, chosen)

    return rows.filter("node IS NOT NULL").select("node", "n_shingles", "elements").mapInArrow(enter, ENTRY)


def subset_entries(rows: DataFrame, bound: int, percent: int) -> DataFrame:
    """(key, node, n_shingles): the subsets of each document's set of less than ``bound`` elements."""

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield entries_of(batch, [subset_keys(one, percent) for _, one in elements_of(batch)])

    small = rows.filter("node IS NOT NULL").filter(F.col("n_shingles") < bound)
    return small.select("node", "n_shingles", "elements").mapInArrow(enter, ENTRY)


def met(entries: DataFrame) -> DataFrame:
    """The entries of keys that several sets have, each once."""
    one, by_key = F.xxhash64("node"), Window.partitionBy("key")
    dealt = entries.repartition("key").withColumns({"low": F.min(one).over(by_key), "high": F.max(one).over(by_key)})
    several = dealt.filter("low <> high").select("key", "node", "n_shingles").distinct()
    several = materialized(several, "shared-entries")
    release_shuffles(entries.sparkSession)
    return several


def sized_entries(entries: DataFrame, percent: int) -> DataFrame:
    """(key, node, n_shingles, own): the lists of the entries by classes of sizes, and whether they are of the set's own."""

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            elements = batch.column("key").to_numpy().view(np.uint64)
            sizes, which = np.unique(batch.column("n_shingles").to_numpy(), return_inverse=True)
            keys = np.empty((2, len(elements)), np.uint64)
            for i, n in enumerate(sizes):
                at = np.flatnonzero(which == i)
                keys[:, at] = sized_keys(elements[at], int(n), percent).reshape(2, -1)
            twice = pa.array(np.tile(np.arange(len(elements)), 2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1).view(np.int64)), batch.column("node").take(twice), batch.column("n_shingles").take(twice),
                 pa.array(np.arange(2 * len(elements)) < len(elements))],
                names=["key", "node", "n_shingles", "own"],
            )

    return entries.mapInArrow(enter, ENTRY + ", own boolean")


LISTED = "any_own AND n > 1"  # where all sets are of the class of sizes below, they meet in the list of that one


def light_members(shared: DataFrame, percent: int) -> DataFrame:
    """(key, node, n_shingles, n): the lists of light elements, from the entries of those that several sets have, and how
    many entries each list has."""
    by_key = Window.partitionBy("key")
    listed = sized_entries(shared, percent).withColumns({"n": F.count("*").over(by_key), "any_own": F.max("own").over(by_key)})
    return listed.filter(LISTED).select("key", "node", "n_shingles", "n")


def heavy_members(entries: DataFrame, percent: int) -> DataFrame:
    """The same of heavy elements, which may have very many entries: equal ones and numbers are combined before they are dealt."""
    listed = sized_entries(entries.distinct(), percent)
    counts = listed.groupBy("key").agg(F.count("*").alias("n"), F.max("own").alias("any_own")).filter(LISTED)
    return listed.join(counts, "key").select("key", "node", "n_shingles", "n")


def boundary(classes: DataFrame, members: DataFrame, percent: int) -> int:
    """The size from which sets count as large."""
    scan = members.agg(F.avg(F.least("n", F.lit(HEAVY)))).first()[0] or 1.0
    most = max(BOUNDARIES)
    sizes = dict(classes.filter(F.col("n_shingles") < most).groupBy("n_shingles").count().collect())  # below ``most`` rows

    def cost(bound: int) -> float:
        return sum(
            number * (
                (subsets(n, percent) if n < bound else 0)
                + (2 * (slack(n, percent) + 1) * (1 + scan / COMPARED) if 100 * n >= percent * bound else 0)
            )
            for n, number in sizes.items()
        )

    return min(BOUNDARIES, key=cost)


def may_link(size: np.ndarray, bits: np.ndarray, n: int, one: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets may be linked with one of size ``n``, by sizes and by the differing bits of their sketches."""
    differ = np.bitwise_count(bits ^ one).sum(1, dtype=np.int64)
    close = 100 * np.minimum(size, n) >= percent * np.maximum(size, n)
    return close & ((100 + percent) * differ <= (100 - percent) * (size + n))


class Gathered:
    """Sets of a list gathered so far, to compare others with."""

    def __init__(self):
        self.count, self.codes, self.rows = 0, {}, []
        self.size, self.label, self.bits = np.empty(8, np.int64), np.empty(8, np.int64), np.empty((8, BITS // 64), np.uint64)

    def add(self, node: bytes, n: int, bits: np.ndarray, more: bytes | None, label: bytes | None = None) -> None:
        if self.count == len(self.size):
            self.size, self.label, self.bits = [np.concatenate([one] * 2) for one in (self.size, self.label, self.bits)]
        self.size[self.count], self.bits[self.count] = n, bits
        self.label[self.count] = self.codes.setdefault(label, len(self.codes))
        self.rows.append((node, more))
        self.count += 1

    def near(self, n: int, bits: np.ndarray, more: bytes | None, percent: int, label: bytes | None = b"") -> list[bytes]:
        """The sets with other labels that may link with this one."""
        if not self.count:
            return []
        fits = may_link(self.size[: self.count], self.bits[: self.count], n, bits, percent)
        fits &= self.label[: self.count] != self.codes.get(label, -1)
        return [
            self.rows[i][0] for i in np.flatnonzero(fits) if long_may_link(n, more, int(self.size[i]), self.rows[i][1], percent)
        ]


def lists_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple]:
    """(key, rest of the row) in order, from batches sorted by key."""
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in batch.schema.names]
        width = len(keys)
        for row in zip(*columns):
            yield row[:width], row[width:]


CANDIDATE = "key long, leader binary, node binary"


def scanned(lists: DataFrame, percent: int) -> DataFrame:
    """(key, leader, node) of each set that may link with a leader of its list, and (key, null, node) of the leaders."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, leaders, found = None, Gathered(), []
        for key, (node, n, bits, more) in lists_of(batches, ["key", "chunk"]):
            if key != last:
                last, leaders = key, Gathered()
            bits = np.frombuffer(bits, np.uint64)
            links = leaders.near(n, bits, more, percent)
            if not links:
                leaders.add(node, n, bits, more)
            found.extend((key[0], leader, node) for leader in links or [None])
            if len(found) >= 20_000:
                yield table_of(found)
                found = []
        yield table_of(found)

    def table_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())],
            names=["key", "leader", "node"],
        )

    ordered = lists.select("key", "chunk", "node", "n_shingles", "bits", "more").repartition("key", "chunk")
    return ordered.sortWithinPartitions("key", "chunk", "node").mapInArrow(scan, CANDIDATE)


def apart(lists: DataFrame, percent: int) -> DataFrame:
    """(u, v): pairs of a list that may link and have different labels. The entries at home in a chunk, which are of
    bounded number, are gathered first; those that visit it stream past them."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, homes, found = None, Gathered(), []
        for key, (away, node, label, n, bits, more) in lists_of(batches, ["key", "chunk"]):
            if key != last:
                last, homes = key, Gathered()
            bits = np.frombuffer(bits, np.uint64)
            found.extend((other, node) for other in homes.near(n, bits, more, percent, label))
            if not away:
                homes.add(node, n, bits, more, label)
            if len(found) >= 20_000:
                yield pairs_of(found)
                found = []
        yield pairs_of(found)

    def pairs_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(column, pa.binary()) for column in columns], names=["u", "v"])

    ordered = lists.select("key", "chunk", "away", "node", "label", "n_shingles", "bits", "more").repartition("key", "chunk")
    return ordered.sortWithinPartitions("key", "chunk", "away", "node").mapInArrow(compare, "u binary, v binary")


def whole_sets(nodes: DataFrame, docs: DataFrame, classes: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """(node, set) of these classes, read from the documents that stand for them."""
    needed = nodes.join(classes.select("node", "row1"), "node")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        seen: set[bytes] = set()  # equal rows come to one task, but for a few splits; a node more than once does no harm
        for batch in batches:
            nodes, sets = [], []
            for node, one in zip(batch.column("node").to_pylist(), batch.column("text")):
                if node in seen:
                    continue
                found = shingle_set(one.as_py(), shingle, known).tobytes()
                if xxhash.xxh3_128_digest(found) == node:  # half a row key may be that of another row too
                    seen.add(node)
                    nodes.append(node)
                    sets.append(found)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sets, pa.binary())], names=["node", "set"])

    plain = docs.select(row_key(doc_id, text)[0].alias("row1"), F.col(f"`{text}`").alias("text"))
    chosen = plain.join(needed, "row1").select("node", "text")
    return chosen.mapInArrow(sets, "node binary, set binary")


def linked(
    pairs: DataFrame, docs: DataFrame, classes: DataFrame, doc_id: str, text: str, shingle: int, percent: int
) -> DataFrame:
    """The pairs (u, v) whose whole sets are linked. Only the sets of these pairs are read; they are deleted at the end."""
    nodes = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    sets = materialized(whole_sets(nodes, docs, classes, doc_id, text, shingle), "shingle-sets")
    release_shuffles(docs.sparkSession)
    links = materialized(verified(pairs, sets, percent), "links")
    discard(sets)
    release_shuffles(docs.sparkSession)
    return links


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose whole ``sets`` are linked."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                a, b = (np.frombuffer(side.as_py(), np.uint64) for side in (left, right))
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column(name).filter(pa.array(keep, pa.bool_())) for name in ("u", "v")], names=["u", "v"]
            )

    left = sets.select(F.col("node").alias("u"), F.col("set").alias("left"))
    right = sets.select(F.col("node").alias("v"), F.col("set").alias("right"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "left", "right").mapInArrow(link, "u binary, v binary")


def class_links(
    docs: DataFrame, rows: DataFrame, classes: DataFrame, doc_id: str, text: str, shingle: int, percent: int, heavy: int,
    chunk: int,
) -> DataFrame:
    """(node, label) of every class that is linked with another one. ``rows`` is deleted when its lists are stored."""
    spark = rows.sparkSession
    hot = heavy_elements(rows, heavy)
    parts = []
    for share in range(PASSES):
        shared = met(list_entries(rows, hot, percent, share))
        parts.append(materialized(light_members(shared, percent), "list-members"))
        discard(shared)
        release_shuffles(spark)
    if len(hot):
        parts.append(materialized(heavy_members(list_entries(rows, hot, percent), percent), "list-members"))
        release_shuffles(spark)
    members = reduce(DataFrame.unionByName, parts)
    bound = boundary(classes, members, percent)
    shared = met(subset_entries(rows, bound, percent))
    small = materialized(shared.withColumn("n", F.count("*").over(Window.partitionBy("key"))), "small-members")
    discard(rows, shared)
    release_shuffles(spark)
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    lists = members.filter(100 * F.col("n_shingles") >= percent * bound).unionByName(small).select(
        "key", F.pmod(F.xxhash64("node"), chunks).cast("int").alias("chunk"), chunks.alias("chunks"), "node"
    )

    def sketched(some: DataFrame) -> DataFrame:
        return some.join(classes.select("node", "n_shingles", "bits", "more"), "node")

    shares = []
    for share in range(PASSES):
        some = lists.filter(F.pmod("key", F.lit(PASSES)) == share)
        shares.append(materialized(scanned(sketched(some), percent), "leaders"))
        release_shuffles(spark)
    first = reduce(DataFrame.unionByName, shares)
    several = lists.filter("chunks > 1")
    leading = first.filter("leader IS NULL").select("key", "node").distinct()
    again = several.join(leading, ["key", "node"], "left_semi").withColumn("chunk", F.lit(-1))
    found = first.unionByName(scanned(sketched(again), percent)).filter("leader IS NOT NULL")
    found = materialized(found, "candidates")
    discard(*shares)
    release_shuffles(spark)
    pairs = found.select(F.least("leader", "node").alias("u"), F.greatest("leader", "node").alias("v")).distinct()
    pairs = materialized(pairs, "pairs")
    links = linked(pairs, docs, classes, doc_id, text, shingle, percent)
    labels = materialized(connected_components(links), "labels")
    release_shuffles(spark)

    # Round two: only lists in which some sets may link, and in these only pairs with different labels.
    active = lists.join(found.select("key").distinct(), "key", "left_semi").join(labels, "node", "left")
    active = materialized(active.withColumn("label", F.coalesce("label", "node")), "active")
    sizes = active.groupBy("key", "label").agg(F.count("*").alias("m"))
    summary = sizes.groupBy("key").agg(F.count("*").alias("labels"), F.max_by("label", "m").alias("main")).filter("labels > 1")
    summary = materialized(summary.select("key", "main"), "mixed-keys")
    release_shuffles(spark)
    mixed = materialized(sketched(active.join(summary, "key")), "mixed")
    discard(*parts, small, active)
    release_shuffles(spark)
    home = mixed.withColumn("away", F.lit(False))
    others = mixed.filter(F.col("label") != F.col("main")).select(
        "*", F.lit(True).alias("away"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("visited")
    ).filter("visited <> chunk").withColumn("chunk", F.col("visited")).drop("visited")
    rest = apart(home.unionByName(others), percent)
    rest = rest.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    rest = materialized(rest.join(pairs, ["u", "v"], "left_anti"), "pairs")
    discard(mixed)
    release_shuffles(spark)
    if not rest.take(1):
        return labels
    more = linked(rest, docs, classes, doc_id, text, shingle, percent)
    return connected_components(links.unionByName(more))


def labelled_rows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
    heavy: int = HEAVY, chunk: int = CHUNK,
) -> DataFrame:
    """(doc_id, row1, row2, n_shingles, label, component): each document with its row key, what its component is called
    internally (null for an empty set) and the smallest doc_id there."""
    spark = docs.sparkSession
    rows = materialized(described(docs, doc_id, text, shingle, percent), "sets")
    values = [F.min(name).alias(name) for name in ("n_shingles", "bits", "more")]  # equal within a class
    classes = rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.min("row1").alias("row1"), *values  # a row that stands for the class, by its key
    )
    classes = materialized(classes, "classes")
    slim = materialized(rows.select("doc_id", "row1", "row2", "n_shingles", "node"), "row-classes")
    labels = class_links(docs, rows, classes, doc_id, text, shingle, percent, heavy, chunk)
    labelled = classes.select("node", "rep").join(labels, "node", "left").select(
        "node", "rep", F.coalesce("label", "node").alias("label")
    )
    smallest = labelled.groupBy("label").agg(F.min("rep").alias("component"))
    named = materialized(labelled.join(smallest, "label").select("node", "label", "component"), "components")
    discard(classes)
    release_shuffles(spark)
    return slim.join(named, "node", "left").drop("node")


def jaccard_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
    heavy: int = HEAVY, chunk: int = CHUNK,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each document; the component is named by the smallest doc_id in it.

    Documents are linked when their sets of shingles of ``shingle`` words have a Jaccard similarity of ``percent`` or
    more; texts with fewer words have their whole sequence as one shingle.
    """
    found = labelled_rows(docs, doc_id, text, shingle, percent, heavy, chunk)
    own = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return found.select("doc_id", "n_shingles", own.alias("component_id"))
