"""Line dedup through a sharded minimal perfect hash over the hashes of repeated lines.

One aggregation counts, for each line key, the documents that hold it. Of the keys found often enough, minimal perfect
hashes index three compact arrays: a fingerprint that tells members from other lines, the count, and the document that
keeps the line. The keys are cut into shards of bounded size. Documents probe the arrays with 16-byte hashes, which
travel to the shard; line texts are never joined. Keys that hold more than 1/4096 of all repeated lines, of which there
can be no more than 4096, form one more index that goes to every task, so that no shard receives a hot key.

Defined results: a null or empty text is one empty line. Every row is a document: rows that share a doc_id count
separately, and all of them keep a line that their doc_id keeps. A null doc_id is smaller than every other. Keys are
compared by 128-bit hashes. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..sources.shared import materialized
from .texts import WHITE_SPACE, row_key, spread, with_struct

MIN_CHARS, MIN_DOCS = 20, 3
KEYS_PER_SHARD = 1 << 17
HOT_SHARE = 4096  # a key is hot beyond this fraction of all repeated lines, so at most this many are hot
NO_DOC = np.iinfo(np.int64).min
ROOM = 2.0  # bits for each key that a level of the perfect hash has left


class PerfectHash:
    """A minimal perfect hash: levels of bits, a key lies at the first level where it meets no other.

    A key's index is the number of set bits before its own. Keys outside the set get any index or none.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray):
        """Over distinct pairs of 64-bit halves."""
        self.sizes, levels, self.count = [], [], len(high)
        left = np.arange(len(high))
        while len(left):
            size = int(ROOM * len(left)) + 1
            place = self.place(high[left], low[left], len(self.sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            self.sizes.append(size)
            levels.append(alone)
            left = left[~alone[place]]
        self.bits = np.packbits(np.concatenate(levels)) if levels else np.array([], np.uint8)
        self.rank()

    def rank(self) -> None:
        ones = np.unpackbits(self.bits).reshape(-1, 8).sum(1) if len(self.bits) else np.array([], np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)]).astype(np.int64)

    @staticmethod
    def place(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        return (spread(high ^ spread(low, level), level + 1) % np.uint64(size)).astype(np.int64)

    def index(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The index of each key; -1 where no level has a bit for it."""
        found = np.full(len(high), -1, np.int64)
        left, start = np.arange(len(high)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = start + self.place(high[left], low[left], level, size)
            byte, bit = self.bits[at >> 3], at & 7
            is_set = (byte >> (7 - bit).astype(np.uint8)) & 1 == 1
            earlier = BELOW[byte[is_set], bit[is_set]]
            found[left[is_set]] = self.before[at[is_set] >> 3] + earlier
            left, start = left[~is_set], start + size
        return found


BELOW = np.array([[bin(byte >> (8 - bit)).count("1") if bit else 0 for bit in range(8)] for byte in range(256)], np.int64)


class LineIndex:
    """Fingerprints, counts and keepers of a shard's keys, in the order of a perfect hash."""

    def __init__(self, high: np.ndarray, low: np.ndarray, counts: np.ndarray, keepers: np.ndarray):
        self.hash = PerfectHash(high, low)
        order = np.empty(len(high), np.int64)
        order[self.hash.index(high, low)] = np.arange(len(high))
        self.fingerprints = spread(high, 97)[order] ^ low[order]
        self.counts, self.keepers = counts[order], keepers[order]

    def probe(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Index into the arrays; -1 for lines that are no member."""
        at = self.hash.index(high, low)
        member = at >= 0
        member[member] = self.fingerprints[at[member]] == spread(high[member], 97) ^ low[member]
        return np.where(member, at, -1)

    def dropped(self, high: np.ndarray, low: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Which of the lines are members that another document keeps."""
        at = self.probe(high, low)
        drop = at >= 0
        drop[drop] = self.keepers[at[drop]] != docs[drop]
        return drop

    def to_bytes(self) -> bytes:
        head = np.array([self.hash.count, len(self.hash.sizes), len(self.hash.bits), *self.hash.sizes], np.int64)
        return b"".join(
            part.tobytes() for part in (head, self.fingerprints, self.counts, self.keepers, self.hash.bits)
        )

    @classmethod
    def from_bytes(cls, data: bytes) -> LineIndex:
        count, levels, bits = np.frombuffer(data, np.int64, 3).tolist()
        self, self.hash = cls.__new__(cls), PerfectHash.__new__(PerfectHash)
        self.hash.count, start = count, 24 + 8 * levels
        self.hash.sizes = np.frombuffer(data, np.int64, levels, 24).tolist()
        self.fingerprints = np.frombuffer(data, np.uint64, count, start)
        self.counts = np.frombuffer(data, np.int64, count, start + 8 * count)
        self.keepers = np.frombuffer(data, np.int64, count, start + 16 * count)
        self.hash.bits = np.frombuffer(data, np.uint8, bits, start + 24 * count)
        self.hash.rank()
        return self


def line_keys(text: str | None, min_chars: int) -> tuple[list[str], list[int], np.ndarray]:
    """The lines, the places of those with a key long enough, and the halves of their keys' hashes."""
    lines = (text or "").split("\n")
    places, digests = [], []
    for place, line in enumerate(lines):
        key = line.strip(WHITE_SPACE)
        if len(key) >= min_chars:
            places.append(place)
            digests.append(xxhash.xxh3_128_digest(key.encode().lower()))
    return lines, places, np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)


def doc_numbers(ids: pa.Array) -> np.ndarray:
    return ids.cast(pa.int64()).fill_null(NO_DOC).to_numpy(zero_copy_only=False)


def counted_lines(docs: DataFrame, doc_id: str, text: str, min_chars: int, min_docs: int) -> DataFrame:
    """(high, low, n_docs, keeper) of every line key found in at least ``min_docs`` documents."""

    def distinct_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = doc_numbers(batch.column(0))
            keys = [np.unique(line_keys(one.as_py(), min_chars)[2], axis=0) for one in batch.column(1)]
            both = np.concatenate(keys) if keys else np.empty((0, 2), np.uint64)
            owner = np.repeat(ids, [len(one) for one in keys])
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0].view(np.int64)), pa.array(both[:, 1].view(np.int64)), pa.array(owner)],
                names=["high", "low", "doc"],
            )

    keys = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).mapInArrow(distinct_keys, "high long, low long, doc long")
    counts = keys.groupBy("high", "low").agg(F.count("*").alias("n_docs"), F.max("doc").alias("keeper"))
    return counts.filter(F.col("n_docs") >= min_docs)


def index_of(table: pa.Table) -> LineIndex:
    columns = [table.column(name).to_numpy() for name in ("high", "low", "n_docs", "keeper")]
    return LineIndex(columns[0].view(np.uint64), columns[1].view(np.uint64), columns[2], columns[3])


def shard_indexes(counts: DataFrame, shards: int) -> DataFrame:
    """(shard, index): the keys of a shard, whose number is bounded as hashes spread evenly, in one binary value."""

    def build(table: pa.Table) -> pa.Table:
        return pa.table({"shard": table.column("shard")[:1], "index": pa.array([index_of(table).to_bytes()])})

    keyed = counts.withColumn("shard", F.pmod("high", F.lit(shards)).cast("int"))
    return keyed.groupBy("shard").applyInArrow(build, "shard int, index binary")


def probes(docs: DataFrame, doc_id: str, text: str, min_chars: int, shards: int, hot: bytes) -> DataFrame:
    """(shard, high, low, doc, row1, row2) of every line key that is not in the hot index."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LineIndex.from_bytes(hot)
        for batch in batches:
            ids = doc_numbers(batch.column(0))
            keys = [np.unique(line_keys(one.as_py(), min_chars)[2], axis=0) for one in batch.column(1)]
            both = np.concatenate(keys) if keys else np.empty((0, 2), np.uint64)
            owner = np.repeat(np.arange(len(ids)), [len(one) for one in keys])
            cold = known.probe(both[:, 0], both[:, 1]) < 0
            both, owner = both[cold].view(np.int64), owner[cold]
            rows = [batch.column(i).to_numpy()[owner] for i in (2, 3)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.mod(both[:, 0], shards).astype(np.int32)), pa.array(both[:, 0]), pa.array(both[:, 1]),
                 pa.array(ids[owner]), *map(pa.array, rows)],
                names=["shard", "high", "low", "doc", "row1", "row2"],
            )

    row1, row2 = row_key(doc_id, text)
    slim = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").alias("text"), row1.alias("row1"), row2.alias("row2"))
    return slim.mapInArrow(emit, "shard int, high long, low long, doc long, row1 long, row2 long")


def dropped_lines(indexes: DataFrame, lines: DataFrame, shards: int) -> DataFrame:
    """(row1, row2, high, low) of the lines to drop: each shard's index streams before its probes through one task."""
    both = lines.withColumn("index", F.lit(None).cast("binary")).unionByName(indexes, allowMissingColumns=True)
    both = both.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", F.col("index").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, index = None, None
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            of, found = columns["shard"].to_numpy(), np.zeros(batch.num_rows, bool)
            for number in np.unique(of):
                at = np.flatnonzero(of == number)
                if not columns["index"][int(at[0])].as_py() is None:
                    shard, index = number, LineIndex.from_bytes(columns["index"][int(at[0])].as_py())
                    at = at[1:]
                if len(at) and shard == number:
                    pick = [columns[name].take(pa.array(at)).to_numpy() for name in ("high", "low", "doc")]
                    found[at] = index.dropped(pick[0].view(np.uint64), pick[1].view(np.uint64), pick[2])
            kept = pa.array(np.flatnonzero(found))
            yield pa.RecordBatch.from_arrays(
                [columns[name].take(kept) for name in ("row1", "row2", "high", "low")], names=["row1", "row2", "high", "low"]
            )

    return both.mapInArrow(run, "row1 long, row2 long, high long, low long")


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", into: str = "line_dedup",
    min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, keys_per_shard: int = KEYS_PER_SHARD,
) -> DataFrame:
    """``docs`` with a struct ``into``: n_lines, n_dropped and the text that is left.

    A key is a line without white space at its ends and with A-Z in lower case. Keys of at least ``min_chars`` code
    points in at least ``min_docs`` documents lose all their lines but those of the largest doc_id.
    """
    spark = docs.sparkSession
    counts = materialized(counted_lines(docs, doc_id, text, min_chars, min_docs), "line-counts")
    size = counts.agg(F.count("*").alias("keys"), F.coalesce(F.sum("n_docs"), F.lit(0)).alias("lines")).first()
    is_hot = F.col("n_docs") * HOT_SHARE > size["lines"]
    hot = index_of(counts.filter(is_hot).toArrow()).to_bytes()  # fewer than HOT_SHARE rows
    shards = max(-(-size["keys"] // keys_per_shard), int(spark.conf.get("spark.sql.shuffle.partitions")))
    drops = dropped_lines(
        shard_indexes(counts.filter(~is_hot), shards), probes(docs, doc_id, text, min_chars, shards, hot), shards
    )
    per_row = drops.groupBy("row1", "row2").agg(F.collect_set(F.struct("high", "low")).alias("drops"))
    row1, row2 = row_key(doc_id, text)
    mine = {"row1": "_line_row1", "row2": "_line_row2", "drops": "_line_drops"}
    per_row = per_row.select([F.col(old).alias(new) for old, new in mine.items()])
    joined = docs.withColumns({"_line_row1": row1, "_line_row2": row2}).join(per_row, ["_line_row1", "_line_row2"], "left")

    @F.arrow_udf("struct<n_lines:bigint,n_dropped:bigint,text:string>")
    def assemble(ids: pa.Array, texts: pa.Array, dropped: pa.Array) -> pa.Array:
        known, rows = LineIndex.from_bytes(hot), []
        numbers = doc_numbers(ids)
        for number, one, drops in zip(numbers, texts, dropped):
            lines, places, keys = line_keys(one.as_py(), min_chars)
            gone = known.dropped(keys[:, 0], keys[:, 1], np.full(len(keys), number))
            listed = drops.as_py()
            if listed:
                listed = {(drop["high"], drop["low"]) for drop in listed}
                gone |= np.fromiter(((int(a), int(b)) in listed for a, b in keys.view(np.int64)), bool, len(keys))
            at = {places[i] for i in np.flatnonzero(gone)}
            kept = "\n".join(line for i, line in enumerate(lines) if i not in at) if at else "\n".join(lines)
            rows.append((len(lines), len(at), kept))
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.StructArray.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds)], names=["n_lines", "n_dropped", "text"]
        )

    result = with_struct(joined, into, assemble(F.col(f"`{doc_id}`"), F.col(f"`{text}`"), F.col("_line_drops")))
    return result.drop(*mine.values())
