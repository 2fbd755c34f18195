"""Exact dedup through an extendible-hash index on shared files.

The 64-bit hashes of the texts are dealt into key ranges, each owned by one task. An owner gets, in the order of hashes,
one row of facts for each distinct text (how many rows have it, which row stays) and the text itself from every task that
saw it, compares the bytes of all of them, and chains different texts that share a hash. Entries go to an extendible
hash: a directory of pointers to buckets; an overfull bucket is split by one more bit of the address, and the directory
doubles when that bucket had used up all its bits. Directories and buckets are written as rows of Parquet files in the
shared folder. Every document then probes the index of its range: directory, bucket, chain.

Hot groups: counts and the row that stays are combined before the shuffle; a task sends a text that it sees again and
again once. Rows of groups with more than 1/4096 of all rows, of which there are fewer than 4096, get their entry by a
broadcast; all other rows go to the owner of their range.

Defined results: a null text counts as empty, so null and empty texts are one group. Of equal texts the row with the
largest doc_id stays; a null doc_id is smaller than every other; of several such rows exactly one stays. Texts are told
apart by hash and SHA-256, and every two texts that agree in both are compared byte by byte: should they differ, the
job fails instead of merging them. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from ..sources.shared import materialized
from .texts import spread

KEYS_PER_OWNER = 1 << 17
ROOM = 256  # entries of a bucket
HOT_SHARE = 4096
SEEN_CHARS = 8_000_000  # characters of repeated texts that a task remembers
ENTRY = np.dtype([
    ("address", "u8"), ("hash", "i8"), ("digest", "u8", 4), ("chain", "i4"), ("count", "i8"), ("keep_id", "i8"),
    ("has_id", "?"), ("keep_tag", "i8"),
])


class ExtendibleHash:
    """A directory of 2**depth pointers to buckets of at most ``room`` entries; entries of one address stay together,
    however many there are. The last bits of an address choose the pointer."""

    def __init__(self, room: int = ROOM):
        self.room, self.depth = room, 0
        self.pointers, self.depths = np.zeros(1, np.int32), [0]
        self.buckets: list[list[np.ndarray]] = [[]]

    def insert(self, entries: np.ndarray) -> None:
        target = self.bucket_of(entries["address"])
        order = np.argsort(target, kind="stable")
        entries, target = entries[order], target[order]
        for part in np.split(entries, np.flatnonzero(np.diff(target)) + 1) if len(entries) else []:
            bucket = int(self.bucket_of(part["address"][:1])[0])
            self.buckets[bucket].append(part)
            self.split(bucket)

    def bucket_of(self, address: np.ndarray) -> np.ndarray:
        return self.pointers[(address & np.uint64(len(self.pointers) - 1)).astype(np.int64)]

    def split(self, bucket: int) -> None:
        """Splits the bucket, and what comes of it, until none is overfull."""
        open_ = [bucket]
        while open_:
            bucket = open_.pop()
            if sum(map(len, self.buckets[bucket])) <= self.room:
                continue
            entries = np.concatenate(self.buckets[bucket])
            self.buckets[bucket] = [entries]
            if (entries["address"] == entries["address"][0]).all():
                continue
            if self.depths[bucket] == self.depth:
                self.pointers, self.depth = np.tile(self.pointers, 2), self.depth + 1
            bit = np.uint64(1 << self.depths[bucket])
            high, new = (entries["address"] & bit) != 0, len(self.buckets)
            self.depths[bucket] += 1
            self.depths.append(self.depths[bucket])
            self.buckets[bucket] = [entries[~high]]
            self.buckets.append([entries[high]])
            slots = np.flatnonzero(self.pointers == bucket)
            self.pointers[slots[(slots & int(bit)) != 0]] = new
            open_ += [bucket, new]

    def page(self, bucket: int) -> np.ndarray:
        """The entries of a bucket in the order of hash and chain."""
        parts = self.buckets[bucket]
        entries = np.concatenate(parts) if parts else np.empty(0, ENTRY)
        return entries[np.lexsort((entries["chain"], entries["hash"]))]


class Pages:
    """A stored index, as read by a probe."""

    def __init__(self, directory: bytes):
        self.pointers, self.pages = np.frombuffer(directory, np.int32), {}

    def find(self, hashes: np.ndarray, digests: np.ndarray) -> np.ndarray:
        """The entry of each (hash, digest); all of them are in the index."""
        address = spread(hashes.view(np.uint64), 11)
        bucket = self.pointers[(address & np.uint64(len(self.pointers) - 1)).astype(np.int64)]
        found = np.empty(len(hashes), ENTRY)
        order = np.argsort(bucket, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
            page = self.pages[int(bucket[at[0]])]
            place = np.searchsorted(page["hash"], hashes[at])
            while True:  # along the chains, most of which have one entry
                other = (page["digest"][place] != digests[at]).any(axis=1)
                if not other.any():
                    break
                place[other] += 1
            found[at] = page[place]
        return found


def digests_of(column: pa.Array) -> np.ndarray:
    """Binary values of 32 bytes as four numbers each."""
    joined = b"".join(value.as_py() for value in column)
    return np.frombuffer(joined, np.uint64).reshape(-1, 4)


def text_sightings(texts: DataFrame) -> DataFrame:
    """Rows (owner, hash, digest, text) with each text once per batch, and once per task if it is seen repeatedly."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        size = 0
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text")).dictionary_encode()
            _, first, times = np.unique(column.indices.to_numpy(), return_index=True, return_counts=True)
            skipped = []
            for number in np.flatnonzero(times > 1).tolist():
                text = column.dictionary[number].as_py()
                if text in seen:
                    skipped.append(number)
                elif size + len(text) <= SEEN_CHARS:
                    seen.add(text)
                    size += len(text)
            yield batch.take(pa.array(np.sort(np.delete(first, skipped))))

    return texts.mapInArrow(emit, texts.schema)


def build_index(facts: DataFrame, texts: DataFrame, owners: int, room: int) -> DataFrame:
    """(owner, page, depth, entries): of each key range its directory as page -1, and the buckets."""
    both = facts.unionByName(text_sightings(texts), allowMissingColumns=True)
    both = both.repartitionById(owners, F.col("owner"))
    both = both.sortWithinPartitions("owner", "hash", "digest", F.col("text").isNotNull())

    def pages(owner: int, index: ExtendibleHash) -> pa.RecordBatch:
        rows = [(owner, -1, index.depth, index.pointers.tobytes())]
        rows += [(owner, i, index.depths[i], index.page(i).tobytes()) for i in range(len(index.buckets))]
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=["owner", "page", "depth", "entries"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, index, last, chain = None, None, None, (None, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {name: batch.column(name) for name in batch.schema.names}
            of, hashes = columns["owner"].to_numpy(), columns["hash"].to_numpy()
            # Texts side by side that agree in hash and digest must agree in every byte.
            if last is not None:
                check_equal(pa.concat_arrays([last["hash"], columns["hash"][:1]]),
                            pa.concat_arrays([last["digest"], columns["digest"][:1]]),
                            pa.concat_arrays([last["text"], columns["text"][:1]]))
            check_equal(columns["hash"], columns["digest"], columns["text"])
            for number in np.unique(of):
                if number != owner:
                    if index is not None:
                        yield pages(owner, index)
                    owner, index, last = int(number), ExtendibleHash(room), None
                at = np.flatnonzero((of == number) & columns["count"].is_valid().to_numpy(zero_copy_only=False))
                if not len(at):
                    continue
                entries = np.zeros(len(at), ENTRY)
                entries["hash"], entries["digest"] = hashes[at], digests_of(columns["digest"].take(pa.array(at)))
                entries["address"] = spread(hashes[at].view(np.uint64), 11)
                ids = columns["keep_id"].take(pa.array(at))
                entries["keep_id"], entries["has_id"] = ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(False)
                entries["count"], entries["keep_tag"] = (columns[n].take(pa.array(at)).to_numpy() for n in ("count", "keep_tag"))
                entries["chain"] = numbers = chain_numbers(entries["hash"], *chain)
                chain = entries["hash"][-1], int(numbers[-1]) + 1
                index.insert(entries)
            last = {name: columns[name][-1:] for name in ("hash", "digest", "text")}
        if index is not None:
            yield pages(owner, index)

    return both.mapInArrow(run, "owner int, page int, depth int, entries binary")


def chain_numbers(hashes: np.ndarray, last: int | None, count: int) -> np.ndarray:
    """The number of each entry among those of its hash, which stand side by side; ``count`` entries of the hash ``last``
    came before."""
    new = np.append(True, hashes[1:] != hashes[:-1])
    numbers = np.arange(len(hashes)) - np.maximum.accumulate(np.where(new, np.arange(len(hashes)), 0))
    return numbers + np.where(hashes == last, count, 0) if last is not None else numbers


def check_equal(hashes: pa.Array, digests: pa.Array, texts: pa.Array) -> None:
    """Fails if neighbours agree in hash and digest but not in their bytes."""
    if len(hashes) < 2:
        return
    same = pc.and_(pc.equal(hashes[1:], hashes[:-1]), pc.equal(digests[1:], digests[:-1]))
    differ = pc.fill_null(pc.not_equal(texts[1:], texts[:-1]), False)  # a row of facts has no text
    if pc.any(pc.and_(same, differ)).as_py():
        raise ValueError("two different texts share a hash and a SHA-256")


def probe(index: DataFrame, rows: DataFrame, owners: int) -> DataFrame:
    """``rows`` (owner, hash, digest, ...) with the entry of each: group_size, keep_id, keep_tag, chain."""
    names, added = rows.columns, ["group_size", "keep_id", "keep_tag", "chain"]
    both = rows.unionByName(index, allowMissingColumns=True).repartitionById(owners, F.col("owner"))
    both = both.sortWithinPartitions("owner", F.col("entries").isNull(), "page")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, pages = None, None
        for batch in batches:
            of, entries, numbers = (batch.column(name) for name in ("owner", "entries", "page"))
            stored = entries.is_valid().to_numpy(zero_copy_only=False)
            of = of.to_numpy()
            for number in np.unique(of):
                mine = of == number
                for i in np.flatnonzero(mine & stored).tolist():
                    if numbers[i].as_py() < 0:
                        owner, pages = number, Pages(entries[i].as_py())
                    else:
                        pages.pages[numbers[i].as_py()] = np.frombuffer(entries[i].as_py(), ENTRY)
                at = np.flatnonzero(mine & ~stored)
                if not len(at):
                    continue
                if owner != number:
                    raise ValueError(f"the index has no range {number}")
                piece = batch.take(pa.array(at))
                found = pages.find(piece.column("hash").to_numpy(), digests_of(piece.column("digest")))
                values = [
                    pa.array(found["count"]), pa.array(found["keep_id"], mask=~found["has_id"]),
                    pa.array(found["keep_tag"]), pa.array(found["chain"]),
                ]
                yield pa.RecordBatch.from_arrays([*(piece.column(name) for name in names), *values], names=[*names, *added])

    schema = T.StructType([*rows.schema, *T.StructType.fromDDL("group_size long, keep_id long, keep_tag long, chain int")])
    return both.mapInArrow(run, schema)


def exact_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", into: str = "exact_dedup", *,
    with_text: bool = False, keys_per_owner: int = KEYS_PER_OWNER, room: int = ROOM, bits: int = 64,
) -> DataFrame:
    """The columns of ``docs`` without the text (or, at the price of writing all texts once more, with it), and a struct
    ``into``: keep_id (doc_id of the row that stays), group_size, kept, sha256 and chain (the text's number among the
    different texts of its hash, nearly always 0). ``bits`` shortens the hash, for tests of chains."""
    spark = docs.sparkSession
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    dropped = {into.lower()} if with_text else {into.lower(), text.lower()}
    kept = [F.col(f"`{name}`") for name in docs.columns if name.lower() not in dropped]
    key = F.xxhash64(content) if bits == 64 else F.shiftleft(F.shiftright(F.xxhash64(content), 64 - bits), 64 - bits)
    digest = F.unhex(F.sha2(content, 256))
    rows = docs.select(
        F.struct(*kept).alias("row"), F.col(f"`{doc_id}`").cast("long").alias("id"), key.alias("hash"),
        digest.alias("digest"), F.monotonically_increasing_id().alias("tag"),
    )
    rows = materialized(rows, "exact-rows")  # from here on every row has one tag, whatever is computed again
    total = rows.count()
    owners = max(-(-total // keys_per_owner), int(spark.conf.get("spark.sql.shuffle.partitions")))
    owner = F.shiftright(F.shiftrightunsigned("hash", 33) * owners, 31).cast("int").alias("owner")
    facts = rows.groupBy("hash", "digest").agg(
        F.count("*").alias("count"), F.max("id").alias("keep_id"),
        F.coalesce(F.max_by("tag", "id"), F.max("tag")).alias("keep_tag"),
    )
    facts = materialized(facts.select(owner, "*"), "exact-facts")
    texts = docs.select(key.alias("hash"), digest.alias("digest"), content.alias("text")).select(owner, "*")
    index = materialized(build_index(facts, texts, owners, room), "exact-index")

    hot = facts.filter(F.col("count") * HOT_SHARE > total).select("owner", "hash", "digest")
    hot = probe(index, hot, owners).drop("owner")  # fewer than HOT_SHARE rows
    cold = rows.join(F.broadcast(hot.select("hash", "digest")), ["hash", "digest"], "left_anti")
    found = probe(index, cold.select(owner, "*"), owners).drop("owner")
    found = found.unionByName(rows.join(F.broadcast(hot), ["hash", "digest"]))
    value = F.struct(
        "keep_id", "group_size", (F.col("tag") == F.col("keep_tag")).alias("kept"),
        F.lower(F.hex("digest")).alias("sha256"), "chain",
    )
    return found.select("row.*", value.alias(into))


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with one row of each group of equal texts."""
    return exact_dedup(docs, doc_id, text, "_dedup", with_text=True).filter("_dedup.kept").select(
        [f"`{name}`" for name in docs.columns]
    )
