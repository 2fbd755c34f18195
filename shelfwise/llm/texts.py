"""Words, lines and Arrow helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# The white space of every contract here, and how upper case is folded.
WHITE_SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ODD = 0x9E3779B97F4A7C15  # 2**64 divided by the golden ratio


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def folded(text: str | None) -> bytes:
    """UTF-8 of the text with A-Z, and nothing else, in lower case."""
    return (text or "").encode().lower()


def words_of(data: bytes) -> list[bytes]:
    """Words between ASCII white space, which is what ``bytes.split`` splits at."""
    return data.split()


def spread(values: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of each value: equal values stay equal, all bits depend on all bits."""
    x = values.astype(np.uint64, copy=True) + np.uint64(seed * ODD % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: Iterable[bytes], known: dict[bytes, int]) -> np.ndarray:
    """64-bit hashes; ``known`` holds those of words seen before and is emptied when large."""
    if len(known) > 200_000:
        known.clear()
    found = []
    for word in words:
        value = known.get(word)
        if value is None:
            value = known[word] = xxhash.xxh3_64_intdigest(word)
        found.append(value)
    return np.array(found, dtype=np.uint64)


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of every window of ``size`` words; shorter texts give their whole sequence as one."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    mixed = spread(hashes[: len(hashes) - size + 1], size)
    for i in range(1, size):
        mixed = spread(mixed ^ hashes[i : len(hashes) - size + 1 + i], i)
    return mixed


def portions(texts: pa.Array, most: int = 2_000_000) -> Iterator[list[str]]:
    """The texts as Python strings ('' for null), in lists of about ``most`` characters, so that what is built from a
    list stays small whatever the batch holds."""
    part, size = [], 0
    for value in texts:
        text = value.as_py() or ""
        part.append(text)
        size += len(text)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def row_key(*columns: str) -> list[Column]:
    """Two longs that tell rows apart by content. Rows equal in all these columns share a key, which is right wherever
    equal rows get equal results."""
    return [F.xxhash64(F.lit(seed), *[F.col(f"`{name}`") for name in columns]) for seed in (1, 2)]


def with_struct(df: DataFrame, into: str, value: Column) -> DataFrame:
    """``df`` with ``value`` as column ``into``; a column of that name, in either case, is replaced."""
    kept = [F.col(f"`{name}`") for name in df.columns if name.lower() != into.lower()]
    return df.select(*kept, value.alias(into))


def appended(
    df: DataFrame, into: str, kind: str, run: Callable[[pa.RecordBatch], pa.Array], text: str | None = None,
    most_rows: int = 4096,
) -> DataFrame:
    """``df`` with ``run`` of its rows as column ``into`` of the type ``kind``; a column of that name, in either case, is
    replaced. ``run`` gets pieces of a batch of at most ``most_rows`` rows or, with ``text``, of about two million
    characters, and each piece leaves the worker before the next is begun."""
    names = [name for name in df.columns if name.lower() != into.lower()]
    schema = T.StructType([df.schema[name] for name in names]).add(into, T.DataType.fromDDL(kind))

    def sizes(batch: pa.RecordBatch) -> Iterator[int]:
        if text is not None:
            yield from (len(part) for part in portions(batch.column(batch.schema.get_field_index(text))))
        else:
            yield from (min(most_rows, batch.num_rows - at) for at in range(0, batch.num_rows, most_rows))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for size in sizes(batch):
                piece = batch.slice(start, size)
                start += size
                yield pa.RecordBatch.from_arrays([*piece.columns, run(piece)], names=[*names, into])

    return df.select([F.col(f"`{name}`") for name in names]).mapInArrow(emit, schema)
