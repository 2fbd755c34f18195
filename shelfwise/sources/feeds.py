"""Raw CSV feeds. Everything is read as text under an explicit contract; nothing is inferred."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from .. import schemas

CORRUPT = "_corrupt_record"
# Text as it stands: RFC 4180 quotes, and a header that must name the contract's columns in its order.
CSV_OPTIONS = {"header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"', "enforceSchema": "false"}


def _reader(spark: SparkSession, schema: T.StructType) -> DataFrameReader:
    return spark.read.schema(schema).options(**CSV_OPTIONS)


def read_bronze(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """One of the feeds ``Sales``, ``Items``, ``Store``, ``Client``; empty fields are NULL."""
    return _reader(spark, schemas.FEEDS[feed]).csv(path)


def read_bronze_strict(spark: SparkSession, path: str, feed: str, header: bool = True) -> DataFrame:
    """As :func:`read_bronze`, plus ``_corrupt_record`` with the whole line where the field count is wrong."""
    schema = T.StructType([*schemas.FEEDS[feed].fields, T.StructField(CORRUPT, T.StringType())])
    return (
        _reader(spark, schema)
        .option("mode", "PERMISSIVE")
        .option("header", header)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def file_headers(spark: SparkSession, path: str, at_once: int = 32) -> dict[str, tuple[str, ...]]:
    """The header of every data file at or below ``path``: one line per file, so no more than a listing of the files."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(hadoop)
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(hadoop)
    files, listed = [], system.listFiles(root, True)
    while listed.hasNext():
        status = listed.next()
        name = status.getPath().getName()
        if status.getLen() > 0 and not name.startswith(("_", ".")):
            files.append(status.getPath().toString())

    def header(file: str) -> tuple[str, ...]:
        place = jvm.org.apache.hadoop.fs.Path(file)
        stream, codec = system.open(place), codecs.getCodec(place)
        text = codec.createInputStream(stream) if codec else stream
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8"))
        try:
            line = lines.readLine() or ""
        finally:
            lines.close()
        return tuple(name.strip() for name in next(csv.reader([line.removeprefix("\ufeff")]), []))

    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(files, pool.map(header, files)))


def read_bronze_by_name(
    spark: SparkSession, path: str, feed: str, names: Mapping[str, str] | None = None, optional: frozenset[str] = frozenset()
) -> DataFrame:
    """As :func:`read_bronze_strict` for files of several versions of the contract, each understood by its own header.

    Columns may stand in any order. Other columns are left out, though a line must have a field for each. ``names`` gives
    the contract's name for a renamed one; columns in ``optional`` may be missing and are NULL then. Letter case does not
    matter. A file without a column that must be there, or with one twice, fails the load before it starts.

    Files with the same header are read as one table, so the plan grows with the versions, not with the files.
    """
    contract = schemas.FEEDS[feed].fieldNames()
    known = {name.lower(): name for name in contract} | {old.lower(): name for old, name in (names or {}).items()}
    versions: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for file, header in file_headers(spark, path).items():
        versions[header].append(file)

    def read(header: tuple[str, ...], files: list[str]) -> DataFrame:
        found = [known.get(name.lower()) for name in header]
        for name in contract:
            if found.count(name) > 1 or not (name in found or name in optional):
                raise ValueError(f"{feed}: column {name!r} is {'there twice' if name in found else 'missing'} in {files[0]}")
        # Names only have to be apart here: the header itself is skipped, as its columns have been looked up already.
        columns = [f"_{i}" for i in range(len(header))]
        schema = T.StructType([T.StructField(name, T.StringType()) for name in [*columns, CORRUPT]])
        lines = _reader(spark, schema).options(
            enforceSchema="true", mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
            columnPruning="false",  # or a line's fields would be counted among the columns that are used only
        ).csv(files)
        return lines.select(
            *[(F.col(columns[found.index(name)]) if name in found else F.lit(None).cast("string")).alias(name) for name in contract],
            CORRUPT,
        )

    if not versions:
        return spark.createDataFrame([], T.StructType([*schemas.FEEDS[feed].fields, T.StructField(CORRUPT, T.StringType())]))
    return reduce(DataFrame.unionByName, [read(header, sorted(files)) for header, files in sorted(versions.items())])


def read_feeds(
    spark: SparkSession, folder: str, by_name: bool = False, names: Mapping[str, Mapping[str, str]] | None = None
) -> dict[str, DataFrame]:
    """The four feeds; sales with their broken lines marked, for the load to put them in quarantine.

    ``by_name`` takes files whose columns stand in another order or under other ``names`` (by feed), see
    :func:`read_bronze_by_name`; otherwise such files fail the load.
    """
    if by_name:
        named = {
            feed: read_bronze_by_name(spark, f"{folder}/{feed}.csv", feed, (names or {}).get(feed)) for feed in schemas.FEEDS
        }
        return {feed: rows if feed == "Sales" else rows.drop(CORRUPT) for feed, rows in named.items()}
    masters = {feed: read_bronze(spark, f"{folder}/{feed}.csv", feed) for feed in schemas.FEEDS if feed != "Sales"}
    return {"Sales": read_bronze_strict(spark, f"{folder}/Sales.csv", "Sales"), **masters}
