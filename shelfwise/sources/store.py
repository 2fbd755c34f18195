"""The stored tables, as snapshots: a load shows all its tables at once, when it is done, or none of them.

A load writes every table, or the months of it that change, into new folders and never into those of an earlier load.
It is committed by a manifest, which lists the folders of all tables; the manifest with the highest number is the
current one. Readers take their folders from one manifest, so that tables read together belong together, and go on
reading them while later loads are written. ``clean_up`` removes folders that only older manifests list, and what
loads that were broken off have left.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from .. import schemas
from ..settings import PORTION_BYTES, PRICE_SCALE, STORED_FILES
from .shared import release_shuffles

MANIFESTS = "_snapshots"
KEPT = 2  # snapshots that a clean-up leaves: the current one, and the one before for those who still read it
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # how Spark names the folder of a partition without a value


class Files:
    """The few operations on the file system of a path, local or not, that Spark has no reader or writer for."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._bytes = spark._jvm.org.apache.commons.io.IOUtils

    def names(self, pattern: str) -> list[str]:
        """The paths that match a pattern."""
        return [str(status.getPath().toString()) for status in self._system.globStatus(self._path(pattern)) or []]

    def size(self, path: str) -> int:
        return self._system.getContentSummary(self._path(path)).getLength()

    def read(self, path: str) -> str:
        stream = self._system.open(self._path(path))
        try:
            return self._bytes.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, text: str, path: str) -> None:
        """Writes a small file that is either there in full or not at all; fails if there is one already."""
        draft = f"{path.rsplit('/', 1)[0]}/.draft-{uuid.uuid4().hex}"
        stream = self._system.create(self._path(draft), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self._system.exists(self._path(path)) or not self._system.rename(self._path(draft), self._path(path)):
            self._system.delete(self._path(draft), False)
            raise FileExistsError(f"another load was committed first: {path}")

    def delete(self, path: str) -> None:
        self._system.delete(self._path(path), True)


def _partition(name: str, month: Sequence[int | None]) -> str:
    """The folder of a month below that of a version."""
    return "/".join(
        f"{column}={NO_VALUE if value is None else value}" for column, value in zip(schemas.PARTITIONS[name], month)
    )


def month_of(part: str) -> tuple[int | None, ...]:
    """The month whose folder that is."""
    values = [step.split("=", 1)[1] for step in part.split("/")]
    return tuple(None if value == NO_VALUE else int(value) for value in values)


class Snapshot:
    """The tables of one load, as {table: {folder of a month, or '': [versions]}}; ``audited`` has the folders of the
    fact that the stored audit of its grain was made from."""

    def __init__(
        self, spark: SparkSession, root: str, number: int, tables: dict[str, dict[str, list[str]]],
        audited: dict[str, list[str]] | None = None,
    ):
        self.spark, self.root, self.number, self.tables, self.audited = spark, root, number, tables, audited or {}
        self._read: dict[tuple[str, int], DataFrame] = {}

    def has(self, name: str) -> bool:
        return name in self.tables

    def folders(self, name: str) -> list[str]:
        parts = self.tables.get(name, {})
        return [f"{name}/version={version}/{part}".rstrip("/") for part in sorted(parts) for version in parts[part]]

    def table(self, name: str, price_scale: int = PRICE_SCALE) -> DataFrame:
        """A table under its contract. Files are listed once for each snapshot opened."""
        if (name, price_scale) not in self._read:
            contract = schemas.tables(price_scale)[name]
            paths = [f"{self.root}/{folder}" for folder in self.folders(name)]
            if paths:
                stored = self.spark.read.schema(contract).option("basePath", f"{self.root}/{name}").parquet(*paths)
            else:
                stored = self.spark.createDataFrame([], contract)
            self._read[name, price_scale] = stored.select([f"`{column}`" for column in contract.fieldNames()])
        return self._read[name, price_scale]

    def share(self, other: Snapshot) -> None:
        """Takes over the tables that another snapshot has opened and that are the same here."""
        self._read |= {key: df for key, df in other._read.items() if self.tables.get(key[0]) == other.tables.get(key[0])}

    def star(self, price_scale: int = PRICE_SCALE) -> dict[str, DataFrame]:
        return {name: self.table(name, price_scale) for name in schemas.STAR}

    def stored_bytes(self, name: str) -> int:
        files = Files(self.spark, self.root)
        return sum(files.size(f"{self.root}/{folder}") for folder in self.folders(name))

    def portions(self, name: str, months: Iterable[Sequence[int | None]] | None, at_most: int, least: int) -> list[list[tuple]]:
        """These months of a table, or all, in order and in ``at_most`` portions of about the same size on disk, none of
        which (but the last) has less than ``least`` bytes."""
        files, parts = Files(self.spark, self.root), self.tables.get(name, {})
        chosen = sorted({month_of(part): part for part in parts} if months is None else {tuple(month) for month in months}, key=str)
        sizes = [
            sum(files.size(f"{self.root}/{name}/version={version}/{part}") for version in parts.get(part, []))
            for part in (_partition(name, month) for month in chosen)
        ]
        enough, held = max(least, -(-sum(sizes) // at_most)), 0
        portions: list[list[tuple]] = [[]]
        for month, size in zip(chosen, sizes):
            if held >= enough:
                portions.append([])
                held = 0
            portions[-1].append(month)
            held += size
        return portions


def snapshot_numbers(spark: SparkSession, root: str) -> list[int]:
    found = Files(spark, root).names(f"{root}/{MANIFESTS}/*.json")
    return sorted(int(path.rsplit("/", 1)[1].removesuffix(".json")) for path in found)


def open_snapshot(spark: SparkSession, root: str, number: int | None = None) -> Snapshot | None:
    """The current snapshot, or the one of a number; None before the first load."""
    if number is None:
        numbers = snapshot_numbers(spark, root)
        if not numbers:
            return None
        number = numbers[-1]
    manifest = json.loads(Files(spark, root).read(f"{root}/{MANIFESTS}/{number:09d}.json"))
    return Snapshot(spark, root, number, manifest["tables"], manifest.get("audited"))


class Load:
    """A load in progress: what it writes is seen through ``table`` at once, and by others after ``commit``."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.root, self.name = spark, root, name
        self.base = open_snapshot(spark, root)
        self.number = self.base.number + 1 if self.base else 1
        self.tables = {key: dict(parts) for key, parts in self.base.tables.items()} if self.base else {}
        self.audited = dict(self.base.audited) if self.base else {}
        self._state: Snapshot | None = None
        self._unreleased = 0  # bytes written since shuffle files were given back

    def state(self) -> Snapshot:
        """The tables as this load has written them so far."""
        if self._state is None or self._state.tables != self.tables:
            now = Snapshot(self.spark, self.root, self.number, {key: dict(parts) for key, parts in self.tables.items()}, self.audited)
            if self._state is not None:
                now.share(self._state)
            self._state = now
        return self._state

    def table(self, name: str, price_scale: int = PRICE_SCALE) -> DataFrame:
        return self.state().table(name, price_scale)

    def write(
        self, df: DataFrame, name: str, *, months: Iterable[Sequence[int | None]] | None = None, add: bool = False,
        spread: bool = True, cell: Column | None = None, after: Mapping[str, Column] | None = None,
    ) -> None:
        """Replaces a table, or with ``months`` these of its months, which may end without rows; with ``add`` nothing.

        A partitioned table is rebalanced first: every output file then holds one month, small months end in one
        file and large ones are split over many tasks at the advisory partition size. ``spread=False`` leaves that
        out, for rows that already come from month files. Rows of a file are sorted by month and
        ``cell`` (see ``functions.zorder``), which is computed once for each row. Columns in ``after`` are computed where
        the rows are then, from the others.

        Shuffle files are given back whenever so much is written, or those of all tables would stay until the load ends.
        """
        partitions = schemas.PARTITIONS.get(name, [])
        names, after = schemas.tables()[name].fieldNames(), after or {}
        df = df.select([f"`{column}`" for column in names if column not in after])
        if partitions and spread:
            df = df.hint("rebalance", *partitions)
        if after:
            df = df.withColumns(dict(after)).select([f"`{column}`" for column in names])
        if cell is not None:
            df = df.withColumn("_cell", cell).sortWithinPartitions(*partitions, "_cell").drop("_cell")
        version = f"v{self.number}_{uuid.uuid4().hex[:12]}"
        folder = f"{self.root}/{name}/version={version}"
        df.write.partitionBy(*partitions).options(**STORED_FILES).parquet(folder)
        self._unreleased += Files(self.spark, self.root).size(folder)
        if self._unreleased >= PORTION_BYTES:
            release_shuffles(self.spark)
            self._unreleased = 0
        if partitions:
            found = Files(self.spark, self.root).names(folder + "/*=*" * len(partitions))
            written = ["/".join(path.rsplit("/", len(partitions))[1:]) for path in found]
        else:
            written = [""]
        parts = self.tables.setdefault(name, {})
        if not add:
            gone = list(parts) if months is None else [_partition(name, month) for month in months]
            for part in gone:
                parts.pop(part, None)
        for part in written:
            parts[part] = [*parts.get(part, []), version]

    def commit(self, keep: int = KEPT) -> Snapshot:
        """Shows what was written, in one step, and removes what only older snapshots need. Fails if another load was
        committed since this one began."""
        manifest = {"number": self.number, "load": self.name, "tables": self.tables, "audited": self.audited}
        path = f"{self.root}/{MANIFESTS}/{self.number:09d}.json"
        Files(self.spark, self.root).publish(json.dumps(manifest, indent=1), path)
        clean_up(self.spark, self.root, keep)
        return self.state()


def clean_up(spark: SparkSession, root: str, keep: int = KEPT) -> None:
    """Removes all snapshots but the last ``keep``, and every folder that none of these lists; folders of loads that may
    still run, which have a higher number than the current snapshot, stay."""
    files, numbers = Files(spark, root), snapshot_numbers(spark, root)
    if not numbers:
        return
    kept = [open_snapshot(spark, root, number) for number in numbers[-keep:]]
    for number in numbers[:-keep]:
        files.delete(f"{root}/{MANIFESTS}/{number:09d}.json")
    used = {folder for one in kept for name in one.tables for folder in one.folders(name)}
    whole = {"/".join(folder.split("/")[:2]) for folder in used}
    for name in schemas.tables():
        for path in files.names(f"{root}/{name}/version=*"):
            version = path.rsplit("/", 1)[1]
            if int(version.removeprefix("version=v").split("_")[0]) > numbers[-1]:
                continue
            if f"{name}/{version}" not in whole:
                files.delete(path)
                continue
            depth = len(schemas.PARTITIONS.get(name, []))
            for part in files.names(path + "/*=*" * depth) if depth else []:
                if "/".join(part.rsplit("/", depth + 2)[1:]) not in used:
                    files.delete(part)


def _current(spark: SparkSession, root: str) -> Snapshot:
    found = open_snapshot(spark, root)
    if found is None:
        raise FileNotFoundError(f"nothing is loaded below {root}")
    return found


def read_table(spark: SparkSession, root: str, name: str, price_scale: int = PRICE_SCALE) -> DataFrame:
    """One table of the current snapshot. For tables that are used together, open the snapshot once."""
    return _current(spark, root).table(name, price_scale)


def read_star(spark: SparkSession, root: str, price_scale: int = PRICE_SCALE) -> dict[str, DataFrame]:
    return _current(spark, root).star(price_scale)
