"""Vector code compression: product codes by clustering integer parts, assigned through memoised grid cells.

Vectors become integers and are cut into equal parts. For every position of a part a codebook is trained over all
vectors: a part goes to its nearest entry, each entry moves to the mean of its parts. To assign a part, its coarse cell (a
box whose side is a power of two) is hashed and looked up in a cache. For a cell seen for the first time, the smallest
and largest distance from the box to every entry are computed; an entry whose smallest distance exceeds another's
largest one is dominated and can be nearest to no point of the box. Only the other entries are evaluated exactly. The
cells are compared by their coordinates, not only by their hash, so that the result is exact.

Tasks send one row of sums for each component of an entry; the driver holds the codebooks only. The side of the cells is
chosen by each task, at what costs least on its first rows: small cells leave few entries, large ones are met again.

Defined results: vectors that are null or hold null, NaN or infinite components are left out. All others must have one
length, a multiple of the number of parts, and components below 2**13 in absolute value, so that distances and sums are
exact in 64 bits; otherwise the job fails. The first codebook has the vectors of the smallest ids (null ids last, ties
by content); with fewer vectors it has fewer entries. Repeated rows count repeatedly; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.shared import materialized
from .texts import appended, spread

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
LIMIT = SCALE << 13
CELLS = 1 << 16  # cells that a task remembers for each part
SIDES = range(5, 15)  # powers of two that a cell's side is chosen from
TRIED_ROWS = 1024
HOT_SHARE = 4096
FARTHEST = np.iinfo(np.int64).max


def integers(column: pa.Array, parts: int) -> np.ndarray:
    """The vectors of a column as rows of integers."""
    sizes = np.unique(column.value_lengths().to_numpy())
    if len(sizes) > 1 or sizes[0] % parts:
        raise ValueError(f"vectors must have one length, a multiple of {parts}: {sizes.tolist()}")
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    found = np.floor(SCALE * values)
    if len(found) and np.abs(found).max() > LIMIT:
        raise ValueError(f"components beyond {LIMIT // SCALE} have no exact distances")
    return found.astype(np.int64).reshape(len(column), int(sizes[0]))


def distances(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    apart = points - entry
    return np.einsum("ij,ij->i", apart, apart)


@dataclass
class Cells:
    """The cache of one part: cells and, as bits, the entries that are not dominated in each."""

    codebook: np.ndarray
    side: int | None = None
    place: dict[int, int] = field(default_factory=dict)
    cells: np.ndarray | None = None
    masks: np.ndarray | None = None

    def undominated(self, cells: np.ndarray, side: int) -> np.ndarray:
        """Bits of the entries that can be nearest to a point of each cell, ties included."""
        low = (cells << side)[:, None, :]
        high = low + ((1 << side) - 1)
        entries = self.codebook[None, :, :]
        nearest = np.maximum(np.maximum(low - entries, entries - high), 0)
        farthest = np.maximum(np.abs(entries - low), np.abs(high - entries))
        least, most = (nearest**2).sum(2), (farthest**2).sum(2)
        open_ = least <= most.min(1)[:, None]
        return (open_ << np.arange(len(self.codebook))).sum(1)

    def choose_side(self, points: np.ndarray) -> int:
        """The side that costs least: an entry evaluated for a point counts 1, one bounded for a new cell 4."""
        costs = {}
        for side in SIDES:
            cells, times = np.unique(points >> side, axis=0, return_counts=True)
            masks = self.undominated(cells, side)
            evaluated = sum((masks >> i & 1) @ times for i in range(len(self.codebook)))
            costs[side] = int(evaluated) + 4 * len(cells) * len(self.codebook)
        return min(costs, key=costs.get)

    def masks_of(self, points: np.ndarray) -> np.ndarray:
        """The entries to evaluate for each point."""
        if self.side is None:
            self.side = self.choose_side(points[:TRIED_ROWS])
            self.cells = np.zeros((CELLS, points.shape[1]), np.int64)
            self.masks = np.zeros(CELLS, np.int64)
        cells = points >> self.side
        hashes = np.zeros(len(points), np.uint64)
        for i in range(points.shape[1]):
            hashes = spread(hashes ^ cells[:, i].view(np.uint64), i + 1)
        hashes, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.place) + len(hashes) > CELLS:
            self.place.clear()
        known = [self.place.get(value) for value in hashes.tolist()]
        new = np.array([i for i, at in enumerate(known) if at is None], np.int64)
        if len(new):
            at = len(self.place) + np.arange(len(new))
            self.cells[at] = cells[first[new]]
            self.masks[at] = self.undominated(self.cells[at], self.side)
            for i, place in zip(new.tolist(), at.tolist()):
                known[i] = self.place[int(hashes[i])] = place
        place = np.array(known, np.int64)[back]
        same = (self.cells[place] == cells).all(1)  # not so where two cells share a hash
        return np.where(same, self.masks[place], (1 << len(self.codebook)) - 1)

    def assign(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each point, the first of equally near ones, and its squared distance."""
        masks = self.masks_of(points)
        best, nearest = np.full(len(points), FARTHEST), np.zeros(len(points), np.int64)
        for i, entry in enumerate(self.codebook):
            at = np.flatnonzero(masks >> i & 1)
            apart = distances(points[at], entry)
            closer = apart < best[at]
            best[at[closer]], nearest[at[closer]] = apart[closer], i
        return nearest, best


class Coder:
    """The parts of vectors against their codebooks, an array of (parts, entries, positions)."""

    def __init__(self, codebooks: np.ndarray):
        self.parts = [Cells(codebook) for codebook in codebooks]

    def assign(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(points, nearest, distance) of each part."""
        for cells, points in zip(self.parts, np.split(vectors, len(self.parts), axis=1)):
            points = np.ascontiguousarray(points)
            yield points, *cells.assign(points)


def usable(vector: str) -> F.Column:
    value = F.col(f"`{vector}`")

    def finite(x: F.Column) -> F.Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return value.isNotNull() & F.forall(value, finite)


def first_codebooks(vectors: DataFrame, vec_id: str, vector: str, parts: int, entries: int) -> np.ndarray:
    """The parts of the vectors with the smallest ids: at most ``entries`` rows come to the driver."""
    order = [F.col(f"`{vec_id}`").asc_nulls_last(), F.col(f"`{vector}`")]
    rows = vectors.select(f"`{vec_id}`", f"`{vector}`").orderBy(*order).limit(entries).toArrow()
    if not rows.num_rows:
        return np.zeros((parts, 0, 0), np.int64)
    found = integers(rows.column(1).combine_chunks(), parts)
    return found.reshape(len(found), parts, -1).transpose(1, 0, 2)


def moved(vectors: DataFrame, vector: str, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round: every entry at the mean of its parts, rounded down; unused ones stay."""
    parts, entries, width = codebooks.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(codebooks)
        total, count = np.zeros_like(codebooks), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                found = coder.assign(integers(batch.column(0).slice(start, 4096), parts))
                for part, (points, nearest, _) in enumerate(found):
                    order = np.argsort(nearest, kind="stable")
                    used, begin, times = np.unique(nearest[order], return_index=True, return_counts=True)
                    total[part, used] += np.add.reduceat(points[order], begin, axis=0)
                    count[part, used] += times
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part * entries + entry), pa.array(count[part, entry]),
             pa.array(list(total[part, entry]), pa.list_(pa.int64()))], names=["at", "count", "total"],
        )

    found = vectors.select(f"`{vector}`").mapInArrow(sums, "at long, count long, total array<long>")
    counts = found.select("at", "count", F.posexplode("total").alias("i", "value")).groupBy("at", "i")
    wide = "decimal(38,0)"  # sums over all vectors of a large table need not fit 64 bits
    means = counts.agg(F.sum("count").alias("count"), F.sum(F.col("value").cast(wide)).alias("total"))
    result = codebooks.copy()
    for row in means.collect():  # one row for each component of a codebook
        result[row.at // entries, row.at % entries, row.i] = int(row.total) // row["count"]
    return result


def trained(
    vectors: DataFrame, vec_id: str, vector: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> np.ndarray:
    """Codebooks of (parts, entries, positions) over all usable vectors."""
    vectors = vectors.filter(usable(vector))
    codebooks = first_codebooks(vectors, vec_id, vector, parts, entries)
    for _ in range(rounds if codebooks.size else 0):
        codebooks = moved(vectors, vector, codebooks)
    return codebooks


def compressed(vectors: DataFrame, codebooks: np.ndarray, vector: str = "embedding", into: str = "code") -> DataFrame:
    """The usable rows of ``vectors`` with a struct ``into``: the code, as two hex digits for each part, and the squared
    distance to what it stands for. Other columns stay."""
    digits = np.array([f"{i:02x}" for i in range(256)])
    if codebooks.shape[1] > len(digits):
        raise ValueError("a code has two hex digits, for 256 entries at most")
    coders: list[Coder] = []  # one for each task, made where it runs

    def run(piece: pa.RecordBatch) -> pa.Array:
        if not coders:
            coders.append(Coder(codebooks))
        found = integers(piece.column(piece.schema.get_field_index(vector)), len(codebooks))
        codes, error = np.full(len(found), "", object), np.zeros(len(found), np.int64)
        for _, nearest, apart in coders[0].assign(found):
            codes, error = codes + digits[nearest].astype(object), error + apart
        return pa.StructArray.from_arrays([pa.array(codes, pa.string()), pa.array(error)], names=["code", "error"])

    return appended(vectors.filter(usable(vector)), into, "struct<code:string,error:bigint>", run)


def codebooks_text(codebooks: np.ndarray) -> str:
    return ",".join(map(str, codebooks.ravel().tolist()))


def codebooks_sha256(codebooks: np.ndarray) -> str:
    return hashlib.sha256(codebooks_text(codebooks).encode()).hexdigest()


def decoded(code: str, codebooks: np.ndarray) -> np.ndarray:
    """The vector that a code stands for."""
    return np.concatenate([codebook[entry] for codebook, entry in zip(codebooks, bytes.fromhex(code))]) / SCALE


def with_label_error(rows: DataFrame, label: str, error: str, into: str) -> DataFrame:
    """``rows`` with the sum of ``error`` over all rows of the same label, nulls together. Sums are combined before the
    shuffle; labels with more than 1/4096 of all rows are joined by a broadcast, as there are fewer than 4096."""
    rows = materialized(rows, "vector-codes")
    sums = rows.groupBy(F.col(label).alias("_label")).agg(F.sum(error).alias(into), F.count("*").alias("_rows"))
    sums = materialized(sums, "label-errors")
    hot = F.col("_rows") * HOT_SHARE > rows.count()
    same = F.col(label).eqNullSafe(F.col("_label"))
    few = F.broadcast(sums.filter(hot))
    found = rows.join(few, same)
    rest = rows.join(few, same, "left_anti").join(sums.filter(~hot), same)
    return found.unionByName(rest).drop("_label", "_rows")
