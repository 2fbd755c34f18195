"""Z-order: rows sorted so that a filter on any one of several columns skips most of a file.

A sort by (brand, city) keeps brands together and scatters cities and clients over the whole file. Here each column is cut
into ranges of values and the numbers of a row's ranges are interleaved bit by bit, so that neighbouring rows are near each
other in all columns, and the smallest and largest values of a row group or page rule it out for most filters.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

BITS = 5  # 32 ranges for each column
SAMPLE = 1024  # values that the ranges of a column are cut from


def boundaries(values: Mapping[str, DataFrame]) -> dict[str, list[str]]:
    """Where each column's values are cut into ranges, from its distinct values in ``{column: frame}``: all of them, or
    the ``SAMPLE`` with the smallest hashes, which are drawn evenly. The driver gets no more than these. They say where
    rows lie in a file and have no effect on results."""
    drawn = reduce(DataFrame.unionByName, [
        frame.where(F.col(column).isNotNull()).select(F.lit(column).alias("Name"), F.col(column).alias("Value"))
        .distinct().orderBy(F.xxhash64("Value"), "Value").limit(SAMPLE)
        for column, frame in values.items()
    ])
    found: dict[str, list[str]] = {column: [] for column in values}
    for row in drawn.collect():
        found[row.Name].append(row.Value)
    return {column: _cuts(sorted(listed, key=str.encode)) for column, listed in found.items()}


def _cuts(listed: Sequence[str], ranges: int = 2**BITS) -> list[str]:
    """The first values of all ranges but the first, in the order in which Spark compares text."""
    return list(dict.fromkeys(listed[len(listed) * i // ranges] for i in range(1, ranges) if len(listed) * i // ranges))


def _spread(number: int, columns: int) -> int:
    """The bits of a range's number, with room between them for those of the other columns."""
    return sum((number >> bit & 1) << bit * columns for bit in range(BITS))


def _part(value: Column, cuts: Sequence[str], columns: int, place: int, first: int = 0) -> Column:
    """What a column adds to the number of a cell. The range is found by halving, its bits are constants; a NULL is in
    the first range."""
    if not cuts:
        return F.lit(_spread(first, columns) << place)
    middle = len(cuts) // 2
    return F.when(value >= cuts[middle], _part(value, cuts[middle + 1:], columns, place, first + middle + 1)).otherwise(
        _part(value, cuts[:middle], columns, place, first)
    )


def cell(values: Mapping[str, DataFrame]) -> Column:
    """The number of a row's cell, for rows with these columns."""
    cuts = boundaries(values)
    parts = [_part(F.col(column), cuts[column], len(cuts), place) for place, column in enumerate(cuts)]
    return reduce(Column.__add__, parts)
