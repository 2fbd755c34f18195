"""Fill-in-the-middle transformation: documents cut at two units into prefix, middle and suffix, and put in new order.

A unit is a run of ASCII letters or any other single code point. A text is cut into fixed blocks; a Fenwick tree over them
holds how many units begin in each block and how many code points it has. A cut given in units descends the tree in
powers of two to the block where that unit begins, and only this block is searched for the place. Prefixes of the tree
need no pass over the text, and a text of any length keeps two numbers for each block besides itself.

Defined results: a null or empty text is plain, with no units. A null doc_id draws as the empty string. Rows that share a
doc_id draw the same numbers. Repeated rows give repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .texts import appended

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = MARKS = "<P>", "<S>", "<M>"
SEED = "1:"
FIM_PERCENT, SPM_PERCENT = 90, 20
BLOCK = 1024
AT_ONCE = 256 * BLOCK  # code points looked at in one step while counting


def unit_starts(text: str, after_letter: bool) -> np.ndarray:
    """At which code points units begin, given whether a letter stands before the text."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    folded = codes | np.uint32(32)
    letter = (folded >= ord("a")) & (folded <= ord("z"))
    before = np.append(after_letter, letter[:-1])
    return ~(letter & before)


def is_letter(char: str) -> bool:
    return char.isascii() and char.isalpha()


class Blocks:
    """A Fenwick tree over the blocks of a text, of units and code points."""

    def __init__(self, text: str, block: int = BLOCK):
        self.text, self.block = text, block
        units, step = [], max(AT_ONCE // block, 1) * block
        for start in range(0, len(text), step):
            part = text[start : start + step]
            starts = unit_starts(part, start > 0 and is_letter(text[start - 1]))
            units.append(np.add.reduceat(starts.astype(np.int64), np.arange(0, len(part), block)))
        units = np.concatenate(units) if units else np.array([], np.int64)
        self.count = len(units)
        points = np.full(self.count, block, np.int64)
        points[-1:] = len(text) - block * (self.count - 1)
        self.units, self.points = self.tree(units), self.tree(points)
        self.n_units = int(units.sum())

    @staticmethod
    def tree(values: np.ndarray) -> list[int]:
        """Node i, from 1, holds the sum of as many values up to the i-th as its lowest set bit says."""
        sums = np.concatenate([[0], np.cumsum(values)])
        node = np.arange(1, len(sums))
        return [0, *(sums[node] - sums[node - (node & -node)]).tolist()]

    def place(self, unit: int) -> int:
        """The code point where a unit begins, the end of the text for the number of units."""
        block, left, point = 0, unit, 0
        step = 1 << self.count.bit_length()
        while step:
            node = block + step
            if node <= self.count and self.units[node] <= left:
                block, left, point = node, left - self.units[node], point + self.points[node]
            step >>= 1
        if block == self.count:
            return point
        part = self.text[point : point + self.block]
        starts = unit_starts(part, point > 0 and is_letter(self.text[point - 1]))
        return point + int(np.flatnonzero(starts)[left])


def draws(seed: str, doc_id: int | None) -> list[int]:
    """Four numbers below 2**32 that follow from the document's id."""
    digest = hashlib.sha256(f"{seed}{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(4)]


def transform(
    doc_id: int | None, text: str, seed: str, fim_percent: int, spm_percent: int
) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of prefix and of middle, output) of one document."""
    blocks = Blocks(text)
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not text or any(mark in text for mark in MARKS) or h3 % 100 >= fim_percent:
        return blocks.n_units, "plain", None, None, text
    first, second = sorted((h1 % (blocks.n_units + 1), h2 % (blocks.n_units + 1)))
    begin, end = blocks.place(first), blocks.place(second)
    prefix, middle, suffix = text[:begin], text[begin:end], text[end:]
    if h4 % 100 < spm_percent:
        return blocks.n_units, "spm", begin, end - begin, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return blocks.n_units, "psm", begin, end - begin, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


KIND = "struct<n_units:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"


def fill_in_middle(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", into: str = "fim",
    seed: str = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """``docs`` with a struct ``into``: the number of units, the form (plain, psm or spm), the code points of prefix and
    middle (null if plain) and the transformed text. Other columns stay; there is no shuffle.

    ``fim_percent`` of the documents are transformed, ``spm_percent`` of these with the suffix first; texts that hold
    a mark stay plain, so that every output can be taken apart again (``restored``).
    """

    def run(piece: pa.RecordBatch) -> pa.Array:
        ids = piece.column(piece.schema.get_field_index(doc_id)).to_pylist()
        texts = piece.column(piece.schema.get_field_index(text))
        rows = [
            transform(number, one.as_py() or "", seed, fim_percent, spm_percent) for number, one in zip(ids, texts)
        ]
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
        return pa.StructArray.from_arrays(columns, names=["n_units", "form", "prefix_chars", "middle_chars", "output"])

    return appended(docs, into, KIND, run, text)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. No mark overlaps itself and no text in the form psm or spm holds one, so
    that the first mark found is the one that was put there."""

    def after(value: Column, skipped: Column | int) -> Column:
        return F.substr(value, F.lit(1 + len(PREFIX)) + skipped)

    def apart(second: str) -> tuple[Column, Column, Column]:
        body = after(output, 0)
        one = F.substring_index(body, second, 1)
        rest = after(body, F.char_length(one))
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, after(rest, F.char_length(two))

    prefix, suffix, middle = apart(SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = apart(PREFIX)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
