"""Benchmark decontamination: a BM25 index of test items, searched with every passage by block-max WAND.

The items are cut into units of up to 64 words, the documents into passages of 128 words that begin every 64, so any
unit's text lies in a passage as a whole. A unit's BM25 score for a passage, taken as the set of its words, is divided by
the unit's score for its own text: 1 means that all its words are there. Every unit that reaches the threshold is retrieved;
there is no top-k. Block-max WAND skips units whose upper bounds cannot reach it: a pivot is chosen by the largest
impacts of each word, checked by the largest impacts within the pivot's block of units, and only then scored. Most
passages end before that, as a vectorised look at the same block bounds shows that no block can reach the threshold.

What is retrieved is verified on the whole document: the shares of the five-word shingles of the question and of the answer
that occur in it. The answer is the last line of an item, or the last fifth of its words if it has one line.

The index goes to every task, in blocks of items with a bounded number of words; a pass over the documents serves a block,
so memory does not grow with the benchmark. Document frequencies are those of the whole benchmark.

Defined results: null or empty documents hold no leak. Items of fewer than ``min_words`` words are no evidence and are
left out. Every row is a document, and every row of the benchmark an item: repeated rows give repeated results. Either
table may be empty.
"""

from __future__ import annotations

import functools
import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .texts import row_key, shingle_hashes, word_hashes

K1, B = 1.2, 0.75
UNIT, PASSAGE, STRIDE = 64, 128, 64
MIN_SCORE = 0.5
SHINGLE, OVERLAP, PARTIAL = 5, 0.8, 0.5
MIN_WORDS = 5
BLOCK_UNITS = 2
INDEX_WORDS = 1_000_000  # words of the items that one pass holds in memory
FEW_BLOCKS = 256
WIDE = 0.25  # words in more blocks than that, and in more than this share, count with their largest impact in the first look

# Letters and digits, in lower case, and all bytes beyond ASCII; everything else separates words.
_FOLD = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or 48 <= byte <= 57 or 97 <= byte <= 122 else 32
    for byte in range(256)
)
LEAK = "doc_id long, row1 long, row2 long, item_id long, score double, question_overlap double, answer_overlap double"


def plain_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The words of the question and those of the answer."""
    lines = [line for line in text.split("\n") if plain_words(line)]
    if len(lines) > 1:
        return plain_words("\n".join(lines[:-1])), plain_words(lines[-1])
    words = plain_words(text)
    cut = len(words) - max(1, len(words) // 5)
    return words[:cut], words[cut:]


class BlockMaxIndex:
    """Impacts of the words of units, normalised by the units' own scores, with the largest of each block of units."""

    def __init__(self, units: list[list[bytes]], frequency: dict[bytes, int], total: int, average: float):
        postings: dict[bytes, list[tuple[int, float]]] = {}
        for number, words in enumerate(units):
            impacts = {}
            for word, count in Counter(words).items():
                held = frequency.get(word, 1)
                rarity = math.log(1 + (total - held + 0.5) / (held + 0.5))
                impacts[word] = rarity * count * (K1 + 1) / (count + K1 * (1 - B + B * len(words) / average))
            own = sum(impacts.values())
            for word, impact in impacts.items():
                postings.setdefault(word, []).append((number, impact / own))
        self.blocks = -(-len(units) // BLOCK_UNITS)
        self.number = {word: i for i, word in enumerate(postings)}
        self.units = [[unit for unit, _ in listed] for listed in postings.values()]
        self.impacts = [[impact for _, impact in listed] for listed in postings.values()]
        self.most = np.array([max(listed) for listed in self.impacts] or [0.0])
        self.block_most: list[dict[int, float]] = []
        for listed, impacts in zip(self.units, self.impacts):
            most: dict[int, float] = {}
            for unit, impact in zip(listed, impacts):
                most[unit // BLOCK_UNITS] = max(impact, most.get(unit // BLOCK_UNITS, 0.0))
            self.block_most.append(most)
        sizes = [len(most) for most in self.block_most]
        self.wide = np.array([size > max(FEW_BLOCKS, WIDE * self.blocks) for size in sizes] or [True])
        narrow = [most if not wide else {} for most, wide in zip(self.block_most, self.wide)]
        self.starts = np.cumsum([0, *map(len, narrow)])
        self.block_of = np.array([block for most in narrow for block in most], np.int64)
        self.bound_of = np.array([bound for most in narrow for bound in most.values()])

    def promising(self, terms: np.ndarray, owner: np.ndarray, passages: int, least: float) -> np.ndarray:
        """Passages for which some block's bounds add up to ``least``; ``terms`` are the different words of each."""
        base = np.bincount(owner, np.where(self.wide[terms], self.most[terms], 0.0), passages)
        counts = self.starts[terms + 1] - self.starts[terms]
        ends = np.cumsum(counts)
        places = np.repeat(self.starts[terms] - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)
        cells = np.repeat(owner, counts) * self.blocks + self.block_of[places]
        sums = np.bincount(cells, self.bound_of[places], passages * self.blocks).reshape(passages, self.blocks)
        return np.flatnonzero(base + sums.max(1, initial=0.0) >= least - 1e-9)

    def search(self, terms: list[int], least: float) -> list[tuple[int, float]]:
        """(unit, score) of every unit whose score for these different words is at least ``least``."""
        least -= 1e-9
        cursors = [[self.units[t][0], 0, t] for t in terms]
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for place, (unit, _, term) in enumerate(cursors):
                bound += self.most[term]
                if bound >= least:
                    pivot, last = unit, place
                    break
            if pivot is None:
                break
            while last + 1 < len(cursors) and cursors[last + 1][0] == pivot:
                last += 1
            block = pivot // BLOCK_UNITS
            if sum(self.block_most[c[2]].get(block, 0.0) for c in cursors[: last + 1]) < least:
                target = (block + 1) * BLOCK_UNITS
                if last + 1 < len(cursors):
                    target = min(target, cursors[last + 1][0])
                target = max(target, pivot + 1)
            elif cursors[0][0] == pivot:
                score = sum(self.impacts[term][at] for _, at, term in cursors[: last + 1])
                if score >= least:
                    found.append((pivot, score))
                target = pivot + 1
            else:
                target = pivot
            for cursor in cursors[: last + 1]:
                if cursor[0] < target:
                    listed = self.units[cursor[2]]
                    at = bisect_left(listed, target, cursor[1])
                    cursor[0], cursor[1] = (listed[at], at) if at < len(listed) else (-1, at)
            cursors = [cursor for cursor in cursors if cursor[0] >= 0]
        return found


class Items:
    """A block of the benchmark: its index, and the shingles of questions and answers."""

    def __init__(self, rows: list[tuple], frequency: dict[bytes, int], total: int, average: float):
        known: dict[bytes, int] = {}
        units, self.item_of, self.rows = [], [], []
        for item_id, text in rows:
            words, parts = plain_words(text), question_and_answer(text)
            hashed = []
            for part in parts:
                size = min(SHINGLE, len(part))
                hashed.append((size, np.unique(shingle_hashes(word_hashes(part, known), size)) if size else None))
            for start in range(0, len(words), UNIT):
                units.append(words[start : start + UNIT])
                self.item_of.append(len(self.rows))
            self.rows.append((item_id, hashed))
        self.index = BlockMaxIndex(units, frequency, total, average)

    def retrieved(self, texts: list[list[bytes]], least: float) -> list[dict[int, float]]:
        """For each text, the items with a unit over the threshold in some passage, and the best score."""
        number, terms, owners, text_of = self.index.number, [], [], []
        for place, words in enumerate(texts):
            ids = np.fromiter((number.get(word, -1) for word in words), np.int64, len(words))
            for start in range(0, max(1, len(ids) - (PASSAGE - STRIDE)), STRIDE):
                part = ids[start : start + PASSAGE]
                part = np.unique(part[part >= 0])
                terms.append(part)
                owners.append(np.full(len(part), len(text_of)))
                text_of.append(place)
        found: list[dict[int, float]] = [{} for _ in texts]
        if text_of:
            for passage in self.index.promising(np.concatenate(terms), np.concatenate(owners), len(text_of), least):
                best = found[text_of[passage]]
                for unit, score in self.index.search(terms[passage].tolist(), least):
                    item = self.item_of[unit]
                    best[item] = max(score, best.get(item, 0.0))
        return found

    def verified(self, words: list[bytes], retrieved: dict[int, float]) -> list[tuple]:
        """(item_id, score, question overlap, answer overlap) of the items that the document holds."""
        hashes, held, found = word_hashes(words, {}), {}, []
        for item, score in retrieved.items():
            item_id, parts = self.rows[item]
            shares = []
            for size, shingles in parts:
                if size and len(words) >= size:
                    if size not in held:
                        held[size] = np.unique(shingle_hashes(hashes, size))
                    shares.append(float(np.isin(shingles, held[size]).mean()))
                else:
                    shares.append(0.0)
            question, answer = shares
            if question >= OVERLAP or (question >= PARTIAL and answer >= OVERLAP):
                found.append((item_id, min(score, 1.0), question, answer))
        return found


def item_words(items: DataFrame) -> DataFrame:
    """(slot, words, text, item_id), and with ``word`` each different word of an item, as rows of their own."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [plain_words(one.as_py()) for one in batch.column("text")]
            yield pa.RecordBatch.from_arrays([
                batch.column("item_id").cast(pa.int64()), batch.column("text").cast(pa.string()), pa.array([len(one) for one in words], pa.int64()),
                pa.array([sorted(set(one)) for one in words], pa.list_(pa.binary())),
            ], names=["item_id", "text", "size", "words"])

    return items.mapInArrow(split, "item_id long, text string, size long, words array<binary>")


def blocks_of_items(benchmark: DataFrame, item_id: str, text: str, min_words: int, index_words: int) -> Iterator[Items]:
    """The benchmark in blocks of about ``index_words`` words; one block at a time is on the driver."""
    items = item_words(benchmark.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").alias("text")))
    items = items.filter(F.col("size") >= min_words)
    total, words = items.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    number = max(1, -(-words // index_words))
    slotted = items.withColumn("slot", F.pmod(F.xxhash64("item_id", "text"), F.lit(number)))
    frequency = slotted.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("held"))
    for slot in range(number if total else 0):
        block = slotted.filter(F.col("slot") == slot)
        rows = block.select("item_id", "text").orderBy("item_id", "text").collect()  # about ``index_words`` words
        used = block.select(F.explode("words").alias("word")).distinct().join(frequency, "word")
        held = {bytes(row.word): row.held for row in used.collect()}
        yield Items([tuple(row) for row in rows], held, total, min(UNIT, words / total))


def leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", min_score: float = MIN_SCORE, min_words: int = MIN_WORDS, index_words: int = INDEX_WORDS,
) -> DataFrame:
    """(doc_id, row1, row2, item_id, score, question_overlap, answer_overlap) of every item that a document holds.

    A document holds an item with ``OVERLAP`` of its question, or ``PARTIAL`` of it and ``OVERLAP`` of its answer. The
    row keys tell rows apart that share a doc_id (see ``texts.row_key``).
    """
    row1, row2 = row_key(doc_id, text)
    plain = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), row1.alias("row1"), row2.alias("row2"), F.col(f"`{text}`").alias("text"))

    def search(batches: Iterator[pa.RecordBatch], items: Items) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
        names = [field.split()[0] for field in LEAK.split(", ")]
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                texts = [plain_words(one.as_py()) for one in part.column("text")]
                found = []
                for place, best in enumerate(items.retrieved(texts, min_score)):
                    if best:
                        row = [part.column(name)[place].as_py() for name in ("doc_id", "row1", "row2")]
                        found.extend((*row, *leak) for leak in items.verified(texts[place], best))
                columns = list(zip(*found)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

    found = None
    for items in blocks_of_items(benchmark, item_id, item_text, min_words, index_words):
        block = docs.sparkSession.sparkContext.broadcast(items)  # bounded by ``index_words``
        some = plain.mapInArrow(functools.partial(_searched, search, block), LEAK)
        found = some if found is None else found.unionByName(some)
    return found if found is not None else docs.sparkSession.createDataFrame([], LEAK)


def _searched(search, block, batches):
    return search(batches, block.value)
