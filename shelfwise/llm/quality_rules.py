"""Quality rules by compression: zstandard ratios of whole documents and fixed chunks against length-specific bands.

Text that compresses far better than prose of its length repeats itself; text that hardly compresses is noise, such as
encoded data. Short texts compress worse, as the compressor has seen nothing yet, so the limits depend on the length.

``BANDS`` are wide, for single texts. ``derived_limits`` finds narrow ones from all documents of a table: by half octaves of
length, and apart for documents and chunks, the median of the ratio and ``SPREADS`` times its quartile range around it.

Defined results: a null text counts as empty; an empty text has no words and fails the base rules. Whole texts are read,
one at a time, so memory is bounded by the longest text. Other columns are passed on untouched.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from .texts import WHITE_SPACE, portions, with_struct, words_of

SYMBOLS = b"#*$%&|<>"
LEVEL = 3
CHUNK_BYTES = 4096
MAX_BAD_CHUNKS = 0.5
# (bytes up to which the band holds, smallest ratio, largest ratio). Encoded or random ASCII stays below 1.4 at any
# length; prose reaches 1.3 to 2 within a kilobyte and 2 to 3.5 beyond; twice the usual ratio means repetition.
BANDS = (
    (300, 0.0, 3.0),
    (1_000, 1.15, 3.5),
    (3_000, 1.4, 4.5),
    (10_000, 1.5, 5.5),
    (float("inf"), 1.6, 7.0),
)
SPREADS, LEAST_SPREAD = 4, 0.02  # quartile ranges from the median; a quartile range is this share of the median at least
LEAST_TEXTS = 100  # different texts of a length without which ``BANDS`` alone hold there
MAX_BAD_DERIVED = 0.25  # share of bad chunks, the rest after the last whole one included, under derived limits
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 50, 50, 3

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "ratio double, n_chunks long, n_repetitive_chunks long, n_noisy_chunks long, reason string, kept boolean"
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur at least twice in the text."""
    if len(words) <= window:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), np.int64, len(words))
    ends = len(words) - window + 1
    codes = ids[:ends]
    for i in range(1, window):
        if (int(codes.max()) + 1) * len(numbers) >= 2**62:
            codes = np.unique(codes, return_inverse=True)[1]
        codes = codes * len(numbers) + ids[i : i + ends]
    _, place, counts = np.unique(codes, return_inverse=True, return_counts=True)
    repeated = counts[place] > 1
    covered = np.zeros(len(words), bool)
    for i in range(window):
        covered[i : i + ends] |= repeated
    return int(covered.sum())


def repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    white, seen, repeated = WHITE_SPACE.encode(), set(), 0
    for line in data.split(b"\n"):
        if line.strip(white):
            repeated += line in seen
            seen.add(line)
    return repeated


def band(size: int, bands=BANDS) -> tuple[float, float]:
    return next((low, high) for limit, low, high in bands if size < limit)


@functools.cache
def compressor(level: int) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=level)


def ratio(data: bytes, level: int = LEVEL) -> float:
    return len(data) / len(compressor(level).compress(data)) if data else 0.0


def length_class(size: int) -> int:
    """Half octaves."""
    return (size * size).bit_length() if size else 0


def pieces(data: bytes, chunk: int, rest: bool) -> list[bytes]:
    """The whole chunks; with ``rest`` also what follows the last one."""
    return [data[i : i + chunk] for i in range(0, len(data) - (0 if rest and len(data) > chunk else chunk - 1), chunk)]


def limits_of(size: int, bands, limits: dict | None, kind: str) -> tuple[float, float]:
    low, high = band(size, bands)
    least, most = (limits or {}).get((kind, length_class(size)), (low, high))
    return max(low, least), min(high, most)


def derived_limits(docs: DataFrame, text: str = "text", level: int = LEVEL, chunk: int = CHUNK_BYTES) -> dict:
    """Smallest and largest ratio by kind ("whole" or "chunk") and class of length, from all different texts with enough
    words. The driver holds some hundred numbers."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch.column(0)):
                rows = []
                for one in part:
                    data = one.encode()
                    if len(words_of(data)) < MIN_WORDS:
                        continue
                    rows.append(("whole", length_class(len(data)), xxhash.xxh3_64_intdigest(data) >> 1, ratio(data, level)))
                    for piece in pieces(data, chunk, True) if len(data) >= chunk else ():
                        key = xxhash.xxh3_64_intdigest(piece) >> 1
                        rows.append(("chunk", length_class(len(piece)), key, ratio(piece, level)))
                columns = list(zip(*rows)) or [()] * 4
                kinds = [pa.string(), pa.int32(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=["kind", "size", "key", "ratio"]
                )

    rows = docs.select(F.col(f"`{text}`")).mapInArrow(measured, "kind string, size int, key long, ratio double")
    found = rows.distinct().groupBy("kind", "size").agg(
        F.count("*").alias("n"), F.percentile_approx("ratio", [0.25, 0.5, 0.75]).alias("quartiles")
    )
    limits = {}
    for kind, size, n, (first, median, third) in found.collect():
        if n >= LEAST_TEXTS:
            away = SPREADS * max(third - first, LEAST_SPREAD * median)
            limits[kind, size] = median - away, median + away
    return limits


def verdict(data: bytes, level: int, chunk: int, bands, most_bad: float, limits: dict | None = None) -> tuple:
    """Ratio, chunks, repetitive chunks, noisy chunks and what is wrong (None: nothing). The rest after the last whole
    chunk is judged with the document only, unless there are ``limits``."""
    whole = ratio(data, level)
    low, high = limits_of(len(data), bands, limits, "whole")
    chunks = pieces(data, chunk, limits is not None)
    judged_ = [(ratio(part, level), *limits_of(len(part), bands, limits, "chunk")) for part in chunks]
    repetitive, noisy = sum(r > most for r, _, most in judged_), sum(r < least for r, least, _ in judged_)
    reason = None
    if whole > high:
        reason = "repetitive"
    elif whole < low:
        reason = "incompressible"
    elif repetitive > most_bad * len(chunks):
        reason = "repetitive chunks"
    elif noisy > most_bad * len(chunks):
        reason = "incompressible chunks"
    return whole, len(chunks), repetitive, noisy, reason


def judged(text: str, level: int, chunk: int, bands, most_bad: float, limits: dict | None = None) -> tuple:
    data = text.encode()
    words = words_of(data)
    repeats = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    whole, chunks, repetitive, noisy, reason = verdict(data, level, chunk, bands, most_bad, limits)
    return (
        len(words), sum(len(word.decode()) for word in words) if len(text) != len(data) else sum(map(len, words)),
        len(data) - len(data.translate(None, SYMBOLS)), repeated_lines(data), repeats, failed, whole, chunks,
        repetitive, noisy, reason, not failed and reason is None,
    )


def quality_rules(
    docs: DataFrame, text: str = "text", into: str = "quality_rules", level: int = LEVEL, chunk: int = CHUNK_BYTES,
    bands=BANDS, most_bad: float = MAX_BAD_CHUNKS, limits: dict | None = None,
) -> DataFrame:
    """``docs`` with a struct ``into`` of counts, ratios and the verdict ``kept`` (see ``SCHEMA``)."""

    @F.arrow_udf(f"struct<{SCHEMA.replace(' ', ':').replace(',:', ',')}>")
    def judge(texts: pa.Array) -> pa.Array:
        rows = [judged(one, level, chunk, bands, most_bad, limits) for part in portions(texts) for one in part]
        columns = list(zip(*rows)) or [()] * len(TYPES)
        return pa.StructArray.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, TYPES.values())], names=list(TYPES)
        )

    return with_struct(docs, into, judge(F.col(text)))


_ARROW = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}
TYPES = {name: _ARROW[kind] for name, kind in (field.split() for field in SCHEMA.split(", "))}
