"""Places of pattern matches, in built-in expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ONE_SPAN = "struct<start:int,rank:int,end:int,kind:string>"
SPAN = f"array<{ONE_SPAN}>"
CHUNK = 64


def add(one: Column, other: Column) -> Column:
    return one + other


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def running(
    items: Column, zero: Column, measure: Callable[[Column], Column], combine: Callable[[Column, Column], Column],
    value: Callable[[Column, Column], Column],
) -> Column:
    """``value(state, item)`` of every item, where the state combines the measures of all items before it.

    Items are cut into chunks: the state at the start of a chunk comes from the totals of the chunks before. No array
    is carried from item to item, which would copy it each time.
    """
    def fold(numbers: Column, start: Column) -> Column:
        return F.aggregate(numbers, start, combine)

    def first(numbers: Column, count: Column) -> Column:
        return F.slice(numbers, F.lit(1), count)

    def within(chunk: Column, start: Column) -> Column:
        return let(F.transform(chunk, measure), lambda measures: F.transform(
            chunk, lambda item, i: let(fold(first(measures, i), start), lambda state: value(state, item))
        ))

    def whole(all_: Column) -> Column:
        numbers = F.sequence(F.lit(0), ((F.size(all_) - 1) / CHUNK).cast("int"))
        chunks = F.transform(numbers, lambda i: F.slice(all_, i * CHUNK + 1, F.lit(CHUNK)))
        return let(chunks, lambda parts: let(
            F.transform(parts, lambda part: fold(F.transform(part, measure), zero)),
            lambda totals: F.flatten(F.transform(
                parts, lambda part, i: let(fold(first(totals, i), zero), lambda start: within(part, start))
            )),
        ))

    return let(items, whole)


def spans(text: Column, pattern: str, kind: str, rank: int, passes: Callable[[Column], Column] | None = None) -> Column:
    """The leftmost non-overlapping matches, as an array of (start, rank, end, kind) in code points, end exclusive.

    What stands between the matches, from ``split``, gives their places. ``passes`` keeps matches by their text. Texts
    without a match are searched once only.
    """
    def piece(gap: Column, match: Column) -> Column:
        keep = match.isNotNull() if passes is None else match.isNotNull() & passes(match)
        return F.struct(
            F.char_length(gap).alias("gap"), F.coalesce(F.char_length(match), F.lit(0)).alias("size"), keep.alias("keep")
        )

    def span(at: Column, one: Column) -> Column:
        start = at + one["gap"]
        return F.when(one["keep"], F.struct(
            start.alias("start"), F.lit(rank).alias("rank"), (start + one["size"]).alias("end"), F.lit(kind).alias("kind")
        ))

    pieces = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), piece)
    found = F.filter(running(pieces, F.lit(0), lambda one: one["gap"] + one["size"], add, span), lambda s: s.isNotNull())
    return F.when(text.rlike(pattern), found.cast(SPAN)).otherwise(F.array().cast(SPAN))


def apart(some: Column, others: Column) -> Column:
    """Those of the spans ``some`` that overlap none of ``others``, by two passes over both in the order of their starts."""
    def mark(is_other: bool) -> Callable[[Column], Column]:
        names = ("start", "rank", "end", "kind")
        flags = F.lit(is_other).alias("other"), F.lit(False).alias("meets")
        return lambda s: F.struct(*[s[name].alias(name) for name in names], *flags)

    def with_meets(s: Column, meets: Column) -> Column:
        return s.withField("meets", s["meets"] | (~s["other"] & meets))

    both = F.array_sort(F.concat(F.transform(others, mark(True)), F.transform(some, mark(False))))
    # A span meets an earlier one that has not ended; read backwards, a later one that begins before its end.
    forth = running(
        both, F.lit(-1), lambda s: F.when(s["other"], s["end"]).otherwise(-1), lambda a, b: F.greatest(a, b),
        lambda end, s: with_meets(s, s["start"] < end),
    )
    back = running(
        F.reverse(forth), F.lit(2**31 - 1), lambda s: F.when(s["other"], s["start"]).otherwise(2**31 - 1), lambda a, b: F.least(a, b),
        lambda start, s: with_meets(s, s["end"] > start),
    )
    left = F.filter(F.reverse(back), lambda s: ~s["other"] & ~s["meets"])
    return F.transform(left, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"])).cast(SPAN)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with these columns. A generator of one row keeps the optimizer from copying their expressions into every
    place that uses them."""
    names = {name.lower() for name in columns}
    kept = [F.col(f"`{name}`") for name in df.columns if name.lower() not in names]
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(values)))


def joined(spans_: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
