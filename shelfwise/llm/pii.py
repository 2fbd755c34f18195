"""Pseudonyms for personal data that keep its format: a keyed Feistel permutation of each value within its kind.

Candidates are found by one pattern and validated: card numbers by Luhn's check, IBANs by theirs, addresses by the range
of their parts, dates by the calendar. A value is split in two halves; round after round, one half is shifted by a keyed
hash of the other, modulo the size of its range. That is a permutation of the kind's whole range, so equal values
get equal pseudonyms in every document, different values different ones, and the key (and only the key) leads back.
Check digits are computed anew; separators stay. All work is done by built-in expressions, row by row, without a shuffle.

Defined results: a null text stays null and counts nothing. Candidates that fail validation stay as they are. Of
overlapping candidates the leftmost counts. Dates with slashes or dots are read day first, within 1800 to 2199.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .spans import add, let, once, running

ROUNDS = 10
QUADS_LENGTH = 19  # characters of four times four digits
AGAIN = 40  # permutations until the first 16 of 17 to 19 digits are not valid; each is with one chance in ten
FIRST_DAY, DAYS = "1800-01-01", (189, 773)  # 400 years have 189 * 773 days

# The formats, in the order in which they are tried at a place.
_OPEN, _CLOSE = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
# Cards as they are printed: 4-4-4-4, of up to 19 digits if nothing else can begin there; 4-6-5; unbroken. Other digits
# beside these are not part of them.
_QUADS, _TAIL = r"[0-9]{4}(?:[ -][0-9]{4}){3}", r"[ -][0-9]{1,3}(?![ ./-]?[0-9])"
_PRINTED = rf"(?:{_QUADS}(?:{_TAIL}{_CLOSE})?|[0-9]{{4}}[ -][0-9]{{6}}[ -][0-9]{{5}}|[0-9]{{13,19}}){_CLOSE}"
PATTERNS = {
    # A host has at most 127 labels; the pattern library recurses over repeated groups, so they need a bound.
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,125}\.[A-Za-z]{2,}" + _CLOSE,
    "iban": _OPEN + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _CLOSE,
    "date": _OPEN + r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})" + _CLOSE,
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-]?[0-9]{4}" + _CLOSE
    + r"|(?<![0-9A-Za-z+])\+[2-9][0-9]{1,2}(?:[ .-]?\(?[0-9]{2,4}\)?){2,4}" + _CLOSE,
    "card": rf"(?<![0-9A-Za-z+])(?:{_PRINTED}|[0-9](?:(?![ -]{_PRINTED})[ -]?[0-9]){{12,18}}{_CLOSE})",
}
ANY = "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())
KINDS = list(PATTERNS)


def number(text: Column) -> Column:
    return F.when(F.length(text) == 0, F.lit(0)).otherwise(text.cast("long")).cast("long")


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def refill(pattern: Column, digits: Column) -> Column:
    """The pattern with its digits replaced in order."""
    places = F.split(pattern, "[0-9]", -1)
    return F.array_join(F.transform(places, lambda gap, i: F.concat(gap, F.substr(digits, i + 1, F.lit(1)))), "")


def shifts(key: str, tweak: Column, round_: Column, other: Column) -> Column:
    """A keyed hash, as 64 hexadecimal digits."""
    return F.sha2(F.concat_ws("|", F.lit(key), tweak, round_.cast("string"), other.cast("string")), 256)


def rounds(inverse: bool) -> Column:
    return F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if inverse else F.sequence(F.lit(1), F.lit(ROUNDS))


def permuted(left: Column, lefts: Column, right: Column, rights: Column, key: str, tweak: Column, inverse: bool) -> Column:
    """(left, right): the pair permuted within ranges of ``lefts`` and ``rights`` values, each below 10**10."""
    sign = -1 if inverse else 1

    def step(state: Column, round_: Column) -> Column:
        odd = round_ % 2 == 1
        other = F.when(odd, state["right"]).otherwise(state["left"])
        size = F.when(odd, lefts).otherwise(rights)
        hashed = F.conv(F.substr(shifts(key, tweak, round_, other), F.lit(1), F.lit(15)), 16, 10).cast("long") % size
        mine = F.when(odd, state["left"]).otherwise(state["right"])
        moved = F.pmod(mine + sign * hashed, size)
        return F.struct(
            F.when(odd, moved).otherwise(state["left"]).alias("left"),
            F.when(odd, state["right"]).otherwise(moved).alias("right"),
        )

    start = F.struct(left.cast("long").alias("left"), right.cast("long").alias("right"))
    return F.aggregate(rounds(inverse), start, step)


def permuted_digits(digits: Column, key: str, tweak: str, inverse: bool) -> Column:
    """As many digits (at most 19), permuted."""

    def halves(both: Column) -> Column:
        text, half, rest = both["text"], both["half"], both["rest"]
        powers = [F.pow(F.lit(10.0), part).cast("long") for part in (half, rest)]
        pair = permuted(
            number(F.substr(text, F.lit(1), half)), powers[0], number(F.substr(text, half + 1, rest)), powers[1], key,
            F.concat_ws(":", F.lit(tweak), F.length(text).cast("string")), inverse,
        )
        return let(pair, lambda moved: F.concat(
            F.when(half > 0, F.lpad(moved["left"].cast("string"), half, "0")).otherwise(F.lit("")),
            F.when(rest > 0, F.lpad(moved["right"].cast("string"), rest, "0")).otherwise(F.lit("")),
        ))

    def cut(text: Column) -> Column:
        half = F.floor(F.length(text) / 2).cast("int")
        return F.struct(text.alias("text"), half.alias("half"), (F.length(text) - half).alias("rest"))

    return let(let(digits, cut), halves)


def shifted_letters(text: Column, hashed: Column, sign: int) -> Column:
    """Each letter or digit moved within a-z, A-Z or 0-9 by a byte of the hash; other characters stay."""

    def moved(i: Column) -> Column:
        by = F.conv(F.substr(hashed, F.pmod(i - 1, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int") * sign

        def within(letter: Column) -> Column:
            code = F.ascii(letter)
            first = F.when(code.between(97, 122), 97).when(code.between(65, 90), 65).when(code.between(48, 57), 48)
            size = F.when(code >= 65, 26).otherwise(10)
            return F.coalesce(F.char((F.pmod(code - first + by, size) + first).cast("long")), letter)

        return let(F.substr(text, i, F.lit(1)), within)

    places = F.when(F.char_length(text) > 0, F.sequence(F.lit(1), F.char_length(text))).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, moved), "")


def permuted_letters(text: Column, key: str, tweak: str, inverse: bool) -> Column:
    """A string of the same classes of characters, permuted."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    sign = -1 if inverse else 1

    def step(state: Column, round_: Column) -> Column:
        odd = round_ % 2 == 1
        other = F.when(odd, state["right"]).otherwise(state["left"])
        mine = F.when(odd, state["left"]).otherwise(state["right"])
        moved = shifted_letters(mine, shifts(key, F.lit(tweak), round_, other), sign)
        return F.struct(
            F.when(odd, moved).otherwise(state["left"]).alias("left"),
            F.when(odd, state["right"]).otherwise(moved).alias("right"),
        )

    start = F.struct(
        F.substr(text, F.lit(1), half).alias("left"), F.substr(text, half + 1, F.char_length(text) - half).alias("right")
    )
    return F.aggregate(rounds(inverse), start, step, lambda state: F.concat(state["left"], state["right"]))


def remainder97(text: Column) -> Column:
    """The string, with letters as numbers from 10, modulo 97."""

    def step(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substr(text, i, F.lit(1)))
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(text)), F.lit(0), step)


def email(value: Column, key: str, inverse: bool) -> Column:
    at = F.locate("@", value)
    name = permuted_letters(F.substr(value, F.lit(1), at - 1), key, "email", inverse)
    return F.concat(name, F.substr(value, at, F.char_length(value)))


def iban(value: Column, key: str, inverse: bool) -> Column:
    """Country and letters stay, the digits of the account are permuted, the check digits follow."""

    def valid(plain: Column) -> Column:
        turned = F.concat(F.substr(plain, F.lit(5), F.char_length(plain)), F.substr(plain, F.lit(1), F.lit(4)))
        check = F.substr(plain, F.lit(3), F.lit(2)).cast("int")
        return (remainder97(turned) == 1) & F.char_length(plain).between(15, 34) & check.between(2, 98)

    def written(plain: Column) -> Column:
        account, country = F.substr(plain, F.lit(5), F.char_length(plain)), F.substr(plain, F.lit(1), F.lit(2))

        def moved(digits: Column) -> Column:
            cut = F.floor(F.length(digits) / 2).cast("int")  # up to 30 digits, in two permutations
            parts = F.substr(digits, F.lit(1), cut), F.substr(digits, cut + 1, F.length(digits))
            return F.concat(*[permuted_digits(part, key, f"iban{i}", inverse) for i, part in enumerate(parts)])

        def checked(fresh: Column) -> Column:
            rest = 98 - remainder97(F.concat(refill(account, fresh), country, F.lit("00")))
            return F.concat(F.lpad(rest.cast("string"), 2, "0"), fresh)

        digits = let(let(digits_of(account), moved), checked)
        return let(digits, lambda d: F.concat(country, refill(F.substr(value, F.lit(3), F.char_length(value)), d)))

    return let(F.replace(value, F.lit(" "), F.lit("")), lambda plain: F.when(valid(plain), written(plain)))


def date(value: Column, key: str, inverse: bool) -> Column:
    iso = F.substr(value, F.lit(5), F.lit(1)) == "-"
    parts = F.split(value, "[-/.]")
    day = F.when(iso, F.try_to_date(value, "yyyy-MM-dd")).otherwise(
        F.try_to_date(F.concat_ws("-", parts[2], parts[1], parts[0]), "yyyy-MM-dd")
    )
    first = F.lit(FIRST_DAY).cast("date")

    def moved(place: Column) -> Column:
        pair = permuted(
            F.floor(place / DAYS[1]), F.lit(DAYS[0]), place % DAYS[1], F.lit(DAYS[1]), key, F.lit("date"), inverse
        )
        fresh = let(pair, lambda both: F.date_add(first, (both["left"] * DAYS[1] + both["right"]).cast("int")))
        return F.when(place.between(0, DAYS[0] * DAYS[1] - 1), fresh)

    def written(fresh: Column) -> Column:
        mark = F.substr(value, F.lit(3), F.lit(1))
        year, month, date_ = [F.date_format(fresh, part) for part in ("yyyy", "MM", "dd")]
        return F.when(iso, F.concat_ws("-", year, month, date_)).otherwise(F.concat(date_, mark, month, mark, year))

    return F.when(day.isNotNull(), let(let(F.date_diff(day, first), moved), lambda d: F.when(d.isNotNull(), written(d))))


def ip(value: Column, key: str, inverse: bool) -> Column:
    def moved(parts: Column) -> Column:
        pair = permuted(
            parts[0] * 256 + parts[1], F.lit(65536), parts[2] * 256 + parts[3], F.lit(65536), key, F.lit("ip"), inverse
        )
        fresh = let(pair, lambda both: F.concat_ws(".", *[
            part.cast("int").cast("string") for side in ("left", "right") for part in (both[side] / 256, both[side] % 256)
        ]))
        plain = F.array_join(F.transform(parts, lambda part: part.cast("string")), ".") == value  # no leading zeros
        return F.when(plain & (F.array_max(parts) <= 255), fresh)

    return let(F.transform(F.split(value, r"\."), lambda part: part.cast("int")), moved)


def ssn(value: Column, key: str, inverse: bool) -> Column:
    """Areas 001-899 without 666, groups 01-99, serials 0001-9999."""
    area, group, serial = [F.substr(value, F.lit(at), F.lit(size)).cast("int") for at, size in ((1, 3), (5, 2), (8, 4))]
    pair = permuted(
        F.when(area > 666, area - 2).otherwise(area - 1), F.lit(898), (group - 1) * 9999 + serial - 1, F.lit(99 * 9999), key,
        F.lit("ssn"), inverse,
    )

    def written(both: Column) -> Column:
        fresh = F.when(both["left"] >= 665, both["left"] + 2).otherwise(both["left"] + 1)
        parts = (fresh, 3), ((both["right"] / 9999).cast("long") + 1, 2), (both["right"] % 9999 + 1, 4)
        return F.concat_ws("-", *[F.lpad(part.cast("string"), size, "0") for part, size in parts])

    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, let(pair, written))


def phone(value: Column, key: str, inverse: bool) -> Column:
    """North American numbers within valid areas and exchanges; others keep the two or three digits after the plus."""

    def american(digits: Column) -> Column:
        area, exchange, line = [
            F.substr(digits, F.length(digits) - at, F.lit(size)).cast("long") for at, size in ((9, 3), (6, 3), (3, 4))
        ]
        pair = permuted(
            area - 200, F.lit(800), (exchange - 200) * 10_000 + line, F.lit(8_000_000), key, F.lit("phone"), inverse
        )
        return let(pair, lambda both: F.concat(
            F.substr(digits, F.lit(1), F.length(digits) - 10), (both["left"] + 200).cast("string"),
            ((both["right"] / 10_000).cast("long") + 200).cast("string"),
            F.lpad((both["right"] % 10_000).cast("string"), 4, "0"),
        ))

    def abroad(digits: Column) -> Column:
        kept = F.char_length(F.regexp_extract(value, r"^\+([0-9]{2,3})", 1))
        moved = permuted_digits(F.substr(digits, kept + 1, F.length(digits)), key, "abroad", inverse)
        return F.when(F.length(digits).between(8, 15), F.concat(F.substr(digits, F.lit(1), kept), moved))

    fresh = let(digits_of(value), lambda d: F.when(value.rlike(r"^\+[2-9]"), abroad(d)).otherwise(american(d)))
    return let(fresh, lambda digits: F.when(digits.isNotNull(), refill(value, digits)))


def luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def card_length(value: Column) -> Column:
    """Characters of the card number in a candidate: the first 16 digits of four, four, four, four and some more, if these
    are valid; else all."""
    short = value.rlike(f"^{_QUADS}[ -]") & luhn(digits_of(F.substr(value, F.lit(1), F.lit(QUADS_LENGTH))))
    return F.when(short, F.lit(QUADS_LENGTH)).otherwise(F.char_length(value))


def card(value: Column, key: str, inverse: bool) -> Column:
    """The first digit, which names the kind of issuer, stays; the last one is the check digit. A longer number whose first
    16 digits would be valid is permuted again, so that the way back finds the same digits."""

    def payload(digits: Column) -> Column:
        inner = permuted_digits(F.substr(digits, F.lit(2), F.length(digits) - 2), key, "card", inverse)
        return F.concat(F.substr(digits, F.lit(1), F.lit(1)), inner)

    def checked(part: Column) -> Column:
        check = F.get(F.filter(F.sequence(F.lit(0), F.lit(9)), lambda d: luhn(F.concat(part, d.cast("string")))), F.lit(0))
        return F.concat(part, check.cast("string"))

    def moved(digits: Column) -> Column:
        return let(payload(digits), checked)

    def written(number_: Column) -> Column:
        quads = number_.rlike(f"^{_QUADS}[ -]")

        def again(state: Column, _: Column) -> Column:
            return F.when(quads & luhn(F.substr(state, F.lit(1), F.lit(16))), moved(state)).otherwise(state)

        def stable(digits: Column) -> Column:
            return F.when(quads, F.aggregate(F.sequence(F.lit(1), F.lit(AGAIN)), digits, again)).otherwise(digits)

        fresh = let(digits_of(number_), lambda digits: F.when(luhn(digits), let(moved(digits), stable)))
        return let(fresh, lambda digits: F.when(digits.isNotNull(), refill(number_, digits)))

    def split(length: Column) -> Column:
        fresh = let(F.substr(value, F.lit(1), length), written)
        return F.concat(fresh, F.substr(value, length + 1, F.char_length(value)))

    return let(card_length(value), split)


MOVES = {"email": email, "iban": iban, "date": date, "ip": ip, "ssn": ssn, "phone": phone, "card": card}


def pseudonyms(
    docs: DataFrame, key: str, text: str = "text", into: str = "pii", inverse: bool = False, kinds: list[str] | None = None
) -> DataFrame:
    """``docs`` with a struct ``into``: the text with pseudonyms, and ``found``, the values replaced, as an array of
    (start, end, kind) in code points of the original text. ``inverse`` takes pseudonyms back to the values."""
    original = F.col(f"`{text}`")
    chosen = [kind for kind in KINDS if kinds is None or kind in kinds]

    def judged(match: Column) -> Column:
        kind = F.lit(None).cast("string")
        for name in reversed(chosen):
            kind = F.when(match.rlike(f"^(?:{PATTERNS[name]})$"), F.lit(name)).otherwise(kind)
        return F.struct(match.alias("match"), kind.alias("kind"))

    def moved(one: Column) -> Column:
        fresh = F.lit(None).cast("string")
        for name in chosen:
            fresh = F.when(one["kind"] == name, MOVES[name](one["match"], key, inverse)).otherwise(fresh)
        return F.struct(one["match"].alias("match"), one["kind"].alias("kind"), fresh.alias("fresh"))

    def length(one: Column) -> Column:
        return F.when(one["kind"] == "card", card_length(one["match"])).otherwise(F.char_length(one["match"]))

    def span(at: Column, one: Column) -> Column:
        start = at + one["gap"]
        return F.when(one["fresh"].isNotNull(), F.struct(
            start.alias("start"), (start + one["length"]).alias("end"), one["kind"].alias("kind")
        ))

    first = once(docs, _matches=F.transform(F.transform(F.regexp_extract_all(original, F.lit(ANY), F.lit(0)), judged), moved))
    some = F.exists("_matches", lambda one: one["fresh"].isNotNull())
    second = once(first, _gaps=F.when(some, F.split(original, ANY, -1)))
    fresh = F.zip_with("_gaps", "_matches", lambda gap, one: F.concat(gap, F.coalesce(one["fresh"], one["match"], F.lit(""))))
    pieces = F.zip_with("_gaps", "_matches", lambda gap, one: F.struct(
        F.char_length(gap).alias("gap"), F.coalesce(F.char_length(one["match"]), F.lit(0)).alias("size"),
        one["kind"].alias("kind"), one["fresh"].alias("fresh"), length(one).alias("length"),
    ))
    kind = "array<struct<start:int,end:int,kind:string>>"
    found = F.filter(running(pieces, F.lit(0), lambda one: one["gap"] + one["size"], add, span), lambda one: one.isNotNull())
    third = once(second, **{into: F.struct(
        F.when(some, F.array_join(fresh, "")).otherwise(original).alias("text"),
        F.when(some, found.cast(kind)).otherwise(F.array().cast(kind)).alias("found"),
    )})
    return third.drop("_matches", "_gaps")
