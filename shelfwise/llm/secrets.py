"""Secret scans: patterns, and character Markov models of random strings and ordinary identifiers.

Two first-order models give the probability of each next character; their log-likelihood ratio tells whether a string
was drawn at random. They are trained from labelled samples, counted with DataFrame operations; a model is a table of
128 x 128 numbers whatever the input. All work on texts is done by built-in expressions.

Defined results: a null text counts as empty. Matches are found in whole texts; places are code points from 0, ends
exclusive. Every row is scanned by itself, so repeated rows and null ids need no care.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .spans import apart, once, spans

# The base patterns, their order, and the smallest length of what they must match.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32

CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"  # what the models judge
IDENTIFIER = r"(?<![A-Za-z0-9+/_=-])[A-Za-z][A-Za-z0-9_-]{5,}(?![A-Za-z0-9+/_=-])"  # samples of ordinary strings
LETTERS = 66  # different characters that a candidate may hold, and the end
EDGE = 1  # stands before the first and after the last character
SMOOTHING = 0.5
MIN_RATIO = 0.4  # mean log-likelihood ratio, in nats a character, from which a candidate counts as random
SAMPLE_DOCS = 20_000  # about so many documents, chosen by hash, give the samples


def base_spans(text: Column) -> dict[str, Column]:
    return {
        "assign": spans(text, ASSIGN, "assign", 0, lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 2)) >= MIN_VALUE),
        # A run is matched whole, so a run that is too short holds no match at all.
        "access": spans(text, ACCESS.replace("+", f"{{{MIN_ACCESS - 4},}}"), "access", 1),
        "hex": spans(text, HEX.replace("+", f"{{{MIN_HEX},}}"), "hex", 2),
    }


def samples(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(value, random): strings labelled by the base patterns. What they match is random; words elsewhere are ordinary.

    About ``sample_docs`` documents are read, chosen by the hash of their text, as this only fits the models.
    """
    share = min(1.0, sample_docs / max(1, docs.count()))
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    chosen = docs.select(value.alias("text")).filter(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < share * 1_000_003)
    matches = F.concat(
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)), F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
    )
    random = F.filter(matches, lambda m: F.char_length(m) >= 16)
    rest = F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), "[0-9a-f]{16,}|[A-Z0-9]{16,}", " ")
    ordinary = F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0))
    labelled = F.concat(
        F.transform(random, lambda v: F.struct(v.alias("value"), F.lit(True).alias("random"))),
        F.transform(ordinary, lambda v: F.struct(v.alias("value"), F.lit(False).alias("random"))),
    )
    return chosen.select(F.inline(labelled))


def codes(value: Column) -> Column:
    """Each pair of neighbouring characters, edges included, as one number."""
    edge, size = F.array(F.lit(EDGE)), F.char_length(value) + 1
    numbers = F.concat(edge, F.transform(F.split(value, ""), F.ascii), edge)  # an empty pattern splits into characters

    def pairs(all_: Column) -> Column:
        return F.zip_with(F.slice(all_, F.lit(1), size), F.slice(all_, F.lit(2), size), lambda one, next_: one * 128 + next_)

    return F.transform(F.array(numbers), pairs)[0]


def train(labelled: DataFrame) -> np.ndarray:
    """The log-likelihood ratio of every pair of characters, from (value, random) rows; other characters than those of
    a candidate, empty and null values are left out. Without samples of one kind, its characters are all as likely."""
    usable = labelled.filter(F.col("value").rlike(r"^[A-Za-z0-9+/_.=-]+$") & F.col("random").isNotNull())
    weighted = usable.groupBy("value", "random").agg(F.count("*").alias("n"))
    pairs = weighted.select("random", "n", F.explode(codes(F.col("value"))).alias("code"))
    counts = pairs.groupBy("code").agg(
        F.sum(F.when(F.col("random"), F.col("n")).otherwise(0)).alias("random"),
        F.sum(F.when(F.col("random"), 0).otherwise(F.col("n"))).alias("ordinary"),
    )
    table = np.zeros((2, 128, 128))
    for row in counts.collect():  # at most 128 x 128 rows
        table[:, row.code // 128, row.code % 128] = row.random, row.ordinary
    logs = np.log((table + SMOOTHING) / (table.sum(2, keepdims=True) + SMOOTHING * LETTERS))
    return logs[0] - logs[1]


def ratio(value: Column, model: np.ndarray) -> Column:
    """Mean log-likelihood ratio of the string, random against ordinary."""
    table = F.split(F.lit(",".join(f"{x:.6g}" for x in model.ravel())), ",").cast("array<double>")  # folded once
    total = F.aggregate(codes(value), F.lit(0.0), lambda sum_, code: sum_ + F.get(table, code))
    return total / (F.char_length(value) + 1)


def scan_secrets(
    docs: DataFrame, model: np.ndarray, text: str = "text", into: str = "secrets", min_ratio: float = MIN_RATIO
) -> DataFrame:
    """``docs`` with a struct ``into``: arrays of spans ``assign``, ``access``, ``hex`` and ``markov``.

    Candidates of the models are strings of at least 16 characters with a letter, outside the base spans.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def random(candidate: Column) -> Column:
        return candidate.rlike("[A-Za-z]") & (ratio(candidate, model) >= min_ratio)

    found = base_spans(value) | {"markov": spans(value, CANDIDATE, "markov", 3, random)}
    first = once(docs, **{into: F.struct(*[column.alias(name) for name, column in found.items()])})
    base = F.concat(*[F.col(f"`{into}`.{name}") for name in ("assign", "access", "hex")])
    rest = apart(F.col(f"`{into}`.markov"), base)
    return first.withColumn(into, F.col(f"`{into}`").withField("markov", rest))
