"""URL filters by a temporal list join: every capture is judged by the list entries in force when it was fetched.

A list is a history of dated entries: from some instant on, a host or host-and-path prefix is blocked, allowed or no
longer listed. Entries become validity intervals that end where the next entry for the same key begins. A capture has
one key for its host, each parent domain and each leading path segment. The as-of join meets both by key and month:
intervals are laid out over the months they cover, so a hot host is dealt over the months of its captures, and each
capture meets at most the few intervals of a month, of which its instant picks one. Of all keys in force, the most specific
decides. Neither side is broadcast.

Defined results: a null or malformed URL has no keys and is undecided, as is a capture without a fetch time. Entries
without key, instant or a known action are left out; of several for the same key and instant the strictest counts
(block, then allow, then remove), so repeated entries change nothing. An entry is in force at its very instant. Rows
that are repeated are judged each by itself, alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .spans import once

# What entries may say, strictest first.
ACTIONS = ["block", "allow", "remove"]
URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@\[\]]+)(?::[0-9]*)?([^?#]*)"
OPEN_END = "9999-12-31"
FIELDS = "array<struct<key:string,specific:int>>"


def host_of(url: Column) -> Column:
    """The host in lower case without a final dot; null where the URL has none."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, URL, 1)), r"\.$", "")
    return F.when(host != "", host)


def url_keys(url: Column) -> Column:
    """(key, specific): parent domains and host from 1 on, then host and leading path segments."""
    labels = F.split(host_of(url), r"\.")
    segments = F.filter(F.split(F.regexp_extract(url, URL, 2), "/"), lambda part: part != "")
    size = F.size(labels)
    domains = F.transform(
        F.sequence(F.lit(1), size),
        lambda n: F.struct(F.array_join(F.slice(labels, size - n + 1, n), ".").alias("key"), n.alias("specific")),
    )
    count = F.size(segments)
    paths = F.transform(
        F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>")),
        lambda n: F.struct(
            F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(segments, F.lit(1), n), "/")).alias("key"),
            (n + size).alias("specific"),
        ),
    )
    return F.when(labels.isNotNull(), F.concat(domains.cast(FIELDS), paths.cast(FIELDS))).otherwise(F.array().cast(FIELDS))


def intervals(entries: DataFrame) -> DataFrame:
    """(key, action, valid_from, valid_to) from (key, action, since); the end is exclusive, removals leave gaps."""
    strict = F.array_position(F.lit(ACTIONS), F.col("action"))
    known = entries.filter(F.col("key").isNotNull() & F.col("since").isNotNull() & (strict > 0))
    dated = known.groupBy("key", "since").agg(F.min(strict).alias("strict"))
    following = F.lead("since").over(Window.partitionBy("key").orderBy("since"))  # the history of one key
    spans = dated.select(
        "key", F.get(F.lit(ACTIONS), (F.col("strict") - 1).cast("int")).alias("action"), F.col("since").alias("valid_from"),
        F.coalesce(following, F.lit(OPEN_END).cast("timestamp_ntz")).alias("valid_to"),
    )
    return spans.filter("action <> 'remove'")


def month_of(time: Column) -> Column:
    return F.year(time) * 12 + F.month(time) - 1


def judge_captures(
    captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched", into: str = "listing"
) -> DataFrame:
    """``captures`` with a struct ``into``: the key that decides, its action and since when, and how many keys were in
    force. ``decision`` is ``block``, ``allow`` or ``none``.

    ``captures`` must have a timestamp without time zone in ``fetched``; ``entries`` has key, action and since.
    """
    time = F.col(f"`{fetched}`")
    # The months that captures have: no more than a calendar has, and nearly always a few hundred at most.
    months = sorted(row.month for row in captures.select(month_of(time).alias("month")).distinct().collect() if row.month is not None)
    first, last = month_of(F.col("valid_from")), month_of(F.col("valid_to"))
    held = F.filter(F.array(*map(F.lit, months)).cast("array<int>"), lambda month: (month >= first) & (month <= last))
    monthly = intervals(entries).select("*", F.explode(held).alias("month"))
    different = captures.select(F.col(f"`{url}`").alias("url"), time.alias("at")).filter("at IS NOT NULL").distinct()
    probes = different.select(
        *[F.xxhash64(F.lit(seed), "url", "at").alias(f"row{seed}") for seed in (1, 2)], "at", month_of(F.col("at")).alias("month"),
        F.inline(url_keys(F.col("url"))),
    )
    met = probes.alias("c").join(
        monthly.alias("e"),
        (F.col("c.key") == F.col("e.key")) & (F.col("c.month") == F.col("e.month"))
        & (F.col("c.at") >= F.col("e.valid_from")) & (F.col("c.at") < F.col("e.valid_to")),
    )
    best = F.max_by(F.struct(F.col("e.key").alias("key"), "action", "valid_from"), "specific")
    verdicts = met.groupBy("row1", "row2").agg(best.alias("best"), F.count("*").alias("n_in_force"))
    mine = {"row1": "_url_row1", "row2": "_url_row2", "best": "_url_best", "n_in_force": "_url_n"}
    verdicts = verdicts.select([F.col(old).alias(new) for old, new in mine.items()])
    keyed = captures.withColumns({
        f"_url_row{seed}": F.xxhash64(F.lit(seed), F.col(f"`{url}`"), time) for seed in (1, 2)
    })
    joined = keyed.join(verdicts, ["_url_row1", "_url_row2"], "left")
    value = F.struct(
        F.coalesce(F.col("_url_best.action"), F.lit("none")).alias("decision"), F.col("_url_best.key").alias("key"),
        F.col("_url_best.valid_from").alias("valid_from"), F.coalesce(F.col("_url_n"), F.lit(0)).cast("long").alias("n_in_force"),
    )
    return once(joined, **{into: value}).drop(*mine.values())
