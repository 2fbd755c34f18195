"""One query for each operator, over its whole table, in the columns of its contract; and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import (
    bpe as byte_pairs, decontamination, exact_dedup, fill_in_middle, licenses, line_dedup, ngram_join, pii,
    quality_rules as rules, secrets, substring_dedup, url_lists, vector_codes,
)
from .spans import joined
from .texts import documents

VOCABULARY = "byte_bpe_50k.json"
DEMONSTRATION_KEY = "demonstration key, use your own secret"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.dedup_lines(documents(spark, folder).select("doc_id", "text"))
    return found.select(
        "doc_id", "line_dedup.n_lines", "line_dedup.n_dropped", F.sha2("line_dedup.text", 256).alias("kept_sha256")
    )


OP1_SQL = r"""
WITH cut AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM cut),
shared AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT doc_id, line, i, coalesce(doc_id <> holder, false) AS gone FROM keyed LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    found = secrets.scan_secrets(docs, secrets.train(secrets.samples(docs)))
    base = F.array_sort(F.concat("secrets.assign", "secrets.access", "secrets.hex"))
    both = F.array_sort(F.concat("secrets.assign", "secrets.access", "secrets.hex", "secrets.markov"))
    return found.select(
        "doc_id", *[F.size(f"secrets.{kind}").cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(both).alias("spans"),
        F.size("secrets.markov").cast("long").alias("n_markov"),
    )


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    found = rules.quality_rules(docs, most_bad=rules.MAX_BAD_DERIVED, limits=rules.derived_limits(docs))
    return found.select("doc_id", "quality_rules.*")


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontamination.leaks(documents(spark, folder), benchmark).drop("row1", "row2")


def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_components(documents(spark, folder).select("doc_id", "text"))


OP5_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM worded),
held AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM held AS a JOIN held AS b USING (shingle) WHERE a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reached AS (
  SELECT doc_id AS x, doc_id AS y FROM sets
  UNION
  SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x) USING (doc_id)
"""


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    found = byte_pairs.bpe(documents(spark, folder).select("doc_id", "text"), vocabulary_path())
    return found.select(
        "doc_id", F.size("bpe.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("bpe.ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bpe.decoded", 256).alias("decoded_sha256"),
    )


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.pseudonyms(documents(spark, folder).select("doc_id", "text"), DEMONSTRATION_KEY)
    kinds = F.transform("pii.found", lambda one: one["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS
    ]
    spans = F.array_join(F.transform("pii.found", lambda one: F.concat_ws(":", one["kind"], one["start"], one["end"])), ",")
    return found.select("doc_id", F.size("pii.found").cast("long").alias("n_found"), *counts, spans.alias("spans"), "pii.text")


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring_dedup.repeated_passages(documents(spark, folder).select("doc_id", "text"))

    def words(column: str) -> Column:
        total = F.aggregate(column, F.lit(0), lambda sum_, span: sum_ + span["end"] - span["begin"])
        return total.cast("long")

    def listed(column: str) -> Column:
        return F.array_join(F.transform(column, lambda span: F.concat_ws(":", span["begin"], span["end"])), ",")

    return found.select(
        "doc_id", F.size("passages").cast("long").alias("n_passages"), words("passages").alias("n_words"),
        words("duplicates").alias("n_duplicate_words"), listed("passages").alias("passages"),
        listed("duplicates").alias("duplicates"),
    )


def dated_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The pages with a fetch time, which the table lacks: an hour within two years that follows from the page_id."""
    hours = F.pmod(F.col("page_id") * 7919, F.lit(17520)).cast("int")
    fetched = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=hours)
    return spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", fetched.alias("fetched"))


def list_history(pages: DataFrame) -> DataFrame:
    """Dated entries for hosts, their parent domains and first path segments; dates and actions follow from the key."""
    host = url_lists.host_of(F.col("url"))
    segment = F.regexp_extract("url", "://[^/]+/([a-z]+)", 1)
    parent = F.regexp_replace(host, r"^[^.]+\.", "")
    keys = pages.select(F.explode(F.array(host, parent, F.concat(host, F.lit("/"), segment))).alias("key")).distinct()
    drawn = keys.select("key", F.explode(F.array(*map(F.lit, range(4)))).alias("i")).withColumn(
        "h", F.conv(F.substring(F.md5(F.concat("key", F.lit(":"), F.col("i").cast("string"))), 1, 7), 16, 10).cast("int")
    )
    since = F.lit("2023-09-01").cast("timestamp_ntz") + F.make_dt_interval(days=F.col("h") % 850)
    action = F.get(F.lit(url_lists.ACTIONS), F.col("h") % 17 % 3)
    return drawn.select("key", action.alias("action"), since.alias("since"))


def op9_url_lists(spark: SparkSession, folder: str) -> DataFrame:
    pages = dated_pages(spark, folder)
    found = url_lists.judge_captures(pages, list_history(pages))
    return found.select("page_id", "fetched", "listing.*")


OP9_SQL = r"""
WITH pages_ AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + to_hours(CAST(page_id * 7919 % 17520 AS INT)) AS fetched,
    regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@\[\]]+)', 1)), '\.$', '') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(?:[^/?#:@\[\]]+)(?::[0-9]*)?([^?#]*)', 1) AS path
  FROM pages),
listed AS (
  SELECT DISTINCT unnest([host, regexp_replace(host, '^[^.]+\.', ''), host || '/' || regexp_extract(url, '://[^/]+/([a-z]+)', 1)]) AS key
  FROM pages_),
drawn AS (
  SELECT key, CAST('0x' || substr(md5(key || ':' || i), 1, 7) AS INT) AS h FROM listed, range(4) AS t(i)),
dated AS (
  SELECT key, TIMESTAMP '2023-09-01' + to_days(h % 850) AS since, min(h % 17 % 3) AS strict FROM drawn GROUP BY ALL),
intervals AS (
  SELECT key, strict, since, coalesce(lead(since) OVER (PARTITION BY key ORDER BY since), TIMESTAMP '9999-12-31') AS until FROM dated),
keys AS (
  SELECT page_id, fetched, unnest(list_transform(range(1, len(string_split(host, '.')) + 1),
    lambda n: {'key': array_to_string(string_split(host, '.')[-n:], '.'), 'specific': n})) AS k
  FROM pages_ WHERE host <> ''
  UNION ALL
  SELECT page_id, fetched, unnest(list_transform(range(1, len(parts) + 1),
    lambda n: {'key': host || '/' || array_to_string(parts[:n], '/'), 'specific': n + len(string_split(host, '.'))})) AS k
  FROM (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS parts FROM pages_) WHERE host <> ''),
met AS (
  SELECT page_id, arg_max({'key': i.key, 'strict': strict, 'since': since}, k.specific) AS best, count(*) AS n
  FROM keys JOIN intervals AS i ON i.key = k.key AND fetched >= since AND fetched < until AND strict < 2 GROUP BY page_id)
SELECT p.page_id, p.fetched, CASE best.strict WHEN 0 THEN 'block' WHEN 1 THEN 'allow' ELSE 'none' END AS decision,
  best.key AS key, best.since AS valid_from, coalesce(n, 0) AS n_in_force
FROM pages_ AS p LEFT JOIN met USING (page_id)
"""


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan_licenses(documents(spark, folder).select("doc_id", "text"))
    return found.select(
        "doc_id", *[f"licenses.{name}" for name in ("n_words", "n_base", "first_word", "last_word")],
        F.array_join("licenses.base_labels", ",").alias("base_labels"), F.array_join("licenses.labels", ",").alias("labels"),
        "licenses.score", F.size("licenses.matches").cast("long").alias("n_matches"),
    )


def op11_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.exact_dedup(documents(spark, folder).select("doc_id", "text"))
    return found.select(
        "doc_id", *[f"exact_dedup.{name}" for name in ("keep_id", "group_size", "kept")],
        F.col("exact_dedup.sha256").alias("text_sha256"),
    )


OP11_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "label", "embedding")
    codebooks = vector_codes.trained(vectors, "vec_id", "embedding")
    found = vector_codes.compressed(vectors, codebooks, into="_code").select("vec_id", "label", "_code.*")
    found = vector_codes.with_label_error(found, "label", "error", "label_error")
    digest = F.lit(vector_codes.codebooks_sha256(codebooks)).alias("codebooks_sha256")
    return found.select("vec_id", "code", "error", "label_error", digest)


def op12_sql(parts: int = vector_codes.PARTS, rounds: int = vector_codes.ROUNDS) -> str:
    """The rounds of the training as one SQL statement."""
    steps = [f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
cut AS MATERIALIZED (
  SELECT r, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x FROM kept, range({parts}) AS t(p)),
c0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM cut WHERE r <= {vector_codes.ENTRIES})"""]
    nearest = """
a{i} AS MATERIALIZED (
  SELECT r, p, x, min({{'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': e}}) AS best
  FROM cut JOIN c{i} USING (p) GROUP BY r, p, x)"""
    mean = """
m{i} AS MATERIALIZED (
  SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
    SELECT p, best.e AS e, i, sum(x[i]) AS s, count(*) AS n
    FROM a{i}, unnest(range(1, len(x) + 1)) AS t(i) GROUP BY ALL) GROUP BY p, e),
c{j} AS MATERIALIZED (SELECT p, e, coalesce(m.c, o.c) AS c FROM c{i} AS o LEFT JOIN m{i} AS m USING (p, e))"""
    for i in range(rounds):
        steps += [nearest.format(i=i), mean.format(i=i, j=i + 1)]
    steps.append(nearest.format(i=rounds))
    return ",".join(steps) + f""",
books AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds}),
coded AS (
  SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), books
"""


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    found = fill_in_middle.fill_in_middle(documents(spark, folder).select("doc_id", "text"))
    back = fill_in_middle.restored(F.col("fim.output"), F.col("fim.form"))
    return found.select(
        "doc_id", F.col("fim.n_units").alias("n"), "fim.form", "fim.prefix_chars", "fim.middle_chars",
        F.sha2("fim.output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )


OP13_SQL = """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS one,
    CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS two,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
      WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM units),
cut AS (
  SELECT *, array_to_string(u[1 : least(one, two)], '') AS prefix,
    array_to_string(u[least(one, two) + 1 : greatest(one, two)], '') AS middle,
    array_to_string(u[greatest(one, two) + 1 : n], '') AS suffix
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM cut
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_secrets": op2_secrets,
        "op3_quality_rules": op3_quality_rules,
        "op4_decontamination": op4_decontamination,
        "op5_ngram_join": op5_ngram_join,
        "op6_bpe": op6_bpe,
        "op7_pii": op7_pii,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_url_lists": op9_url_lists,
        "op10_licenses": op10_licenses,
        "op11_exact_dedup": op11_exact_dedup,
        "op12_vector_codes": op12_vector_codes,
        "op13_fill_in_middle": op13_fill_in_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": OP1_SQL,
        "op5_ngram_join": OP5_SQL,
        "op9_url_lists": OP9_SQL,
        "op11_exact_dedup": OP11_SQL,
        "op12_vector_codes": op12_sql(),
        "op13_fill_in_middle": OP13_SQL,
    }
