"""The training-data pipeline: documents to tokens, in stages that each write Parquet for the next.

Every stage works on all that its predecessor kept. Rows that share a doc_id stay apart, as decisions are joined back by
the content of a row; of each group of linked documents one row stays, that with the smallest doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.llm import bpe, decontamination, line_dedup, ngram_join, quality_rules as rules
from shelfwise.llm.queries import vocabulary_path
from shelfwise.llm.texts import documents, row_key
from shelfwise.sources.shared import materialized

# Near duplicates are documents whose sets of five-word shingles have a similarity of 0.8 or more.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops documents that the quality rules reject, by the limits that all documents give."""
    limits = rules.derived_limits(docs)
    found = rules.quality_rules(docs, into="_found", most_bad=rules.MAX_BAD_DERIVED, limits=limits)
    return found.filter("_found.kept").drop("_found")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops lines that many documents share, but for one copy; every document stays."""
    found = line_dedup.dedup_lines(docs, into="_found")
    length = F.char_length("_found.text").cast(docs.schema["n_chars"].dataType)
    return found.withColumns({"text": F.col("_found.text"), "n_chars": length}).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of linked documents the one with the smallest doc_id stays (a null one only if no other has an id); of several such
    the one with the smallest row key, and of equal rows one."""
    found = ngram_join.labelled_rows(docs, shingle=NEAR_SHINGLE, percent=NEAR_PERCENT).filter("label IS NOT NULL")
    rows = found.groupBy("label", "doc_id", "row1", "row2").agg(F.count("*").alias("copies"))
    rows = materialized(rows, "group-rows")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row1", "row2")
    stays = rows.groupBy("label").agg(F.min(order).alias("first"))
    same = (F.col("row1") == F.col("first.row1")) & (F.col("row2") == F.col("first.row2"))
    marks = rows.join(stays, "label").withColumn("goes", ~same).filter("goes OR copies > 1")
    marks = marks.select(F.col("row1").alias("_row1"), F.col("row2").alias("_row2"), F.col("goes").alias("_goes"))
    marks = materialized(marks, "group-marks")
    row1, row2 = row_key("doc_id", "text")
    alone = docs.join(marks, (row1 == F.col("_row1")) & (row2 == F.col("_row2")), "left_anti")
    again = marks.filter("NOT _goes")
    if not again.take(1):
        return alone
    equal = docs.join(again, (row1 == F.col("_row1")) & (row2 == F.col("_row2")))
    return alone.unionByName(equal.dropDuplicates(["_row1", "_row2"]).select(docs.columns))


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops documents that hold items of the benchmark."""
    leaks = decontamination.leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))
    goes = leaks.select(F.col("row1").alias("_row1"), F.col("row2").alias("_row2")).distinct()
    row1, row2 = row_key("doc_id", "text")
    return docs.join(goes, (row1 == F.col("_row1")) & (row2 == F.col("_row2")), "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents with their tokens instead of their text, and whether these decode to it."""
    found = bpe.bpe(docs, vocabulary_path(), into="_found").withColumn("ids", F.col("_found.ids"))
    found = found.withColumn("round_trip", F.col("_found.decoded").eqNullSafe(F.coalesce("text", F.lit(""))))
    return found.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("quality_rules", good_quality),
    ("line_dedup", without_repeated_lines),
    ("ngram_join", one_of_each_group),
    ("decontamination", without_benchmark),
    ("bpe", tokens),
]
ORACLE_SQL = None  # compression ratios, similarity groups, BM25 and BPE have no SQL; tests compare with brute force


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    for name, stage in STAGES:
        docs = materialized(stage(spark, docs, folder), f"pipeline-{name}")
    return docs
