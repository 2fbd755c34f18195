import base64
import random
import re

from shelfwise.llm.queries import op3_quality_rules
from shelfwise.llm.quality_rules import SCHEMA, quality_rules, repeated_words

SPACE = r"[^\x20\x09-\x0D]+"


def brute(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = re.findall(SPACE, text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {i + k for i, one in enumerate(windows) if windows.count(one) > 1 for k in range(3)}
    lines = text.split("\n")
    duplicates = sum(bool(re.search(SPACE, line)) and line in lines[:i] for i, line in enumerate(lines))
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(repeated), failed


def test_query_against_brute_force(spark, testdata):
    texts = {row.doc_id: row.text for row in spark.read.parquet(f"{testdata}/documents.parquet").collect()}
    rows = op3_quality_rules(spark, testdata).collect()
    assert len(rows) == len(texts)
    short = [row for row in rows if len(texts[row.doc_id]) < 6000]
    assert len(short) > 100
    for row in short:
        assert tuple(row)[1:7] == brute(texts[row.doc_id])
    assert all(not row.kept for row in rows if row.base_failed)


def test_clean_documents_stay(spark, testdata):
    good = spark.read.parquet(f"{testdata}/labels.parquet").filter("quality = 1 AND toxic = 0").select("doc_id")
    rows = op3_quality_rules(spark, testdata).join(good, "doc_id").filter("NOT base_failed").collect()
    assert len(rows) > 50 and all(row.kept for row in rows)


def test_derived_limits_reject_bad_documents_and_keep_clean_ones(spark, larger):
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    rows = op3_quality_rules(spark, larger).join(labels, "doc_id").filter("NOT base_failed").collect()
    clean = [row.kept for row in rows if row.quality == 1 and row.toxic == 0]
    bad = [row.kept for row in rows if row.quality == 0]
    assert len(clean) > 50 and all(clean)
    assert len(bad) > 10 and sum(bad) < 0.7 * len(bad)


def verdict(make_docs, *texts):
    rows = quality_rules(make_docs(*enumerate(texts))).select("doc_id", "quality_rules.*").orderBy("doc_id").collect()
    return [row.reason for row in rows], [row.kept for row in rows]


def test_bands(make_docs):
    chooser = random.Random(3)
    prose = " ".join("".join(chooser.choice("etaoinshrdlu") for _ in range(chooser.randint(2, 7))) for _ in range(3000))
    noise = base64.b64encode(chooser.randbytes(9000)).decode()
    noisy = " ".join(noise[i : i + 60] for i in range(0, len(noise), 60))
    mixed = prose[:4000] + " " + noisy + noisy
    words = " ".join(f"{a}-{b}" for a in "abcdefgh" for b in range(40)) + " "
    reasons, kept = verdict(make_docs, prose, noisy, words * 60, mixed)
    assert reasons[0] is None and kept[0]
    assert reasons[1] == "incompressible" and reasons[2] == "repetitive" and not any(kept[1:])
    assert reasons[3] in ("incompressible", "incompressible chunks")


def test_awkward_rows(make_docs, awkward):
    df = make_docs(*awkward)
    rows = quality_rules(df).select("doc_id", "text", "quality_rules.*").collect()
    assert len(rows) == len(awkward) and quality_rules(df).columns == [*df.columns, "quality_rules"]
    assert [field.name for field in quality_rules(df).schema["quality_rules"].dataType] == [part.split()[0] for part in SCHEMA.split(", ")]
    for row in rows:
        if row.text is None or len(row.text) < 1000:
            assert tuple(row)[2:8] == brute(row.text)
    assert quality_rules(make_docs()).count() == 0


def test_many_different_words():
    words = [str(i).encode() for i in range(2_200_000)]
    assert repeated_words(words[:100] + words + words[:100]) >= 300
