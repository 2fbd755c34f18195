import sys

from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from shelfwise.llm import decontamination, quality_rules
from shelfwise.llm.queries import vocabulary_path
from shelfwise.llm.texts import documents

sys.path.insert(0, __file__.rsplit("/", 1)[0])
import test_decontamination  # noqa: E402
import test_line_dedup  # noqa: E402


def groups(docs):
    """Documents that stay: of those linked, directly or not, by five-word shingles and 0.8, the smallest doc_id."""
    import re

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(lower))
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = [(i, shingles(text)) for i, text in docs]
    holders, label = {}, {i: i for i, _ in docs}
    for i, one in sets:
        for shingle in one:
            holders.setdefault(shingle, []).append(i)
    by_id = dict(sets)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, one in sets:
        common = {}
        for shingle in one:
            for j in holders[shingle]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, n in common.items():
            if 100 * n >= 80 * (len(one) + len(by_id[j]) - n):
                low, high = sorted((root(i), root(j)))
                label[high] = low
    return {i for i in label if root(i) == i}


def expected(docs, items, limits):
    kept = [(i, t) for i, t in docs if quality_rules.judged(t or "", 3, 4096, quality_rules.BANDS, 0.25, limits)[-1]]
    after = [(i, text) for i, _, _, text in test_line_dedup.brute(kept)]
    stay = groups(after)
    after = [(i, text) for i, text in after if i in stay]
    leaking = {i for i, *_ in test_decontamination.brute(after, items)}
    return {i: text for i, text in after if i not in leaking}


def test_pipeline_against_brute_force(spark, larger):
    docs = [tuple(row) for row in documents(spark, larger).select("doc_id", "text").collect()]
    items = [tuple(row) for row in spark.read.parquet(f"{larger}/benchmark.parquet").collect()]
    library = Tokenizer.from_file(vocabulary_path())
    rows = {row.doc_id: row for row in pipeline.run(spark, larger).collect()}
    left = expected(docs, items, quality_rules.derived_limits(documents(spark, larger)))
    assert set(rows) == set(left) and 0 < len(left) < len(docs)
    for i, row in rows.items():
        assert row.round_trip and row.n_tokens == len(row.ids)
        assert row.ids == library.encode(left[i], add_special_tokens=False).ids


def test_quality_stage_rejects_by_derived_limits(spark, larger):
    docs = documents(spark, larger)
    stays = pipeline.good_quality(spark, docs, larger).select("doc_id")
    base = quality_rules.quality_rules(docs).filter("NOT quality_rules.base_failed")
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    lost = base.join(stays, "doc_id", "left_anti")
    quality = {row.quality: row["count"] for row in lost.join(labels, "doc_id").groupBy("quality").count().collect()}
    assert quality.get(0, 0) >= 10 and set(quality) == {0}


def test_stages_keep_the_columns(spark, make_docs, awkward, testdata):
    benchmark_folder = testdata
    docs = make_docs(*awkward)
    for rows in (docs, docs.limit(0)):
        frame = rows
        for name, stage in pipeline.STAGES[:-1]:
            frame = stage(spark, rows, benchmark_folder)
            assert frame.columns == docs.columns and frame.schema == docs.schema or set(frame.columns) == set(docs.columns), name
            assert frame.count() <= rows.count()
        assert pipeline.STAGES[-1][1](spark, rows, benchmark_folder).count() == rows.count()


def test_rows_that_share_an_id_or_have_none(spark, make_docs, testdata):
    item = spark.read.parquet(f"{testdata}/benchmark.parquet").first().text
    words = " ".join(f"word{i}" for i in range(80))
    docs = make_docs((None, f"{words} {item}"), (None, f"{words} stays"), (1, f"{item} {words}"), (1, f"{words} as well"))
    left = {row.text for row in pipeline.without_benchmark(spark, docs, testdata).collect()}
    assert left == {f"{words} stays", f"{words} as well"}
    assert decontamination.MIN_SCORE <= 0.5


def test_groups_with_shared_and_missing_ids(spark, make_docs, testdata):
    words = {name: " ".join(f"{name}{i}" for i in range(80)) for name in "abcdef"}
    docs = make_docs(
        (None, words["a"]), (3, words["a"] + " more"), (None, words["b"]), (None, words["b"] + " more"), (None, words["c"]),
        (7, words["d"]), (7, words["d"] + " more"), (7, words["e"]), (2, words["e"] + " more"), (7, words["f"]), (7, words["f"]),
        (None, None), (None, ""),
    )
    rows = pipeline.one_of_each_group(spark, docs, testdata).collect()
    groups = sorted((row.text or "-")[0] for row in rows)
    assert groups == ["-", "-", *"abcdef"] and len(rows) == 8
    assert {(row.doc_id, row.text[0]) for row in rows if row.text} == {
        (3, "a"), (None, "b"), (None, "c"), (7, "d"), (2, "e"), (7, "f")
    }
