import math
import random
import re

from shelfwise.llm import licenses
from shelfwise.llm.queries import op10_licenses

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(text):
    """n_words, n_base, first_word, last_word, base_labels."""
    words = words_of(text)
    places = [
        (i, label) for phrase, label in PHRASES.items() for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places] or [None]
    return len(words), len(places), min(starts), max(starts), ",".join(sorted({label for _, label in places}))


def brute_matches(text, templates, threshold=licenses.THRESHOLD, size=licenses.BLOCK_WORDS):
    words, stride = words_of(text), size // 2
    found = set()
    for number, at in enumerate(range(0, max(len(words) - 1 - (size - stride), 0) + 1, stride)):
        for label, held in templates.items():
            share = len(held & set(words[at : at + size])) / len(held)
            if share >= threshold:
                found.add((number, label, round(share, 9)))
    return found


def test_query_against_brute_force(spark, larger):
    texts = {row.doc_id: row.text for row in spark.read.parquet(f"{larger}/documents.parquet").collect()}
    rows, hits = op10_licenses(spark, larger).collect(), 0
    assert len(rows) == len(texts)
    for row in rows:
        assert tuple(row)[1:6] == brute(texts[row.doc_id])
        assert set(row.base_labels.split(",")) - {""} <= set(row.labels.split(",")) and 0 <= row.score <= 1
        hits += row.n_base
    assert hits > 5


def test_places(make_docs):
    texts = [
        "CC-BY cc by, Cc\tBY", "The MIT License and the Apache License", "mit licenses xmit license", "éMIT license; mit license",
        "GNU General Public License\nGNU GENERAL PUBLIC LICENSE v3 " * 30, "cc", "by cc", "mit license", "İ mİt license K apache\x7flicense",
    ]
    rows = licenses.scan_licenses(make_docs(*enumerate(texts))).select("text", "licenses.*").collect()
    for row in rows:
        assert (row.n_words, row.n_base, row.first_word, row.last_word, ",".join(row.base_labels)) == brute(row.text)


def test_every_block_over_the_threshold(make_docs):
    chooser = random.Random(2)
    held = {label: set(words) for label, words in licenses.template_words(licenses.TEMPLATES).items()}
    common = sorted(set().union(*held.values()))
    docs = []
    for i in range(150):
        parts = [chooser.choice([*common[:30], "filler", "prose", "other"]) for _ in range(chooser.randint(0, 500))]
        for label in chooser.sample(sorted(held), 2):
            listed = licenses.TEMPLATES[label].split()
            for _ in range(chooser.randint(0, len(listed) // 4)):
                listed[chooser.randrange(len(listed))] = "changed"
            at = chooser.randint(0, len(parts))
            parts[at:at] = listed
        docs.append((i, " ".join(parts)))
    rows = licenses.scan_licenses(make_docs(*docs)).select("text", "licenses.*").collect()
    found = 0
    for row in rows:
        expected = brute_matches(row.text, held)
        assert {(m.block, m.label, round(m.containment, 9)) for m in row.matches} == expected
        assert {label for _, label, _ in expected} <= set(row.labels)
        found += len(expected)
    assert found > 100
    assert all(math.isclose(row.score, 1 if row.n_base else max([m.containment for m in row.matches], default=0)) for row in rows)


def test_templates_longer_than_a_block(make_docs):
    chooser = random.Random(5)
    long = {f"long {n}": " ".join(f"w{n}x{i}" for i in range(n)) for n in (90, 101, 300, 1500)}
    templates = {**long, "short": licenses.TEMPLATES["isc"]}
    texts = []
    for label, template in templates.items():
        for before in (0, 1, 99, 150, 777):
            words = template.split()
            for i in chooser.sample(range(len(words)), len(words) // 10):
                words[i] = "changed"
            texts.append((label, " ".join(["prose"] * before + words + ["prose"] * chooser.randint(0, 300))))
    half = " ".join(long["long 300"].split()[:150])
    docs = make_docs(*enumerate([text for _, text in texts] + [half, None, ""]))
    rows = {row.doc_id: row for row in licenses.scan_licenses(docs, templates=templates).select("doc_id", "licenses.*").collect()}
    for i, (label, text) in enumerate(texts):
        assert rows[i].labels == [label] and rows[i].score >= 0.8
        size = 200
        while size < 2 * len(licenses.template_words(templates)[label]):
            size *= 2
        held = {label: set(licenses.template_words(templates)[label])}
        assert {(m.block, m.label, round(m.containment, 9)) for m in rows[i].matches} == brute_matches(text, held, size=size)
    assert all(rows[len(texts) + i].labels == [] and rows[len(texts) + i].score == 0 for i in range(3))


def test_awkward_rows(make_docs, awkward):
    df = make_docs(*awkward)
    rows = licenses.scan_licenses(df).select("text", "licenses.*").collect()
    assert len(rows) == len(awkward) and licenses.scan_licenses(df).columns == [*df.columns, "licenses"]
    for row in rows:
        assert (row.n_words, row.n_base, row.first_word, row.last_word, ",".join(row.base_labels)) == brute(row.text)
    assert licenses.scan_licenses(make_docs()).count() == 0
