import hashlib
import random

import pytest
from tokenizers import Tokenizer

from shelfwise.llm.bpe import Vocabulary, bpe
from shelfwise.llm.queries import op6_bpe, vocabulary_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_against_library(spark, testdata, library):
    texts = {row.doc_id: row.text or "" for row in spark.read.parquet(f"{testdata}/documents.parquet").collect()}
    rows = op6_bpe(spark, testdata).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), digest(",".join(map(str, ids))), digest(decoded))


def test_random_texts(library):
    words, chooser = Vocabulary(vocabulary_path()), random.Random(1)
    letters = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 　᠎​'sdtrevmlaaaabbZ019é日本語😀́½²\x00"
    texts = ["".join(chooser.choice(letters) for _ in range(chooser.randint(0, 60))) for _ in range(1500)]
    texts += [text + "<|endoftext|>" + text[:9] + "<|endoftext|><|endoftext|>" for text in texts[:300]] + ["a" * 5001, "<|endof"]
    for text, ids in zip(texts, words.encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert words.decode(ids) == text
    assert words.decode(words.of_byte[[0xE9, 0x41]]) == library.decode(words.of_byte[[0xE9, 0x41]].tolist())


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr("shelfwise.llm.bpe.REMEMBERED", 20)
    words = Vocabulary(vocabulary_path())
    for i in range(30):
        text = " ".join(f"w{i * k}" for k in range(15))
        assert words.decode(words.encode([text])[0]) == text
        assert len(words.known) < 40 and len(words.of_word) < 80


def test_awkward_rows(make_docs, awkward):
    df = make_docs(*awkward)
    rows = bpe(df, vocabulary_path()).select("text", "bpe.*").collect()
    assert len(rows) == len(awkward) and all(row.decoded == (row.text or "") for row in rows)
    assert bpe(make_docs(), vocabulary_path()).count() == 0
