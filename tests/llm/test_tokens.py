"""Token counts against the library on whole texts."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from jobsluice.llm import tokens

FILE = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(FILE)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False))


def test_all_rows(docs, corpus):
    got = tokens.count_tokens(docs, FILE).collect()
    want = sorted(((r[0], len((r[1] or "").encode()), library(r[1])) for r in corpus), key=repr)
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got), key=repr) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)


def test_odd_texts(spark, monkeypatch):
    texts = [
        "<|endoftext|>", "a<|startoftext|>b <|endoftext|> <|ENDOFTEXT|>", "don't I'LL x's 's ' s", "é ́a",
        "a b c\x85d\x1ce", "ΑΣ ΟΔΟΣ.", "ﬁ ½ Ⅷ 中文字 🙂👍🏽", "x" * 5_000, "1234 5678,90", "\x00 \x7f", "İstanbul K",
    ]
    monkeypatch.setattr(tokens, "CACHE_WORDS", 49_000)
    rows = tokens.count_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), FILE).collect()
    assert [r["n_tokens"] for r in sorted(rows)] == [library(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_words_add_up(text):
    words = [w.decode() for w in text.encode("utf-8", "ignore").split()]
    assert sum(map(library, words)) == library(text)


def test_other_tokenizers_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        tokens.check_tokenizer(f.read())


def test_empty_table(empty):
    assert tokens.count_tokens(empty, FILE).count() == 0
