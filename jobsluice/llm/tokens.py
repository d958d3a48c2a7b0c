"""Token counts by a two-tier lookup inside the map tasks.

The tokenizer drops white space, so that the count of a text is the sum of the counts of its words.
Tier one is a broadcast table of the tokenizer's own whole words, its frequent pre-tokens, with the
number of tokens that the library gives each; its size is that of the vocabulary. Tier two is a
dictionary in each Python worker: words that neither tier knows are encoded by the library, once per
worker while the dictionary holds them. No word is shuffled.

A word here is what ASCII white space separates. No pre-token, normal form or added token of the
tokenizer reaches across such white space, which ``check_tokenizer`` tests on its settings.

Defined results: NULL and empty texts have no bytes and no tokens; repeated rows are counted each;
an empty table gives no rows. Other columns than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsluice.llm.words import slices

LIMIT = 2048
#: Words that a worker remembers; it starts anew when it knows more.
CACHE_WORDS = 1_000_000
#: Longer words are encoded each time.
CACHE_BYTES = 64


def check_tokenizer(text: str) -> None:
    """Raise if the settings of a tokenizer file let a token depend on what lies beyond white space."""
    settings = json.loads(text)
    steps = json.dumps(settings["pre_tokenizer"])
    if settings["model"].get("end_of_word_suffix") != "</w>" or "\\\\s\\\\p{L}" not in steps or '"add_prefix_space": true' in steps:
        raise ValueError("counts of words do not add up for this tokenizer")
    if any(set(t["content"]) & set(" \t\n\r\v\f") or t["single_word"] for t in settings["added_tokens"]):
        raise ValueError("an added token depends on white space")


def frequent_words(settings: str) -> dict[bytes, int]:
    """The whole words of the vocabulary that are valid text, and their numbers of tokens."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(settings)
    words = [w.removesuffix("</w>") for w in json.loads(settings)["model"]["vocab"] if w.endswith("</w>")]
    words = [w for w in words if w.isascii() and w.isprintable() and w and len(w) <= CACHE_BYTES]
    counts = tokenizer.encode_batch_fast(words, add_special_tokens=False)
    return {w.encode(): len(c) for w, c in zip(words, counts, strict=True)}


_state: dict = {}


def _worker(settings: str, table: dict[bytes, int]):
    """The tokenizer and the cache of this worker process, kept between tasks."""
    key = hash(settings)
    if _state.get("key") != key:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(settings)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _state.update(key=key, tokenizer=tokenizer, known=dict(table))
    return _state["tokenizer"], _state["known"]


def count_tokens(docs: DataFrame, tokenizer_file: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` for every row of ``docs``."""
    with open(tokenizer_file, encoding="utf-8") as f:
        settings = f.read()
    check_tokenizer(settings)
    shared = docs.sparkSession.sparkContext.broadcast((settings, frequent_words(settings)))

    def count(batches):
        tokenizer, known = _worker(*shared.value)
        table = shared.value[1]

        def lengths(words: list[bytes]) -> list[int]:
            found = tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
            return [len(f) for f in found]

        for rows, texts in slices(batches):
            texts_words = [texts.bytes_of(i).split() for i in range(len(texts))]
            missing = set().union(*texts_words).difference(known) if texts_words else set()
            if len(known) + len(missing) > CACHE_WORDS:
                known.clear()
                known.update(table)
                missing = set().union(*texts_words).difference(known)
            missing = list(missing)
            extra = dict(zip(missing, lengths(missing), strict=True))
            known.update((w, n) for w, n in extra.items() if len(w) <= CACHE_BYTES)
            counts = [sum(known[w] if w in known else extra[w] for w in words) for words in texts_words]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(texts.sizes, pa.int64()), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    counted = docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
