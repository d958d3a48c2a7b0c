"""Language identification: known words first, shorter and shorter character n-grams for the others.

A model holds, per language, the log frequencies of words and of character n-grams of 5 down to 1 code points of the
words, each word between two blanks. A text is scored word by word. A word that any language knows gives every
language its log frequency there, and the penalty where that language lacks it. An unknown word gives the
mean over those of its n-grams of the greatest length of which any is known; a word without any says nothing. The
language with the highest mean over the words wins.

The model is fitted on a sample of the labelled rows: about ``TRAIN_ROWS`` rows shared out evenly among the languages,
chosen by a hash of the row, whole texts. Of each kind and language the ``ENTRIES`` most frequent entries stay. So the
model that is broadcast has at most 6 * ENTRIES entries of 16 bytes for each language, whatever the input.

Words are runs of letters (Unicode category L) of the lower-cased text. Defined results: a NULL text, one
without letters, and every text if nothing was learnt, is ``und`` with score 0; a text none of whose n-grams is known
gets the language with most training rows; equal scores are decided for the language with more training rows, then
the smaller name; rows with a NULL language are not learnt from; repeated rows are all scored; an empty table gives no
rows. Long texts are scored whole, in pieces that end between words. Only the named columns are read, so extra
columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsluice.llm.shared import stored
from jobsluice.llm.words import mix64, range_hashes, sequence_hashes, slices

UNKNOWN = "und"
#: Rows that the model is fitted on, shared out among the languages, with at least ``LEAST_ROWS`` for each.
TRAIN_ROWS = 40_000
LEAST_ROWS = 200
#: Entries of a kind that a language keeps.
ENTRIES = 200_000
#: Length of the longest n-grams; kind 0 is whole words, kind n the n-grams of n code points.
LONGEST = 5
#: So many words at most sharpen the score.
SURE_WORDS = 8
#: Code points handled at once, unless one word alone has more.
PIECE = 1 << 20
BLANK = 0x20


@cache
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _pieces(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """The texts from ``first`` on as far as a piece reaches; a long text comes in parts that end between words."""
    held, size, first = [], 0, 0
    for i, text in enumerate(texts):
        text = text or ""
        if held and size + len(text) > PIECE:
            yield first, held
            held, size, first = [], 0, i
        while len(text) > PIECE:
            end = PIECE
            while end < len(text) and text[end].isalpha():
                end += 1
            yield i, [text[:end]]
            text = text[end:]
        held.append(text)
        size += len(text)
    if held:
        yield first, held


@dataclass
class Spans:
    """The words of a piece: its code points, where words begin and end, their texts and hashes."""

    chars: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    hashes: np.ndarray


def spans(first: int, texts: list[str]) -> Spans:
    """The words of ``texts``; the first of them has number ``first``."""
    texts = [text.lower() for text in texts]
    lowered = "\n".join(texts)
    chars = np.frombuffer(lowered.encode("utf-32-le"), np.uint32)
    letter = np.concatenate([[False], _letters()[chars], [False]])
    starts, ends = np.flatnonzero(letter[1:] & ~letter[:-1]), np.flatnonzero(letter[:-1] & ~letter[1:])
    width = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
    at = np.concatenate([np.zeros(1, np.int64), np.cumsum(width)])
    hashes = range_hashes(np.frombuffer(lowered.encode(), np.uint8), at[starts], at[ends])
    doc = first + np.searchsorted(np.cumsum([len(text) + 1 for text in texts]), starts, "right")
    return Spans(chars, starts, ends, doc, hashes)


def _words(texts: list[str | None]) -> Iterator[Spans]:
    """The words of all texts, piece by piece, each with the index of its text."""
    for first, piece in _pieces(texts):
        yield spans(first, piece)


def distinct(found: Spans) -> tuple[np.ndarray, np.ndarray]:
    """Index of one occurrence of each different word, and the different word of each occurrence."""
    _, at, word = np.unique(found.hashes, return_index=True, return_inverse=True)
    return at, word


def padded(found: Spans, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of the words ``at``, each between blanks, and the word of each code point."""
    sizes = found.ends[at] - found.starts[at] + 2
    word = np.repeat(np.arange(len(at)), sizes)
    place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = (place > 0) & (place < sizes[word] - 1)
    out = np.full(len(word), BLANK, np.uint32)
    out[inside] = found.chars[found.starts[at][word[inside]] + place[inside] - 1]
    return out, word


def grams(chars: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams within words, and their words; a lone blank is none."""
    hashes = sequence_hashes(mix64(chars.astype(np.uint64)), n)
    first = word[: len(hashes)]
    within = first == word[n - 1 :][: len(hashes)]
    if n == 1:
        within &= chars != BLANK
    return hashes[within], first[within]


def _summed(keys: tuple[np.ndarray, ...], weights: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    order = np.lexsort(keys[::-1])
    keys = tuple(k[order] for k in keys)
    head = np.ones(len(order), bool)
    head[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    begins = np.flatnonzero(head)
    return tuple(k[begins] for k in keys), np.add.reduceat(weights[order], begins) if len(begins) else weights[:0]


def count_grams(rows: DataFrame) -> DataFrame:
    """``kind``, ``lang``, ``gram``, ``n`` of the texts of ``rows`` (``lang``, ``text``); ``gram`` is a hash."""

    def count(batches):
        for batch, _ in slices(batches):
            langs = batch.column("lang").dictionary_encode()
            names, lang_of = langs.dictionary, langs.indices.to_numpy()
            for found in _words(batch.column("text").to_pylist()):
                at, word = distinct(found)
                (lang, word), n = _summed((lang_of[found.doc], word), np.ones(len(word), np.int64))
                parts = [(np.zeros(len(n), np.int64), lang, found.hashes[at][word], n)]
                chars, owner = padded(found, at[word])
                for k in range(1, LONGEST + 1):
                    hashes, of = grams(chars, owner, k)
                    (l, h), m = _summed((lang[of], hashes), n[of])
                    parts.append((np.full(len(m), k), l, h, m))
                kind, lang, gram, n = (np.concatenate(p) for p in zip(*parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kind, pa.int32()), names.take(pa.array(lang)), pa.array(gram.view(np.int64)), pa.array(n)],
                    ["kind", "lang", "gram", "n"],
                )

    counted = rows.mapInArrow(count, "kind int, lang string, gram bigint, n bigint")
    return counted.groupBy("kind", "lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Table:
    """Log frequencies of one kind: sorted hashes, where the entries of each begin, their languages and values."""

    hashes: np.ndarray
    begins: np.ndarray
    langs: np.ndarray
    values: np.ndarray
    #: What a language gets for an entry it lacks.
    penalty: float

    def add(self, wanted: np.ndarray, of: np.ndarray, n: int, n_langs: int) -> tuple[np.ndarray, np.ndarray]:
        """Sums over the known ones of ``wanted`` by owner ``of`` (below ``n``) and language, and how many each owner has."""
        total, known = np.zeros((n, n_langs)), np.zeros(n, np.int64)
        if not len(self.hashes) or not len(wanted):
            return total, known
        at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        hit = self.hashes[at] == wanted
        at, of = at[hit], of[hit]
        known = np.bincount(of, minlength=n)
        sizes = self.begins[at + 1] - self.begins[at]
        entry = np.repeat(self.begins[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
        cell = np.repeat(of, sizes) * n_langs + self.langs[entry]
        total = np.bincount(cell, self.values[entry] - self.penalty, n * n_langs).reshape(n, n_langs)
        return total + known[:, None] * self.penalty, known


@dataclass
class Model:
    """The languages, most training rows first, and a table for words and for each length of n-grams."""

    langs: list[str]
    tables: list[Table]

    def of_words(self, found: Spans, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the words ``at`` the score in every language, and which words have one."""
        n, n_langs = len(at), len(self.langs)
        score, known = self.tables[0].add(found.hashes[at], np.arange(n), n, n_langs)
        done = known > 0
        rest = np.flatnonzero(~done)
        for k in range(LONGEST, 0, -1):
            if not len(rest):
                break
            chars, word = padded(found, at[rest])
            total, count = self.tables[k].add(*grams(chars, word, k), len(rest), n_langs)
            hit = count > 0
            score[rest[hit]] = total[hit] / count[hit, None]
            done[rest[hit]] = True
            rest = rest[~hit]
        return score, done

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text the sum of the scores of its words in every language, how many words had one, and all its words."""
        total = np.zeros((len(texts), len(self.langs)))
        scored, words = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for found in _words(texts):
            words += np.bincount(found.doc, minlength=len(texts))
            at, word = distinct(found)
            value, done = self.of_words(found, at)
            (doc, word), n = _summed((found.doc, word), np.ones(len(word), np.int64))
            has = done[word]
            doc, word, n = doc[has], word[has], n[has]
            scored += np.bincount(doc, n, len(texts)).astype(np.int64)
            for lang in range(len(self.langs)):
                total[:, lang] += np.bincount(doc, value[word, lang] * n, len(texts))
        return total, scored, words

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        total, scored, words = self.scores(texts)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        mean = total / np.maximum(scored, 1)[:, None]
        best = mean.argmax(1)
        away = (mean - mean.max(1)[:, None]) * np.log(10) * np.minimum(scored, SURE_WORDS)[:, None]
        sure = 1 / np.exp(away).sum(1)
        names = [self.langs[b] if w else UNKNOWN for b, w in zip(best.tolist(), words.tolist())]
        return names, np.where(words > 0, sure, 0.0)


def _table(rows: pa.Table, kind: int, langs: list[str], totals: dict[tuple[int, str], int]) -> Table:
    rows = rows.filter(pa.compute.equal(rows["kind"], kind))
    lang = np.array([langs.index(x) for x in rows["lang"].to_pylist()], np.int64)
    gram = rows["gram"].to_numpy().view(np.uint64)
    total = np.array([totals[kind, x] for x in langs if (kind, x) in totals] or [1], np.float64)
    own = np.array([totals.get((kind, x), 1) for x in langs], np.float64)
    value = np.log10(rows["n"].to_numpy() / own[lang])
    order = np.lexsort((lang, gram))
    hashes, begins = np.unique(gram[order], return_index=True)
    return Table(hashes, np.append(begins, len(order)), lang[order], value[order], float(-np.log10(2 * total.max())))


def train(rows: DataFrame, train_rows: int = TRAIN_ROWS, entries: int = ENTRIES) -> Model:
    """The model of ``rows`` (``doc_id``, ``text``, ``lang``); NULL languages and texts are left out."""
    rows = rows.where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes, key=lambda x: (-sizes[x], x))
    share = max(LEAST_ROWS, train_rows // max(len(langs), 1))
    # A row is taken if its hash falls into the share of its language; no sort, no window over a language.
    rates = {x: min(1.0, share / sizes[x]) for x in langs}
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text"), F.lit(1 << 30)) / (1 << 30)
    cut = F.lit(1.0)
    for lang, rate in rates.items():
        if rate < 1:
            cut = F.when(F.col("lang") == lang, rate).otherwise(cut)
    counts = stored(count_grams(rows.where(part < cut).select("lang", "text")), "grams")
    totals = {(r["kind"], r["lang"]): r["n"] for r in counts.groupBy("kind", "lang").agg(F.sum("n").alias("n")).collect()}
    order = Window.partitionBy("kind", "lang").orderBy(F.col("n").desc(), "gram")
    kept = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= entries)
    found = kept.select("kind", "lang", "gram", "n").toArrow()
    return Model(langs, [_table(found, kind, langs, totals) for kind in range(LONGEST + 1)])


def identify(docs: DataFrame, held_out: Column, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` for every row of ``docs``, learnt from those not held out."""
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"), held_out.alias("held_out"))
    model = train(rows.where("not held_out").select("doc_id", "text", "lang"), train_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        for batch, _ in slices(batches):
            names, scores = shared.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = dict(rows.dtypes)["doc_id"]
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )
