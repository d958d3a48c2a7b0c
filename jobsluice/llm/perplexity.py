"""Quality rules: base signals of a text and bands of its n-gram perplexity.

The language model is a modified Kneser-Ney model of byte trigrams. Spark counts the trigrams of
all texts; the discounts, continuation counts and backoff weights are DataFrame aggregates over
the count table. The finished model is one sorted array of n-gram hashes per order with the log
probabilities beside it. An alphabet of 256 symbols bounds it: at most 2^24 trigrams, 2^16 bigrams,
so that the broadcast is at most 200 MB whatever the input (a few MB for texts in some languages).

Two more models of the same kind see beyond three bytes. That of the words themselves, trigrams of all words of
the corpus whose tables stay spread over buckets (``wordgrams``), scores a text by the others. That of the shape of a
text knows each word only as one of ``WORD_CLASSES`` classes of its hash: at most 2^18 trigrams exist, whatever the input.

Bands are per language and model: a text whose log2 perplexity per word lies too far above or below
the median of its language is rejected. The spread of bytes is the median absolute deviation of the
rows that pass the base rules; those of shape and of words are a share of the median. A third of junk can move
none far. That of words has no lower end: what other texts foresee is a copy, which is no fault of the text.
Widths are fitted on labelled rows.

Defined results: NULL and empty texts have no words and fail the base rules; NULL languages are a
language of their own; repeated rows count as often as they occur; an empty table gives no rows.
Columns other than ``doc_id``, ``text`` and ``lang`` are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsluice.llm.shared import stored
from jobsluice.llm.wordgrams import with_word_bits
from jobsluice.llm.words import (
    Texts,
    mix64,
    range_hashes,
    sequence_hashes,
    slices,
    sums,
    windows_within,
    word_hashes,
    words_of,
)

MIN_WORDS = 50
REPEAT_PERCENT = 50
REPEAT_WINDOW = 3
#: Band of bytes: this many times the standard deviation that the median absolute deviation stands for.
BAND = 5.0
DEVIATION = 1.4826
#: Band of shapes: from this share of the median to the median over this share, where that of words ends too.
WORD_SHARE = 0.7
WORD_CLASSES = 64
SYMBOLS = b"#*$%&|<>"
#: Bytes that no UTF-8 text holds, as marks before and after a text.
BEGIN, END = 0xFF, 0xFE
#: Entries gathered in a task before they are merged.
MERGE_AT = 4_000_000
#: Width of the cells in which quantiles are found.
CELL = 0.01

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _salted(doc: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values told apart by text, as one 64-bit key."""
    return mix64(values + mix64(doc.astype(np.uint64) + np.uint64(1)))


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    hit = np.zeros(len(keys), bool)
    hit[order[1:]] |= same
    hit[order[:-1]] |= same
    return hit


def base_signals(texts: Texts) -> dict[str, np.ndarray]:
    """The counts behind the base rules, one value a text."""
    words = words_of(texts)
    doc = words.doc
    data, offsets, n = texts.data, texts.offsets, len(texts)
    starts_char = (data & 0xC0) != 0x80
    chars = np.concatenate([np.zeros(1, np.int64), np.cumsum(starts_char)])
    word_chars = sums(chars[words.ends] - chars[words.starts], words.first)

    breaks = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    line_doc = np.searchsorted(offsets, line_starts, "right") - 1
    # A break at the very end of a text starts a line there, which belongs to that text and is empty.
    line_ends = np.append(line_starts[1:], len(data))
    has_word = np.searchsorted(words.starts, line_ends) > np.searchsorted(words.starts, line_starts)
    line_starts, line_ends, line_doc = line_starts[has_word], line_ends[has_word], line_doc[has_word]
    line_ends = line_ends - (data[line_ends - 1] == 10)
    keys = _salted(line_doc, range_hashes(data, line_starts, line_ends))
    order = np.argsort(keys)
    later = order[1:][keys[order[1:]] == keys[order[:-1]]]
    dup_lines = np.bincount(line_doc[later], minlength=n)

    covered = np.zeros(int(words.first[-1]) + 1, np.int32)
    inside = np.flatnonzero(windows_within(words, REPEAT_WINDOW))
    if len(inside):
        grams = sequence_hashes(word_hashes(texts, words), REPEAT_WINDOW)[inside]
        found = inside[_repeated(_salted(doc[inside], grams))]
        np.add.at(covered, found, 1)
        np.add.at(covered, found + REPEAT_WINDOW, -1)
    repeat = sums(np.cumsum(covered[:-1]) > 0, words.first)
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": word_chars,
        "n_symbols": sums(_SYMBOL[data], offsets),
        "n_dup_lines": dup_lines.astype(np.int64),
        "n_repeat_words": repeat,
    }


def trigrams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all byte trigrams, each text between its marks, and where each text's codes begin."""
    n = len(texts)
    padded = np.full(len(texts.data) + 3 * n, END, np.uint32)
    first = texts.offsets[:-1] + 3 * np.arange(n)
    at = np.arange(len(texts.data)) + 2 + np.repeat(3 * np.arange(n), texts.sizes)
    padded[first], padded[first + 1] = BEGIN, BEGIN
    padded[at] = texts.data
    codes = padded[:-2] << 16 | padded[1:-1] << 8 | padded[2:] if n else np.zeros(0, np.uint32)
    # Of each text's symbols the first two begin no event; a text of b bytes has b + 1 events.
    event = np.ones(len(padded), bool)
    event[first], event[first + 1] = False, False
    begins = texts.offsets + np.arange(n + 1)
    return codes[event[2:]] if n else codes, begins


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)


def word_classes(texts: Texts) -> Texts:
    """Every word as one byte, the class of its hash."""
    words = words_of(texts)
    return Texts((word_hashes(texts, words) % np.uint64(WORD_CLASSES)).astype(np.uint8), words.first)


def count_trigrams(docs: DataFrame, text: str = "text", of_words: bool = False) -> DataFrame:
    """``code``, ``n``: every trigram of bytes or word classes, counted in the tasks before the shuffle."""

    def count(batches):
        parts, held = [], 0
        for _, texts in slices(batches):
            codes, n = np.unique(trigrams(word_classes(texts) if of_words else texts)[0], return_counts=True)
            parts.append((codes, n))
            held += len(codes)
            if held > MERGE_AT:
                parts = [_merged(parts)]
                held = len(parts[0][0])
        if parts:
            codes, n = _merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int32)), pa.array(n)], ["code", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, "code int, n bigint")
    return rows.groupBy("code").agg(F.sum("n").alias("n"))


def _discount(n: Column, d: dict[str, float]) -> Column:
    return F.when(n == 1, d["d1"]).when(n == 2, d["d2"]).otherwise(d["d3"])


def _discounts(counts: DataFrame) -> dict[str, float]:
    """Discounts of one order from its counts of counts; usual values where those are too few."""
    row = counts.agg(*[F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    return dict(zip(("d1", "d2", "d3"), discounts_of(*(row[f"n{k}"] for k in (1, 2, 3, 4))), strict=True))


def discounts_of(n1: int, n2: int, n3: int, n4: int) -> tuple[float, ...]:
    """Discounts of the counts 1, 2 and more from how many counts are 1, 2, 3 and 4."""
    if not all((n1, n2, n3, n4)):
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(float(min(max(v, 0.05), k + 0.95)) for k, v in enumerate(found))


def _order(counts: DataFrame, lower: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Interpolated probabilities of one order, and the backoff weights of its contexts.

    ``counts`` has ``code`` and ``n``. ``lower`` has ``code`` (the code without its first symbol)
    and ``p``; None stands for equal probabilities of 256 symbols.
    """
    d = _discounts(counts)
    counts = counts.withColumn("context", F.shiftright("code", 8)).withColumn("taken", _discount(F.col("n"), d))
    contexts = counts.groupBy("context").agg(F.sum("n").alias("total"), F.sum("taken").alias("left"))
    contexts = contexts.select("context", "total", (F.col("left") / F.col("total")).alias("weight"))
    rows = counts.join(contexts, "context")
    own = (F.col("n") - F.col("taken")) / F.col("total")
    if lower is None:
        return rows.select("code", (own + F.col("weight") / 256).alias("p")), contexts
    mask = 0xFFFF if "wide" in lower.columns else 0xFF
    rows = rows.withColumn("tail", F.col("code").bitwiseAND(mask))
    rows = rows.join(lower.select(F.col("code").alias("tail"), F.col("p").alias("q")), "tail")
    return rows.select("code", (own + F.col("weight") * F.col("q")).alias("p")), contexts


@dataclass
class Model:
    """Sorted hashes of the n-grams of each order, log10 probabilities, and those of the backoff weights."""

    grams: list[tuple[np.ndarray, np.ndarray]]
    weights: list[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, values = table
        if not len(hashes):
            return np.zeros(len(codes), bool), np.zeros(len(codes))
        wanted = mix64(codes)
        at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
        return hashes[at] == wanted, values[at]

    def log_probability(self, codes: np.ndarray) -> np.ndarray:
        """log10 of the probability of the last symbol of each trigram after the first two."""
        codes = codes.astype(np.uint64)
        known, out = self._find(self.grams[2], codes)
        out = out.astype(np.float64)
        rest = np.flatnonzero(~known)
        out[rest] = 0.0
        for order in (2, 1):
            tail = codes[rest] & np.uint64((1 << 8 * order) - 1)
            has, weight = self._find(self.weights[order], codes[rest] >> np.uint64(8) & np.uint64((1 << 8 * order) - 1))
            out[rest] += np.where(has, weight, 0.0)
            known, value = self._find(self.grams[order - 1], tail)
            out[rest[known]] += value[known]
            rest = rest[~known]
        has, weight = self._find(self.weights[0], np.zeros(len(rest), np.uint64))
        out[rest] += np.where(has, weight, 0.0) - np.log10(256)
        return out


def _sorted(table: pa.Table, value: str) -> tuple[np.ndarray, np.ndarray]:
    hashes = mix64(table["code"].to_numpy().astype(np.uint64))
    order = np.argsort(hashes)
    return hashes[order], np.log10(table[value].to_numpy())[order].astype(np.float32)


def train(docs: DataFrame, text: str = "text", of_words: bool = False) -> Model:
    """The model of the bytes or the word classes of all texts of ``docs``."""
    third = stored(count_trigrams(docs, text, of_words), "trigrams")
    tails = third.groupBy(F.col("code").bitwiseAND(0xFFFF).alias("code")).agg(F.count("*").alias("n"))
    second = stored(tails, "bigrams")
    first = second.groupBy(F.col("code").bitwiseAND(0xFF).alias("code")).agg(F.count("*").alias("n"))
    p1, w0 = _order(first, None)
    p1 = stored(p1, "unigram-p")
    p2, w1 = _order(second, p1)
    p2 = stored(p2, "bigram-p")
    p3, w2 = _order(third, p2.withColumn("wide", F.lit(True)))
    grams = [_sorted(p.select("code", "p").toArrow(), "p") for p in (p1, p2, p3)]
    weights = [
        _sorted(w.select(F.col("context").alias("code"), F.col("weight").alias("p")).toArrow(), "p")
        for w in (w0, w1, w2)
    ]
    return Model(grams, weights)


def _quantiles(rows: DataFrame, group: str, value: Column, probabilities: dict[str, float]) -> DataFrame:
    """Per group, the value below which lies each share of the rows, exact to a cell."""
    cells = rows.groupBy(group, F.floor(value / CELL).alias("_cell")).agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("_upto", F.sum("_n").over(upto))
    cells = cells.withColumn("_all", F.sum("_n").over(Window.partitionBy(group)))
    return cells.groupBy(group).agg(
        *[
            (F.min(F.when(F.col("_upto") >= F.col("_all") * p, F.col("_cell"))) * CELL).alias(name)
            for name, p in probabilities.items()
        ]
    )


def _bits(model: Model, texts: Texts) -> np.ndarray:
    """log2 of one over the probability of every text."""
    codes, begins = trigrams(texts)
    distinct, at = np.unique(codes, return_inverse=True)
    total = np.concatenate([np.zeros(1), np.cumsum(model.log_probability(distinct)[at])])
    return (total[begins[:-1]] - total[begins[1:]]) / np.log10(2)


def score(docs: DataFrame, model: Model, shapes: Model) -> DataFrame:
    """``doc_id``, ``lang``, the base signals, and per word the bits of its bytes, of the classes of its words and of its words.

    These are ``surprise``, ``shape_surprise`` and ``word_surprise``, each a log2 perplexity per word. ``known_surprise`` are
    the bits of the words shared out to those that other texts know.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model, shapes))

    def measure(rows: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        of_bytes, of_classes = shared.value
        signals = base_signals(texts)
        n = np.maximum(signals["n_words"], 1)
        return pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id"),
                rows.column("lang"),
                *[pa.array(v, pa.int64()) for v in signals.values()],
                pa.array(_bits(of_bytes, texts) / n, pa.float64()),
                pa.array(_bits(of_classes, word_classes(texts)) / n, pa.float64()),
            ],
            ["doc_id", "lang", *signals, "surprise", "shape_surprise"],
        )

    kinds = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
    doc_kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    kinds = f"doc_id {doc_kind}, lang string, {kinds}, surprise double, shape_surprise double"
    scored = with_word_bits(rows, measure, kinds, discounts_of, "word_bits")
    bits, known = F.col("word_bits"), F.greatest("word_bits_of", F.lit(1))
    scored = scored.withColumns({"word_surprise": bits / F.greatest("n_words", F.lit(1)), "known_surprise": bits / known})
    return scored.drop("word_bits", "word_bits_of")


def quality_rules(docs: DataFrame, band: float = BAND, word_share: float = WORD_SHARE) -> DataFrame:
    """One row per row of ``docs``: the base signals, ``base_failed``, ``surprise``, the band and ``kept``.

    A row is kept if it passes the base rules and the surprises of its bytes, of the classes of its words
    and of its words lie in the bands of its language. The band of bytes is the median minus or plus ``band`` times the
    larger of two deviations: that of the surprise itself, and that of the deviation times the square
    root of the length, scaled back to the length of the text, since short texts vary more. The band
    of classes reaches from ``word_share`` of the median to the median over it, that of words up to the same, per word
    or per word that other texts know. ``band_low`` and
    ``band_high`` are those of the bytes.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    scored = score(docs, train(docs), train(docs, of_words=True))
    rows = stored(scored.withColumn("base_failed", failed), "surprise")
    rows = rows.withColumn("_lang", F.coalesce("lang", F.lit("")))
    passed = rows.where(~F.col("base_failed")).select("_lang", "n_words", "surprise", "shape_surprise", "word_surprise", "known_surprise")
    middle = _quantiles(passed, "_lang", F.col("surprise"), {"_mid": 0.5})
    for name in ("shape", "word", "known"):
        middle = middle.join(_quantiles(passed, "_lang", F.col(f"{name}_surprise"), {f"_{name}_mid": 0.5}), "_lang")
    middle = stored(middle, "bands")
    away = F.abs(F.col("surprise") - F.col("_mid"))
    scaled = passed.join(F.broadcast(middle) if small(middle) else middle, "_lang")
    plain = _quantiles(scaled, "_lang", away, {"_plain": 0.5})
    scaled = _quantiles(scaled, "_lang", away * F.sqrt("n_words"), {"_scaled": 0.5})
    bands = stored(middle.join(plain, "_lang").join(scaled, "_lang"), "spreads")
    rows = rows.join(F.broadcast(bands) if small(bands) else bands, "_lang", "left")
    length = F.sqrt(F.greatest("n_words", F.lit(1)))
    width = band * DEVIATION * (F.greatest(F.col("_plain"), F.col("_scaled") / length) + CELL)
    rows = rows.withColumn("band_low", F.col("_mid") - width).withColumn("band_high", F.col("_mid") + width)
    within = F.col("surprise").between(F.col("band_low"), F.col("band_high"))
    within = within & F.col("shape_surprise").between(F.col("_shape_mid") * word_share, F.col("_shape_mid") / word_share)
    # Unknown words cost nothing, so a text that shares more words than most may cost more per word and yet be no junk.
    costly = [F.col(f"{name}_surprise") > F.col(f"_{name}_mid") / word_share for name in ("word", "known")]
    within = within & ~(costly[0] & costly[1])
    return rows.withColumn("kept", ~F.col("base_failed") & F.coalesce(within, F.lit(False))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "surprise", "band_low", "band_high",
    )


def small(table: DataFrame, rows: int = 100_000) -> bool:
    """Whether a table of a language code and a few numbers may be broadcast."""
    return table.limit(rows + 1).count() <= rows
