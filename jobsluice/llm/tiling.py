"""Benchmark decontamination by greedy string tiling.

Rolling hashes of five consecutive words (lower-cased in A-Z) are the seeds that a text and a
benchmark item share. Along each diagonal, neighbouring seeds form a maximal match. Matches are
marked longest first; a match that touches marked words is cut back and waits its turn again. The
tiles of an item cannot overlap, in the text or in the item, and their order is free, so that a
passage is found when its sentences were put in another order. The share of the item's words that
tiles cover decides.

Texts are read once per block of items; a block has a bounded number of words, so that what is
broadcast does not grow with the benchmark. Nothing is shuffled and no pair is built that shares no
seed.

Defined results: NULL and empty texts match nothing, items of fewer than five words cannot be
covered, repeated rows give repeated pairs, empty tables none. Extra columns are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsluice.llm.words import sequence_hashes, slices, texts_of, windows_within, word_hashes, words_of

MATCH = 5
COVERAGE = 0.5
#: Bytes of item texts that are broadcast at once.
BLOCK_BYTES = 16 << 20
_FILTER_BITS = 22


@dataclass
class Items:
    """One block of benchmark items: their words, and where each seed occurs."""

    ids: list
    id_kind: pa.DataType
    lengths: np.ndarray
    seeds: np.ndarray
    item: np.ndarray
    at: np.ndarray
    present: np.ndarray

    @classmethod
    def build(cls, ids: pa.Array, texts: pa.Array, size: int) -> Items:
        lowered = texts_of(texts).lowered()
        words = words_of(lowered)
        hashes = word_hashes(lowered, words)
        inside = np.flatnonzero(windows_within(words, size))
        seeds = sequence_hashes(hashes, size)[inside]
        item = words.doc[inside]
        order = np.argsort(seeds, kind="stable")
        present = np.zeros(1 << _FILTER_BITS, bool)
        present[(seeds & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
        at = inside - words.first[item]
        return cls(ids.to_pylist(), ids.type, words.counts, seeds[order], item[order], at[order], present)


def matches(at_text: np.ndarray, at_item: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Maximal matches ``(length, place in the item, place in the text)`` from pairs of seed places."""
    order = np.lexsort((at_text, at_text - at_item))
    at_text, at_item = at_text[order], at_item[order]
    begin = np.ones(len(at_text), bool)
    begin[1:] = (np.diff(at_text) != 1) | (np.diff(at_item) != 1)
    first = np.flatnonzero(begin)
    lengths = np.diff(np.append(first, len(at_text))) + size - 1
    return list(zip(lengths.tolist(), at_item[first].tolist(), at_text[first].tolist(), strict=True))


def tiles(found: list[tuple[int, int, int]], size: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: the longest match first, then the longest among what is not marked yet."""
    queue = [(-length, i, t) for length, i, t in found]
    heapq.heapify(queue)
    in_item: set[int] = set()
    in_text: set[int] = set()
    out = []
    while queue:
        length, i, t = heapq.heappop(queue)
        length = -length
        free = [i + k not in in_item and t + k not in in_text for k in range(length)]
        if all(free):
            out.append((length, i, t))
            in_item.update(range(i, i + length))
            in_text.update(range(t, t + length))
            continue
        k = 0
        while k < length:
            start = k
            while k < length and free[k]:
                k += 1
            if k - start >= size:
                heapq.heappush(queue, (start - k, i + start, t + start))
            k += 1
    return out


def _search(items, size: int, coverage: float):
    """Pairs of a batch of texts and the items of a broadcast block."""

    def run(batches):
        block = items.value
        for rows, texts in slices(batches):
            texts = texts.lowered()
            words = words_of(texts)
            seeds = sequence_hashes(word_hashes(texts, words), size)
            low = (seeds & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)
            hits = np.flatnonzero(block.present[low] & windows_within(words, size))
            left = np.searchsorted(block.seeds, seeds[hits], "left")
            count = np.searchsorted(block.seeds, seeds[hits], "right") - left
            hits, left, count = hits[count > 0], left[count > 0], count[count > 0]
            # One entry per text place and item place that share a seed, grouped by text and item.
            entry = np.repeat(left, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            place = np.repeat(hits, count)
            doc = words.doc[place]
            order = np.lexsort((block.item[entry], doc))
            place, doc, entry = place[order], doc[order], entry[order]
            item = block.item[entry]
            edge = np.flatnonzero((np.diff(doc) != 0) | (np.diff(item) != 0)) + 1 if len(doc) else []
            bounds = [0, *edge, len(doc)] if len(doc) else []
            out = {"row": [], "item_id": [], "item_words": [], "covered_words": [], "n_tiles": []}
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                laid = tiles(matches(place[a:b] - words.first[doc[a]], block.at[entry[a:b]], size), size)
                covered, total = sum(n for n, _, _ in laid), int(block.lengths[item[a]])
                if covered >= coverage * total:
                    for name, value in zip(out, (doc[a], block.ids[item[a]], total, covered, len(laid)), strict=True):
                        out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").take(pa.array(out["row"], pa.int64())),
                    pa.array(out["item_id"], block.id_kind),
                    *[pa.array(out[c], pa.int64()) for c in ("item_words", "covered_words", "n_tiles")],
                ],
                ["doc_id", "item_id", "item_words", "covered_words", "n_tiles"],
            )

    return run


def contaminated(
    docs: DataFrame, benchmark: DataFrame, size: int = MATCH, coverage: float = COVERAGE
) -> DataFrame:
    """Pairs ``doc_id``, ``item_id`` with ``item_words``, ``covered_words``, ``n_tiles`` and ``coverage``.

    ``docs`` has ``doc_id`` and ``text``, ``benchmark`` has ``item_id`` and ``text``.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text")
    items = benchmark.select("item_id", "text").where("text is not null")
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    kinds = f"doc_id {dict(texts.dtypes)['doc_id']}, item_id {dict(items.dtypes)['item_id']}"
    found = None
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).toArrow()
        block = Items.build(part["item_id"].combine_chunks(), part["text"].combine_chunks(), size)
        search = _search(spark.sparkContext.broadcast(block), size, coverage)
        rows = texts.mapInArrow(search, f"{kinds}, item_words bigint, covered_words bigint, n_tiles bigint")
        found = rows if found is None else found.unionByName(rows)
    return found.withColumn("coverage", F.col("covered_words") / F.col("item_words"))
