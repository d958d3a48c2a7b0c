"""Spelling variants: words one code point apart, by pairs of trie nodes, and the form each belongs to.

Every distinct prefix of the vocabulary is a node of a forward trie, every distinct suffix a node of a
reversed one, and both are numbered. A word that skips position i is the pair (node before i, node after
i); a word split before position i is the pair of the nodes on both sides. Two words with one skip pair
differ by one replaced code point there; a skip pair that equals a split pair is one code point deleted
or inserted. Integer pairs alone are shuffled and compared, and equal pairs mean equal text, so the
neighbours are exact. All words of a skip pair differ at one code point, so no pair has more words than
the alphabet has letters, plus the one word that is split there: no group can grow with the input.

The nodes are numbered where the sorted words lie: a word adds the nodes beyond the prefix it shares with
the word before it. A range partition numbers on its own; the path that the first word of a partition
shares with the last word of the one before is renamed afterwards. That list has at most the length of
one shared prefix for each partition and is the only thing that is broadcast.

Words are counted in the tasks. A word's form is its most frequent neighbour if that is ``factor`` times as
frequent; forms are followed by pointer doubling, in rounds whose number the counts bound, as every step
multiplies the count by ``factor``.

Defined results: NULL and empty texts hold no words; a NULL id counts as the empty text in the damage
rule; repeated rows count as often as they occur; of equally frequent neighbours the first in code-point
order is the form; an empty table gives no rows. A text of any length is counted whole; one text has to fit a
task, its words need not. Only the named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsluice.llm.shared import stored
from jobsluice.llm.words import Texts, slices

#: A word is kept from this many code points and occurrences on.
MIN_CHARS = 6
MIN_COUNT = 5
#: How much more frequent than a word its form is.
FACTOR = 5
#: Nodes of partition k have numbers from k * 2^40 on; 0 is the root.
NODE_BITS = 40
ROOT = 0

# Kinds of a pair: skipped position that repeats the letter before it, any other skipped position, split.
REPEAT, SKIP, SPLIT = 0, 1, 2

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: The first byte of U+00C0 to U+00FF in UTF-8, and of nothing else.
_LATIN = 0xC3


def letter_runs(texts: Texts, min_chars: int) -> tuple[pa.Array, np.ndarray]:
    """Runs of ``[A-Za-z\\u00C0-\\u00FF]`` with ``min_chars`` code points or more, A-Z lower-cased, and the text of each."""
    data, n = _LOWER[texts.data], len(texts.data)
    latin = data == _LATIN
    letter = _LETTER[data] | latin
    letter[1:] |= latin[:-1]
    edge = np.zeros(n + 1, bool)
    edge[texts.offsets] = True
    begin, end = letter.copy(), letter.copy()
    begin[1:] &= ~letter[:-1] | edge[1:n]
    end[:-1] &= ~letter[1:] | edge[1:n]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    chars = np.concatenate([np.zeros(1, np.int64), np.cumsum((data & 0xC0) != 0x80)])
    long = chars[ends] - chars[starts] >= min_chars
    starts, ends = starts[long], ends[long]
    doc = np.searchsorted(texts.offsets, starts, "right") - 1
    if not len(starts):
        return pa.array([], pa.large_binary()), doc
    # The runs and the gaps between them, as one array over the bytes; every second value is a run.
    bounds = np.stack([starts, ends], axis=1).ravel()
    both = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    return both.take(pa.array(np.arange(0, len(bounds) - 1, 2))), doc


def _damaged(words: list[bytes], idx: np.ndarray, doc: np.ndarray, seeds: list[int], every: int) -> dict[int, int]:
    """Checksums of ``<doc_id>:<word>`` that ``every`` divides, by place."""
    sums = np.fromiter((zlib.crc32(words[i], seeds[d]) for i, d in zip(idx.tolist(), doc.tolist())), np.int64, len(idx))
    hit = np.flatnonzero(sums % every == 0)
    return dict(zip(hit.tolist(), sums[hit].tolist()))


def count_words(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = MIN_CHARS, damage_every: int | None = None
) -> DataFrame:
    """``word``, ``n``: runs of letters of all texts with ``min_chars`` code points or more.

    With ``damage_every``, a run whose crc32 of ``<doc_id>:<run>`` it divides loses the code point at that
    checksum modulo its length, which plants misspellings that depend on nothing but the row.
    """

    def count(batches):
        for rows, texts in slices(batches):
            runs, doc = letter_runs(texts, min_chars)
            coded = runs.dictionary_encode()
            words = coded.dictionary.to_pylist()
            idx = coded.indices.to_numpy()
            changed: Counter[str] = Counter()
            if damage_every:
                # The checksum is one for all occurrences of a word in a text.
                pairs, n = np.unique(doc * max(len(words), 1) + idx, return_counts=True)
                doc, idx = pairs // max(len(words), 1), pairs % max(len(words), 1)
                seeds = [zlib.crc32(f"{i}:".encode()) for i in rows.column("id").to_pylist()]
                for at, checksum in _damaged(words, idx, doc, seeds, damage_every).items():
                    word = words[idx[at]].decode()
                    gone = checksum % len(word)
                    if len(word) > min_chars:
                        changed[word[:gone] + word[gone + 1 :]] += int(n[at])
                    n[at] = 0
                n = np.bincount(idx, n, len(words)).astype(np.int64)
            else:
                n = np.bincount(idx, minlength=len(words))
            left = np.flatnonzero(n)
            found = pa.array([words[i].decode() for i in left.tolist()] + list(changed), pa.string())
            yield pa.RecordBatch.from_arrays([found, pa.array([*n[left].tolist(), *changed.values()], pa.int64())], ["word", "n"])

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _code_points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words one after the other, and the length of each."""
    sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32), sizes


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])


def _shared_prefix(chars: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many code points each word shares with the one before it."""
    shared = np.zeros(len(sizes), np.int64)
    open_, k = np.arange(1, len(sizes)), 0
    while len(open_):
        open_ = open_[(sizes[open_ - 1] > k) & (sizes[open_] > k)]
        open_ = open_[chars[first[open_ - 1] + k] == chars[first[open_] + k]]
        k += 1
        shared[open_] = k
    return shared


def _numbered(batches):
    """Node numbers of every prefix of the sorted words of one partition."""
    last_chars, last_nodes, used = np.zeros(0, np.uint32), np.zeros(0, np.int64), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        base = batch.column("part")[0].as_py() << NODE_BITS
        chars, sizes = _code_points(batch.column("word"))
        # The last word of the batch before stands in front.
        chars, sizes = np.concatenate([last_chars, chars]), np.concatenate([[len(last_chars)], sizes])
        first = _starts(sizes)
        shared = _shared_prefix(chars, first, sizes)
        fresh = sizes - shared
        fresh[0] = 0
        upto = used + np.cumsum(fresh) - fresh
        used += int(fresh.sum())
        nodes = np.empty(len(chars), np.int64)
        rows = np.flatnonzero(sizes)
        for depth in range(1, int(sizes.max()) + 1):
            rows = rows[sizes[rows] >= depth]
            # A node keeps the number that the first word below it has given it; numbers ascend.
            number = np.where(shared[rows] < depth, base + upto[rows] + depth - shared[rows], 0)
            if rows[0] == 0:
                number[0] = last_nodes[depth - 1]
            nodes[first[rows] + depth - 1] = np.maximum.accumulate(number)
        last_chars, last_nodes = chars[first[-2] :], nodes[first[-2] :]
        offsets = pa.array((first[1:] - first[1]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), batch.column("word"), batch.column("n"), pa.ListArray.from_arrays(offsets, nodes[first[1] :])],
            ["part", "word", "n", "nodes"],
        )


def number_prefixes(words: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """``word``, ``n``, ``nodes`` (a number for every prefix, shortest first), and the numbers to rename.

    ``words`` has distinct words. Equal prefixes have equal numbers once renamed; the number of a whole word is
    never renamed, and ascends with the word in code-point order.
    """
    placed = words.repartitionByRange("word").sortWithinPartitions("word").withColumn("part", F.spark_partition_id())
    numbered = placed.select("part", "word", "n").mapInArrow(_numbered, "part int, word string, n bigint, nodes array<bigint>")
    numbered = stored(numbered, "trie")
    # Two words of each partition, whatever its size.
    ends = numbered.groupBy("part").agg(
        F.min_by(F.struct("word", "nodes"), "word").alias("low"), F.max_by(F.struct("word", "nodes"), "word").alias("high")
    )
    rename: dict[int, int] = {}
    before = None
    for row in sorted(ends.collect(), key=lambda r: r["part"]):
        if before is not None:
            for a, b, node, real in zip(before["word"], row["low"]["word"], row["low"]["nodes"], before["nodes"]):
                if a != b:
                    break
                rename[node] = rename.get(real, real)
        before = row["high"]
    return numbered.select("word", "n", "nodes"), rename


def _renamed(nodes: np.ndarray, names: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    old, new = names
    if not len(old):
        return nodes
    at = np.minimum(np.searchsorted(old, nodes), len(old) - 1)
    return np.where(old[at] == nodes, new[at], nodes)


def _names(rename: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    old = np.array(sorted(rename), np.int64)
    return old, np.array([rename[i] for i in old.tolist()], np.int64)


def node_pairs(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The numbered words (``word``, ``node``, ``n``), and their pairs: ``before``, ``after``, ``kind``, ``node``, ``n``."""
    ahead, ahead_names = number_prefixes(words)
    back, back_names = number_prefixes(words.select(F.reverse("word").alias("word"), "n"))
    back = back.select(F.reverse("word").alias("word"), F.col("nodes").alias("back"))
    shared = words.sparkSession.sparkContext.broadcast((_names(ahead_names), _names(back_names)))

    def pairs(batches):
        ahead_names, back_names = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            chars, sizes = _code_points(batch.column("word"))
            first, word = _starts(sizes), np.repeat(np.arange(len(sizes)), sizes)
            # One more place for each word: the root, before its first code point or after its last one.
            padded = np.arange(len(chars)) + word + 1
            before, after = np.full(len(chars) + len(sizes), ROOT), np.full(len(chars) + len(sizes), ROOT)
            before[padded] = _renamed(batch.column("nodes").flatten().to_numpy(), ahead_names)
            after[padded] = _renamed(batch.column("back").flatten().to_numpy(), back_names)
            root = first[:-1] + np.arange(len(sizes))
            node, n = before[root + sizes], batch.column("n").to_numpy()
            # Skipped position i: i code points before it, size - i - 1 after it.
            i = np.arange(len(chars)) - first[word]
            repeats = np.concatenate([np.zeros(1, bool), chars[1:] == chars[:-1]])[: len(chars)] & (i > 0)
            skip = before[root[word] + i], after[root[word] + sizes[word] - i - 1], np.where(repeats, REPEAT, SKIP), word
            place = np.repeat(np.arange(len(sizes)), sizes + 1)
            i = np.arange(len(place)) - root[place]
            split = before[root[place] + i], after[root[place] + sizes[place] - i], np.full(len(place), SPLIT), place
            p, s, kind, at = (np.concatenate(x) for x in zip(skip, split))
            yield pa.RecordBatch.from_arrays(
                [pa.array(p), pa.array(s), pa.array(kind.astype(np.int8)), pa.array(node[at]), pa.array(n[at])],
                ["before", "after", "kind", "node", "n"],
            )

    both = ahead.join(back, "word").select("word", "n", "nodes", "back")
    rows = both.mapInArrow(pairs, "before bigint, after bigint, kind tinyint, node bigint, n bigint")
    return ahead.select("word", F.element_at("nodes", -1).alias("node"), "n"), rows


def neighbours(pairs: DataFrame) -> DataFrame:
    """``node``, ``n_near``, ``best_n``, ``best``: how many words are near a word, and its most frequent neighbour.

    Any two near words meet in exactly one pair: replaced code points in the skip pair of their place, a deleted one
    in that of the first of a run of equal letters.
    """
    group = Window.partitionBy("before", "after")
    # Skipping words first, the most frequent one at the head.
    ranked = group.orderBy(F.col("kind") == SPLIT, F.col("n").desc(), "node")
    skips, split = F.col("kind") != SPLIT, F.col("kind") == SPLIT
    best = F.struct(F.col("n").alias("n"), (-F.col("node")).alias("neg"))
    rows = pairs.withColumn("size", F.count("*").over(group)).where("size > 1")
    rows = rows.select(
        "kind",
        "node",
        F.count(F.when(skips, 1)).over(group).alias("n_skips"),
        F.count(F.when(F.col("kind") == SKIP, 1)).over(group).alias("n_once"),
        F.max(F.when(F.col("kind") == SKIP, best)).over(group).alias("once"),
        F.max(F.when(split, best)).over(group).alias("split"),
        F.row_number().over(ranked).alias("place"),
        F.first(best).over(ranked).alias("head"),
        F.lead(F.when(skips, best)).over(ranked).alias("next"),
    )
    replaced = F.when(F.col("place") > 1, F.col("head")).otherwise(F.col("next"))
    shorter = F.when(F.col("kind") == SKIP, F.col("split"))
    near = F.when(split, F.col("n_once")).otherwise(F.col("n_skips") - 1 + shorter.isNotNull().cast("int"))
    best = F.when(split, F.col("once")).otherwise(F.greatest(replaced, shorter))
    rows = rows.select("node", near.alias("near"), best.alias("best")).where("near > 0")
    found = rows.groupBy("node").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))
    return found.select("node", "n_near", F.col("best.n").alias("best_n"), (-F.col("best.neg")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``node``, ``root``: the last form of every row of ``forms`` (``node``, ``form``), which holds no circle."""
    held = stored(forms.select("node", F.col("form").alias("root")), "roots")
    while True:
        on = held.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
        held = held.join(on, "root", "left")
        held = stored(held.select("node", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        if held.where("moved").isEmpty():
            return held.select("node", "root")
        held = held.drop("moved")


def variants(counts: DataFrame, min_count: int = MIN_COUNT, factor: int = FACTOR) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for the words of ``counts`` (``word``, ``n``) with ``min_count``."""
    words, pairs = node_pairs(stored(counts.where(F.col("n") >= min_count).select("word", "n"), "words"))
    near = neighbours(pairs)
    rows = words.join(near, "node", "left").withColumn("form", F.when(F.col("best_n") >= factor * F.col("n"), F.col("best")))
    rows = stored(rows.select("node", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form"), "near")
    forms = rows.where("form is not null").select("node", "form")
    ends = roots(forms)
    named = rows.select(F.col("node").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n"))
    last = rows.select(F.col("node").alias("root"), F.col("word").alias("root_word"))
    forms = forms.join(named, "form").join(ends, "node").join(last, "root").select("node", "form_word", "form_n", "root_word")
    rows = rows.select("node", "word", "n", "n_near").join(forms, "node", "left")
    return rows.select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )
