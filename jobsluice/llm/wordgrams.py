"""Bits of every text under a modified Kneser-Ney model of word trigrams, counted over all texts.

The events of a text are its words and one end; two marks stand before the first. Words are told apart
by 64-bit hashes. The model interpolates trigrams with bigrams, words and equal shares of all words;
below the trigrams it counts how many different words stand before. A text is scored by what the others
hold: its own trigrams are taken out of the counts of trigrams and pairs, or else every text of rare
words would seem foreseen. (The counts of single words stay; a word
that ends one pair of one text alone is unknown to the others and costs nothing. Of a pair after
a frequent word only what the text has in the same bucket is taken out.) No table of the model is ever
whole in one place:

1. *blocks* of texts send every trigram with its text, packed, to the bucket of its middle word. A
   bucket thus holds all trigrams of a pair of words, and all words before and after its middle words.
   This exchange is the only place where trigrams are written: a bucket is merged for step 2 and again for step 3;
2. buckets send the words after their middle words to *ranges* of word hashes, which return in how many
   pairs each word comes second;
3. buckets send each block the bits of its texts, which are summed by block.

A middle word with more than ``FREQUENT`` occurrences has several buckets, by the word before; what
follows such a word is merged in the ranges too. There is one such word per ``FREQUENT`` words of the
corpus at most, and a few sums of each go to all tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsluice.llm.katz import _by, pack, pack_sorted, unpack, unpack_sorted
from jobsluice.llm.shared import stored
from jobsluice.llm.words import Texts, mix64, slices, word_hashes, words_of

#: Events that make up a block, unless one text alone has more, and that a bucket gets on average.
BLOCK_EVENTS = 1_500_000
BUCKET_EVENTS = 800_000
#: A middle word with more occurrences has several buckets.
FREQUENT = 1_000_000
#: Words are looked at as frequent if they make up this share of some block.
SHARE = 0.001

BEGIN, END = np.uint64(0x6A09E667F3BCC908), np.uint64(0x2545F4914F6CDD1D)
_ROW = [
    ("kind", pa.int32()), ("at", pa.int32()), ("source", pa.string()),
    ("data", pa.list_(pa.binary())), ("stats", pa.list_(pa.int64())), ("often", pa.list_(pa.list_(pa.int64()))),
]
_SCHEMA = "kind int, at int, source string, data array<binary>, stats array<bigint>, often array<array<bigint>>"
#: Kinds of rows: rows of a block, trigrams for a bucket, words for a range, an answer, bits for a block, sums for all.
ROWS, GRAMS, WORDS, ANSWER, BITS, SUMS = range(6)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema(_ROW))


def sequence_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Two marks, the words and the end of every text, one text after the other, and the events of each."""
    words = words_of(texts)
    events = words.counts + 1
    out = np.full(int(events.sum()) + 2 * len(texts), END, np.uint64)
    first = np.cumsum(events + 2) - events - 2
    out[first], out[first + 1] = BEGIN, BEGIN
    out[np.arange(len(words.starts)) + 3 * words.doc + 2] = word_hashes(texts, words)
    return out, events


def frequent_words(docs: DataFrame) -> tuple[int, dict[int, int]]:
    """The number of events, and the middle words with more than ``FREQUENT`` occurrences (as far as they reach ``SHARE``)."""

    def count(batches):
        held, size = [], 0

        def block():
            middle, n = np.unique(np.concatenate(held), return_counts=True)
            often = n > SHARE * n.sum()
            words = np.append(middle[often].view(np.int64), 0)
            total = np.zeros(len(words), np.int64)
            total[-1] = n.sum()
            return pa.RecordBatch.from_arrays(
                [pa.array(words), pa.array(np.append(n[often], 0)), pa.array(total)], ["word", "n", "total"]
            )

        for _, texts in slices(batches):
            sequence, events = sequence_of(texts)
            held.append(sequence[_events(events) - 1])
            size += len(held[-1])
            if size >= BLOCK_EVENTS:
                yield block()
                held, size = [], 0
        if held:
            yield block()

    rows = docs.select("text").mapInArrow(count, "word bigint, n bigint, total bigint")
    rows = stored(rows.groupBy("word").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "middle-words")
    total = rows.agg(F.sum("total")).first()[0] or 0
    return total, {r["word"] % (1 << 64): r["n"] for r in rows.where(F.col("n") > FREQUENT).collect()}


def _events(events: np.ndarray) -> np.ndarray:
    """Places of the events in a sequence."""
    return np.arange(int(events.sum())) + 2 * np.repeat(np.arange(1, len(events) + 1), events)


def _grouped(major: np.ndarray, minor: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order as ``major * width + minor``, and the pair of every entry."""
    return np.unique(major.astype(np.int64) * width + minor, return_inverse=True)


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _block(name: str, rows: list[pa.RecordBatch], sequence: np.ndarray, events: np.ndarray, buckets: int, often: dict):
    """The rows of a block and its trigrams for every bucket."""
    held = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
    yield _batch([{"kind": ROWS, "at": 0, "source": name, "data": [_ipc(held)], "stats": [len(held)]}])
    vocabulary, place = np.unique(sequence, return_inverse=True)
    place = place.astype(np.int32)
    at = _events(events)
    u, v, w = place[at - 2], place[at - 1], place[at]
    doc = np.repeat(np.arange(len(events), dtype=np.int32), events)
    bucket = (mix64(vocabulary) % np.uint64(buckets)).astype(np.int64)[v]
    for word, n in often.items():
        k = int(np.searchsorted(vocabulary, np.uint64(word)))
        if k < len(vocabulary) and int(vocabulary[k]) == word:
            own = np.flatnonzero(v == k)
            ways = np.uint64(-(-n // FREQUENT))
            bucket[own] = (bucket[own] + (mix64(mix64(vocabulary[u[own]])) % ways).astype(np.int64)) % buckets
    width = len(vocabulary)
    small = buckets * width * width < 1 << 63
    order = np.argsort((bucket * width + v) * width + u) if small else np.lexsort((u, v, bucket))
    bucket = bucket[order]
    numbers, begin = np.unique(bucket, return_index=True)
    for k, a, b in zip(numbers.tolist(), begin.tolist(), [*begin[1:].tolist(), len(bucket)], strict=True):
        own = order[a:b]
        words, local = np.unique(np.concatenate([u[own], v[own], w[own]]), return_inverse=True)
        lu, lv, lw = local.reshape(3, -1)
        parts = [pack_sorted(vocabulary[words]), pack(lu), pack_sorted(lv.astype(np.uint64)), pack(lw), pack(doc[own])]
        yield _batch([{"kind": GRAMS, "at": k, "source": name, "data": parts, "stats": [len(events)]}])


def _few(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


def _levels(counts: np.ndarray, group: np.ndarray, size: int) -> np.ndarray:
    """Per group: the sum of the counts, and how many are 1, 2, and more."""
    level = np.minimum(counts, 3)
    parts = [np.bincount(group, counts, size), *(np.bincount(group[level == k], minlength=size) for k in (1, 2, 3))]
    return np.stack(parts).astype(np.int64)


def _lower(often: dict) -> np.ndarray:
    return np.array(sorted(often), np.uint64)


class _Tails:
    """The pairs of a middle word and the next in a bucket, of which those after frequent words are ``wide``."""

    def __init__(self, words: np.ndarray, context: np.ndarray, of: np.ndarray, last: np.ndarray, frequent: np.ndarray):
        width = len(words)
        self.words = words
        pairs, self.of = _grouped(context[of] // width, last, width)
        self.middle, self.last = pairs // width, pairs % width
        self.counts = np.bincount(self.of, minlength=len(pairs))
        self.frequent = np.full(len(pairs), -1, np.int64)
        if len(frequent):
            near = np.minimum(np.searchsorted(frequent, words[self.middle]), len(frequent) - 1)
            self.frequent = np.where(frequent[near] == words[self.middle], near, -1)
        self.wide = self.frequent >= 0
        #: The different next words, of which the bits of hashes give the range, and the next word of every pair.
        self.next, self.next_of = np.unique(self.last, return_inverse=True)

    @property
    def wide_in_order(self) -> np.ndarray:
        """The wide pairs, by their next word."""
        wide = np.flatnonzero(self.wide)
        return wide[np.argsort(self.next_of[wide], kind="stable")]


class _Bucket:
    """The trigrams of a bucket, distinct and in order, and where each stands.

    ``of`` is the context of every trigram, ``last`` its last word, ``n`` how often it occurs; ``doc`` are the texts of all
    occurrences in the order of the trigrams, numbered over the blocks ``names`` with ``sizes`` texts each.
    """

    def __init__(self, rows: list[dict], frequent: np.ndarray):
        self.names = [r["source"] for r in rows]
        self.sizes = np.array([r["stats"][0] for r in rows], np.int64)
        local = [unpack_sorted(r["data"][0]) for r in rows]
        self.words = np.unique(np.concatenate(local))
        maps = [np.searchsorted(self.words, x) for x in local]
        u, v, w = (
            np.concatenate([m[f(r["data"][k]).astype(np.int64)] for m, r in zip(maps, rows, strict=True)])
            for k, f in ((1, unpack), (2, unpack_sorted), (3, unpack))
        )
        del local, maps
        width = len(self.words)
        self.context, of = _grouped(v, u, width)
        del u, v
        grams, gram_of = _grouped(of, w, width)
        del of, w
        self.n = np.bincount(gram_of, minlength=len(grams))
        order = np.argsort(gram_of, kind="stable")
        del gram_of
        starts = np.cumsum(self.sizes) - self.sizes
        doc = [unpack(r["data"][4]).astype(np.int64) + s for r, s in zip(rows, starts.tolist(), strict=True)]
        self.doc = np.concatenate(doc)[order]
        self.of, self.last = grams // width, grams % width
        self.tails = _Tails(self.words, self.context, self.of, self.last, frequent)


def _ranges(buckets: int, often: dict) -> Callable[[list[dict]], list[dict]]:
    """What a bucket sends to the ranges of words, and a row of sums."""
    frequent = _lower(often)
    edges = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)

    def merge(rows: list[dict]) -> list[dict]:
        number = rows[0]["at"]
        rows = [r for r in rows if r["kind"] == GRAMS]
        if not rows:
            return []
        bucket = _Bucket(rows, frequent)
        tails = bucket.tails
        few = [*_few(bucket.n), *_few(tails.counts[~tails.wide]), *[0] * 9]
        out = [{"kind": SUMS, "at": number, "source": "", "stats": few, "often": []}]
        hashes = bucket.words[tails.next]
        pairs = np.bincount(tails.next_of[~tails.wide], minlength=len(hashes))
        cuts = [0, *np.searchsorted(hashes, edges).tolist(), len(hashes)]
        wide = tails.wide_in_order
        next_of = tails.next_of[wide]
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if a < b:
                x, y = np.searchsorted(next_of, [a, b])
                own = wide[x:y]
                parts = [pack_sorted(hashes[a:b]), pack(pairs[a:b])]
                parts += [pack(next_of[x:y] - a), pack(tails.frequent[own]), pack(tails.counts[own])]
                out.append({"kind": WORDS, "at": k, "source": str(number), "data": parts})
        return out

    return merge


def _count_words(often: dict) -> Callable[[list[dict]], list[dict]]:
    """Per range of words: to every bucket the pairs each word ends, and the counts after frequent words."""
    size = max(1, len(often))

    def count(rows: list[dict]) -> list[dict]:
        out = [r for r in rows if r["kind"] == SUMS]
        rows = [r for r in rows if r["kind"] == WORDS]
        if not rows:
            return out
        keys = [unpack_sorted(r["data"][0]) for r in rows]
        words, place = np.unique(np.concatenate(keys), return_inverse=True)
        pairs = np.bincount(place, np.concatenate([unpack(r["data"][1]) for r in rows]), len(words)).astype(np.int64)
        begins = np.cumsum([0, *map(len, keys)])
        own = [
            (place[s + unpack(r["data"][2]).astype(np.int64)], unpack(r["data"][3]).astype(np.int64))
            for r, s in zip(rows, begins, strict=False)
        ]
        wide, of = _grouped(np.concatenate([o[0] for o in own]), np.concatenate([o[1] for o in own]), size)
        counts = np.bincount(of, np.concatenate([unpack(r["data"][4]) for r in rows]), len(wide)).astype(np.int64)
        pairs += np.bincount(wide // size, minlength=len(words))
        begin = 0
        for r, s, e, o in zip(rows, begins[:-1], begins[1:], own, strict=True):
            data = [pack(pairs[place[s:e]]), pack(counts[of[begin : begin + len(o[0])]])]
            begin += len(o[0])
            out.append({"kind": ANSWER, "at": int(r["source"]), "source": str(r["at"]), "data": data})
        levels = _levels(counts, wide % size, size).T
        hit = np.flatnonzero(levels[:, 0]).tolist()
        stats = [*[0] * 4, *_few(counts), *_few(pairs), len(words), *_levels(pairs, np.zeros(len(pairs), np.int64), 1)[:, 0].tolist()]
        out.append({"kind": SUMS, "at": 0, "source": "", "stats": stats, "often": [[k, *levels[k].tolist()] for k in hit]})
        return out

    return count


def _share(counts: np.ndarray, total: np.ndarray, left: np.ndarray, d: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Interpolated probabilities, from the sum of a context's counts and what was taken off them; ``below`` where it has none."""
    some = np.maximum(total, 1)
    return np.where(total > 0, (counts - d[np.minimum(counts, 3)] + np.maximum(left, 0) * below) / some, below)


class _Without:
    """Groups of entries by text, and sums of their group without what the text itself adds."""

    def __init__(self, group: np.ndarray, doc: np.ndarray, docs: int):
        pairs, self.of = _grouped(group, doc, docs)
        self.group, self.doc = pairs // docs, pairs % docs

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, values, len(self.group))


def _score(discounts: Callable, often: dict) -> Callable[[list[dict], list[dict]], list[dict]]:
    """Per bucket, from its trigrams, what the ranges answered and the sums: to every block the bits of its texts."""
    frequent = _lower(often)

    def score(rows: list[dict], answers: list[dict]) -> list[dict]:
        out = [r for r in rows if r["kind"] == ROWS]
        rows = [r for r in rows if r["kind"] == GRAMS]
        if not rows:
            return out
        sums = next(r for r in answers if r["kind"] == SUMS)
        few, types, all_words = sums["stats"][:12], max(1, sums["stats"][12]), np.array(sums["stats"][13:], np.int64)
        d3, d2, d1 = (np.array([0.0, *discounts(*few[k : k + 4])]) for k in (0, 4, 8))
        levels_of_frequent = np.zeros((max(1, len(often)), 4), np.int64)
        for k, *each in sums["often"]:
            levels_of_frequent[k] = each
        answers = sorted((r for r in answers if r["kind"] == ANSWER), key=lambda r: int(r["source"]))
        bucket = _Bucket(rows, frequent)
        names, sizes = bucket.names, bucket.sizes
        del rows
        words, of, n, doc, tails = bucket.words, bucket.of, bucket.n, bucket.doc, bucket.tails
        contexts, docs = len(bucket.context), int(sizes.sum())
        del bucket
        pairs = np.concatenate([unpack(r["data"][0]) for r in answers]).astype(np.int64)
        counts = tails.counts.astype(np.int64)
        wide = tails.wide_in_order
        counts[wide] = np.concatenate([unpack(r["data"][1]) for r in answers]).astype(np.int64)
        levels = _levels(counts, tails.middle, len(words))
        levels[:, tails.middle[wide]] = levels_of_frequent[tails.frequent[wide]].T
        below = _share(pairs, all_words[0], d1[1:] @ all_words[1:], d1, 1.0 / types)

        # One entry for every trigram of a text; ``others`` is how often it occurs in other texts.
        gram = _Without(np.repeat(np.arange(len(n)), n), doc, docs)
        del doc
        times = np.bincount(gram.of, minlength=len(gram.group))
        del gram.of
        others = n[gram.group] - times

        # Pairs of the middle word and the next, by the different words before them in other texts.
        tail = _Without(tails.of[gram.group], gram.doc, docs)
        gone = tail.sums(others == 0).astype(np.int64)
        before = counts[tail.group]
        middle = _Without(tails.middle[tail.group], tail.doc, docs)
        taken = middle.sums(d2[np.minimum(before, 3)] - d2[np.minimum(before - gone, 3)])
        total = levels[0][middle.group] - middle.sums(gone)
        left = (d2[1:] @ levels[1:])[middle.group] - taken
        at = middle.of
        pair = _share(before - gone, total[at], left[at], d2, below[tails.next_of[tail.group]])
        # A word that ends one pair only, which no other text has, is unknown to the others and costs nothing.
        unknown = ((pairs[tails.next_of[tail.group]] == 1) & (before == gone))[tail.of]
        pair = pair[tail.of]
        del tail, middle, before, gone, at

        each = _Without(of[gram.group], gram.doc, docs)
        levels = _levels(n, of, contexts)
        taken = each.sums(d3[np.minimum(n, 3)][gram.group] - d3[np.minimum(others, 3)])
        total = levels[0][each.group] - each.sums(times)
        left = (d3[1:] @ levels[1:])[each.group] - taken
        at = each.of
        log = -np.log2(_share(others, total[at], left[at], d3, pair))
        bits = np.bincount(gram.doc, np.where(unknown, 0.0, times * log), docs)
        known = np.bincount(gram.doc, np.where(unknown, 0, times), docs).astype(np.int64)
        # Only texts with words here: a text has few of all buckets.
        hit = np.flatnonzero(known)
        ends = np.cumsum(sizes)
        cuts = np.searchsorted(hit, ends)
        for name, start, x, y in zip(names, (ends - sizes).tolist(), [0, *cuts[:-1].tolist()], cuts.tolist(), strict=True):
            own = hit[x:y]
            parts = [pack_sorted((own - start).astype(np.uint64)), bits[own].tobytes(), pack(known[own])]
            out.append({"kind": BITS, "source": name, "data": parts})
        return out

    return score


def _table(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, pa.schema(_ROW))


def _sums(words: DataFrame, buckets: int, often: bool) -> DataFrame:
    """The sums over all buckets and ranges, as a row for every bucket."""
    found = words.where(F.col("kind") == SUMS)
    sums = found.agg(F.array(*[F.coalesce(F.sum(F.col("stats")[k]), F.lit(0)) for k in range(17)]).alias("stats"))
    if often:
        each = found.select(F.explode("often").alias("o")).groupBy(F.col("o")[0].alias("k"))
        each = each.agg(*[F.sum(F.col("o")[k]).alias(f"s{k}") for k in range(1, 5)])
        lists = each.agg(F.collect_list(F.array("k", *[f"s{k}" for k in range(1, 5)])).alias("often"))
    else:
        lists = sums.sparkSession.range(1).select(F.array().cast("array<array<bigint>>").alias("often"))
    all_buckets = sums.sparkSession.range(buckets).select(F.col("id").cast("int").alias("at"))
    rows = all_buckets.crossJoin(F.broadcast(sums.crossJoin(F.broadcast(lists))))
    data = F.array().cast("array<binary>").alias("data")
    return rows.select(F.lit(SUMS).alias("kind"), "at", F.lit("").alias("source"), data, "stats", "often")


def with_word_bits(
    docs: DataFrame, measure: Callable[[pa.RecordBatch, Texts], pa.RecordBatch], kinds: str, discounts: Callable, name: str
) -> DataFrame:
    """One row per row of ``docs``: what ``measure`` gives for it (of the types ``kinds``) and ``name``, the bits of its words.

    ``<name>_of`` is how many events cost these bits, without the words that are unknown to the other texts. ``docs`` has a column ``text``; ``discounts`` gives three discounts from how many counts are 1, 2, 3 and 4.
    """
    total, often = frequent_words(docs)
    buckets = max(1, -(-total // BUCKET_EVENTS))

    def send(batches):
        task, number = TaskContext.get(), 0
        rows, sequences, events, size = [], [], [], 0

        def block():
            label = f"{task.partitionId()}-{number}"
            yield from _block(label, rows, np.concatenate(sequences), np.concatenate(events), buckets, often)

        for batch, texts in slices(batches):
            rows.append(measure(batch, texts))
            sequence, n = sequence_of(texts)
            sequences.append(sequence)
            events.append(n)
            size += int(n.sum())
            if size >= BLOCK_EVENTS:
                yield from block()
                number += 1
                rows, sequences, events, size = [], [], [], 0
        if rows:
            yield from block()

    parts = min(buckets, 2_000)
    # The rows of a block travel beside its trigrams, so that both come from one run of a task.
    at = F.when(F.col("kind") == ROWS, F.pmod(F.hash("source"), F.lit(buckets))).otherwise(F.col("at"))
    # The one place where trigrams are written. Both readers take this exchange, in one plan, so Spark runs it once.
    grams = docs.mapInArrow(send, _SCHEMA).withColumn("at", at).repartition(parts, "at")
    merge, count, score = _ranges(buckets, often), _count_words(often), _score(discounts, often)
    words = grams.groupBy("at").applyInArrow(lambda rows: _table(merge(rows.to_pylist())), _SCHEMA).repartition(parts, "at")
    words = words.groupBy("at").applyInArrow(lambda rows: _table(count(rows.to_pylist())), _SCHEMA)
    answers = words.where(F.col("kind") == ANSWER).unionByName(_sums(words, buckets, bool(often))).repartition(parts, "at")
    rows = grams.groupBy("at").cogroup(answers.groupBy("at"))
    rows = rows.applyInArrow(lambda own, found: _table(score(own.to_pylist(), found.to_pylist())), _SCHEMA)

    def add(batches):
        for rows in _by(batches, "source"):
            held = pa.ipc.open_stream(next(r["data"][0] for r in rows if r["kind"] == ROWS)).read_next_batch()
            bits, known = np.zeros(len(held)), np.zeros(len(held), np.int64)
            for r in rows:
                if r["kind"] == BITS:
                    at = unpack_sorted(r["data"][0]).astype(np.int64)
                    bits[at] += np.frombuffer(r["data"][1])
                    known[at] += unpack(r["data"][2]).astype(np.int64)
            columns = [*held.columns, pa.array(bits), pa.array(known)]
            yield pa.RecordBatch.from_arrays(columns, [*held.schema.names, name, f"{name}_of"])

    return rows.repartition(parts, "source").sortWithinPartitions("source").mapInArrow(add, f"{kinds}, {name} double, {name}_of bigint")
