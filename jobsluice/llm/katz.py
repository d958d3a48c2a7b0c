"""Katz backoff bigram scores, from Good-Turing discounted counts of the corpus.

Tokens are words, lower-cased in A-Z, and one end after the words of each text. A text begins after
a mark that is a history only. With c the training counts, N all training tokens and d the discounts:

    P(w)     = d[c(w)] c(w) / N                      and what that leaves for all unknown words as one
    P(w | h) = d[c(hw)] c(hw) / c(h)                 if hw occurs in training
             = a(h) P(w)                             if it does not but h does; a(h) makes the sum over w one
             = P(w)                                  if h does not occur

How it is spread. Texts are cut into *blocks* of a few MB. A block knows its own distinct words and
bigrams; only these are exchanged, each once a block, as packed arrays:

1. blocks send their words with counts to word buckets, which return to each block the counts of all
   blocks and a dense word number;
2. blocks send their bigrams as pairs of word numbers, with counts, to buckets by first word, which
   return the counts of all blocks and what a(h) needs; the merged buckets are the model's table;
3. blocks score their texts.

A bucket holds a bounded number of entries. The successors of a word that makes up more than a
millionth of the corpus (100,000 occurrences at least) go to several buckets; what these know of such
a word is summed and sent to all tasks. There are at most a million such words, whatever the corpus.

Defined results: NULL and empty texts are one end token; a NULL doc_id is in training; repeated rows
count each; without training rows every probability is one and all scores are 0. Extra columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsluice.llm.shared import stored
from jobsluice.llm.words import mix64, slices, word_hashes, words_of

#: Words of the texts that make up a block, unless one text alone has more.
BLOCK_WORDS = 1_500_000
#: Entries that a bucket gets on average.
BUCKET_ENTRIES = 500_000
#: A word with more occurrences than this, and than a millionth of the corpus, has several buckets.
FREQUENT = 100_000
#: Counts up to this are discounted.
LARGEST = 5

END = np.uint64(0x2545F4914F6CDD1D)
#: Word number of the mark before a text; those of words start at 1.
BEGIN = 0


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers as compressed byte planes; ascending ones should be given as differences."""
    values = np.ascontiguousarray(values, np.uint64)
    planes = values.view(np.uint8).reshape(len(values), 8).T
    used = max((k + 1 for k in range(8) if planes[k].any()), default=0)
    head = np.array([len(values), used], np.uint32).tobytes()
    return head + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes[:used]).tobytes())


def unpack(data: bytes) -> np.ndarray:
    n, used = np.frombuffer(data[:8], np.uint32).tolist()
    raw = zstandard.ZstdDecompressor().decompress(data[8:], max_output_size=max(1, n * used)) if used else b""
    planes = np.zeros((8, n), np.uint8)
    planes[:used] = np.frombuffer(raw, np.uint8).reshape(used, n)
    return np.ascontiguousarray(planes.T).view(np.uint64).reshape(n)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def discounts(counts_of_counts: np.ndarray) -> np.ndarray:
    """Katz's discounts of the counts 1 to 5 from how many types occur 1 to 6 times.

    Where Good-Turing estimates fall outside (0, 1), as with few types, a half occurrence is taken off.
    """
    n = np.asarray(counts_of_counts, np.float64)
    r = np.arange(1, LARGEST + 1)
    if n[0] > 0 and (n > 0).all():
        tail = (LARGEST + 1) * n[LARGEST] / n[0]
        d = ((r + 1) * n[1:] / n[:-1] / r - tail) / (1 - tail) if tail != 1 else np.zeros(LARGEST)
        if ((d > 0) & (d < 1)).all():
            return d
    return 1 - 0.5 / r


def _discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Discounted counts."""
    factor = np.ones(len(counts))
    low = (counts > 0) & (counts <= LARGEST)
    factor[low] = d[counts[low].astype(np.int64) - 1]
    return factor * counts


@dataclass
class Unigrams:
    """What all tasks know of the single tokens: N, V, discounts, and the mass of unknown words over ``total``."""

    tokens: int
    types: int
    discounts: np.ndarray
    unknown: float
    total: float

    @classmethod
    def of(cls, tokens: int, types: int, counts_of_counts: np.ndarray) -> Unigrams:
        d = discounts(counts_of_counts)
        left = float(((1 - d) * np.arange(1, LARGEST + 1) * counts_of_counts[:LARGEST]).sum())
        # If no token is rare enough for a discount, one occurrence is added for the unknown words.
        return cls(tokens, types, d, left, tokens) if left > 0 else cls(tokens, types, d, 1.0, tokens + 1.0)

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, _discounted(counts, self.discounts), self.unknown) / self.total

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the add-one probability."""
        return np.log10((counts + 1.0) / (self.tokens + 1 * (self.types + 1)))


def _by(batches, key: str):
    """Rows of a stream that is sorted by ``key``, a list per value."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row[key] != held[0][key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _batch(rows: list[dict], fields: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema(fields))


def make_blocks(docs: DataFrame, held_out: Column) -> DataFrame:
    """The texts as blocks of token numbers that count within the block; see the columns below."""

    def build(batches):
        task, number = TaskContext.get(), 0
        ids, held, tokens, lengths, size = [], [], [], [], 0

        def block():
            name = f"{task.partitionId()}-{task.taskAttemptId()}-{number}"
            sequence, length = np.concatenate(tokens), np.concatenate(lengths)
            out = pa.concat_arrays(held)
            training = np.repeat(~out.to_numpy(zero_copy_only=False), length)
            vocabulary, at = np.unique(sequence, return_inverse=True)
            doc_ids = pa.concat_arrays(ids)
            whole = pa.array([0, len(doc_ids)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([name]),
                    pa.array([len(vocabulary)], pa.int64()),
                    pa.array([int(training.sum())], pa.int64()),
                    pa.array([len(out) - int(pa.compute.sum(out).as_py() or 0)], pa.int64()),
                    pa.ListArray.from_arrays(whole, doc_ids),
                    pa.ListArray.from_arrays(whole, out),
                    pa.array([pack(length)], pa.binary()),
                    pa.array([pack_sorted(vocabulary)], pa.binary()),
                    pa.array([pack(np.bincount(at[training], minlength=len(vocabulary)))], pa.binary()),
                    pa.array([pack(at)], pa.binary()),
                ],
                names,
            )

        for rows, texts in slices(batches):
            texts = texts.lowered()
            words = words_of(texts)
            length = words.counts + 1
            sequence = np.full(int(length.sum()), END, np.uint64)
            sequence[np.arange(len(words.starts)) + words.doc] = word_hashes(texts, words)
            ids.append(rows.column("doc_id"))
            held.append(rows.column("held_out"))
            tokens.append(sequence)
            lengths.append(length)
            size += len(sequence)
            if size >= BLOCK_WORDS:
                yield block()
                number += 1
                ids, held, tokens, lengths, size = [], [], [], [], 0
        if ids:
            yield block()

    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    names = ["block", "n_vocabulary", "n_tokens", "n_docs", "ids", "held", "lengths", "vocabulary", "counts", "tokens"]
    kind = dict(rows.dtypes)["doc_id"]
    numbers = "block string, n_vocabulary bigint, n_tokens bigint, n_docs bigint"
    return rows.mapInArrow(
        build,
        f"{numbers}, ids array<{kind}>, held array<boolean>, lengths binary, vocabulary binary, counts binary, tokens binary",
    )


def _send_words(buckets: int):
    """Each block's words and counts, cut into ranges of hashes."""
    edges = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)

    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words, counts = unpack_sorted(row["vocabulary"]), unpack(row["counts"])
                cuts = [0, *np.searchsorted(words, edges).tolist(), len(words)]
                yield _batch(
                    [
                        {"bucket": k, "block": row["block"], "p": pack_sorted(words[a:b]), "q": pack(counts[a:b])}
                        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
                        if a < b
                    ],
                    _SENT,
                )

    return send


_SENT = [("bucket", pa.int64()), ("block", pa.string()), ("p", pa.binary()), ("q", pa.binary()), ("r", pa.binary())]
_SENT_SCHEMA = "bucket bigint, block string, p binary, q binary, r binary"
_BACK = [("bucket", pa.int64()), ("block", pa.string()), *((c, pa.binary()) for c in "pqrs")]
_STATS = [("size", pa.int64()), ("types", pa.int64()), ("counts_of_counts", pa.list_(pa.int64()))]
_FREQUENT = [("word", pa.list_(pa.int64())), ("numbers", pa.list_(pa.list_(pa.float64())))]
_BACK_SCHEMA = (
    "bucket bigint, block string, p binary, q binary, r binary, s binary, size bigint, types bigint, "
    "counts_of_counts array<bigint>, word array<bigint>, numbers array<array<double>>"
)


def _few(counts: np.ndarray) -> list[int]:
    """How many types occur once, twice, up to six times."""
    return np.bincount(np.minimum(counts, LARGEST + 2).astype(np.int64), minlength=LARGEST + 3)[1 : LARGEST + 2].tolist()


def _merge_words(batches):
    """Per bucket of words: to every block its words' places in the bucket and counts; one row about the bucket."""
    for rows in _by(batches, "bucket"):
        keys = [unpack_sorted(r["p"]) for r in rows]
        words, at = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.bincount(at, np.concatenate([unpack(r["q"]) for r in rows]), len(words)).astype(np.int64)
        out, begin = [], 0
        for row, own in zip(rows, keys, strict=True):
            place = at[begin : begin + len(own)]
            begin += len(own)
            out.append({"bucket": row["bucket"], "block": row["block"], "p": pack_sorted(place), "q": pack(counts[place])})
        often = np.flatnonzero(counts > FREQUENT)
        out.append(
            {
                "bucket": row["bucket"],
                "size": len(words),
                "types": int((counts > 0).sum()),
                "counts_of_counts": _few(counts),
                "word": often.tolist(),
                "numbers": [[float(counts[k])] for k in often],
            }
        )
        yield _batch(out, [*_BACK, *_STATS, *_FREQUENT])


@dataclass
class Spread:
    """How words are numbered and bigrams dealt to buckets."""

    stride: int
    word_space: int
    buckets: int
    limit: float
    often: dict[int, float]
    docs: int

    def numbers(self, rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers, ascending, and counts of a block's words from what the buckets returned."""
        parts = [unpack_sorted(r["p"]) + np.uint64(r["bucket"] * self.stride + 1) for r in rows]
        return np.concatenate(parts).astype(np.int64), np.concatenate([unpack(r["q"]) for r in rows]).astype(np.int64)

    def pairs(self, tokens: np.ndarray, lengths: np.ndarray, words: int) -> np.ndarray:
        """History and token of every token as one number of the block; history 0 is the mark before a text."""
        history = np.empty(len(tokens), np.int64)
        history[1:] = tokens[:-1] + 1
        history[np.cumsum(lengths) - lengths] = 0
        return history * words + tokens

    def bucket(self, history: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The bucket of each pair of word numbers."""
        out = (history.astype(np.float64) / (self.word_space + 1) * self.buckets).astype(np.int64)
        if self.often:
            often = np.array(sorted(self.often), np.int64)
            at = np.minimum(np.searchsorted(often, history), len(often) - 1)
            hit = np.flatnonzero(often[at] == history)
            count = np.array([self.often[int(h)] for h in often])[at[hit]]
            ways = np.ceil(count / self.limit).astype(np.uint64)
            out[hit] += (mix64(word[hit]) % ways).astype(np.int64)
        return np.minimum(out, self.buckets - 1) if not self.often else out % self.buckets


class _Known:
    """One block with the numbers and counts of its words and its distinct pairs, by bucket."""

    def __init__(self, rows: list[dict], spread: Spread, need_places: bool):
        text = rows[0]
        self.ids, self.held = text["ids"], np.array(text["held"], bool)
        self.lengths = unpack(text["p"]).astype(np.int64)
        self.tokens = unpack(text["q"]).astype(np.int64)
        self.numbers, self.counts = spread.numbers([r for r in rows if r["kind"] == 1])
        words = len(self.numbers)
        codes = spread.pairs(self.tokens, self.lengths, words)
        training = np.repeat(~self.held, self.lengths)
        if need_places:
            codes, self.place = np.unique(codes, return_inverse=True)
            self.times = None
        else:
            codes, place = np.unique(codes, return_inverse=True)
            self.times = np.bincount(place[training], minlength=len(codes))
        self.word = codes % words
        local = codes // words
        self.first = np.where(local > 0, self.numbers[np.maximum(local - 1, 0)], BEGIN)
        self.first_count = np.where(local > 0, self.counts[np.maximum(local - 1, 0)], spread.docs)
        self.second = self.numbers[self.word]
        bucket = spread.bucket(self.first, self.second)
        self.order = np.argsort(bucket, kind="stable")
        self.buckets, begin = np.unique(bucket[self.order], return_index=True)
        self.bounds = [*begin.tolist(), len(bucket)]


def _send_pairs(spread: Spread):
    def send(batches):
        for rows in _by(batches, "block"):
            block = _Known(rows, spread, False)
            codes = block.first * spread.word_space + block.second
            out = []
            for k, a, b in zip(block.buckets.tolist(), block.bounds[:-1], block.bounds[1:], strict=True):
                own = block.order[a:b]
                out.append(
                    {
                        "bucket": k,
                        "block": rows[0]["block"],
                        "p": pack_sorted(codes[own].astype(np.uint64)),
                        "q": pack(block.times[own]),
                        "r": pack(block.counts[block.word[own]]),
                    }
                )
            yield _batch(out, _SENT)

    return send


def _merge_pairs(spread: Spread, unigrams: Unigrams):
    """Per bucket of bigrams: to every block the counts and what the backoff weights need."""

    def merge(batches):
        for rows in _by(batches, "bucket"):
            keys = [unpack_sorted(r["p"]) for r in rows]
            codes, at = np.unique(np.concatenate(keys), return_inverse=True)
            counts = np.bincount(at, np.concatenate([unpack(r["q"]) for r in rows]), len(codes)).astype(np.int64)
            single = np.zeros(len(codes), np.int64)
            single[at] = np.concatenate([unpack(r["r"]) for r in rows]).astype(np.int64)
            history, of = np.unique(codes.astype(np.int64) // spread.word_space, return_inverse=True)
            low = [np.bincount(of[counts == r], minlength=len(history)) for r in range(1, LARGEST + 1)]
            covered = np.bincount(of, np.where(counts > 0, unigrams.probability(single), 0.0), len(history))
            rare = np.sum(low, axis=0)
            out, begin = [], 0
            for row, own in zip(rows, keys, strict=True):
                place = at[begin : begin + len(own)]
                begin += len(own)
                new = of[place[counts[place] == 0]]
                out.append(
                    {
                        "bucket": row["bucket"],
                        "block": row["block"],
                        "p": pack(counts[place]),
                        "q": pack(rare[of[place]] == 0),
                        "r": pack(np.concatenate([m[new] for m in low])),
                        "s": zstandard.ZstdCompressor(level=1).compress(covered[new].tobytes()),
                    }
                )
            wide = [k for k, h in enumerate(history.tolist()) if h in spread.often]
            out.append(
                {
                    "bucket": row["bucket"],
                    "p": pack_sorted(codes),
                    "q": pack(counts),
                    "counts_of_counts": _few(counts),
                    "word": history[wide].tolist(),
                    "numbers": [[*(float(m[k]) for m in low), float(covered[k])] for k in wide],
                }
            )
            yield _batch(out, [*_BACK, *_STATS, *_FREQUENT])

    return merge


def _score(spread: Spread, unigrams: Unigrams, d: np.ndarray, often, id_kind):
    """Scores of the texts of each block, from its words and pairs."""

    def run(batches):
        shared = often.value
        for rows in _by(batches, "block"):
            block = _Known(rows, spread, True)
            n = len(block.first)
            counts, bare = np.zeros(n, np.int64), np.zeros(n, bool)
            left, covered = np.zeros(n), np.zeros(n)
            taken = (1 - d) * np.arange(1, LARGEST + 1)
            back = {r["bucket"]: r for r in rows if r["kind"] == 2}
            for k, a, b in zip(block.buckets.tolist(), block.bounds[:-1], block.bounds[1:], strict=True):
                own, row = block.order[a:b], back[k]
                counts[own] = unpack(row["p"])
                bare[own] = unpack(row["q"]) > 0
                new = own[counts[own] == 0]
                left[new] = taken @ unpack(row["r"]).reshape(LARGEST, len(new))
                covered[new] = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["s"]) if len(new) else b"")
            for h, values in shared.items():
                begin, end = np.searchsorted(block.first, [h, h + 1])
                left[begin:end] = taken @ np.array(values[:LARGEST])
                covered[begin:end] = values[LARGEST]
                bare[begin:end] = not any(values[:LARGEST])
            history = block.first_count.astype(np.float64)
            single = unigrams.probability(block.counts)[block.word]
            some = np.maximum(history, 1)
            seen = _discounted(counts, d) / np.where(bare, some + 1, some)
            left = np.where(left > 0, left / some, 1 / (some + 1))
            backed = np.where(history > 0, left / (1 - covered), 1.0) * single
            logs = np.log10(np.where(counts > 0, seen, backed))[block.place]
            begin = np.cumsum(block.lengths) - block.lengths
            total = lambda v: np.add.reduceat(v, begin)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block.ids, id_kind),
                    pa.array(block.held),
                    pa.array(block.lengths),
                    pa.array(total((block.counts[block.tokens] > 0).astype(np.int64))),
                    pa.array(np.full(len(begin), unigrams.tokens)),
                    pa.array(total(unigrams.base(block.counts)[block.tokens])),
                    pa.array(total(logs)),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def _summed(back: DataFrame) -> tuple[int, int, np.ndarray]:
    """Largest bucket, all types and the counts of counts of all buckets."""
    about = back.where("counts_of_counts is not null")
    sums = [F.sum(F.col("counts_of_counts")[k]) for k in range(LARGEST + 1)]
    row = about.agg(F.max("size"), F.sum("types"), *sums).first()
    return row[0] or 0, row[1] or 0, np.array([v or 0 for v in row[2:]], np.float64)


def katz_scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    The model learns from the rows where ``held_out`` is false and scores all.
    """
    spark = docs.sparkSession
    blocks = stored(make_blocks(docs, held_out), "token-blocks")
    sizes = blocks.agg(F.sum("n_vocabulary"), F.sum("n_tokens"), F.sum("n_docs"), F.sum(F.size("ids"))).first()
    entries, tokens, training_docs, _ = (v or 0 for v in sizes)

    word_buckets = max(1, -(-entries // BUCKET_ENTRIES))
    sent = blocks.select("block", "vocabulary", "counts").mapInArrow(_send_words(word_buckets), _SENT_SCHEMA)
    sent = sent.repartition("bucket").sortWithinPartitions("bucket", "block")
    words = stored(sent.mapInArrow(_merge_words, _BACK_SCHEMA), "word-counts")
    stride, types, few = _summed(words)
    unigrams = Unigrams.of(tokens, types, few)
    limit = max(FREQUENT, tokens / 1e6)
    common = words.where(F.size("word") > 0).select("bucket", F.explode(F.arrays_zip("word", "numbers")).alias("w"))
    common = common.select("bucket", F.col("w.word").alias("place"), F.col("w.numbers")[0].alias("n")).where(F.col("n") > limit)
    often = {int(r["bucket"]) * stride + int(r["place"]) + 1: float(r["n"]) for r in common.collect()}
    if training_docs > limit:
        often[BEGIN] = float(training_docs)
    space = word_buckets * stride + 1
    if (space + 1) ** 2 >= 1 << 63:
        raise ValueError("too many words for pairs of 64 bits")
    all_tokens = max(tokens, entries)
    spread = Spread(stride, space, max(1, -(-all_tokens // BUCKET_ENTRIES)), limit, often, training_docs)

    none = F.lit(None).cast("binary")
    texts = blocks.select(
        "block", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("bucket"), "ids", "held",
        F.col("lengths").alias("p"), F.col("tokens").alias("q"), none.alias("r"), none.alias("s"),
    )
    kinds = dict(blocks.dtypes)

    def returned(rows: DataFrame, kind: int) -> DataFrame:
        return rows.where("block is not null").select(
            "block", F.lit(kind).alias("kind"), "bucket", F.lit(None).cast(kinds["ids"]).alias("ids"),
            F.lit(None).cast(kinds["held"]).alias("held"), "p", "q", "r", "s",
        )

    known = texts.unionByName(returned(words, 1))
    sent = known.repartition("block").sortWithinPartitions("block", "kind", "bucket")
    sent = sent.mapInArrow(_send_pairs(spread), _SENT_SCHEMA).repartition("bucket")
    sent = sent.sortWithinPartitions("bucket", "block")
    pairs = stored(sent.mapInArrow(_merge_pairs(spread, unigrams), _BACK_SCHEMA), "bigram-counts")
    d = discounts(_summed(pairs)[2])
    wide = pairs.where(F.size("word") > 0).select(F.explode(F.arrays_zip("word", "numbers")).alias("w"))
    wide = wide.groupBy("w.word").agg(*[F.sum(F.col("w.numbers")[k]).alias(f"n{k}") for k in range(LARGEST + 1)])
    shared = spark.sparkContext.broadcast({int(r[0]): list(r[1:]) for r in wide.collect()})

    rows = known.unionByName(returned(pairs, 2)).repartition("block").sortWithinPartitions("block", "kind", "bucket")
    id_kind = rows.select(F.explode("ids").alias("i")).limit(0).toArrow().schema.field("i").type
    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInArrow(
        _score(spread, unigrams, d, shared, id_kind),
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double",
    )
