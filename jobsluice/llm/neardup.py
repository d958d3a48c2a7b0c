"""Near-duplicate documents: banded MinHash, odd sketches, confirmation on the full shingle sets.

1. Every text becomes the set of its 5-word shingles as 64-bit hashes, 160 MinHash samples of it in
   40 bands of 4, and an odd sketch: a bitmap in which every sample flips one bit. Texts with equal
   sets form a class; from here on there is one row per class, so exact copies cost nothing.
2. Classes that share a band meet in a bucket. Each is paired with the smallest class of the bucket,
   not with all others. The number of bits in which two sketches differ estimates the similarity;
   pairs that the estimate leaves open are confirmed on the full sets.
3. Linked classes are contracted to components. Only buckets whose classes still lie in different
   components need more: their pairs across components are compared in blocks of bounded size, so
   that no link is lost because the smallest class of a bucket happened to be a poor partner.

A pair at the threshold shares no band with probability (1 - 0.75^4)^40 = 2.5e-7, and a sketch hides
it with a probability below 1e-7 (the estimate may be off by more than five standard deviations).

Defined results: NULL, empty and white-space texts have no shingles and no links. Repeated rows are
rows of one class. A row without a doc_id takes part; ids of components are those of rows that have
one. Extra columns are not read, an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsluice.llm.graph import components
from jobsluice.llm.shared import fits, stored
from jobsluice.llm.words import (
    Texts,
    Words,
    mix64,
    sequence_hashes,
    slices,
    unique_per_doc,
    windows_within,
    word_hashes,
    words_of,
)

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 40, 4
SKETCH_BITS = 512
#: Pairs whose estimated similarity is below this are dropped without looking at the sets.
SKETCH_LEAST = 0.45
#: Classes of a bucket compared at once in one task.
BLOCK = 500
#: A list of ids and hashes up to this long (64 MB) is broadcast; a longer one is joined by shuffle.
BROADCAST_IDS = 4_000_000

_SEEDS = mix64(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
_FACTORS, _SHIFTS = _SEEDS[: BANDS * ROWS] | np.uint64(1), _SEEDS[BANDS * ROWS :]


def sketch_limit(least: float = SKETCH_LEAST) -> int:
    """The largest number of differing bits at which the estimate reaches ``least``."""
    return math.floor(SKETCH_BITS / 2 * (1 - math.exp(-4 * BANDS * ROWS * (1 - least) / SKETCH_BITS)))


def shingle_sets(texts: Texts, words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending, and where each text's shingles begin.

    A text with fewer than ``size`` words has all of them as its one shingle.
    """
    hashes = word_hashes(texts, words)
    inside = np.flatnonzero(windows_within(words, size))
    grams, doc = sequence_hashes(hashes, size)[inside], words.doc[inside]
    counts = words.counts
    short = np.flatnonzero((counts > 0) & (counts < size))
    whole = np.zeros(len(short), np.uint64)
    for k in range(1, size):
        of = counts[short] == k
        if of.any():
            whole[of] = mix64(sequence_hashes(hashes, k)[words.first[short[of]]] + np.uint64(k))
    return unique_per_doc(np.concatenate([doc, short]), np.concatenate([grams, whole]), len(texts))


def _class_ids(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set."""
    n = np.diff(first).astype(np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(values ^ np.uint64(0x5851F42D4C957F2D)))])
    return mix64(mix64(total[first[1:]] - total[first[:-1]]) + n)


def _min_hashes(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """All samples of every non-empty set, a row a set."""
    out = np.empty((len(first) - 1, BANDS * ROWS), np.uint64)
    for k in range(BANDS * ROWS):
        out[:, k] = np.minimum.reduceat(values * _FACTORS[k] + _SHIFTS[k], first[:-1])
    return out


def _bands(samples: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.zeros((len(samples), 1), np.uint64)
    for k in range(ROWS):
        keys = mix64(keys + samples[:, k::ROWS])
    return keys


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """One bitmap a row, as 64-bit words: bit ``h`` says whether an odd number of samples hash to ``h``."""
    numbered = samples + np.arange(1, samples.shape[1] + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    at = (mix64(numbered) % np.uint64(SKETCH_BITS)).astype(np.int64)
    bits = np.zeros((len(samples), SKETCH_BITS), np.uint8)
    np.add.at(bits, (np.arange(len(samples))[:, None], at), 1)
    return np.packbits(bits & 1, axis=1, bitorder="little").view(np.uint64)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """64-bit values as one list a row."""
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1).view(np.int64)))


def signatures(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text), ``cid`` (hash of the set), ``n``, ``sketch``, ``bands``."""

    def sign(batches):
        for rows, texts in slices(batches):
            texts = texts.lowered()
            values, first = shingle_sets(texts, words_of(texts))
            n = np.diff(first)
            full = np.flatnonzero(n)
            sketches, bands = np.zeros((0, SKETCH_BITS // 64), np.uint64), np.zeros((0, BANDS), np.uint64)
            if len(full):
                samples = _min_hashes(values, np.append(first[full], len(values)))
                sketches, bands = odd_sketches(samples), _bands(samples)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("mark"),
                    pa.array(_class_ids(values, first).view(np.int64)),
                    pa.array(n, pa.int64()),
                    _lists(sketches, np.where(n > 0, SKETCH_BITS // 64, 0)),
                    _lists(bands, np.where(n > 0, BANDS, 0)),
                ],
                ["doc_id", "mark", "cid", "n", "sketch", "bands"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(
        sign, f"doc_id {kind}, mark bigint, cid bigint, n bigint, sketch array<bigint>, bands array<bigint>"
    )


def _sets(docs: DataFrame, text: str, doc_id: str, wanted: DataFrame) -> DataFrame:
    """``cid``, ``items`` of the classes ``wanted`` (``cid``, ``first_id``, ``mark``), one row a class however many copies it has.

    A class is read from one row of it, known by id and text; only rows that repeat both have to be thinned out.
    """

    def build(batches):
        for _, texts in slices(batches):
            texts = texts.lowered()
            values, first = shingle_sets(texts, words_of(texts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(_class_ids(values, first).view(np.int64)), _lists(values, np.diff(first))], ["cid", "items"]
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    wanted = stored(wanted.select("first_id", F.col("mark").alias("_mark")), "wanted")
    some = F.broadcast(wanted) if fits(wanted, BROADCAST_IDS) else wanted
    same = (F.col("mark") == F.col("_mark")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    sets = stored(rows.join(some, same, "left_semi").select("text").mapInArrow(build, "cid bigint, items array<bigint>"), "sets")
    return sets if sets.count() <= wanted.count() else stored(sets.dropDuplicates(["cid"]), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets are as similar as asked."""
    left = sets.select(F.col("cid").alias("a"), F.col("items").alias("left"))
    right = sets.select(F.col("cid").alias("b"), F.col("items").alias("right"))
    both = F.size(F.array_intersect("left", "right")).cast("bigint")
    rows = pairs.select("a", "b").join(left, "a").join(right, "b")
    rows = rows.select("a", "b", both.alias("both"), (F.size("left") + F.size("right")).cast("bigint").alias("sum"))
    return rows.where(100 * F.col("both") >= percent * (F.col("sum") - F.col("both"))).select("a", "b").distinct()


def _apart(left: str, right: str) -> Column:
    """The number of bits in which two sketches differ."""
    bits = F.zip_with(left, right, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda total, x: total + x)


def _alike(n: str, m: str, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _labelled(rows: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """``rows`` with the component of ``node``, which is itself if it has no link."""
    labels = labels.select(F.col("node").alias(node), F.col("label").alias("_label"))
    return rows.join(labels, node, "left").withColumn(name, F.coalesce("_label", node)).drop("_label")


def _stars(labels: DataFrame) -> DataFrame:
    """The components so far as links ``a``, ``b``."""
    return labels.select(F.col("node").alias("a"), F.col("label").alias("b"))


def _flat(rows: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists, all in one, and where each list begins."""
    lists = rows.column(column).chunk(0)
    return lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()


def _block_links(percent: int):
    """Links between the classes of one pair of blocks that lie in different components."""

    def search(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        n, cid, block, label = (rows.column(c).to_numpy() for c in ("n", "cid", "block", "label"))
        sketches = _flat(rows, "sketch")[0].reshape(len(n), -1).view(np.uint64)
        items, at = _flat(rows, "items")
        across = key[1].as_py() != key[2].as_py()
        parent = {x: x for x in label.tolist()}

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        limit, found = sketch_limit(), []
        for i in range(len(n) - 1):
            other = n[i + 1 :]
            open_ = label[i + 1 :] != label[i]
            open_ &= 100 * np.minimum(other, n[i]) >= percent * np.maximum(other, n[i])
            if across:
                open_ &= block[i + 1 :] != block[i]
            rest = np.flatnonzero(open_) + i + 1
            if not len(rest):
                continue
            apart = np.bitwise_count(sketches[rest] ^ sketches[i]).sum(axis=1)
            near = apart <= limit
            rest, apart = rest[near], apart[near]
            for j in rest[np.argsort(apart, kind="stable")].tolist():
                a, b = root(int(label[i])), root(int(label[j]))
                if a != b:
                    left, right = items[at[i] : at[i + 1]], items[at[j] : at[j + 1]]
                    both = len(np.intersect1d(left, right, assume_unique=True))
                    if 100 * both >= percent * (n[i] + n[j] - both):
                        parent[max(a, b)] = min(a, b)
                        found.append((cid[i], cid[j]))
        ends = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": ends[:, 0], "b": ends[:, 1]})

    return search


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    ``component_id`` is the smallest doc_id that links of at least ``percent`` similarity reach.
    """
    signed = stored(signatures(docs, text, doc_id), "signatures")
    classes = stored(
        signed.where("n > 0")
        .groupBy("cid")
        .agg(
            F.min("doc_id").alias("first_id"),
            F.coalesce(F.min_by("mark", "doc_id"), F.min("mark")).alias("mark"),
            F.first("n").alias("n"),
            F.first("sketch").alias("sketch"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )
    banded = classes.select("cid", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("cid").alias("rep"), F.max("cid").alias("last"), F.count("*").alias("size"))
    buckets = stored(buckets.where("rep <> last").drop("last"), "buckets")
    members = stored(banded.join(buckets, "band"), "members")

    info = classes.select("cid", "n", "sketch")
    pairs = members.where("cid <> rep").select(F.col("cid").alias("a"), F.col("rep").alias("b")).distinct()
    pairs = pairs.join(info.toDF("a", "n", "sketch"), "a").join(info.toDF("b", "m", "other"), "b")
    pairs = pairs.where(_alike("n", "m", percent)).select("a", "b", _apart("sketch", "other").alias("apart"))
    pairs = stored(pairs.where(F.col("apart") <= sketch_limit()), "pairs")

    nodes = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    sets = _sets(docs, text, doc_id, classes.join(nodes, "cid", "left_semi"))
    nearest = pairs.groupBy("a").agg(F.min(F.struct("apart", "b")).alias("p")).select("a", "p.b")
    links = stored(_confirmed(nearest, sets, percent), "near-links")
    labels = stored(components(links), "labels")

    rest = _labelled(_labelled(pairs.select("a", "b"), labels, "a", "x"), labels, "b", "y").where("x <> y")
    more = stored(_confirmed(rest.join(nearest, ["a", "b"], "left_anti"), sets, percent), "near-links")
    if not more.isEmpty():
        # What is contracted already stays so: each class is linked to the smallest one of its component.
        labels = stored(components(_stars(labels).unionByName(more)), "labels")

    crowded = _labelled(members.where("size > 2"), labels, "cid", "label")
    undecided = crowded.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    undecided = stored(undecided.where("low <> high").select("band"), "undecided")
    if not undecided.isEmpty():
        crowded = stored(crowded.join(undecided, "band", "left_semi").select("band", "cid", "label", "size"), "crowded")
        wanted = classes.join(crowded.select("cid").distinct(), "cid", "left_semi")
        rows = crowded.join(info, "cid").join(_sets(docs, text, doc_id, wanted), "cid")
        blocks = F.ceil(F.col("size") / BLOCK)
        rows = rows.withColumn("block", F.pmod(F.xxhash64("cid"), blocks))
        rows = rows.withColumn("partner", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
        rows = rows.withColumn("i", F.least("block", "partner")).withColumn("j", F.greatest("block", "partner"))
        rows = rows.select("band", "i", "j", "cid", "label", "block", "n", "sketch", "items")
        more = rows.groupBy("band", "i", "j").applyInArrow(_block_links(percent), "a bigint, b bigint")
        more = stored(more.distinct(), "near-links")
        if not more.isEmpty():
            labels = stored(components(_stars(labels).unionByName(more)), "labels")

    # Back to documents: classes of one row that have no link are their own component.
    owners = _labelled(classes.select("cid", "first_id"), labels, "cid", "label")
    firsts = owners.groupBy("label").agg(F.min("first_id").alias("component_id"))
    owners = stored(owners.join(firsts, "label").select("cid", "component_id"), "owners")
    rows = signed.select("doc_id", "n", "cid").join(owners, "cid", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    rows = rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
