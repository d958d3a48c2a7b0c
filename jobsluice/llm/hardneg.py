"""Hard negatives by windows of exact inner products over Hilbert-ordered blocks with zone maps.

Vectors are turned into whole numbers, sorted along a Hilbert curve through their most varied dimensions
and written as Parquet blocks of neighbours. A block has a zone map, the least and the largest value of
every dimension; a shelf is one range partition of blocks and has the zone map of all of them. Interval
arithmetic on a zone map bounds the inner product of an anchor with everything inside, from below and
above. An anchor is sent to a shelf, and in it compared with a block, only if the bounds meet one of its
windows. Vectors without structure give bounds that meet every window: then everything is read, and the
result is the same.

A search takes two passes: over the shelf an anchor lies in, which gives each window a k-th best score,
and over all other shelves that may hold something at least as good. Anchors travel in blocks too. They meet
the data by a join on the shelf, which streams (anchors, block) pairs of bounded size through numpy; each
pass keeps the k best of every window, in the task and then by a ranked window function. The zone
maps of the shelves are broadcast: one row for each range partition, so their size is set by
``spark.sql.shuffle.partitions`` and not by the data.

Defined results: rows with a NULL id or label, a NULL vector, or a component that is NULL or not finite take no part;
rows that repeat wholly count once, of other rows with one id the smallest (label, vector) counts; vectors
of different lengths are filled up with zeros; equal scores are ordered by id; scores beyond 64 bits are
cut to them; an empty table gives no rows. Only the named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsluice.llm.shared import scratch_path, stored

N_POSITIVES = 5
N_NEGATIVES = 10
#: A negative has from ``LOW`` to ``HIGH`` percent of the score of the positive.
LOW, HIGH = 30, 90
#: Components are multiplied by this and cut to whole numbers.
SCALE = 256
#: Dimensions of the curve, those with the largest variance, and bits of each.
CURVE_DIMS, CURVE_BITS = 16, 3
#: Rows of a block of data, and of a block of anchors.
BLOCK_ROWS, ANCHOR_ROWS = 1_024, 512

LEAST, MOST = -(2**63), 2**63 - 1


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """``id``, ``label``, ``asked``, ``q``: the rows that take part (``id``, ``label``, ``asked``, ``vec``), one for each id."""
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where("id is not null and label is not null and vec is not null").where(~odd)
    whole = F.transform("vec", lambda x: F.floor(x.cast("double") * scale))
    rows = rows.select(F.col("id").cast("bigint"), F.col("label").cast("bigint"), "asked", whole.alias("q"))
    repeated = stored(rows.groupBy("id").count().where("count > 1").select("id"), "repeated-ids")
    if repeated.isEmpty():
        return rows
    once = rows.join(repeated, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "q", "asked")).alias("r"))
    return rows.join(repeated, "id", "left_anti").unionByName(once.select("id", "r.*"))


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """One row for each list, filled up with zeros."""
    sizes = vectors.value_lengths().to_numpy()
    flat = vectors.flatten().to_numpy()
    if (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


@dataclass(frozen=True)
class Space:
    """The range of every dimension, the dimensions of the curve, and how scores are computed."""

    low: np.ndarray
    high: np.ndarray
    curve: np.ndarray

    @property
    def dim(self) -> int:
        return len(self.low)

    @property
    def largest(self) -> int:
        return max([0, *map(abs, self.low.tolist()), *map(abs, self.high.tolist())])

    @property
    def kind(self) -> str:
        return "<i2" if self.largest < 2**15 else "<i8"

    def products(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Exact inner products of all rows of ``a`` with all rows of ``b``."""
        if self.dim * self.largest**2 < 2**53:
            return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
        return np.clip(a.astype(object) @ b.astype(object).T, LEAST, MOST).astype(np.int64).reshape(len(a), len(b))

    def bounds(self, a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the largest product of each row of ``a`` with a vector between each ``low`` and ``high``."""
        up, down = np.maximum(a, 0), np.minimum(a, 0)
        ahead, back = np.hstack([low, high]), np.hstack([high, low])
        both = np.hstack([up, down])
        return self.products(both, ahead), self.products(both, back)


def space_of(vectors: DataFrame) -> Space:
    """Ranges and variances of all dimensions, summed in the tasks first."""

    def measure(batches):
        for batch in batches:
            q = batch.column("q")
            if not batch.num_rows:
                continue
            rows = _matrix(q, int(q.value_lengths().to_numpy().max()))
            x = rows.astype(np.float64)
            parts = [np.arange(rows.shape[1]), np.full(rows.shape[1], len(rows)), rows.min(0), rows.max(0), x.sum(0), (x * x).sum(0)]
            yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], ["dim", "n", "low", "high", "total", "squares"])

    kinds = "dim bigint, n bigint, low bigint, high bigint, total double, squares double"
    found = vectors.select("q").mapInArrow(measure, kinds).groupBy("dim").agg(
        F.min("low").alias("low"), F.max("high").alias("high"),
        (F.sum("squares") / F.sum("n") - (F.sum("total") / F.sum("n")) ** 2).alias("variance"),
    )
    found = sorted(found.collect(), key=lambda r: r["dim"])
    varied = sorted(range(len(found)), key=lambda d: (-found[d]["variance"], d))[:CURVE_DIMS]
    return Space(
        np.array([r["low"] for r in found], np.int64), np.array([r["high"] for r in found], np.int64), np.array(sorted(varied), np.int64)
    )


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions along the Hilbert curve of rows of cell numbers below ``2**bits``.

    From the highest bit down, each dimension reflects or swaps the lower bits of the first one; the Gray code of the
    result, its bits interleaved, is the position (Skilling's form of the transform).
    """
    x = cells.astype(np.int64).copy()
    n, dims = x.shape
    for bit in range(bits - 1, 0, -1):
        lower = (1 << bit) - 1
        for d in range(dims):
            flip = x[:, d] >> bit & 1 == 1
            swap = np.where(flip, 0, (x[:, 0] ^ x[:, d]) & lower)
            x[:, 0] ^= np.where(flip, lower, swap)
            x[:, d] ^= swap
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    turn = np.zeros(n, np.int64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, -1] >> bit & 1 == 1, (1 << bit) - 1, 0) if dims else 0
    x ^= turn[:, None]
    out = np.zeros(n, np.int64)
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            out = out << 1 | (x[:, d] >> bit & 1)
    return out


def with_curve(vectors: DataFrame, space: Space) -> DataFrame:
    """``vectors`` with ``key``, the position of the cell of each vector on the curve."""
    low = space.low[space.curve]
    width = (space.high[space.curve] - low).astype(np.float64) + 1

    def place(batches):
        for batch in batches:
            rows = _matrix(batch.column("q"), space.dim)[:, space.curve]
            cells = np.clip((rows - low) / width * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1)
            yield batch.append_column("key", pa.array(hilbert(cells.astype(np.int64), CURVE_BITS)))

    return vectors.mapInArrow(place, "id bigint, label bigint, asked boolean, q array<bigint>, key bigint")


BLOCK = (
    "shelf int, place bigint, n_asked bigint, ids binary, labels binary, asked binary, vectors binary,"
    " low array<bigint>, high array<bigint>, low_label bigint, high_label bigint"
)


def build_blocks(vectors: DataFrame, space: Space) -> DataFrame:
    """The vectors as a table of blocks in Hilbert order, one folder for each shelf."""
    placed = with_curve(vectors, space).repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    placed = placed.select(F.spark_partition_id().alias("shelf"), "id", "label", "asked", "q")

    def pack(batches):
        at = 0
        for batch in batches:
            shelf = batch.column("shelf")[0].as_py() if batch.num_rows else 0
            q = _matrix(batch.column("q"), space.dim)
            ids, labels, asked = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label", "asked"))
            for k in range(0, len(ids), BLOCK_ROWS):
                rows = slice(k, k + BLOCK_ROWS)
                block = [
                    shelf, (shelf << 40) + at, int(asked[rows].sum()), ids[rows].tobytes(), labels[rows].tobytes(), asked[rows].tobytes(),
                    q[rows].astype(space.kind).tobytes(), q[rows].min(0).tolist(), q[rows].max(0).tolist(),
                    int(labels[rows].min()), int(labels[rows].max()),
                ]
                at += len(ids[rows])
                yield pa.RecordBatch.from_pylist([dict(zip(_names(BLOCK), block))], _arrow(BLOCK))

    path = scratch_path(vectors.sparkSession, "blocks")
    placed.mapInArrow(pack, BLOCK).write.partitionBy("shelf").option("compression", "zstd").parquet(path)
    return vectors.sparkSession.read.schema(BLOCK).parquet(path)


_KINDS = {
    "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
}


def _names(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(",")]


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (field.split() for field in ddl.split(","))])


def zone_maps(blocks: DataFrame, space: Space) -> dict[str, np.ndarray]:
    """The zone maps of the shelves; there are as many as range partitions."""
    ranges = blocks.select("shelf", F.posexplode(F.arrays_zip("low", "high")).alias("dim", "r"))
    ranges = ranges.groupBy("shelf", "dim").agg(F.min("r.low").alias("low"), F.max("r.high").alias("high"))
    ranges = ranges.groupBy("shelf").agg(F.sort_array(F.collect_list(F.struct("dim", "low", "high"))).alias("zone"))
    labels = blocks.groupBy("shelf").agg(F.min("low_label").alias("low_label"), F.max("high_label").alias("high_label"))
    found = sorted(labels.join(ranges, "shelf", "left").collect(), key=lambda r: r["shelf"])
    sides = {side: np.array([[z[side] for z in r["zone"] or ()] for r in found], np.int64) for side in ("low", "high")}
    one = {c: np.array([r[c] for r in found], np.int64) for c in ("shelf", "low_label", "high_label")}
    return {**one, **{side: x.reshape(len(found), space.dim) for side, x in sides.items()}}


def anchors_of(blocks: DataFrame) -> DataFrame:
    """``id``, ``label``, ``place``, ``home``, ``vector`` of the asked rows; ``home`` is their shelf."""

    def unpack(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels, asked = (np.frombuffer(row[c], k) for c, k in (("ids", "<i8"), ("labels", "<i8"), ("asked", bool)))
                at = np.flatnonzero(asked)
                width = len(row["vectors"]) // len(ids)
                vectors = [row["vectors"][i * width : (i + 1) * width] for i in at.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(labels[at]), pa.array(row["place"] + at), pa.array(np.full(len(at), row["shelf"], np.int32)),
                     pa.array(vectors, pa.binary())],
                    ["id", "label", "place", "home", "vector"],
                )

    asked = blocks.where("n_asked > 0").select("shelf", "place", "ids", "labels", "asked", "vectors")
    return asked.mapInArrow(unpack, "id bigint, label bigint, place bigint, home int, vector binary")


def _meets(space: Space, q, labels, low, high, zone, same: bool) -> np.ndarray:
    """Which anchors (rows) have a window that a zone (columns) may reach into."""
    least, most = space.bounds(q, zone["low"], zone["high"])
    meets = np.zeros(least.shape, bool)
    for slot in range(low.shape[1]):
        meets |= (most >= low[:, slot, None]) & (least <= high[:, slot, None]) & (low[:, slot, None] <= high[:, slot, None])
    if same:
        return meets & (zone["low_label"] <= labels[:, None]) & (labels[:, None] <= zone["high_label"])
    return meets & ~((zone["low_label"] == labels[:, None]) & (zone["high_label"] == labels[:, None]))


REQUEST = "shelf int, request bigint, ids binary, labels binary, vectors binary, low binary, high binary"


def requests(anchors: DataFrame, space: Space, zones, slots: int, same: bool, at_home: bool) -> DataFrame:
    """The anchors (with ``windows``) in blocks, for every shelf that they have to read: their own, or all others."""
    rows = anchors.repartitionByRange("place").sortWithinPartitions("place")
    shared = anchors.sparkSession.sparkContext.broadcast(zones)

    def choose(batches):
        zone = shared.value
        for batch in batches:
            for k in range(0, batch.num_rows, ANCHOR_ROWS):
                part = batch.slice(k, ANCHOR_ROWS)
                ids, labels, places, home = (part.column(c).to_numpy() for c in ("id", "label", "place", "home"))
                q = np.frombuffer(b"".join(part.column("vector").to_pylist()), space.kind).reshape(len(ids), space.dim).astype(np.int64)
                windows = [[(w["low"], w["high"]) for w in ws] + [(1, 0)] * (slots - len(ws)) for ws in part.column("windows").to_pylist()]
                windows = np.array(windows, np.int64).reshape(len(ids), slots, 2)
                low, high = windows[:, :, 0], windows[:, :, 1]
                own = home[:, None] == zone["shelf"]
                wanted = _meets(space, q, labels, low, high, zone, same) & (own if at_home else ~own)
                out = []
                for z in np.flatnonzero(wanted.any(0)):
                    at = np.flatnonzero(wanted[:, z])
                    parts = (ids[at], labels[at], q[at].astype(space.kind), low[at], high[at])
                    row = [int(zone["shelf"][z]), int(places[0]), *[p.tobytes() for p in parts]]
                    out.append(dict(zip(_names(REQUEST), row)))
                    if len(out) == 64:
                        yield pa.RecordBatch.from_pylist(out, _arrow(REQUEST))
                        out = []
                if out:
                    yield pa.RecordBatch.from_pylist(out, _arrow(REQUEST))

    return rows.select("id", "label", "place", "home", "vector", "windows").mapInArrow(choose, REQUEST)


def _best(anchor, slot, score, other, k: int) -> np.ndarray:
    """Indices of the ``k`` best rows of every (anchor, slot)."""
    order = np.lexsort((other, -score.astype(np.float64) if len(score) and abs(score).max() < 2**53 else [-int(s) for s in score], slot, anchor))
    head = np.ones(len(order), bool)
    head[1:] = (anchor[order][1:] != anchor[order][:-1]) | (slot[order][1:] != slot[order][:-1])
    first = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - first < k]


class _Reading:
    """The best rows so far of the windows of one block of anchors."""

    def __init__(self, space: Space, row: dict, same: bool, k: int):
        self.space, self.same, self.k = space, same, k
        self.ids, self.labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
        self.q = np.frombuffer(row["vectors"], space.kind).reshape(len(self.ids), space.dim).astype(np.int64)
        self.low, self.high = (np.frombuffer(row[c], "<i8").reshape(len(self.ids), -1).copy() for c in ("low", "high"))
        self.found = [np.zeros(0, np.int64)] * 4

    def read(self, row: dict) -> None:
        zone = {c: np.array([row[c]], np.int64) for c in ("low", "high", "low_label", "high_label")}
        zone |= {c: zone[c].reshape(1, self.space.dim) for c in ("low", "high")}
        at = np.flatnonzero(_meets(self.space, self.q, self.labels, self.low, self.high, zone, self.same)[:, 0])
        if not len(at):
            return
        ids, labels = (np.frombuffer(row[c], "<i8") for c in ("block_ids", "block_labels"))
        vectors = np.frombuffer(row["block_vectors"], self.space.kind).reshape(len(ids), self.space.dim)
        score = self.space.products(self.q[at], vectors)
        may = (labels == self.labels[at, None]) == self.same
        may &= ids != self.ids[at, None]
        new = [self.found]
        for slot in range(self.low.shape[1]):
            a, r = np.nonzero(may & (score >= self.low[at, slot, None]) & (score <= self.high[at, slot, None]))
            if len(a):
                new.append([at[a], np.full(len(a), slot), score[a, r], ids[r]])
        if len(new) == 1:
            return
        found = [np.concatenate(x) for x in zip(*new)]
        kept = _best(*found, self.k)
        self.found = [x[kept] for x in found]
        # Rows of a window stand together, best first: the k-th one is the new lower end.
        anchor, slot, score, _ = self.found
        last = np.arange(self.k - 1, len(anchor))
        full = last[(anchor[last] == anchor[last - self.k + 1]) & (slot[last] == slot[last - self.k + 1])]
        self.low[anchor[full], slot[full]] = score[full]

    def result(self) -> pa.RecordBatch:
        anchor, slot, score, other = self.found
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (self.ids[anchor], slot, other, score)], ["id", "slot", "other", "score"])


def _read(asked: DataFrame, blocks: DataFrame, space: Space, same: bool, k: int) -> DataFrame:
    """``id``, ``slot``, ``other``, ``score``: what the requests find on their shelves, at most ``k`` for each window and shelf."""

    def compare(batches):
        now, reading = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["shelf"], row["request"]) != now:
                    if reading is not None:
                        yield reading.result()
                    now, reading = (row["shelf"], row["request"]), _Reading(space, row, same, k)
                row |= {"low": row["zone_low"], "high": row["zone_high"]}
                reading.read(row)
        if reading is not None:
            yield reading.result()

    data = blocks.select(
        "shelf", F.col("ids").alias("block_ids"), F.col("labels").alias("block_labels"), F.col("vectors").alias("block_vectors"),
        F.col("low").alias("zone_low"), F.col("high").alias("zone_high"), "low_label", "high_label",
    )
    # The streamed side of a merge join is the left one: all blocks of the shelf follow each other for one request.
    pairs = asked.hint("merge").join(data, "shelf")
    return pairs.mapInArrow(compare, "id bigint, slot bigint, other bigint, score bigint")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("id", "slot").orderBy(F.col("score").desc(), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(anchors: DataFrame, windows: DataFrame, blocks: DataFrame, space: Space, zones, same: bool, k: int, slots: int) -> DataFrame:
    """``id``, ``slot``, ``other``, ``score``, ``rank``: the ``k`` best rows in every window (``id``, ``slot``, ``low``, ``high``).

    ``same`` asks for rows of the anchor's label, otherwise for rows of any other label.
    """

    def pass_(windows: DataFrame, at_home: bool) -> DataFrame:
        # At most ``slots`` windows for each anchor.
        listed = windows.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("slot", "low", "high"))).alias("windows"))
        asked = requests(anchors.join(listed, "id"), space, zones, slots, same, at_home)
        return stored(_ranked(_read(asked, blocks, space, same, k), k), "found")

    near = pass_(windows, True)
    floors = near.where(F.col("rank") == k).select("id", "slot", F.col("score").alias("floor"))
    narrowed = windows.join(floors, ["id", "slot"], "left")
    narrowed = narrowed.select("id", "slot", F.greatest("low", "floor").alias("low"), "high")
    far = pass_(narrowed, False)
    return stored(_ranked(near.unionByName(far).drop("rank"), k), "ranked")


def _floor_div(x: Column, by: int) -> Column:
    return F.call_function("div", x - F.pmod(x, F.lit(by)), F.lit(by))


def hard_negatives(
    table: DataFrame, vec_id: Column, vec: Column, label: Column, asked: Column,
    n_positives: int = N_POSITIVES, n_negatives: int = N_NEGATIVES, low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    ``asked`` marks the anchors. Their positives are the first ``n_positives`` other rows of their label, the negatives of
    a positive the first ``n_negatives`` rows of other labels with ``low`` to ``high`` percent of its score.
    """
    rows = table.select(vec_id.alias("id"), label.alias("label"), F.coalesce(asked, F.lit(False)).alias("asked"), vec.alias("vec"))
    vectors = whole_vectors(rows)
    space = space_of(vectors)
    blocks = build_blocks(vectors, space)
    zones = zone_maps(blocks, space)
    anchors = stored(anchors_of(blocks), "anchors")
    everything = anchors.select("id", F.lit(0).cast("bigint").alias("slot"), F.lit(LEAST).alias("low"), F.lit(MOST).alias("high"))
    positives = search(anchors, everything, blocks, space, zones, True, n_positives, 1)
    positives = positives.select("id", (F.col("rank") - 1).cast("bigint").alias("slot"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    p = F.col("positive_score").cast("decimal(38,0)")
    windows = positives.select(
        "id", "slot", (-_floor_div(-p * low, 100)).cast("bigint").alias("low"), _floor_div(p * high, 100).cast("bigint").alias("high")
    )
    # A window that is empty, as that of a negative score, needs no search.
    windows = stored(windows.where("low <= high"), "windows")
    negatives = search(anchors, windows, blocks, space, zones, False, n_negatives, n_positives)
    found = negatives.join(positives, ["id", "slot"])
    return found.select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
