"""Repeated byte strings: which bytes lie in a string of 200 bytes that also starts elsewhere.

All strings of the corpus cannot be sorted in one place, so equal ones are brought together first.

1. In every text each start of a 200-byte string belongs to the smallest 40-byte hash inside that
   string (of equal ones the last). Consecutive starts with the same smallest hash are one *stretch*;
   equal strings always lie in stretches of the same hash. There is about one stretch per 80 bytes.
2. Stretches of the same hash and the same bytes are repeated as a whole. Aggregates find them
   without moving text. Stretches whose hash occurs elsewhere, but not their bytes as a whole, are
   open: such are the edges of repeated passages.
3. The bytes of open stretches meet by hash. Blocks of them get a suffix array, sorted by doubling to
   the depth of 200 bytes. The previous and next smaller places in suffix order give every start its
   longest previous factor; starts where it reaches 200 bytes are later copies. Hashes with more open
   stretches than a block holds compare hashes of their single strings in a Spark aggregate instead.

``keep="first"`` keeps the earliest place of each string, in the order of doc_id and position, and
removes the later ones. ``keep="none"`` removes all of them.

Defined results: NULL texts are empty. Rows that repeat both doc_id and text are one place that
occurs more than once: removed by ``none``, kept by ``first`` if it is the earliest. Rows without doc_id take part and come first. Matches never cross
from one text into the next. An empty table gives no rows; extra columns are carried or ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsluice.llm.shared import stored
from jobsluice.llm.words import Texts, mix64, powers, prefix_hashes, slices

LENGTH = 200
GRAM = 40
SEGMENT = 1 << 20
#: Open stretches of one hash that are sorted together; more go the way of single strings.
GROUP_STRETCHES = 2_000
#: Bytes of open stretches in one suffix array, unless one hash has more.
BLOCK_BYTES = 1 << 20


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def stretches(texts: Texts, length: int, gram: int) -> dict[str, np.ndarray]:
    """All stretches of a slice: ``text``, ``first``, ``last`` (starts within the text), ``key``, ``whole``."""
    data, n = texts.data, len(texts.data)
    empty = {k: np.zeros(0, np.int64) for k in ("text", "first", "last", "key", "whole")}
    if n < length:
        return empty
    p = prefix_hashes(data)
    inverse = powers(n + 1)[1]
    hashes = mix64((p[gram:] - p[:-gram]) * inverse[: n - gram + 1])
    width = length - gram + 1
    least = sliding_min(hashes, width)
    begins = np.ones(len(least), bool)
    begins[1:] = (least[1:] != least[:-1]) | (hashes[width : width + len(least) - 1] == least[1:])
    # Starts whose string would run into the next text do not exist.
    doc = np.searchsorted(texts.offsets, np.arange(len(least)), "right") - 1
    valid = np.arange(len(least)) + length <= texts.offsets[doc + 1]
    begins[1:] |= doc[1:] != doc[:-1]
    firsts = np.flatnonzero(begins & valid)
    if not len(firsts):
        return empty
    ends = valid.copy()
    ends[:-1] &= begins[1:] | ~valid[1:]
    lasts = np.flatnonzero(ends)
    whole = mix64((p[lasts + length] - p[firsts]) * inverse[firsts] + (lasts - firsts).astype(np.uint64))
    of = doc[firsts]
    return {
        "text": of,
        "first": firsts - texts.offsets[of],
        "last": lasts - texts.offsets[of],
        "key": least[firsts].view(np.int64),
        "whole": whole.view(np.int64),
    }


def _segments(texts: Texts, length: int):
    """A slice as it is, or the one long text of a slice in pieces that overlap by ``length - 1``."""
    if len(texts) > 1 or len(texts.data) <= 2 * SEGMENT:
        yield 0, texts
        return
    for at in range(0, max(1, len(texts.data) - length + 1), SEGMENT):
        piece = texts.data[at : at + SEGMENT + length - 1]
        yield at, Texts(piece, np.array([0, len(piece)], np.int64))


def _find_stretches(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def find(batches):
        for rows, texts in slices(batches, limit=SEGMENT):
            for at, piece in _segments(texts, length):
                found = stretches(piece, length, gram)
                of = pa.array(found["text"])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id").take(of),
                        rows.column("mark").take(of),
                        pa.array(found["first"] + at),
                        pa.array(found["last"] + at),
                        pa.array(found["key"]),
                        pa.array(found["whole"]),
                    ],
                    ["doc_id", "mark", "first", "last", "key", "whole"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(
        find, f"doc_id {kind}, mark bigint, first bigint, last bigint, key bigint, whole bigint"
    )


def suffix_groups(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``starts`` to the depth of ``length``, and the group of each of its entries.

    Entries of a group share ``length`` bytes. Every suffix has a rank, at first by its first eight
    bytes; a round doubles the depth and sorts only the groups that are not single.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.zeros(n, np.uint64)
    for k in range(8):
        words = words << np.uint64(8) | padded[k : k + n].astype(np.uint64)
    order = np.argsort(words)
    new = np.ones(n, bool)
    new[1:] = words[order][1:] != words[order][:-1]
    heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = heads
    depth = 8
    active = order[~(new & np.append(new[1:], True))]
    while depth < length and len(active):
        step = min(depth, length - depth)
        # Suffixes that end before the next depth are single; no wanted start reads past its stretch.
        nxt = active + step
        inner = np.where(nxt < n, rank[np.minimum(nxt, n - 1)], -1)
        by = np.argsort(rank[active] * (n + 1) + inner + 1)
        active, outer, inner = active[by], rank[active][by], inner[by]
        group = np.ones(len(active), bool)
        group[1:] = outer[1:] != outer[:-1]
        split = group.copy()
        split[1:] |= inner[1:] != inner[:-1]
        at = np.arange(len(active))
        rank[active] = outer + np.maximum.accumulate(np.where(split, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        active = active[~(split & np.append(split[1:], True))]
        depth += step
    order = starts[np.argsort(rank[starts])]
    return order, rank[order]


def smaller_before(group: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For every entry the index of the last one of its group before it with a smaller place, -1 if there is none.

    An entry looks at its neighbour; whoever finds a larger place there goes on from where that
    entry's own search has got to, and no search passes over a smaller place.
    """
    at = np.arange(-1, len(place) - 1)
    at[1:][group[1:] != group[:-1]] = -1
    open_ = np.flatnonzero(at >= 0)
    while len(open_):
        open_ = open_[place[at[open_]] > place[open_]]
        at[open_] = at[at[open_]]
        open_ = open_[at[open_] >= 0]
    return at


def longest_previous(group: np.ndarray, place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``lpf``, ``before``, ``after`` for suffixes in suffix order.

    ``before`` and ``after`` are the indices of the previous and the next smaller place: the two earlier
    suffixes with the longest common prefixes. Suffixes of one group share ``length`` bytes and those of two
    groups do not, so a place beyond the group counts as none (-1). ``lpf`` is the larger of the two common
    prefixes, ``length`` for all that reach it and 0 for anything shorter.
    """
    n = len(place)
    before = smaller_before(group, place)
    after = n - 1 - smaller_before(group[::-1], place[::-1])[::-1]
    after[after == n] = -1
    return np.where((before >= 0) | (after >= 0), length, 0), before, after


def repeated(group: np.ndarray, place: np.ndarray, length: int, keep: str) -> np.ndarray:
    """Which suffixes go: those with an earlier match, and for ``none`` the matched ones too.

    The earliest of equal strings is the previous or next smaller place of a neighbour.
    """
    lpf, before, after = longest_previous(group, place, length)
    hit = lpf >= length
    if keep == "none":
        for near in (before, after):
            hit[near[near >= 0]] = True
    return hit


def _runs(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending starts as ranges of covered bytes."""
    cut = np.flatnonzero(np.diff(starts) > length) + 1
    return starts[np.append(0, cut)], starts[np.append(cut - 1, len(starts) - 1)] + length


def _sorted_block(rows: list[dict], length: int, keep: str) -> list[tuple]:
    """Spans of one block of open stretches. Rows are in the order of their places."""
    data = np.frombuffer(b"".join(r["bytes"] for r in rows), np.uint8)
    sizes = np.array([len(r["bytes"]) for r in rows])
    base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    counts = sizes - length + 1
    starts = np.arange(counts.sum()) + np.repeat(base - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    order, group = suffix_groups(data, starts, length)
    hit = np.sort(order[repeated(group, order, length, keep)])
    of = np.searchsorted(base, hit, "right") - 1
    out = []
    for k in np.unique(of):
        r = rows[k]
        for a, b in zip(*_runs(hit[of == k] - base[k] + r["first"], length), strict=True):
            out.append((r["doc_id"], r["mark"], int(a), int(b)))
    return out


def _resolve(length: int, keep: str):
    """Suffix arrays over rows that are sorted by ``key`` and place."""

    def run(batches):
        held, size = [], 0

        def flush():
            found = _sorted_block(held, length, keep) if len(held) > 1 else []
            names = ("doc_id", "mark", "start", "stop")
            return pa.RecordBatch.from_pylist(
                [dict(zip(names, row, strict=True)) for row in found],
                pa.schema([("doc_id", kind), *((name, pa.int64()) for name in names[1:])]),
            )

        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for row in batch.to_pylist():
                if held and all(row[c] == held[-1][c] for c in ("key", "doc_id", "mark", "first")):
                    continue  # a repeated row is the same place
                if size > BLOCK_BYTES and row["key"] != held[-1]["key"]:
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size += len(row["bytes"])
        if held:
            yield flush()

    return run


def _open_bytes(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes, or for crowded hashes the string hashes, of the open stretches.

    ``wanted`` has ``doc_id``, ``mark`` and the list ``open`` of their stretches.
    """

    def cut(batches):
        for batch, texts in slices(batches):
            out = {k: [] for k in ("row", "key", "first", "bytes", "strings")}
            for i, pieces in enumerate(batch.column("open").to_pylist()):
                begin = texts.offsets[i]
                for piece in pieces:
                    part = texts.data[begin + piece["first"] : begin + piece["last"] + length]
                    out["row"].append(i)
                    out["key"].append(piece["key"])
                    out["first"].append(piece["first"])
                    if piece["crowded"]:
                        p = prefix_hashes(part)
                        m = len(part) - length + 1
                        out["strings"].append(mix64((p[length:] - p[:m]) * powers(m)[1]).view(np.int64).tolist())
                        out["bytes"].append(None)
                    else:
                        out["bytes"].append(part.tobytes())
                        out["strings"].append(None)
            of = pa.array(out["row"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(of),
                    batch.column("mark").take(of),
                    pa.array(out["key"], pa.int64()),
                    pa.array(out["first"], pa.int64()),
                    pa.array(out["bytes"], pa.binary()),
                    pa.array(out["strings"], pa.list_(pa.int64())),
                ],
                ["doc_id", "mark", "key", "first", "bytes", "strings"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return _beside(docs, wanted, "inner").mapInArrow(
        cut, f"doc_id {kind}, mark bigint, key bigint, first bigint, bytes binary, strings array<bigint>"
    )


def _beside(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Texts joined with a stored table that has one list per doc_id and text."""
    name = next(c for c in lists.columns if c not in ("doc_id", "mark"))
    lists = lists.toDF("_doc", "_mark", name).hint("merge")
    joined = docs.join(lists, docs["doc_id"].eqNullSafe(lists["_doc"]) & (docs["mark"] == lists["_mark"]), how)
    return joined.drop("_doc", "_mark")


def marked(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text), ``text`` without NULLs, and the columns ``carry``."""
    body = F.coalesce(text, F.lit(""))
    mark = F.xxhash64(body, F.octet_length(body))
    return docs.select(F.col(doc_id).alias("doc_id"), mark.alias("mark"), body.alias("text"), *carry)


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, keep: str = "none", text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``doc_id``, ``mark``, ``spans``: byte ranges to remove, unsorted and overlapping, per text that has any."""
    if keep not in ("none", "first"):
        raise ValueError(keep)
    texts = marked(docs, text, doc_id)
    gram = max(1, length // 5)
    found = stored(_find_stretches(texts, length, gram), "stretches")
    keys = found.groupBy("key").agg(F.count("*").alias("n"))
    keys = stored(keys.where("n > 1").select("key"), "keys")
    again = stored(found.join(keys, "key"), "repeated")
    wholes = stored(again.groupBy("key", "whole").agg(F.count("*").alias("n")), "wholes")
    kinds = wholes.groupBy("key").agg(F.count("*").alias("kinds"), F.count(F.when(F.col("n") == 1, 1)).alias("single"))
    kinds = stored(kinds.where("kinds > 1"), "kinds")

    place = F.struct("doc_id", "mark", "first", "last")
    full = again.join(wholes.where("n > 1").drop("n"), ["key", "whole"])
    if keep == "first":
        earliest = stored(full.groupBy("key", "whole").agg(F.min(place).alias("earliest")), "earliest")
        full = full.join(earliest, ["key", "whole"]).where(~place.eqNullSafe(F.col("earliest")))
    full = full.select("doc_id", "mark", F.col("first").alias("start"), (F.col("last") + length).alias("stop"))

    # One place of every kind of stretch whose hash has other kinds. With all places to go, kinds
    # that occur twice need no comparison unless a single one stands beside them.
    compared = kinds.where("single > 0") if keep == "none" else kinds
    compared = compared.select("key", (F.col("kinds") > GROUP_STRETCHES).alias("crowded"))
    one = again.join(compared, "key").groupBy("key", "whole", "crowded").agg(F.min(place).alias("p"))
    one = one.select("p.*", "key", "crowded")
    listed = one.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("key", "first", "last", "crowded")).alias("open"))
    opened = _open_bytes(texts, stored(listed, "open"), length)
    opened = stored(opened, "open-bytes")
    blocks = opened.where("bytes is not null").drop("strings").repartition("key")
    blocks = blocks.sortWithinPartitions("key", "doc_id", "mark", "first")
    kind = dict(texts.dtypes)["doc_id"]
    sorted_ = blocks.mapInArrow(_resolve(length, keep), f"doc_id {kind}, mark bigint, start bigint, stop bigint")

    strings = opened.where("strings is not null")
    strings = strings.select("doc_id", "mark", "first", "key", F.posexplode("strings").alias("at", "string"))
    strings = strings.select("doc_id", "mark", (F.col("first") + F.col("at")).alias("start"), "key", "string")
    where = F.struct("doc_id", "mark", "start")
    same = strings.groupBy("key", "string").agg(F.count("*").alias("n"), F.min(where).alias("earliest"))
    same = stored(same.where("n > 1").drop("n"), "strings")
    hits = strings.join(same, ["key", "string"])
    if keep == "first":
        hits = hits.where(~where.eqNullSafe(F.col("earliest")))
    hits = hits.select("doc_id", "mark", "start", (F.col("start") + length).alias("stop"))

    spans = full.unionByName(sorted_).unionByName(hits)
    spans = spans.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return stored(spans, "spans")


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes, ascending."""
    out: list[list[int]] = []
    for s in sorted((s["start"], s["stop"]) for s in spans):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append([s[0], s[1]])
    return [(a, b) for a, b in out]


def _whole_characters(data: bytes, a: int, b: int) -> tuple[int, int]:
    """A range without the characters that it holds only in part."""
    while a < b and data[a] & 0xC0 == 0x80:
        a += 1
    while a < b < len(data) and data[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


def without_spans(docs: DataFrame, spans: DataFrame, whole_characters: bool = False) -> DataFrame:
    """``docs`` (``doc_id``, ``mark``, ``text`` and others) with ``kept`` bytes, ``n_bytes``, ``n_removed``, ``n_spans``.

    ``whole_characters`` leaves a character that a range only touches, so that the rest is a text again.
    """
    joined = _beside(docs, spans, "left")
    columns = [c for c in docs.columns if c != "text"]

    def cut(batches):
        for batch, texts in slices(batches):
            kept, removed, runs = [], [], []
            for i, found in enumerate(batch.column("spans").to_pylist()):
                data = texts.bytes_of(i)
                ranges = _merged(found) if found else []
                if whole_characters:
                    ranges = [r for r in (_whole_characters(data, a, b) for a, b in ranges) if r[0] < r[1]]
                at, parts = 0, []
                for a, b in ranges:
                    parts.append(data[at:a])
                    at = b
                parts.append(data[at:])
                kept.append(b"".join(parts))
                removed.append(len(data) - len(kept[-1]))
                runs.append(len(ranges))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in columns],
                    pa.array(kept, pa.binary()),
                    pa.array(texts.sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(runs, pa.int64()),
                ],
                [*columns, "kept", "n_bytes", "n_removed", "n_spans"],
            )

    schema = docs.select(*columns).schema.add("kept", "binary").add("n_bytes", "long")
    return joined.mapInArrow(cut, schema.add("n_removed", "long").add("n_spans", "long"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "none") -> DataFrame:
    """``doc_id``, ``kept`` (remaining bytes), ``n_bytes``, ``n_removed``, ``n_spans`` per row of ``docs``."""
    return without_spans(marked(docs), repeated_spans(docs, length, keep)).drop("mark")
