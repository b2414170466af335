"""Repeated-substring removal with suffix order by external induced sorting.

Every window of `length` bytes picks the least hash among its grams as its anchor (winnowing); neighbouring windows
that pick the same one make a segment. Equal windows pick equal anchors, so an anchor's segments hold all copies of all their windows and can be dealt
to shards by anchor. Segments of anchors that occur once are done. Segments that are equal as a whole are one class: a class of two or more repeats in
all its windows, whatever the number of copies. Where an anchor has several classes, one segment of each goes to a shard,
whose suffixes are ordered with their common prefixes by induced sorting; a window repeats if the suffix before or after it shares `length` bytes.

An anchor whose classes are too large for a shard is split on Spark first, in rounds. Equal windows have the same place relative to their anchor, so a
round halves the range of places and deals a segment's windows of a half by the bytes that all windows of that half cover. With each round
these bytes are more; where only one place is left they are the whole window, and a group is then a single class.
"""

from __future__ import annotations

import hashlib
import math
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, staged, text_batches
from .induced_sort import END, FIRST, GAP, suffix_order

LENGTH, GRAM = 400, 128
#: Bytes at which a shard is closed, and the most that a group of segments may have (a shard holds twice that at most); a text over the other bound is kept in a file.
SHARD_BYTES, IN_MEMORY_BYTES = 4 << 20, 64 << 20
BLOCK = 1 << 20
#: Bits of a gram's place in its block.
_PLACE = np.uint64((1 << 22) - 1)
MOST_BROADCAST = 4_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _gram_hashes(data: np.ndarray, gram: int, tables: dict) -> np.ndarray:
    """64-bit hash of each run of gram bytes: a polynomial by prefix sums, then mixed."""
    n = len(data)
    if len(tables["power"]) < n:
        tables["power"], tables["inverse"] = np.cumprod(np.full(n, _BASE)), np.cumprod(np.full(n, _INVERSE))
    sums = np.append(np.uint64(0), np.cumsum(tables["byte"][data] * tables["power"][:n]))
    h = (sums[gram:] - sums[:-gram]) * tables["inverse"][: n - gram + 1]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def new_tables() -> dict:
    byte = np.array([xxhash.xxh3_64_intdigest(bytes([i])) for i in range(256)], dtype=np.uint64) | np.uint64(1)
    return {"byte": byte, "power": np.empty(0, dtype=np.uint64), "inverse": np.empty(0, dtype=np.uint64)}


def segments(text: bytes, length: int, gram: int, tables: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, its place, first window, number of windows) of a whole text, in order. Long texts are taken in overlapping blocks."""
    anchors, places, firsts = [], [], []
    windows = len(text) - length + 1
    width = length - gram + 1
    for at in range(0, windows, BLOCK):
        end = min(windows, at + BLOCK)
        hashes = _gram_hashes(np.frombuffer(text, np.uint8, end - at + length - 1, at), gram, tables)
        low = hashes & ~_PLACE | np.arange(len(hashes), dtype=np.uint64)  # ties go to the leftmost, in equal windows alike
        step = 1
        while 2 * step <= width:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        if step < width:
            low = np.minimum(low[: len(low) - (width - step)], low[width - step :])
        start = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
        place = (low[start] & _PLACE).astype(np.int64)
        anchors.append(hashes[place])
        places.append(place + at)
        firsts.append(start + at)
    if not anchors:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    anchor, place, first = np.concatenate(anchors), np.concatenate(places), np.concatenate(firsts)
    whole = np.append(True, place[1:] != place[:-1])  # a segment across two blocks is one
    anchor, place, first = anchor[whole], place[whole], first[whole]
    return anchor.view(np.int64), place, first, np.diff(np.append(first, windows))


SEGMENTS = "doc_id long, text_key long, anchor long, print long, place int, first int, windows int"


def find_segments(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = new_tables()
        for b in batches:
            ids, keys, cols = b.column("doc_id").to_pylist(), b.column("text_key").to_pylist(), [[], [], [], [], [], [], []]
            for doc, key, text in zip(ids, keys, b.column("text").to_pylist(), strict=True):
                data = text.encode()
                anchor, place, first, windows = segments(data, length, gram, tables)
                ends = (first + windows + length - 1).tolist()
                prints = [xxhash.xxh3_64_intdigest(data[a:e]) for a, e in zip(first.tolist(), ends, strict=True)]
                for c, x in zip(cols, ([doc] * len(first), [key] * len(first), anchor, np.array(prints, dtype=np.uint64).view(np.int64), place, first, windows), strict=True):
                    c.append(x)
            flat = [[x for part in cols[0] for x in part], [x for part in cols[1] for x in part], *(np.concatenate(c) if c else [] for c in cols[2:])]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(flat, types, strict=True)], ["doc_id", "text_key", "anchor", "print", "place", "first", "windows"])

    return docs.mapInArrow(run, SEGMENTS)


def _halved(length: int, gram: int, level: int):
    """Each cut's windows by the range of their place relative to the anchor, halved level times; the group is named by the bytes that all windows of a range cover."""
    most = length - gram
    shift = most.bit_length() - level

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, key, text, cuts in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text_key", "text", "cuts")), strict=True):
                data = text.encode()
                for c in cuts:
                    place, first, last = c["place"], c["first"], c["first"] + c["windows"] - 1
                    for part in range(place - last >> shift, (place - first >> shift) + 1):
                        near, far = part << shift, min((part + 1 << shift) - 1, most)
                        a, z = max(first, place - far), min(last, place - near)
                        group = xxhash.xxh3_64_intdigest(b"%d %d %d " % (c["anchor"], level, part) + data[place - near : place - far + length])
                        rows.append((doc, key, _signed(group), _signed(xxhash.xxh3_64_intdigest(data[a : z + length])), place, a, z - a + 1, c["copies"]))
            cols = list(zip(*rows, strict=True)) or [()] * 8
            types = [pa.int64()] * 4 + [pa.int32()] * 3 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "text_key", "anchor", "print", "place", "first", "windows", "copies"])

    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for doc, key, text, cuts in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text_key", "text", "cuts")), strict=True):
            data = text.encode()
            rows += [(doc, key, c["anchor"], c["first"], c["windows"], c["copies"] > 1, data[c["first"] : c["end"]]) for c in cuts]
        cols = list(zip(*rows, strict=True)) or [()] * 7
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "text_key", "anchor", "first", "windows", "many", "bytes"])


def _array(n: int, kind: type, bound: int) -> np.ndarray:
    return np.zeros(n, dtype=kind) if n * np.dtype(kind).itemsize <= bound else np.memmap(tempfile.TemporaryFile(), dtype=kind, mode="w+", shape=(n,))


def repeated_windows(parts: list[bytes], length: int, in_memory: int = IN_MEMORY_BYTES) -> list[tuple[int, int, int]]:
    """(part, first window, last window) of the runs of a shard's windows that occur twice or more in it; no part is shorter than length."""
    sizes = np.array([len(p) for p in parts])
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = _array(int((sizes + 1).sum()) + 1, np.uint16, in_memory)
    for p, s in zip(parts, starts.tolist(), strict=True):
        text[s : s + len(p)] = np.frombuffer(p, np.uint8)
        text[s : s + len(p)] += FIRST
        text[s + len(p)] = GAP
    text[-1] = END
    order, prefix = suffix_order(text, length, in_memory)
    hit = prefix >= length
    again = np.zeros(len(text) + 1, dtype=bool)
    again[order[hit]] = True
    again[order[np.flatnonzero(hit) - 1]] = True
    bounds = np.zeros(len(again), dtype=np.int8)
    bounds[starts] += 1
    bounds[starts + sizes - length + 1] -= 1
    again &= np.cumsum(bounds, dtype=np.int8) > 0  # what starts in a part's last length - 1 bytes is no window
    edge = np.diff(again.astype(np.int8), prepend=0)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    of = np.searchsorted(starts, first, side="right") - 1  # windows of two parts are never neighbours: a part ends in length - 1 bytes that start none
    return [(p, a - s, b - s) for p, a, b, s in zip(of.tolist(), first.tolist(), last.tolist(), starts[of].tolist(), strict=True)]


def _sort_shards(length: int, shard_bytes: int):
    def sort(rows: list[tuple]) -> pa.RecordBatch:
        docs, keys, firsts, many, parts = zip(*rows, strict=True)
        found = [x for x in repeated_windows(list(parts), length) if not many[x[0]]]
        cols = [[docs[p] for p, _, _ in found], [keys[p] for p, _, _ in found], [firsts[p] + a for p, a, _ in found], [firsts[p] + z for p, _, z in found]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), pa.int32(), pa.int32()], strict=True)], ["doc_id", "text_key", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A partition comes sorted by anchor; a shard is closed at the first new anchor after shard_bytes."""
        rows, size, last = [], 0, None
        for b in batches:
            for anchor, *row in zip(*(b.column(c).to_pylist() for c in ("anchor", "doc_id", "text_key", "first", "many", "bytes")), strict=True):
                if size >= shard_bytes and anchor != last:
                    yield sort(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[-1])
                last = anchor
        if rows:
            yield sort(rows)

    return run


def _by_document(cuts: DataFrame, length: int) -> DataFrame:
    cut = F.struct("anchor", "place", "first", "windows", "copies", (F.col("first") + F.col("windows") + length - 1).alias("end"))
    return cuts.groupBy("doc_id", "text_key").agg(F.collect_list(cut).alias("cuts"), F.sum(F.col("windows") + length).alias("size"))


def bounded_cuts(long: DataFrame, classes: DataFrame, length: int, gram: int, most_bytes: int) -> tuple[DataFrame, list[DataFrame]]:
    """classes(anchor, copies, doc_id, text_key, place, first, windows), one row a class -> what is left to be sorted, as the same columns, in groups (anchor) of
    most_bytes at most; and the runs of windows (doc_id, text_key, first, last) that were found to repeat on the way."""
    done, found = None, []
    names = ["anchor", "copies", "doc_id", "text_key", "place", "first", "windows"]
    for level in range(1, (length - gram).bit_length() + 2):
        size = F.sum(F.col("windows") + length).alias("bytes")
        groups = classes.groupBy("anchor").agg(F.min("copies").alias("fewest"), F.count("*").alias("n"), size).where("fewest = 1 and n > 1")
        groups = staged(groups.select("anchor", "bytes"), "suffix-groups")
        hot = groups.where(F.col("bytes") > most_bytes).select("anchor")
        split = level <= (length - gram).bit_length() and not hot.isEmpty()
        small = classes.join(groups.where(F.col("bytes") <= most_bytes).select("anchor") if split else groups.select("anchor"), "anchor").select(*names)
        done = small if done is None else done.unionByName(small)
        if not split:
            break
        cuts = staged(_by_document(classes.join(hot, "anchor"), length).drop("size"), "suffix-hot")
        halves = _with(long, cuts).select("doc_id", "text_key", "text", "cuts").mapInArrow(_halved(length, gram, level), f"{SEGMENTS}, copies long")
        halves = staged(halves, "suffix-halves")
        one = F.struct("doc_id", "text_key", "place", "first", "windows")
        merged = staged(halves.groupBy("anchor", "print").agg(F.sum("copies").alias("copies"), F.min(one).alias("one")), "suffix-classes")
        again = halves.where("copies = 1").join(merged.where("copies > 1").select("anchor", "print"), ["anchor", "print"], "left_semi")
        found.append(again.select("doc_id", "text_key", "first", (F.col("first") + F.col("windows") - 1).alias("last")))
        classes = merged.select("anchor", "copies", "one.*")
    return done, found


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """docs(doc_id, text_key, text) -> doc_id, text_key, first, last: runs of windows, by the byte they start at, that also start elsewhere."""
    long = docs.where(F.octet_length("text") >= length)
    segs = staged(find_segments(long, length, gram), "suffix-segments")
    # Anchors and classes are written before they are joined: a join of two written tables splits a hot key's rows among tasks.
    by_anchor = segs.groupBy("anchor").agg(F.count("*").alias("n"), F.min("print").alias("low"), F.max("print").alias("high")).where("n > 1")
    by_anchor = staged(by_anchor.select("anchor", (F.col("low") != F.col("high")).alias("unlike")), "suffix-anchors")
    again = staged(segs.join(by_anchor, "anchor"), "suffix-repeated-anchors")
    one = F.struct("doc_id", "text_key", "place", "first", "windows")
    classes = staged(again.groupBy("anchor", "print", "unlike").agg(F.count("*").alias("copies"), F.min(one).alias("one")), "suffix-classes")
    whole = again.join(classes.where("copies > 1").select("anchor", "print"), ["anchor", "print"], "left_semi").select("doc_id", "text_key", "first", (F.col("first") + F.col("windows") - 1).alias("last"))

    unlike = staged(classes.where("unlike").select("anchor", "copies", "one.*"), "suffix-unlike")
    left, found = bounded_cuts(long, unlike, length, gram, shard_bytes)
    cuts = staged(_by_document(left, length), "suffix-cuts")
    total = cuts.agg(F.coalesce(F.sum("size"), F.lit(0))).head()[0]
    pieces = _with(long, cuts.drop("size")).select("doc_id", "text_key", "text", "cuts").mapInArrow(_cut_out, "doc_id long, text_key long, anchor long, first int, windows int, many boolean, bytes binary")
    shards = max(1, math.ceil(total / shard_bytes))
    parts = pieces.repartition(shards, "anchor").sortWithinPartitions("anchor").mapInArrow(_sort_shards(length, shard_bytes), "doc_id long, text_key long, first int, last int")
    for more in found:
        whole = whole.unionByName(more)
    return whole.unionByName(parts)


def _with(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """docs joined with the rows of their keys, of which there is one each; texts without one stay out of the shuffle where the ids are few enough to be broadcast."""
    keys = rows.select(F.col("doc_id").alias("k_id"), F.col("text_key").alias("k_text"))
    if keys.count() <= MOST_BROADCAST:
        docs = docs.join(F.broadcast(keys), F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("text_key") == F.col("k_text")), "left_semi")
    rows = rows.withColumnsRenamed({"doc_id": "r_id", "text_key": "r_text"})
    return docs.join(rows, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_key") == F.col("r_text"))).drop("r_id", "r_text")


def cover(first: list[int], last: list[int], length: int) -> list[list[int]]:
    """Bytes covered by windows that start in the ranges: maximal [start, end)."""
    out: list[list[int]] = []
    for a, z in sorted(zip(first, last, strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z + length)
        else:
            out.append([a, z + length])
    return out


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, removed array<struct<start:long,end:long>>, kept_sha256 string"
_REMOVED = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _removed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text, ranges in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "ranges")), strict=True):
                data, at, digest = text.encode(), 0, hashlib.sha256()
                spans = cover([r["first"] for r in ranges], [r["last"] for r in ranges], length)
                for a, z in spans:
                    digest.update(data[at:a])
                    at = z
                digest.update(data[at:])
                rows.append((doc, len(data), sum(z - a for a, z in spans), len(spans), [{"start": a, "end": z} for a, z in spans], digest.hexdigest()))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.int64()] * 4 + [_REMOVED, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "removed", "kept_sha256"])

    return run


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_bytes, n_removed, n_spans, removed (byte spans), kept_sha256; a row per row of docs.

    Texts are UTF-8 bytes; a null text is empty, and texts under length bytes lose nothing. Matches never cross rows. Rows that repeat an id are
    documents of their own, and repeat each other if their texts do; null ids too. Other columns are left out. Segments are told apart by 128 bits of hash.
    """
    gram = gram or min(GRAM, max(1, length // 3))
    text_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    ranges = repeated_ranges(rows, length, gram, shard_bytes)
    ranges = staged(ranges.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("first", "last")).alias("ranges")), "suffix-ranges")
    hit = _with(rows, ranges).select("doc_id", "text", "ranges").mapInArrow(_removed(length), RESULT)
    keys = ranges.select(F.col("doc_id").alias("r_id"), F.col("text_key").alias("r_text"))
    keys = F.broadcast(keys) if keys.count() <= MOST_BROADCAST else keys
    clean = rows.join(keys, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_key") == F.col("r_text")), "left_anti")
    zero = F.lit(0).cast("long")
    clean = clean.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.array().cast("array<struct<start:long,end:long>>").alias("removed"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
    return hit.unionByName(clean)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(read(spark, sf_dir, "documents")).drop("removed")


ORACLE_SQL = None
