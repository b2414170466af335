"""MinHash near-duplicates with odd sketches.

A document is the set of its distinct word shingles. Documents of equal sets are one class, of which the smallest id goes on.
MinHash values make bands, which give candidates. One-permutation MinHash samples, the least hash of each of many bins, are folded into an
odd sketch: a bitmap in which each sample flips one bit. The population count of the XOR of two sketches estimates how many samples
differ, precisely so at high similarity, and a candidate pair goes on if that estimate is near the limit or over it. For texts of up to some 3000 shingles it is a bound that
never errs: a pair that it stops is not linked. Full sets then confirm each link.

No bucket is expanded into all its pairs. First each document is held against one leader, the one it shares most bands
with; the links found make components. Then, within each bucket, only documents of different components are compared, and
a bucket inside one component is done. So every pair that shares a band is either compared or connected already.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frugal, read, small_side, staged, text_batches
from .components import components

#: Bands and rows: two sets of similarity 0.8 share no band with probability 1e-7.
BANDS, ROWS = 40, 5
#: Bits of an odd sketch. Bins of samples are so many that a short text's samples are nearly its whole set, and a sketch then bounds the difference of two
#: sets with certainty; long texts have fewer samples, so that sketches do not fill up, and an estimate that may miss by MARGIN standard errors.
#: Texts of SHORT to LONG_FROM shingles have both, as sets of similarity 0.8 lie within a factor of 0.8 in size.
SKETCH_BITS, FINE_BIN_BITS, COARSE_BIN_BITS, MARGIN = 4096, 16, 12, 5.0
LONG_FROM, SHORT_BELOW, LEAST_PERCENT = 2048, 3072, 70
BINS = 1 << COARSE_BIN_BITS
#: Links: 100 * intersection >= PERCENT * union.
PERCENT, SHINGLE_WORDS = 80, 5
CACHE_WORDS = 100_000
MOST_BROADCAST = 2_000_000
_MIX, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(31))


def _multipliers(n: int) -> np.ndarray:
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * _STEP) | np.uint64(1)


class Shingler:
    """64-bit hashes of the distinct word shingles of whole texts: A-Z lower-cased, words parted by ASCII white space."""

    def __init__(self, words: int):
        self.size, self.known = words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode().lower().split() if text else []  # on bytes both touch ASCII only
        if not words:
            return np.empty(0, dtype=np.uint64)
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.size, len(h))
        out = np.full(len(h) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            out = _mixed(out * _STEP + h[i : len(h) - n + 1 + i])
        return np.unique(out)


def min_hashes(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    out = np.full(len(multipliers), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 1024):
        np.minimum(out, (shingles[i : i + 1024, None] * multipliers).min(axis=0), out=out)
    return out


def band_keys(mins: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    key = np.arange(bands, dtype=np.uint64)
    for i in range(rows):
        key = _mixed(key * _STEP + mins[i::rows][:bands])
    return key.view(np.int64)


def bin_samples(shingles: np.ndarray, bin_bits: int = COARSE_BIN_BITS) -> np.ndarray:
    """The least hash of each of 2^bin_bits bins; shingles are sorted, and their leading bits name the bin."""
    bins = shingles >> np.uint64(64 - bin_bits)
    return shingles[np.append(True, bins[1:] != bins[:-1])] if len(shingles) else shingles


def odd_sketch(samples: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity bitmap: each sample flips the bit that it hashes to."""
    at = _mixed(samples * _STEP) % np.uint64(bits)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=bits).astype(np.uint8) & 1).view(np.int64)


SKETCH = "struct<n:long,samples:long,bits:array<long>>"
SKETCHES = f"struct<fine:{SKETCH},coarse:{SKETCH}>"
_SKETCH = pa.struct([("n", pa.int64()), ("samples", pa.int64()), ("bits", pa.list_(pa.int64()))])
_SKETCHES = pa.struct([("fine", _SKETCH), ("coarse", _SKETCH)])


def sketches_of(shingles: np.ndarray) -> dict:
    def one(bin_bits: int) -> dict:
        samples = bin_samples(shingles, bin_bits)
        return {"n": len(shingles), "samples": len(samples), "bits": odd_sketch(samples)}

    return {"fine": one(FINE_BIN_BITS) if len(shingles) < SHORT_BELOW else None, "coarse": one(COARSE_BIN_BITS) if len(shingles) >= LONG_FROM else None}


def _odd_bits(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a["bits"], b["bits"], lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _sizes_fit(a: Column, b: Column, limit: float) -> Column:
    return F.least(a["n"], b["n"]) >= F.floor(F.greatest(a["n"], b["n"]) * limit)


def may_be_linked(a: Column, b: Column, limit: float) -> Column:
    """False only if two fine sketches prove two sets unlinked. The odd bits are at most the samples that differ, and those at most the shingles that differ
    and one for each shingle of either set that its bin's sample hides. Linked sets differ in (n + n') (1 - limit) / (1 + limit) shingles at most."""
    hidden = a["n"] - a["samples"] + b["n"] - b["samples"]
    return _sizes_fit(a, b, limit) & (_odd_bits(a, b) - hidden <= (a["n"] + b["n"]) * F.lit((1 - limit) / (1 + limit) + 1e-12))


def likely_linked(a: Column, b: Column, limit: float, margin: float = MARGIN) -> Column:
    """True if two coarse sketches do not rule out that the sets' similarity is limit.

    The samples that differ follow from the odd bits, the common ones from those and the two numbers of samples. At similarity limit
    the union has (n + n') / (1 + limit) shingles, which fill an expected number of bins, of which the share limit has a common sample."""
    left = 1 - 2 * _odd_bits(a, b) / F.lit(float(SKETCH_BITS))
    differ = -SKETCH_BITS / 2 * F.log(left)
    common = (a["samples"] + b["samples"] - differ) / 2
    union = (a["n"] + b["n"]) / F.lit(1.0 + limit)
    expected = lambda n: BINS * (1 - F.exp(-n / F.lit(float(BINS))))
    filled = expected(union) * (a["samples"] + b["samples"]) / (expected(a["n"]) + expected(b["n"]))
    # Errors: of drawing a sample from each bin that several shingles share, and of bits that several samples share.
    drawn = 0.4 * filled * F.greatest(1 - expected(union) / union, F.lit(0.0))
    folded = differ * differ / F.lit(2.0 * SKETCH_BITS)
    return _sizes_fit(a, b, limit) & (left > 0) & (common >= limit * filled - margin * F.sqrt(drawn + folded) - 1)


def not_ruled_out(x: Column, y: Column, limit: float) -> Column:
    """Sets within a factor of 0.7 in size have a kind of sketch in common; where both have both, both must agree."""
    fine, coarse = may_be_linked(x["fine"], y["fine"], limit), likely_linked(x["coarse"], y["coarse"], limit)
    return (fine.isNotNull() | coarse.isNotNull()) & F.coalesce(fine, F.lit(True)) & F.coalesce(coarse, F.lit(True))


def signatures(docs: DataFrame, shingle_words: int) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_shingles, class (null for empty sets and null ids), bands, sketch."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, multipliers = Shingler(shingle_words), _multipliers(BANDS * ROWS)
        for b in batches:
            ids, sizes, classes, bands, sketches = b.column("doc_id").to_pylist(), [], [], [], []
            for doc, text in zip(ids, b.column("text").to_pylist(), strict=True):
                s = shingler(text)
                sizes.append(len(s))
                if doc is None or not len(s):
                    classes.append(None)
                    bands.append(None)
                    sketches.append(None)
                    continue
                mins = min_hashes(s, multipliers)
                classes.append(xxhash.xxh3_128_digest(s.tobytes()))
                bands.append(band_keys(mins))
                sketches.append(sketches_of(s))
            cols = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, _SKETCHES)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_shingles", "class", "bands", "sketch"])

    return docs.mapInArrow(frugal(run), f"doc_id long, n_shingles long, class binary, bands array<long>, sketch {SKETCHES}")


def shingle_sets(docs: DataFrame, shingle_words: int) -> DataFrame:
    """docs(doc_id, text) -> doc_id, shingles: the sorted hashes, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(shingle_words)
        for b in batches:
            sets = [shingler(t).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "shingles"])

    return docs.mapInArrow(frugal(run), "doc_id long, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs(a, b) those whose full sets are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True):
                both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
                both.sort(kind="stable")  # two sorted runs: a merge
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
    both = x.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_shingles, component_id, kept; a row per row of docs.

    A text of fewer words than a shingle is one shingle; null text, and text without words, is linked with nothing and kept. A row
    without an id is linked with nothing, has no component and is kept. Rows that repeat an id are one node, linked by what any of its texts is
    linked by, and are kept or not together. Other columns are left out. Sets are compared by 64-bit hashes of their shingles.
    percent: LEAST_PERCENT at least, as the bands are made for high similarities.
    """
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent: {LEAST_PERCENT} to 100")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = staged(signatures(docs, shingle_words), "near-signatures")
    classes = staged(signed.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("rep")), "near-classes")
    first = signed.join(classes.select(F.col("class"), F.col("rep").alias("doc_id")), ["class", "doc_id"]).dropDuplicates(["doc_id", "class"])
    first = staged(first.select("doc_id", "bands", "sketch"), "near-representatives")

    # A band's key holds its number, so keys of different bands do not meet.
    members = first.select(F.posexplode("bands").alias("band", "key"), "doc_id")
    shared = members.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("leader")).where("n > 1").drop("n")
    members = staged(members.join(shared, "key"), "near-buckets")
    votes = members.where("doc_id != leader").groupBy("doc_id", "leader").agg(F.count("*").alias("bands"))
    led = votes.groupBy("doc_id").agg(F.max_by("leader", F.struct("bands", -F.col("leader"))).alias("b")).select(F.col("doc_id").alias("a"), "b")

    busy = small_side(members.select("doc_id").distinct(), MOST_BROADCAST)
    sets = staged(shingle_sets(docs.join(busy, "doc_id", "left_semi"), shingle_words).distinct(), "near-sets")
    sketches = first.select("doc_id", "sketch")
    likely = lambda x, y: not_ruled_out(x, y, percent / 100)
    pairs = led.join(sketches.select(F.col("doc_id").alias("a"), F.col("sketch").alias("x")), "a").join(sketches.select(F.col("doc_id").alias("b"), F.col("sketch").alias("y")), "b")
    links = staged(confirmed(pairs.where(likely(F.col("x"), F.col("y"))).select("a", "b"), sets, percent), "near-links")
    label = components(links)

    in_part = members.select("key", "band", "doc_id").join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    parts = in_part.groupBy("key", "component").agg(F.count("*").alias("n"))
    open_ = parts.groupBy("key").agg(F.count("*").alias("parts"), F.max_by("component", "n").alias("largest")).where("parts > 1").drop("parts")
    rows = in_part.join(open_, "key").join(first, "doc_id").withColumn("before", F.slice("bands", F.lit(1), F.col("band"))).drop("bands", "band")
    rows = staged(rows, "near-open-buckets")
    probe = rows.where("component != largest").select("key", F.col("doc_id").alias("a"), F.col("component").alias("ca"), F.col("before").alias("xs"), F.col("sketch").alias("x"))
    home = rows.select("key", F.col("doc_id").alias("b"), F.col("component").alias("cb"), F.col("before").alias("ys"), F.col("sketch").alias("y"), (F.col("component") == F.col("largest")).alias("of_largest"))
    # A pair meets in all bands that it shares, and is compared in the first alone.
    across = (F.col("ca") != F.col("cb")) & (F.col("of_largest") | (F.col("a") < F.col("b"))) & ~F.arrays_overlap("xs", "ys") & likely(F.col("x"), F.col("y"))
    crossed = probe.alias("p").join(home.alias("h"), (F.col("p.key") == F.col("h.key")) & across).select("a", "b").distinct()
    more = staged(confirmed(crossed, sets, percent), "near-more-links")
    name = label.select(F.col("node").alias("id"), "component")
    ends = more.join(name.toDF("a", "ca"), "a", "left").join(name.toDF("b", "cb"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    joined = components(ends)
    final = label.join(joined.toDF("component", "root"), "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    final = final.unionByName(joined.join(label.select("node"), "node", "left_anti"))

    out = signed.select("doc_id", "n_shingles", "class").join(classes, "class", "left").join(final.toDF("rep", "component"), "rep", "left")
    out = out.withColumn("component_id", F.coalesce("component", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """docs without those that near_duplicates does not keep, with all their columns; of rows that repeat an id one stays. Rows without an id stay."""
    verdicts = near_duplicates(docs, shingle_words, percent)
    gone = small_side(verdicts.where(~F.col("kept")).select("doc_id").distinct(), MOST_BROADCAST)
    rest = docs.join(gone, "doc_id", "left_anti")
    twice = rest.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if twice.isEmpty():
        return rest
    return rest.join(twice, "doc_id", "left_anti").unionByName(rest.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id"]))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word shingles, links from 80 percent on."""
    return near_duplicates(read(spark, sf_dir, "documents"), shingle_words=2, percent=80)


#: From the table d(doc_id, text) to the table c(doc_id, n_shingles, component_id); {k} is the shingle's number of words.
COMPONENTS_SQL = r"""
dw as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from d),
ds as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < {k} then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(w[i:i + {k} - 1], ' ')) end) s from dw),
dx as (select doc_id, len(s) n, unnest(s) g from ds),
di as (select a.doc_id x, b.doc_id y, a.n nx, b.n ny, count(*) c from dx a join dx b on a.g = b.g and a.doc_id < b.doc_id group by all),
de as (select x, y from di where 100 * c >= 80 * (nx + ny - c)),
dr as (
  with recursive r(doc_id, node) as (
    select doc_id, doc_id from d union
    select r.doc_id, e.y from r join (select x, y from de union all select y, x from de) e on r.node = e.x)
  select doc_id, min(node) component_id from r group by doc_id),
c as (select doc_id, len(s)::bigint n_shingles, component_id from ds join dr using (doc_id))"""
ORACLE_SQL = "with recursive d as (select doc_id, text from documents), " + COMPONENTS_SQL.replace("{k}", "2") + " select doc_id, n_shingles, component_id, doc_id = component_id kept from c"
assert math.isclose((1 - 0.8**ROWS) ** BANDS, 1.2e-7, rel_tol=0.1) and 100 * LONG_FROM <= LEAST_PERCENT * SHORT_BELOW
