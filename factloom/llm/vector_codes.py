"""Product quantization of vectors by Lloyd rounds over cover trees.

Vectors are cut into parts of whole numbers. Each task of the scan lays its vectors into blocks of bounded size and builds a cover tree for each
part of a block, once, into a written table. A node keeps a point of its subtree, the radius around it and its place in the block's order, in which cumulative sums
give the sum of any subtree. In a round, a node whose point is nearer to one entry than to any other by more than twice its radius
goes to that entry as a whole (triangle inequality); only the others descend, down to leaves whose points are compared exactly.
A round's sums and counts are as many as the codebook's components and are added up on Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frugal, read, small_side, staged
from .exact_topk import whole_numbers

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096.0
#: Vectors of a block, points of a leaf, and points that are compared with all entries at once.
BLOCK_ROWS, LEAF_POINTS, AT_ONCE = 4096, 8, 1024
#: Components up to this size have exact sums and squared distances in 64 bits; larger ones are Python's whole numbers.
EXACT = float(1 << 26)
#: Sums go to Spark in limbs of so many bits, whatever their size.
LIMB = 40
LONG = (1 << 63) - 1
MOST_LABELS = 100_000
NODES = ("low", "high", "radius", "first", "children")
BLOCK = "n int, ids array<long>, labels array<string>, dim int, points array<binary>, orders array<binary>, nodes array<binary>"


def cover_tree(points: np.ndarray, leaf_points: int = LEAF_POINTS) -> tuple[np.ndarray, np.ndarray]:
    """Order of the points and nodes (low, high, radius, first child, number of children), children side by side, parents first.

    points: doubles. A node's own point is the first of its range and the first of its first child's (nesting); its children's points are more than half its radius apart
    (separation) and every point of its subtree is within half its radius of the child that it went to (covering).
    """
    order = np.arange(len(points))
    nodes = [[0.0, float(len(points)), 0.0, 0.0, 0.0]]
    i = 0
    while i < len(nodes):
        low, high = int(nodes[i][0]), int(nodes[i][1])
        at = order[low:high]
        own = points[at]
        near = np.sqrt(((own - own[0]) ** 2).sum(axis=1))
        radius = float(near.max(initial=0.0))
        nodes[i][2] = radius
        if radius > 0 and high - low > leaf_points:
            child, centres = np.zeros(len(at), dtype=np.int64), [0]
            while True:
                far = int(near.argmax())
                if near[far] <= radius / 2:
                    break
                d = np.sqrt(((own - own[far]) ** 2).sum(axis=1))
                closer = d < near
                closer[far] = True
                child[closer] = len(centres)
                near = np.where(closer, d, near)
                centres.append(far)
            rank = np.ones(len(at), dtype=np.int64)
            rank[centres] = 0
            order[low:high] = at[np.lexsort((rank, child))]
            ends = low + np.bincount(child, minlength=len(centres)).cumsum()
            nodes[i][3:] = [float(len(nodes)), float(len(centres))]
            nodes += [[float(a), float(b), 0.0, 0.0, 0.0] for a, b in zip([low, *ends[:-1].tolist()], ends.tolist(), strict=True)]
        i += 1
    return order, np.array(nodes, dtype=np.float64).reshape(-1, len(NODES))


def whole(x: np.ndarray) -> np.ndarray:
    """Doubles that are whole numbers, as exact ones: 64 bits where sums and squares fit, else Python's."""
    if not x.size or np.abs(x).max() <= EXACT:
        return x.astype(np.int64)
    return np.array([int(v) for v in x.ravel().tolist()], dtype=object).reshape(x.shape)


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, point by entry."""
    return ((points[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)


class PartTree:
    """The tree of one part of a block; points in tree order."""

    def __init__(self, points: np.ndarray, nodes: np.ndarray):
        self.points = whole(points)
        self.low, self.high, _, self.first, self.children = (nodes[:, i].astype(np.int64) for i in range(len(NODES)))
        self.radius = nodes[:, 2]
        zero = np.zeros((1, points.shape[1]), dtype=self.points.dtype)
        self.sums = np.concatenate([zero, self.points.cumsum(axis=0)])
        self.compared = self.decided = 0

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest entry of each point, ties to the lower one; and sums and counts of each entry's points."""
        k, points = len(entries), self.points
        if entries.dtype == object or points.dtype == object:
            entries, points = entries.astype(object), points.astype(object)
        codes = np.zeros(len(points), dtype=np.int64)
        sums, counts = np.zeros((k, points.shape[1]), dtype=points.dtype), np.zeros(k, dtype=np.int64)
        frontier = np.arange(min(1, len(points)))
        while len(frontier):
            own = distances(points[self.low[frontier]], entries)
            best = own.argmin(axis=1)
            apart = np.sqrt(own.astype(np.float64))
            radius = self.radius[frontier]
            if k > 1:
                two = np.partition(apart, 1, axis=1)[:, :2]
                gap = two[:, 1] - two[:, 0] - 2 * radius
                sure = (gap > 1e-9 * (two[:, 1] + radius) + 1e-9) | (radius == 0)  # rounding decides nothing
            else:
                sure = np.ones(len(frontier), dtype=bool)
            low, high, to = self.low[frontier[sure]], self.high[frontier[sure]], best[sure]
            np.add.at(sums, to, self.sums[high] - self.sums[low])
            np.add.at(counts, to, high - low)
            codes[_ranges(low, high)] = np.repeat(to, high - low)
            self.decided += len(to)
            rest = frontier[~sure]
            leaves = rest[self.children[rest] == 0]
            at = _ranges(self.low[leaves], self.high[leaves])
            for i in range(0, len(at), AT_ONCE):
                part = at[i : i + AT_ONCE]
                codes[part] = to = distances(points[part], entries).argmin(axis=1)
                np.add.at(sums, to, points[part])
                np.add.at(counts, to, 1)
            self.compared += len(at)
            inner = rest[self.children[rest] > 0]
            frontier = _ranges(self.first[inner], self.first[inner] + self.children[inner])
        return codes, sums, counts


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All whole numbers of the ranges, one after the other."""
    size = high - low
    return np.repeat(low - (size.cumsum() - size), size) + np.arange(size.sum())


def _blocks(parts: int, dim: int, block_rows: int):
    """Rows of vectors into blocks with a tree for each part."""

    def block(ids: list, labels: list, rows: np.ndarray) -> dict:
        points, orders, nodes = [], [], []
        for part in np.split(rows, parts, axis=1):
            order, tree = cover_tree(part)
            points.append(part[order].tobytes())
            orders.append(order.astype("<i4").tobytes())
            nodes.append(tree.tobytes())
        return {"n": len(ids), "ids": ids, "labels": labels, "dim": dim, "points": points, "orders": orders, "nodes": nodes}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("n", pa.int32()), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.string())), ("dim", pa.int32())] + [(c, pa.list_(pa.binary())) for c in ("points", "orders", "nodes")])
        ids, labels, rows = [], [], []
        for b in batches:
            ids += b.column("vec_id").to_pylist()
            labels += b.column("label").to_pylist()
            if b.num_rows:
                rows.append(b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dim))
            while len(ids) >= block_rows:
                rows = [np.concatenate(rows)]
                yield pa.RecordBatch.from_pylist([block(ids[:block_rows], labels[:block_rows], rows[0][:block_rows])], kinds)
                ids, labels, rows = ids[block_rows:], labels[block_rows:], [rows[0][block_rows:]]
        if ids:
            yield pa.RecordBatch.from_pylist([block(ids, labels, np.concatenate(rows))], kinds)

    return run


def _trees(batch: pa.RecordBatch, row: int) -> Iterator[tuple[PartTree, np.ndarray]]:
    """The trees of a block's parts, with the order of their points."""
    for points, order, nodes in zip(*(batch.column(c)[row].as_py() for c in ("points", "orders", "nodes")), strict=True):
        order = np.frombuffer(order, "<i4")
        yield PartTree(np.frombuffer(points, np.float64).reshape(len(order), -1), np.frombuffer(nodes, np.float64).reshape(-1, len(NODES))), order


def _limbs(x: int) -> Iterator[tuple[int, int]]:
    """Signed limbs of x: sum of limb << (LIMB * place)."""
    sign, x, place = (-1 if x < 0 else 1), abs(x), 0
    while x:
        yield place, sign * (x & ((1 << LIMB) - 1))
        x >>= LIMB
        place += 1


def _sums(codebooks: list[np.ndarray]):
    """A task's blocks -> (part, entry, place in the part or -1 for the count, limb, value): as many rows as the codebooks have components, whatever the task holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((len(c), c.shape[1] + 1), dtype=object) for c in codebooks]
        for b in batches:
            for row in range(b.num_rows):
                for part, (tree, _) in enumerate(_trees(b, row)):
                    _, sums, counts = tree.assign(codebooks[part])
                    total[part] += np.concatenate([sums, counts[:, None]], axis=1).astype(object)
        rows = [(p, e, i if i < t.shape[1] - 1 else -1, limb, v) for p, t in enumerate(total) for e in range(t.shape[0]) for i in range(t.shape[1]) for limb, v in _limbs(int(t[e, i]))]
        cols = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [*[pa.int32()] * 4, pa.int64()], strict=True)], ["part", "entry", "place", "limb", "value"])

    return run


def _codes(codebooks: list[np.ndarray]):
    """Blocks -> vec_id, label, code, error of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                n = b.column("n")[row].as_py()
                codes, errors = np.zeros((n, len(codebooks)), dtype=np.uint8), np.zeros(n, dtype=object)
                for part, (tree, order) in enumerate(_trees(b, row)):
                    own, _, _ = tree.assign(codebooks[part])
                    gaps = tree.points.astype(object) - codebooks[part].astype(object)[own] if object in (tree.points.dtype, codebooks[part].dtype) else tree.points - codebooks[part][own]
                    codes[order, part] = own
                    errors[order] += (gaps**2).sum(axis=1).astype(object)
                code = pa.array([c.tobytes().hex() for c in codes], pa.string())
                error = pa.array([min(int(e), LONG) for e in errors], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(b.column("ids")[row].as_py(), pa.int64()), pa.array(b.column("labels")[row].as_py(), pa.string()), code, error], ["vec_id", "label", "code", "error"])

    return run


def compress_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vectors(vec_id, v array of whole numbers as double or null, label) -> vec_id, code, error, label_error, codebooks_sha256.

    Codebooks begin as the vectors of the smallest ids (null ids last; rows that repeat an id by their vector) and so may have equal entries, of which the lower one
    is taken; with fewer vectors than entries they are as many as the vectors. entries: at most 256. Null vectors take no part; nor do vectors whose length is not that of the first
    one, or no multiple of parts. Errors that a long cannot hold are its largest value. Null labels are one label. Each row of a repeated id is coded. No rows give none.
    """
    spark = vectors.sparkSession
    rows = vectors.where("v is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "v")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()  # as many rows as a codebook has entries
    dim = len(first[0]["v"]) if first else parts
    if dim % parts:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    if any(len(r["v"]) != dim for r in first):
        first = rows.where(F.size("v") == dim).orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    start = np.array([r["v"] for r in first], dtype=np.float64).reshape(len(first), dim)
    codebooks = [whole(x) for x in np.split(start, parts, axis=1)]
    blocks = staged(rows.where(F.size("v") == dim).mapInArrow(frugal(_blocks(parts, dim, block_rows)), BLOCK), "vector-blocks")
    for _ in range(rounds):
        sums = blocks.select("points", "orders", "nodes").mapInArrow(frugal(_sums(codebooks)), "part int, entry int, place int, limb int, value long")
        total: dict[tuple[int, int, int], int] = {}
        for r in sums.groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value")).collect():  # a few numbers a component of the codebooks
            key = (r["part"], r["entry"], r["place"])
            total[key] = total.get(key, 0) + (r["value"] << (LIMB * r["limb"]))
        codebooks = [_moved(c, p, total) for p, c in enumerate(codebooks)]
    digest = hashlib.sha256(",".join(str(int(x)) for c in codebooks for x in c.ravel().tolist()).encode()).hexdigest()
    coded = staged(blocks.mapInArrow(frugal(_codes(codebooks)), "vec_id long, label string, code string, error long"), "vector-codes")
    by_label = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    by_label = small_side(staged(by_label.withColumnsRenamed({"label": "of_label"}), "vector-labels"), MOST_LABELS)
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _moved(entries: np.ndarray, part: int, total: dict[tuple[int, int, int], int]) -> np.ndarray:
    """Each entry at the floor of its points' mean; one without points stays."""
    rows = []
    for e, row in enumerate(entries.tolist()):
        n = total.get((part, e, -1), 0)
        rows.append([total.get((part, e, i), 0) // n for i in range(len(row))] if n else [int(x) for x in row])
    exact = all(abs(x) <= EXACT for r in rows for x in r)
    return np.array(rows, dtype=np.int64 if exact else object).reshape(entries.shape)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole, finite embedding in eight parts by codebooks of 16 entries, six rounds; odd rows as in compress_vectors."""
    return compress_vectors(read(spark, sf_dir, "embeddings").select("vec_id", whole_numbers(scale=SCALE).alias("v"), "label"))


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    gap = "list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    floor = "(sum(p.x[i]) - ((sum(p.x[i]) % count(*)) + count(*)) % count(*)) // count(*)"
    ctes = [
        """v as materialized (select vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) x from embeddings
          where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"""p as materialized (select vec_id, label, part, x[part * len(x) // {parts} + 1 : (part + 1) * len(x) // {parts}] x
          from v, range({parts}) r(part))""",
        f"""first as materialized (select vec_id, row_number() over (order by vec_id) - 1 entry from v order by vec_id limit {entries})""",
        "c0 as materialized (select part, entry, x from p join first using (vec_id))",
    ]
    near = "select p.vec_id, p.label, p.part, min({'d': " + gap + ", 'e': c.entry}) b from p join %s c on c.part = p.part group by all"
    for r in range(rounds):
        ctes += [
            f"a{r} as materialized ({near % f'c{r}'})",
            f"""m{r} as materialized (select p.part, a.b.e entry, i, ({floor})::bigint m from p join a{r} a on a.vec_id = p.vec_id and a.part = p.part, range(1, len(p.x) + 1) t(i)
              group by all)""",
            f"""c{r + 1} as materialized (select c.part, c.entry, coalesce(n.x, c.x) x from c{r} c
              left join (select part, entry, list(m order by i) x from m{r} group by all) n on n.part = c.part and n.entry = c.entry)""",
        ]
    ctes += [
        f"a as materialized ({near % f'c{rounds}'})",
        """e as (select vec_id, label, string_agg(printf('%02x', b.e), '' order by part) code, sum(b.d)::bigint error from a group by vec_id, label)""",
        f"h as (select sha256(string_agg(array_to_string(x, ','), ',' order by part, entry)) s from c{rounds})",
    ]
    return f"with {', '.join(ctes)} select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error, h.s codebooks_sha256 from e, h"


ORACLE_SQL = _oracle()
__all__ = ["PartTree", "compress_vectors", "cover_tree", "op13_vector_codes"]
