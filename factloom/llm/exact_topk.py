"""Exact top-k inner-product search: a ball tree per shard of candidates, branch and bound per query.

Candidates go to shards of bounded size by a hash of id and vector, queries to blocks of bounded size. First each query
searches its home shard; its k-th best score there is shared with all other shards, where it prunes from the
start. In a shard, nodes are taken by their upper bound q.centre + |q| * radius, best first, and a node is dropped when the
bound is under the k-th score so far (or equal to it and all the node's ids are larger than the k-th id).
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, staged

K, SCALE = 5, 256.0
SHARD_ROWS, BLOCK_QUERIES, LEAF_ROWS = 16_384, 1024, 64
FOUND = "query_id long, vec_id long, score long"
#: Sums of products under this are exact in doubles; larger ones are summed as Python integers and cut to a long.
EXACT = float(1 << 52)
LONG = (1 << 63) - 1


class BallTree:
    """Rows split in halves along the widest direction; nodes keep centre, radius and smallest id."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.order = np.arange(len(ids))
        self.ids, self.rows = ids, rows
        self.nodes: list[tuple[int, int, int, int]] = []  # start, end, left, right
        centres, radii, least = [], [], []
        todo = [(0, len(ids), -1, False)]
        while todo:
            lo, hi, parent, right = todo.pop()
            at = self.order[lo:hi]
            part = rows[at]
            centre = part.mean(axis=0)
            gap = np.sqrt(((part - centre) ** 2).sum(axis=1))
            me = len(self.nodes)
            self.nodes.append((lo, hi, -1, -1))
            centres.append(centre)
            radii.append(gap.max())
            least.append(ids[at].min())
            if parent >= 0:
                a, b, left, r = self.nodes[parent]
                self.nodes[parent] = (a, b, left, me) if right else (a, b, me, r)
            if hi - lo > leaf_rows and gap.max() > 0:
                far = part[gap.argmax()]
                other = part[((part - far) ** 2).sum(axis=1).argmax()]
                mid = (hi - lo) // 2
                self.order[lo:hi] = at[np.argpartition(part @ (other - far), mid)]
                todo += [(lo, lo + mid, me, False), (lo + mid, hi, me, True)]
        self.centres, self.radii, self.least = np.array(centres), np.array(radii), np.array(least)
        self.rows, self.ids = rows[self.order], ids[self.order]

    def search(self, query_id: int, q: np.ndarray, k: int, floor: tuple[int, int] | None) -> list[tuple[int, int]]:
        """The k best (score, -id) of other ids; floor: a (score, -id) that k rows elsewhere reach already."""
        best: list[tuple[int, int]] = []
        norm = math.sqrt(float(q @ q))
        bounds = self.centres @ q + norm * self.radii
        bounds += np.abs(bounds) * 1e-9 + 1e-6  # rounding never hides a row
        exact = float(np.abs(q).max(initial=0)) * float(np.abs(self.rows).max(initial=0)) * max(1, len(q)) < EXACT
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            cut = best[0] if len(best) == k else None
            cut = max(cut, floor) if cut and floor else cut or floor
            if cut and (math.floor(-bound), -int(self.least[node])) < cut:
                if math.floor(-bound) < cut[0]:
                    break  # all that is left has a lower bound
                continue
            lo, hi, left, right = self.nodes[node]
            if left >= 0:
                heapq.heappush(heap, (-bounds[left], left))
                heapq.heappush(heap, (-bounds[right], right))
                continue
            ids = self.ids[lo:hi]
            if exact:
                scores = (self.rows[lo:hi] @ q).astype(np.int64)
                if cut:
                    keep = scores >= cut[0]
                    scores, ids = scores[keep], ids[keep]
                scores = scores.tolist()
            else:
                whole = [int(x) for x in q]
                scores = [max(-LONG, min(LONG, sum(a * int(b) for a, b in zip(whole, row, strict=True)))) for row in self.rows[lo:hi]]
            for score, i in zip(scores, ids.tolist(), strict=True):
                if i != query_id:
                    item = (score, -i)
                    if floor and item < floor:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
        return best


def _searcher(k: int):
    def search(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(candidates) and len(queries):
            tree = BallTree(candidates["vec_id"].to_numpy(np.int64), np.array(candidates["v"].tolist(), dtype=np.float64).reshape(len(candidates), -1))
            for q in queries.itertuples(index=False):
                floor = None if pd.isna(q.kth_score) else (int(q.kth_score), -int(q.kth_id))
                out += [(q.query_id, -i, s) for s, i in tree.search(q.query_id, np.array(q.qv, dtype=np.float64), k, floor)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return search


def _in_shards(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """queries(query_id, qv, kth_score, kth_id, dim, shard, block) against the candidates(vec_id, v, dim, shard) of their dim and shard."""
    blocks = queries.select(F.col("dim").alias("to_dim"), F.col("shard").alias("to_shard"), F.col("block").alias("to_block")).distinct()
    left = candidates.join(blocks, (F.col("dim") == F.col("to_dim")) & (F.col("shard") == F.col("to_shard"))).select("vec_id", "v", "to_dim", "to_shard", "to_block")
    keys = ["dim", "shard", "block"]
    search = _searcher(k)
    return left.groupBy("to_dim", "to_shard", "to_block").cogroup(queries.groupBy(*keys)).applyInPandas(search, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def exact_topk(vectors: DataFrame, query_ids: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """The k highest inner products of each query's vector with all other vectors: query_id, rank, vec_id, score.

    vectors(vec_id, v array of whole numbers as double); query_ids(query_id) names the rows that are queries. Every row but those of the query's own id is a
    candidate, also where rows repeat an id; a query id of several rows has the k highest of all their products. Of rows that are equal in
    all, k are enough to fill a list, and no more go on. Null ids and null vectors take no part. Vectors of unlike
    length are not compared. Ties go to the smaller vec_id; a query with fewer than k others gets all. No rows in, none out.
    """
    alike = vectors.where("vec_id is not null and v is not null").groupBy("vec_id", "v").agg(F.least(F.count("*"), F.lit(k)).alias("copies"))
    rows = staged(alike.select("vec_id", "v", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy"), "topk-vectors")
    dims = rows.groupBy(F.size("v").alias("dim")).agg(F.ceil(F.count("*") / F.lit(shard_rows)).cast("int").alias("shards"))
    dims = F.broadcast(dims) if dims.count() < 10_000 else dims
    shard = F.pmod(F.xxhash64("vec_id", "v"), F.col("shards")).cast("int")
    rows = rows.withColumn("dim", F.size("v")).join(dims, "dim").withColumn("shard", shard)
    queries = rows.join(query_ids.distinct(), F.col("vec_id") == F.col("query_id")).select("query_id", F.col("v").alias("qv"), "dim", "shards", F.col("shard").alias("home"))
    n = queries.count()
    queries = queries.withColumn("block", F.pmod(F.xxhash64("query_id", "qv", F.lit(1)), F.lit(max(1, math.ceil(n / block_queries)))).cast("int"))
    none = F.lit(None).cast("long")
    first = queries.withColumns({"shard": F.col("home"), "kth_score": none, "kth_id": none})
    seen = staged(_in_shards(rows, first, k), "topk-home")
    kth = _best(seen, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("kth_score"), F.col("vec_id").alias("kth_id"))
    rest = queries.join(kth, "query_id", "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).where("shard != home")
    found = seen.unionByName(_in_shards(rows, rest, k))
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def whole_numbers(embedding: str = "embedding", scale: float = SCALE):
    """floor(scale * x) of each component as double; null for vectors that are null or hold null or non-finite components."""
    v = F.col(embedding).cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~odd, F.transform(v, lambda x: F.expr("double(0)") + _floor(x * scale)))


def _floor(x):
    """floor() of a double gives a long in Spark and overflows on large ones, which are whole already."""
    return F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x)


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whose id is divisible by 50 against all other vectors."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", whole_numbers().alias("v"))
    return exact_topk(vectors, vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id")))


ORACLE_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::bigint score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as "rank" from s)
select query_id, "rank", vec_id, score from r where "rank" <= 5
"""
__all__ = ["BallTree", "exact_topk", "op2_exact_topk", "whole_numbers"]
