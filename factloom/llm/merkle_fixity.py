"""Merkle fixity audit of WARC records.

Records are hashed; ordered ranges of them are hashed into nodes of a fixed fan-out, with the byte offsets they span, up to one
root per shard. Two replicas are compared from the roots on, and only under nodes that differ are children compared, so a sound shard
costs one row and a single rotten record one path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, staged

FAN_OUT = 16
NODE = ("shard", "node", "start", "end", "digest")
SHARD_BYTES = 64 << 20


def warc_record(page_id: Column, url: Column, payload: Column) -> Column:
    """A WARC/1.1 response record as bytes; nulls are empty."""
    none = F.lit("")
    body = F.coalesce(payload, none)
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), none), F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, none),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )
    return head.cast("binary")


def shard_count(pages: DataFrame, shard_bytes: int = SHARD_BYTES) -> int:
    total = pages.agg(F.sum(F.octet_length(F.coalesce("html", F.lit(""))).cast("long"))).head()[0]
    return max(1, -(-(total or 0) // shard_bytes))


def leaves(pages: DataFrame, shards: int) -> DataFrame:
    """pages(page_id, url, html) as records: shard, node (place in its shard), start, end, digest, page_id.

    A shard holds what its ids and urls hash to, in the order of id, url and digest; a record's place and offsets follow from the order, which one task makes for a
    shard. Null ids and urls are records of their own, told from empty ones by nothing but their digests; rows that repeat each other are all records. Other columns are left out, whatever they are called. No rows give no records.
    """
    name = F.md5(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit(""))))
    shard = F.pmod(F.conv(F.substring(name, 1, 8), 16, 10).cast("long"), F.lit(shards)).cast("int")
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), shard.alias("shard"), F.sha2(record, 256).alias("digest"), F.octet_length(record).cast("long").alias("length"))
    order = Window.partitionBy("shard").orderBy(F.asc_nulls_first("page_id"), "url", "digest")
    end = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return rows.select("shard", (F.row_number().over(order) - 1).cast("long").alias("node"), (end - F.col("length")).alias("start"), end.alias("end"), "digest", "page_id", "url")


def parents(nodes: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """One level up: each node's digest is that of its children's offsets and digests, in order."""
    kids = F.sort_array(F.collect_list(F.struct("node", "start", "end", "digest")))  # fan_out at most
    line = lambda k: F.concat_ws(":", k["start"].cast("string"), k["end"].cast("string"), k["digest"])
    up = nodes.groupBy("shard", F.expr(f"node div {fan_out}").alias("node")).agg(kids.alias("kids"))
    return up.select("shard", "node", F.array_min(F.transform("kids", lambda k: k["start"])).alias("start"), F.array_max(F.transform("kids", lambda k: k["end"])).alias("end"), F.sha2(F.array_join(F.transform("kids", line), "\n"), 256).alias("digest"))


def tree(records: DataFrame, height: int, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """Levels from leaves to roots, each written once."""
    levels = [records]
    for _ in range(height):
        levels.append(staged(parents(levels[-1].select(*NODE), fan_out), "merkle-level"))
    return levels


def height_of(counts: list[DataFrame], fan_out: int = FAN_OUT) -> int:
    """Levels above the leaves that the largest shard of any replica needs."""
    most = max(df.groupBy("shard").count().agg(F.max("count")).head()[0] or 0 for df in counts)
    height = 0
    while fan_out**height < most:
        height += 1
    return height


def _differing(a: DataFrame, b: DataFrame, within: DataFrame | None, fan_out: int) -> DataFrame:
    """Nodes of one level, under those of within, that differ between the replicas or that only one has."""
    if within is not None:
        inside = within.select(F.col("shard").alias("in_shard"), F.col("node").alias("in_node"))
        under = (F.col("shard") == F.col("in_shard")) & (F.expr(f"node div {fan_out}") == F.col("in_node"))
        a, b = a.join(inside, under, "left_semi"), b.join(inside, under, "left_semi")
    sides = F.struct("start", "end", "digest", *[c for c in a.columns if c not in NODE])
    left, right = a.select("shard", "node", sides.alias("kept")), b.select("shard", "node", sides.alias("found"))
    both = left.join(right, ["shard", "node"], "full")
    return both.where(~(F.col("kept.digest").eqNullSafe(F.col("found.digest")) & F.col("kept.start").eqNullSafe(F.col("found.start")) & F.col("kept.end").eqNullSafe(F.col("found.end"))))


def audit(primary: DataFrame, replica: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """Records of two replicas, as from leaves(), that differ: shard, position, page_id, start, end, kind, digest, found_digest.

    kind: altered (both have a record of the same id and url), missing (only primary) or extra (only replica). Position, offsets and id are the primary's where it has
    the record. A lost or added record moves those that follow it in its shard; under the branches that therefore differ, records are held against each other by id, url and content, so
    that one which was only moved is sound. Of records that repeat id and url, equal ones are paired first, the rest in order. Equal replicas, and two empty ones, give no rows.
    """
    primary, replica = staged(primary, "merkle-primary"), staged(replica, "merkle-replica")
    height = height_of([primary, replica], fan_out)
    mine, other = tree(primary, height, fan_out), tree(replica, height, fan_out)
    within = None
    for a, b in zip(reversed(mine), reversed(other), strict=True):
        within = staged(_differing(a, b, within, fan_out), "merkle-differing")
    kept = within.where("kept.digest is not null").select("shard", "node", "kept.*")
    found = within.where("found.digest is not null").select("shard", "node", "found.*")
    kept, found = _unpaired(kept, found, ["shard", "page_id", "url", "digest"]), _unpaired(found, kept, ["shard", "page_id", "url", "digest"])
    left, right = _numbered(kept, ["shard", "page_id", "url"]), _numbered(found, ["shard", "page_id", "url"])
    a, b = left.alias("a"), right.alias("b")
    same = F.col("a.name") == F.col("b.name")
    both = a.join(b, same, "full").select(F.when(F.col("a.name").isNotNull(), F.struct("a.*")).otherwise(F.struct("b.*")).alias("side"), F.col("a.digest").alias("digest"), F.col("b.digest").alias("found_digest"))
    kind = F.when(F.col("found_digest").isNull(), "missing").when(F.col("digest").isNull(), "extra").otherwise("altered")
    return both.select("side.shard", F.col("side.node").alias("position"), "side.page_id", "side.start", "side.end", kind.alias("kind"), "digest", "found_digest")


def _numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows with name: a string of the keys and the row's number among those of equal keys, by position."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("node"))
    return rows.withColumn("name", F.to_json(F.struct(*keys, number.alias("number")), {"ignoreNullFields": "false"}))


def _unpaired(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """rows without as many of each kind as others has."""
    return _numbered(rows, keys).join(_numbered(others, keys).select("name"), "name", "left_anti").drop("name")


def rotten(pages: DataFrame) -> DataFrame:
    """A replica with rot: the first character of every page whose id's md5 begins with 0 is overwritten."""
    hit = F.substring(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit(""))), 1, 1) == "0"
    return pages.withColumn("html", F.when(hit & (F.length("html") > 0), F.concat(F.lit("#"), F.expr("substring(html, 2)"))).otherwise(F.col("html")))


def op8_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of pages held against a replica of them with rot, derived from the table."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    shards = shard_count(pages)
    return audit(leaves(pages, shards), leaves(rotten(pages), shards))


ORACLE_SQL = r"""
with rep as (
  select 'a' side, page_id, coalesce(url, '') url, coalesce(html, '') html from pages union all
  select 'b', page_id, coalesce(url, ''), case when md5(coalesce(page_id::varchar, ''))[1] = '0' and length(html) > 0 then '#' || substr(html, 2) else coalesce(html, '') end from pages),
n as (select greatest(1, ceil(coalesce(sum(strlen(html)), 0) / 67108864.0))::bigint shards from rep where side = 'a'),
r as (
  select side, page_id, url, (('0x' || substr(md5(coalesce(page_id::varchar, '') || '|' || url), 1, 8))::bigint % shards)::int shard,
    'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::varchar, '') || '>' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) rec
  from rep, n),
o as (
  select side, page_id, shard, sha256(rec) digest, row_number() over w - 1 pos, (sum(strlen(rec)) over w)::bigint "end", strlen(rec) len from r
  window w as (partition by side, shard order by page_id nulls first, url, sha256(rec) rows unbounded preceding))
select a.shard, a.pos "position", a.page_id, a."end" - a.len "start", a."end", 'altered' kind, a.digest, b.digest found_digest
from o a join o b on a.side = 'a' and b.side = 'b' and a.shard = b.shard and a.pos = b.pos where a.digest <> b.digest
"""
