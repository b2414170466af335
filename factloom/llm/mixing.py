"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

A source's mean repetition rate is its target share of the output over its share of the input. Each document's number of
copies is the Poisson quantile, at that mean, of a uniform number hashed from seed and id, so that a run can be repeated and
no state is shared. Copies are dealt to partitions and ordered by a hash, which shuffles all sources globally.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, small_side

SEED = "mix-1"
#: Where no weights are given, a source's weight is its size to this power.
TEMPERATURE = 0.5
EPOCHS = 1.0
PLAIN_RATE = 500.0
MOST_BROADCAST = 100_000
ROWS_A_PARTITION = 50_000


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the md5 of the parts: 52 bits, at the middle of its step."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = EPOCHS, temperature: float = TEMPERATURE) -> DataFrame:
    """(source, rate): mean copies of each document. A document's size is its characters and one more, so none is empty.

    weights: source -> weight; sources that it lacks get none. Weights are relative to the sources that are there.
    """
    sizes = docs.groupBy(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("of_source")).agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) + 1).cast("double").alias("size"))
    if weights is None:
        weight = F.pow("size", F.lit(temperature)) if temperature != 0.5 else F.sqrt("size")
    else:
        weight = F.lit(0.0)
        for s, w in weights.items():
            weight = F.when(F.col("of_source") == s, F.lit(float(w))).otherwise(weight)
    sizes = sizes.withColumn("weight", weight)
    total = sizes.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    rate = F.when(F.col("all_weight") > 0, F.col("weight") / F.col("all_weight") * F.col("all_size") * F.lit(epochs) / F.col("size")).otherwise(0.0)
    return sizes.crossJoin(F.broadcast(total)).select("of_source", rate.alias("rate"))  # total: one row


def poisson_steps(rate: Column) -> Column:
    """Struct(first, cdf): the distribution's values P(X <= first), P(X <= first + 1), ... up to where the rest is under 2^-53.

    first is 0 for rates up to PLAIN_RATE. For larger ones it lies twelve deviations under the mean, where what is left out is under 2^-53
    too and exp(-rate) would vanish; the first value then comes from Stirling's series."""
    wide = rate > PLAIN_RATE
    first = F.when(wide, F.floor(rate - 12 * F.sqrt(rate))).otherwise(0).cast("int")
    k = F.greatest(first, F.lit(1)).cast("double")
    log_factorial = k * F.log(k) - k + 0.5 * F.log(2 * math.pi * k) + 1 / (12 * k) - 1 / (360 * k * k * k)
    p0 = F.exp(F.when(wide, k * F.log(rate) - rate - log_factorial).otherwise(-rate))
    most = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(p0.alias("p"), F.array(p0).alias("cdf"))

    def step(s: Column, i: Column) -> Column:
        p = s["p"] * rate / i
        return F.struct(p.alias("p"), F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + p)).alias("cdf"))

    return F.struct(first.alias("first"), F.aggregate(F.sequence(first + 1, most), start, step)["cdf"].alias("cdf"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = EPOCHS, seed: str = SEED, temperature: float = TEMPERATURE, shuffle: bool = True, copy_column: str = "copy") -> DataFrame:
    """docs with a column copy_column (from 0), each document as often as it was drawn, in a global random order.

    All columns of docs return as they are. A null source is a source of its own, the empty name's. Null text counts as one character. Rows
    that repeat an id are drawn alike; a null id draws as the empty one. An empty table gives no rows. A column of docs of that name gives way.
    """
    if not (math.isfinite(epochs) and epochs >= 0):
        raise ValueError("epochs: a finite number, 0 at least")
    rates = source_rates(docs, weights, epochs, temperature)
    steps = small_side(rates.select("of_source", poisson_steps(F.col("rate")).alias("poisson")), MOST_BROADCAST)
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("of_source"), uniform(F.lit(seed), F.col("doc_id")).alias("u"))
    drawn = rows.join(steps, "of_source").withColumn("copies", F.col("poisson.first") + F.size(F.filter("poisson.cdf", lambda c: c < F.col("u")))).where("copies > 0")
    out = drawn.select("doc", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    if shuffle:
        # By a hash of id and copy: any partition is a random part of the whole, in random order.
        spread = F.xxhash64(F.lit(seed), F.col("doc.doc_id"), F.col("copy"), F.col("doc.text"))
        out = out.withColumn("place", spread).repartition("place").sortWithinPartitions("place")
    return out.select(*[F.col("doc")[c].alias(c) for c in names if c != copy_column], F.col("copy").alias(copy_column))


def op6_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with copy; weights by the square root of each source's size, one epoch."""
    return mix(read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars"))


#: From the table k to the table x, which has a row for each copy.
MIXED_SQL = """
sz as (select coalesce(source, '') s, sum(coalesce(length(text), 0) + 1)::double size from k group by 1),
rt as (select s, sqrt(size) / (select sum(sqrt(size)) from sz) * (select sum(size) from sz) / size rate from sz),
dr as (
  select k.*, rate, (('0x' || substr(md5('mix-1:' || coalesce(doc_id::varchar, '')), 1, 13))::bigint::double + 0.5) / 4503599627370496 u
  from k join rt on coalesce(source, '') = s),
pmf as (select s, rate, i, exp(-rate + i * ln(rate) - lgamma(i + 1)) p from rt, range(0, 600) r(i) where i <= ceil(rate + 10 * sqrt(rate) + 20)),
cdf as (select s, i, sum(p) over (partition by s order by i) c from pmf),
n as (select *, (select count(*) from cdf where s = coalesce(source, '') and c < u) copies from dr),
x as (select *, unnest(range(0, copies))::int "copy" from n)"""
ORACLE_SQL = f"""with k as (select * from documents), {MIXED_SQL}
select doc_id, text, lang, source, n_chars, "copy" from x"""
