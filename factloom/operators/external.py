"""Values held against an external source of points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.operators.facts import is_pure_usd

POINT = "struct<accn:string,start:string,end:string,val:decimal(28,10)>"
PAYLOAD = f"struct<cik:string,facts:map<string,map<string,struct<units:map<string,array<{POINT}>>>>>>"
FAMILIES = ("us-gaap", "dei", "srt")


def companyfacts_points(payloads: DataFrame) -> DataFrame:
    """payloads(json) -> cik, family, local_name, unit, accession, start, end, value: a row per point. Decimals are read exactly; what is no such document gives no rows."""
    p = payloads.select(F.from_json("json", PAYLOAD).alias("p")).select(F.lpad("p.cik", 10, "0").alias("cik"), F.explode("p.facts").alias("family", "names"))
    p = p.select("cik", "family", F.explode("names").alias("local_name", "body")).select("cik", "family", "local_name", F.explode("body.units").alias("unit", "points"))
    return p.select("cik", "family", "local_name", "unit", F.inline("points")).withColumnsRenamed({"accn": "accession", "val": "value"})


def oracle_eligible() -> Column:
    """Of a scanned fact: of a standard family, without dimensions, in US dollars."""
    return (F.col("origin") == "standard") & F.col("family").isin(*FAMILIES) & ~F.col("has_dimensions") & is_pure_usd(F.col("measures"))


def plain_text(number: Column) -> Column:
    """A decimal as text, without an exponent and without zeros at its end."""
    return F.when(number == 0, "0").otherwise(F.regexp_replace(number.cast("decimal(28,10)").cast("string"), r"\.?0+$", ""))


def oracle_comparisons(observations: DataFrame, facts: DataFrame, points: DataFrame, covered: DataFrame | None = None) -> DataFrame:
    """accession, metric, label, family, local_name, observation, oracle_values (distinct, ascending) of each observation. The label is na where it has no value or no eligible fact of that value; else by the points
    of the smallest such fact's name, unit, accession and period: absent, ambiguous if they differ among themselves, agree or differ. The other columns are null for na.

    observations: with period_start, period_end, numeric; facts: (accession, metric, fact_id, family, local_name, cik, value), eligible ones only. covered(cik): issuers with a readable document; a value of any other is na.
    Points of one key are one group: a filing's values of one name, unit and period. They are shuffled by filing, as observations and facts may lie already."""
    values = observations.where("status = 'value'").select("accession", "metric", "numeric", "period_start", "period_end")
    fact = facts.join(values, ["accession", "metric"]).where("value = numeric").groupBy("accession", "metric", "period_start", "period_end", "numeric").agg(F.min(F.struct("fact_id", "family", "local_name", "cik")).alias("f"))
    keys = fact.select("accession", "metric", "numeric", "period_end", "f.family", "f.local_name", "f.cik", F.coalesce("period_start", F.lit("")).alias("from"))
    if covered is not None:
        keys = keys.join(covered.select("cik").distinct(), "cik", "left_semi")
    found = points.where("unit = 'USD' and value is not null").repartition("accession").groupBy("cik", "family", "local_name", "accession", F.coalesce("start", F.lit("")).alias("from"), F.col("end").alias("period_end")).agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.collect_set("value").alias("values")
    )
    label = F.when(F.col("low").isNull(), "absent").when(F.col("low") != F.col("high"), "ambiguous").when(F.col("low") == F.col("numeric"), "agree").otherwise("differ")
    texts = F.array_join(F.transform(F.sort_array("values"), plain_text), ",")
    on = ["cik", "family", "local_name", "accession", "from", "period_end"]
    labels = keys.join(found, on, "left").select("accession", "metric", label.alias("label"), "family", "local_name", plain_text(F.col("numeric")).alias("observation"), texts.alias("oracle_values"))
    out = observations.select("accession", "metric").join(labels, ["accession", "metric"], "left")
    return out.select("accession", "metric", F.coalesce("label", F.lit("na")).alias("label"), "family", "local_name", "observation", "oracle_values")


def oracle_join(observations: DataFrame, facts: DataFrame, points: DataFrame) -> DataFrame:
    """accession, metric, label of oracle_comparisons."""
    return oracle_comparisons(observations, facts, points).select("accession", "metric", "label")


def oracle_findings(comparisons: DataFrame) -> DataFrame:
    """What a report lists: comparisons that differ or are ambiguous, as accession, metric, status, family, local_name, observation, oracle_values."""
    return comparisons.where("label in ('differ', 'ambiguous')").withColumnRenamed("label", "status")
