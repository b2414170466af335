"""Readers of what people write by hand: gold assertions, the cohort of metrics, the sample of filings. Files that break their rules are refused as a whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fields of an assertion, of its period, and fields that older files had; columns of a sample.
GOLD_FIELDS, PERIOD_FIELDS = ("id", "accession", "metric", "period", "status", "numeric", "reason"), ("kind", "start", "end")
FORBIDDEN_FIELDS = ("capability_state", "metric-v2", "definition_hash_scheme", "review_profile")
SAMPLE_COLUMNS = ("accession", "cik", "form", "fiscal_year", "sic", "industry_bucket", "taxonomy_era_note")
_ASSERTION = "struct<id:string,accession:string,metric:string,period:struct<kind:string,start:string,end:string>,status:string,numeric:string,reason:string>"


class RefusedFile(ValueError):
    """A file that breaks its own rules."""


def _missing(c: Column) -> Column:
    return F.coalesce(F.trim(c) == "", F.lit(True))


def gold_faults(spark: SparkSession, glob: str) -> DataFrame:
    """file, id, code of what is wrong with gold files: malformed (no JSON object with a list of assertions), forbidden_field or unknown_field (in an assertion or its period), missing_field, unknown_kind, start_missing, bad_numeric."""
    raw = spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.from_json("value", f"struct<assertions:array<{_ASSERTION}>>")["assertions"].alias("a"), F.from_json("value", "struct<assertions:array<map<string,string>>>")["assertions"].alias("m"))
    broken = raw.where("a is null").select("file", F.lit(None).cast("string").alias("id"), F.lit("malformed").alias("code"))
    rows = raw.select("file", F.explode(F.arrays_zip("a", "m")).alias("r")).select("file", "r.a", F.map_keys("r.m").alias("keys"), F.coalesce(F.json_object_keys(F.col("r.m")["period"]), F.array().cast("array<string>")).alias("inner"))
    of = lambda names: F.array(*[F.lit(n) for n in names])
    unknown = (F.size(F.array_except("keys", of((*GOLD_FIELDS, *FORBIDDEN_FIELDS)))) > 0) | (F.size(F.array_except("inner", of((*PERIOD_FIELDS, *FORBIDDEN_FIELDS)))) > 0)
    forbidden = F.arrays_overlap("keys", of(FORBIDDEN_FIELDS)) | F.arrays_overlap("inner", of(FORBIDDEN_FIELDS))
    lacks = F.col("a").isNull() | _missing(F.col("a.id")) | _missing(F.col("a.accession")) | _missing(F.col("a.metric")) | _missing(F.col("a.status")) | _missing(F.col("a.period.end"))
    rules = {
        "forbidden_field": forbidden, "unknown_field": unknown, "missing_field": lacks, "unknown_kind": ~F.coalesce(F.col("a.period.kind").isin("duration", "instant"), F.lit(False)),
        "start_missing": (F.col("a.period.kind") == "duration") & _missing(F.col("a.period.start")), "bad_numeric": F.col("a.numeric").isNotNull() & F.col("a.numeric").try_cast("decimal(28,10)").isNull(),
    }
    codes = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    return broken.unionByName(rows.select("file", F.col("a.id").alias("id"), F.explode(codes).alias("code")))


def gold_table(spark: SparkSession, glob: str) -> DataFrame:
    """Gold assertions of the files, as gold_join takes them: id, accession, metric, kind, period_start, period_end, status, numeric, reason. Any fault raises RefusedFile with the first of them. A file is read whole, so files hold a person's work, not a corpus'."""
    if bad := gold_faults(spark, glob).orderBy("file", "id", "code").limit(5).collect():
        raise RefusedFile("; ".join(f"{r.file} {r.id}: {r.code}" for r in bad))
    a = spark.read.text(glob, wholetext=True).select(F.inline(F.from_json("value", f"struct<assertions:array<{_ASSERTION}>>")["assertions"]))
    return a.select("id", "accession", "metric", F.col("period.kind").alias("kind"), F.col("period.start").alias("period_start"), F.col("period.end").alias("period_end"), "status", F.col("numeric").cast("decimal(28,10)").alias("numeric"), "reason")


def cohort_table(spark: SparkSession, path: str, order: tuple[str, ...] = ()) -> DataFrame:
    """metric, position (from 0) of a cohort's metrics, in the file's order. order: what they must be, where it is frozen; another order, a repeated or blank metric, or none at all raises RefusedFile."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", "struct<metrics:array<string>>")["metrics"]).alias("position", "metric")).select("metric", "position")
    found = [r.metric for r in rows.orderBy("position").limit(10_001).collect()]  # a cohort is a list that people keep
    if not found or len(found) > 10_000 or len(set(found)) < len(found) or any(not (m or "").strip() for m in found) or (order and tuple(found) != tuple(order)):
        raise RefusedFile(f"{path}: not the metrics of a cohort")
    return rows


def read_sample_csv(spark: SparkSession, path: str) -> DataFrame:
    """The sample's seven columns, trimmed; a blank industry is unknown, other blanks are empty. More columns are left out. A missing column, a row without an accession, or one accession twice raises RefusedFile."""
    raw = spark.read.csv(path, header=True, escape='"', multiLine=True)
    if lack := [c for c in SAMPLE_COLUMNS if c not in raw.columns]:
        raise RefusedFile(f"{path}: without {', '.join(lack)}")
    rows = raw.select(*[F.coalesce(F.trim(c), F.lit("")).alias(c) for c in SAMPLE_COLUMNS])
    if bad := rows.groupBy("accession").agg(F.count("*").alias("n")).where("n > 1 or accession = ''").orderBy("accession").limit(5).collect():
        raise RefusedFile(f"{path}: " + ", ".join(f"{r.accession or 'no accession'} {r.n} times" for r in bad))
    return rows.withColumn("industry_bucket", F.when(F.col("industry_bucket") == "", "unknown").otherwise(F.col("industry_bucket")))
