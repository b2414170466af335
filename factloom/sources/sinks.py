"""What a build writes: observations, findings, a manifest, mapping exports; published as a whole or not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OBSERVATION = ("accession", "cik", "metric", "status", "reason", "numeric", "decimals", "unit", "period_start", "period_end", "fact_ids", "decision_ids", "relation", "tier")


def _lists(df: DataFrame) -> DataFrame:
    ids = lambda c: F.to_json(F.split(c, ","))
    return df.withColumns({"fact_ids": ids("fact_ids"), "decision_ids": ids("decision_ids")})


def write_observations_csv(observations: DataFrame, path: str) -> None:
    """Fourteen columns, lists as JSON, ordered by filing and cohort position."""
    _lists(observations.orderBy("accession", "position")).select(*OBSERVATION).write.mode("errorifexists").option("header", True).csv(path)


def write_observations_json(observations: DataFrame, path: str) -> None:
    """One document a slot; numbers as text, lists as lists."""
    rows = observations.withColumns({"numeric": F.col("numeric").cast("string"), "fact_ids": F.split("fact_ids", ","), "decision_ids": F.split("decision_ids", ",")})
    rows.select(*OBSERVATION).write.mode("errorifexists").json(path)


def write_findings(findings: DataFrame, path: str) -> None:
    findings.orderBy("accession", "name").write.mode("errorifexists").json(path)


def write_manifest(filing: DataFrame, rules: DataFrame, path: str, version: str, built_at: str) -> None:
    """One document: version, time, accessions' number and digest, and the hash of each rule file. rules(name, content)."""
    hashes = rules.agg(F.sort_array(F.collect_list(F.struct("name", F.sha2(F.col("content").cast("binary"), 256).alias("sha256")))).alias("rules"))
    whole = filing.agg(F.count("*").alias("filings"), F.sha2(F.sum(F.xxhash64("accession").cast("decimal(20,0)")).cast("string"), 256).alias("accessions_digest"))
    whole.crossJoin(F.broadcast(hashes)).withColumns({"version": F.lit(version), "built_at": F.lit(built_at)}).write.mode("errorifexists").json(path)  # one row each


def publish_build(parts: dict[str, DataFrame], path: str, form: str = "parquet") -> None:
    """Writes all parts, in the form named, beside the target and moves them there at once; an existing target is refused and stays as it is."""
    spark = next(iter(parts.values())).sparkSession
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = files.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(target):
        raise FileExistsError(path)
    beside = files.Path(f"{path.rstrip('/')}.partial")
    for name, df in parts.items():
        df.write.format(form).mode("overwrite").save(f"{beside.toString()}/{name}")
    if not system.rename(beside, target):
        raise OSError(f"cannot move to {path}")


def write_quality_report(cells: DataFrame, findings: DataFrame, sources: DataFrame, by_qname: DataFrame, name_reuse: DataFrame, path: str) -> None:
    """The parts of a quality report as JSON, a row per cell, oracle finding, source and name, each part in its order; published as a whole. sources(kind, key, pin): what the report was made from, by digest or release."""
    pinned = sources.orderBy("kind", "key")
    parts = {"cells": cells.orderBy("metric", "fiscal_year", "release", "industry"), "oracle_findings": findings.orderBy("accession", "metric", "status"), "sources": pinned, "by_qname": by_qname.orderBy("qname"), "name_reuse": name_reuse.orderBy("family", "release", "local_name")}
    publish_build(parts, path, "json")


def export_mappings(report: DataFrame, path: str) -> None:
    """A JSON document a head, ordered by concept and head."""
    report.orderBy("concept", "head").select(F.to_json(F.struct(*sorted(report.columns)), {"ignoreNullFields": "false"})).write.mode("errorifexists").text(path)


def write_batch_report(outcomes: DataFrame, path: str) -> None:
    outcomes.orderBy("accession").write.mode("errorifexists").json(path)
