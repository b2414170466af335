"""Referential, ordering and completeness audits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def orphans(rule: str, child: DataFrame, parent: DataFrame, keys: list[str], name: str) -> DataFrame:
    """rule, id of the child's rows whose keys the parent lacks."""
    return child.join(parent.select(*keys).distinct(), keys, "left_anti").select(F.lit(rule).alias("rule"), F.col(name).cast("string").alias("id"))


def orphan_checks(fact: DataFrame, concept: DataFrame, context: DataFrame, unit_measure: DataFrame) -> DataFrame:
    parts = [
        orphans("fact_concept", fact, concept, ["namespace_uri", "local_name"], "fact_id"),
        orphans("fact_context", fact, context, ["context_id"], "fact_id"),
        orphans("fact_unit", fact, unit_measure, ["unit_id"], "fact_id"),
    ]
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def source_order(facts: DataFrame) -> DataFrame:
    """fact_id with its place from 0 in its filing."""
    return facts.select("fact_id", "accession", (F.row_number().over(Window.partitionBy("accession").orderBy("fact_id")) - 1).cast("long").alias("source_order"))


def ordered_digest(rows: DataFrame, group: str, *columns: str) -> DataFrame:
    """SHA-256 of a group's rows in order. Rows are sorted on Spark and hashed as they come, so no group is held whole; one group is still one task's, as SHA-256 is a chain."""
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    sorted_rows = rows.select(F.col(group).cast("string").alias("g"), line.alias("line")).repartition("g").sortWithinPartitions("g", "line")
    out = sorted_rows.mapInArrow(_digests, "g string, digest string, n long")
    return out.select(F.col("g").cast(rows.schema[group].dataType).alias(group), "digest", "n")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64()), strict=True)], ["g", "digest", "n"])

    group, digest, n = None, None, 0
    for b in batches:
        done = []
        for g, line in zip(b.column("g").to_pylist(), b.column("line").to_pylist(), strict=True):
            if n and g == group:
                digest.update(b"\n")
            else:
                if n:
                    done.append((group, digest.hexdigest(), n))
                group, digest, n = g, hashlib.sha256(), 0
            digest.update(line.encode())
            n += 1
        yield out(done)
    if n:
        yield out([(group, digest.hexdigest(), n)])


def snapshot_counts(filing: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """A count per filing and table, 0 where it has none."""
    out = filing.select("accession")
    for name, df in tables.items():
        out = out.join(df.groupBy("accession").agg(F.count("*").alias(f"n_{name}")), "accession", "left")
    return out.select("accession", *[F.coalesce(f"n_{n}", F.lit(0)).alias(f"n_{n}") for n in tables])


def fact_completeness(filing: DataFrame, raw: DataFrame, stored: DataFrame) -> DataFrame:
    """Filings whose stored facts are not as many as the raw ones."""
    both = snapshot_counts(filing, {"raw": raw, "stored": stored})
    return both.where("n_raw <> n_stored")


def union_concept_uses(fact: DataFrame, concept: DataFrame, dimension: DataFrame) -> DataFrame:
    names = [fact.select(F.concat_ws("#", "namespace_uri", "local_name").alias("name")), concept.select(F.concat_ws("#", "namespace_uri", "local_name").alias("name")), dimension.select(F.col("dimension").alias("name")), dimension.select(F.col("member").alias("name"))]
    return reduce(DataFrame.union, names).distinct()


def dimension_members(context: DataFrame, dimension: DataFrame) -> DataFrame:
    pairs = dimension.groupBy("context_id").agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "dimension", "member"))), ",").alias("members"))
    return context.select("context_id", "accession").join(pairs, "context_id")
