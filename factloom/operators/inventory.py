"""What reports hold before a taxonomy is known: items by target, the contexts and units that they name, ids that collide, continued texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators import contracts as cx
from factloom.sources.objects import ITEMS

DEFAULT = ""


def _of_target(occurrences: DataFrame) -> DataFrame:
    return occurrences.withColumn("target", F.coalesce("target", F.lit(DEFAULT)))


def occurrence_inventory(occurrences: DataFrame) -> DataFrame:
    """report_key, target ('' for the default one), items, fractions, tuples, contexts, units: of each target of a report; contexts and units are the distinct ones that its items name."""
    o = _of_target(occurrences).where(F.col("kind").isin(*ITEMS, "tuple", "item"))
    is_item = F.col("kind") != "tuple"
    return o.groupBy("report_key", "target").agg(
        F.count_if(is_item).alias("items"), F.count_if(F.col("kind") == "fraction").alias("fractions"), F.count_if(F.col("kind") == "tuple").alias("tuples"),
        F.count_distinct(F.when(is_item, F.nullif("context_ref", F.lit("")))).alias("contexts"), F.count_distinct(F.when(is_item, F.nullif("unit_ref", F.lit("")))).alias("units"),
    )


def report_totals(occurrences: DataFrame) -> DataFrame:
    """report_key, contexts, units, continuations, malformed: elements with an id in all members of a report, and members that are not read to their end."""
    n = lambda kind: F.count_if((F.col("kind") == kind) & F.col("id").isNotNull()).alias(f"{kind}s")
    return occurrences.groupBy("report_key").agg(n("context"), n("unit"), n("continuation"), F.count_if(F.col("kind") == "malformed").alias("malformed"))


def id_collisions(occurrences: DataFrame) -> DataFrame:
    """report_key, code (CONTEXT_ID_COLLISION, UNIT_ID_COLLISION), id, n: ids that several contexts, or several units, of a report's members share."""
    ids = occurrences.where("kind in ('context', 'unit') and id is not null").groupBy("report_key", "kind", "id").agg(F.count("*").alias("n")).where("n > 1")
    return ids.select("report_key", F.concat(F.upper("kind"), F.lit("_ID_COLLISION")).alias("code"), "id", "n")


def target_faults(occurrences: DataFrame, selected: str | None = None) -> DataFrame:
    """report_key, code: what keeps the selected target (null: the default one) of a report from being taken: fractions or tuples of its own, or a text of its items that is continued nowhere, in several places, in a circle, or together with another text.

    Chains of other targets and of footnotes count where they share a text with the selected one's."""
    o = _of_target(occurrences)
    wanted = F.col("target") == (selected or DEFAULT)
    held = o.where(wanted & F.col("kind").isin("fraction", "tuple")).select("report_key", F.lit("UNSUPPORTED_INLINE_FRACTION_OR_TUPLE").alias("code")).distinct()
    nodes = o.where("kind = 'continuation' and id is not null").select(F.col("report_key").alias("doc"), F.col("id").alias("node"), F.nullif("continued_at", F.lit("")).alias("next"))
    starts = o.where((F.col("kind").isin(*ITEMS) | (F.col("kind") == "footnote")) & (F.coalesce("continued_at", F.lit("")) != ""))
    roots = starts.select(F.col("report_key").alias("doc"), F.concat_ws("|", "path", F.col("place").cast("string")).alias("root"), F.col("continued_at").alias("start"))
    own = starts.where(wanted & (F.col("kind") != "footnote")).select(F.col("report_key").alias("doc"), F.concat_ws("|", "path", F.col("place").cast("string")).alias("root"))
    found = cx.continuation_check(nodes, roots).join(own, ["doc", "root"], "left_semi")
    return held.unionByName(found.select(F.col("doc").alias("report_key"), F.concat(F.lit("CONTINUATION_"), F.upper("code")).alias("code")).distinct())
