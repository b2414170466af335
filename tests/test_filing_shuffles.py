"""How often facts are shuffled on their way to observations and identities."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from factloom.operators import facts as fx
from factloom.plans.catalogue import Model

SF = "/root/testdata/sf0.001"


def shuffles(df) -> list[str]:
    return re.findall(r"hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString())


def test_the_scan_shuffles_no_facts_by_name(spark):
    """A few names have most facts. Facts without their concept, or without a name, are left out as before."""
    fact = spark.createDataFrame([(1, "a", "n", "X", "c", 1), (2, "a", "n", "Y", "c", 1), (3, "a", None, "X", "c", 1), (4, "a", "n", "X", "gone", 1), (5, "a", "n", "X", "c", 9)], "fact_id long, accession string, namespace_uri string, local_name string, context_id string, unit_id int")
    concept = spark.createDataFrame([("n", "X")], "namespace_uri string, local_name string")
    context = spark.createDataFrame([("c", "a", "s")], "context_id string, accession string, entity_scheme string")
    unit = spark.createDataFrame([(1, "numerator", 0, "u", "USD")], "unit_id int, side string, ordinal int, ns string, name string")
    dimension = spark.createDataFrame([("d",)], "context_id string")
    out = fx.fact_scan(fact, concept, context, unit, dimension)
    assert sorted((r.fact_id, r.source_qname, r.has_dimensions, r.measures is None) for r in out.collect()) == [(1, "{n}X", False, False), (5, "{n}X", False, True)]
    assert not [s for s in shuffles(out) if "namespace_uri" in s or "unit_id" in s]


def test_what_fills_slots_meets_filings_once_a_filing(spark):
    m = Model(spark, SF)
    out = m.observations()
    assert not [s for s in shuffles(out) if "accession" in s and "metric" in s]
    assert out.count() == 5 * m.filing.count()


def test_operands_are_reduced_without_another_shuffle(spark):
    assert not [s for s in shuffles(Model(spark, SF).operands()) if "local_name" in s and "namespace_uri" not in s]


def test_a_fact_that_two_decisions_take_is_one_id(spark):
    m = Model(spark, SF)
    twice = m.decision.unionByName(m.decision.where("decision_id = 'd1'").withColumn("decision_id", F.lit("d1b")))
    of = lambda d: {(r.accession, r.metric): r for r in fx.select_observations(m.filing, m.metric, d, m.periods(), m.scan()).collect()}
    one, two = of(m.decision), of(twice)
    found = [k for k, r in one.items() if k[1] == "assets" and r.fact_ids]
    assert found and {two[k].decision_ids for k in found} == {"d1,d1b"} and all(one[k].fact_ids == two[k].fact_ids and one[k].numeric == two[k].numeric for k in found)
    assert all(one[k] == two[k] for k in one if k not in found)
