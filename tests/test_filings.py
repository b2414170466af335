"""Registered queries against their SQL, and the rules' corners on hand-written rows."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from factloom.functions import scalars as S
from factloom.operators import facts as fx
from factloom.operators import integrity as ix
from factloom.operators import ledger as lx
from factloom.plans import catalogue
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(catalogue.ORACLES))
def test_equals_sql(spark, name):
    assert compare(spark, connect(SF), name, catalogue.QUERIES[name], catalogue.ORACLES[name], SF) is None


def reduce(spark, *facts):
    rows = spark.createDataFrame([("k", i, str(v), d) for i, v, d in facts], "k string, fact_id long, v string, decimals string").withColumn("resolved_numeric", F.col("v").cast("decimal(28,10)"))
    return fx.oim_reduce(rows, "k").collect()[0]


def test_duplicate_facts(spark):
    r = reduce(spark, (1, 9867000000, "-6"), (2, 9900000000, "-8"))
    assert (r.conflict, int(r.value), r.fact_ids) == (False, 9867000000, [1, 2])
    r = reduce(spark, (1, 2500, "-2"), (2, 3000, "-3"))
    assert (r.conflict, int(r.value), int(r.lo), int(r.hi)) == (False, 2500, 2500, 2550)
    assert reduce(spark, (1, 100, "-2"), (2, 200, "-2")).conflict
    assert not reduce(spark, (1, 100, "INF"), (2, 100, "INF")).conflict and reduce(spark, (1, 100, "INF"), (2, 200, "INF")).conflict
    assert reduce(spark, (2, 100, "0"), (1, 100, "0")).rank["f"] == 1
    assert reduce(spark, (1, 100, None), (2, 140, "-2")).value == 140


def test_scalars(spark):
    df = spark.createDataFrame([("1", "http://fasb.org/us-gaap/2023", "a/../b"), ("-1", "http://xbrl.sec.gov/dei/2023", "/x"), (None, "http://own.com/2023", "ok/x.htm")], "c string, ns string, p string")
    got = df.select(S.normalize_cik(F.col("c")), S.namespace_family(F.col("ns")), S.namespace_origin(F.col("ns")), S.is_safe_logical_path(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("0000000001", "us-gaap", "standard", False), (None, "dei", "standard", False), (None, "other", "issuer", True)]


def test_open_validity(spark):
    df = spark.createDataFrame([(None, None, None), (None, None, "2020-01-01"), ("2020-01-01", None, None), ("2020-01-01", "2020-12-31", "2020-12-31"), ("2020-01-01", "2020-12-31", "2021-01-01")], "a string, b string, p string")
    assert [r[0] for r in df.select(S.interval_contains(F.col("a"), F.col("b"), F.col("p"))).collect()] == [True, True, False, True, False]


def test_long_chain(spark):
    rows = spark.createDataFrame([(i, i - 1 if i else None, "m", "accepted") for i in range(40)], "id long, supersedes_id long, metric string, status string")
    got = {r.id: (r.root, r.revision, r.is_current) for r in lx.revision_positions(rows).collect()}
    assert got == {i: (0, i + 1, i == 39) for i in range(40)}
    h = lx.mapping_history(rows).collect()[0]
    assert (h["head"], h.revisions) == (39, 40)


def test_chain_of_any_length(spark):
    rows = spark.createDataFrame([(i, i - 1 if i else None) for i in range(150)], "id long, supersedes_id long")
    assert {r.id: (r.root, r.revision) for r in lx.revision_positions(rows).collect()} == {i: (0, i + 1) for i in range(150)}
    with pytest.raises(ValueError):
        lx.revision_positions(spark.createDataFrame([(1, 2), (2, 1)], "id long, supersedes_id long"))


def test_digest_holds_no_group_whole(spark):
    rows = spark.createDataFrame([("a", i, None if i % 3 else "x") for i in range(3000)] + [(None, 1, "é"), ("b", 2, "y")], "accession string, i long, v string")
    df = ix.ordered_digest(rows, "accession", "i", "v")
    assert "collect_list" not in df._jdf.queryExecution().toString()
    want = {g: hashlib.sha256("\n".join(sorted(lines)).encode()).hexdigest() for g, lines in {"a": [f"{i}|{'~' if i % 3 else 'x'}" for i in range(3000)], None: ["1|é"], "b": ["2|y"]}.items()}
    assert {r.accession: r.digest for r in df.collect()} == want and {r.n for r in df.collect()} == {3000, 1}


def test_all_decisions_and_metrics_count(spark):
    rows = [(i, f"m{i}", "exact", "accepted", False, "us-gaap", None, "1,2" if i == 10_999 else "") for i in range(11_000)]
    rows += [(20_000, "own", "exact", "accepted", False, "issuer", "1", ""), (20_001, "own", "exact", "accepted", False, "issuer", "2", "2")]
    decisions = spark.createDataFrame(rows, "decision_id long, metric string, relation string, status string, stale boolean, family string, issuer_cik string, exclude_ciks string")
    filing = spark.createDataFrame([("a", "1", "10-K"), ("b", "2", "10-K"), ("c", "3", "10-K")], "accession string, cik string, form string")
    got = {(r.metric, r.cik) for r in fx.scope_by_metric(decisions, filing).collect()}
    assert got == {("m10999", "1"), ("m10999", "2"), ("own", "2"), ("own", "3")}
    metrics = spark.range(1200).select(F.concat(F.lit("m"), "id").alias("metric"), F.lit("instant").alias("period_type"), F.col("id").alias("position"))
    assert fx.slot_grid(filing, metrics).count() == 3600


def test_entry_imports_without_llm(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and "select_observations" in e.queries()
