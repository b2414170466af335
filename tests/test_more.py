"""The further filing queries against their SQL, and what SQL does not express: readers, sinks, streams, URIs, blocks."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from factloom.functions import scalars as S
from factloom.operators import audits as ax
from factloom.operators import facts as fx
from factloom.operators import quality as qx
from factloom.plans import more
from factloom.sources import records, sinks
from factloom.streaming import ingest
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(more.ORACLES))
def test_equals_sql(spark, name):
    assert compare(spark, connect(SF), name, more.QUERIES[name], more.ORACLES[name], SF) is None


def test_normalize_uri(spark):
    want = {
        "HTTP://User@Example.COM:80/a/./b/../c/%7ex%2f?Q=%41#frag": "http://User@example.com/a/c/~x%2F?Q=A", "https://h:443": "https://h/", "https://h:8443/x?": "https://h:8443/x?", "ftp://h:21/..": "ftp://h/", "http://h/a/..": "http://h/",
        "http://h/a/b/.": "http://h/a/b/", "http://h//a//": "http://h//a//", "http://h/%zz": None, "no scheme": None, "http:///x": None, "http://h/a b": None, "": None, None: None,
    }
    rows = spark.createDataFrame([(k,) for k in want], "u string").select("u", S.normalize_uri(F.col("u")).alias("n")).collect()
    assert {r.u: r.n for r in rows} == want


def test_classification_and_places(spark):
    ns = {"https://fasb.org/us-gaap/2020": ("us-gaap", "standard"), "http://xbrl.us/srt/2009": ("other", "standard"), "https://XBRL.sec.gov:443/country/2021": ("other", "standard"), "ftp://fasb.org/x": ("other", "issuer"), "http://fasb.org.evil.com/us-gaap/": ("other", "issuer"), None: ("other", "issuer")}
    rows = spark.createDataFrame([(k,) for k in ns], "n string").select("n", S.namespace_family(F.col("n")).alias("f"), S.namespace_origin(F.col("n")).alias("o")).collect()
    assert {r.n: (r.f, r.o) for r in rows} == ns
    half = {"-06": Decimal(500000), "inf": Decimal(0), "0": Decimal("0.5"), "9": Decimal("5E-10"), "-18": Decimal(5 * 10**17), None: Decimal(0)}
    rows = spark.createDataFrame([(k,) for k in half], "d string").select("d", S.half_width(F.col("d")).alias("h"), S.parse_decimals(F.col("d"))["rank"].alias("r")).collect()
    assert {r.d: r.h for r in rows} == half and {r.d: r.r for r in rows}["inf"] == 0
    with pytest.raises(Exception, match="out of range"):
        spark.createDataFrame([("12",)], "d string").select(S.half_width(F.col("d"))).collect()


def test_equal_places_however_written_conflict(spark):
    facts = [("a", 1, 100, "-2"), ("a", 2, 200, "-02"), ("b", 3, 5, "INF"), ("b", 4, 5, "inf"), ("c", 5, 7, None), ("c", 6, 7, "-1")]
    df = spark.createDataFrame(facts, "k string, fact_id long, v int, decimals string").withColumn("resolved_numeric", F.col("v").cast("decimal(28,10)"))
    got = {r.k: (r.conflict, r.rank.f, r.n) for r in fx.oim_reduce(df, "k").collect()}
    assert got == {"a": (True, 2, 2) if got["a"][1] == 2 else (True, 1, 2), "b": (False, 3, 2), "c": (False, 6, 2)}
    assert "fact_ids" not in fx.oim_reduce(df, "k", with_ids=False).columns


def test_identities_take_the_noncontrolling_interest(spark):
    d = lambda x: float(x)
    total = "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest"
    nci = "NetIncomeLossAttributableToNoncontrollingInterest"
    rows = [
        ("a", "ProfitLoss", 10, 10), ("a", "NetIncomeLoss", 8, 8), ("a", nci, 2, 2), ("a", "Assets", 9, 9), ("a", "Liabilities", 4, 4), ("a", "StockholdersEquity", 5, 5),  # an interest's income: the parent's equity will not do
        ("b", "ProfitLoss", 10, 10), ("b", "NetIncomeLoss", 10, 10), ("b", "Assets", 9, 9), ("b", "Liabilities", 4, 4), ("b", "StockholdersEquity", 5, 5),
        ("c", "Assets", 9, 9), ("c", "Liabilities", 4, 4), ("c", total, 6, 6), ("c", "MinorityInterest", 1, 1), ("d", "Assets", 9, 9), ("d", "Liabilities", 4, 4), ("d", "StockholdersEquity", 5, 5), ("d", "MinorityInterest", 1, 1),
    ]
    operands = spark.createDataFrame([(a, n, d(lo), d(hi), False) for a, n, lo, hi in rows], "accession string, local_name string, lo double, hi double, bad boolean")
    filing = spark.createDataFrame([(x,) for x in "abcde"], "accession string")
    got = {(r.accession, r.name): r.status for r in fx.identity_checks(filing, operands).collect()}
    assert {k[0]: v for k, v in got.items() if k[1] == "nci_split"} == {"a": "pass", "b": "not_applicable", "c": "not_applicable", "d": "not_applicable", "e": "not_applicable"}
    assert {k[0]: v for k, v in got.items() if k[1] == "balance_sheet"} == {"a": "not_applicable", "b": "pass", "c": "fail", "d": "not_applicable", "e": "not_applicable"}


def test_partition_faults_are_found(spark):
    names = "slots wrong_form eligible value missing conflict unsupported".split()
    good, bad = (5, 1, 4, 1, 1, 1, 1), [(5, 1, 4, 2, 1, 1, 1), (6, 1, 4, 1, 1, 1, 1), (5, 1, 4, 4, 1, 0, 0)]
    assert qx.partition_faults(spark.createDataFrame([good, *bad], names)).count() == 3


def test_blocks(spark):
    html = """<html><head><title>no</title></head><body><h2>Item&nbsp;1. Busi<wbr>ness</h2><p>One<br>two <a href="#x">see</a></p><div style="display: none">gone</div><ul><li>a</li><li>b</li></ul>
    <table><tr><td>r1</td><td> 5 </td></tr><tr><td>r2</td></tr></table><script>x()</script>tail<ix:header>h</ix:header><p hidden>no</p><p>unclosed"""
    rows = records.html_blocks(spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "plain")], "doc_id long, html string")).orderBy("doc_id", "ordinal").collect()
    assert [(r.block_type, r.text) for r in rows if r.doc_id == 1] == [("heading", "Item 1. Business"), ("paragraph", "One two see"), ("list_item", "a"), ("list_item", "b"), ("table", "r1 | 5\nr2"), ("paragraph", "tail"), ("paragraph", "unclosed")]
    assert rows[0].heading_level == 2 and (rows[1].internal_links, rows[1].link_chars) == (1, 3) and [r.text for r in rows if r.doc_id == 4] == ["plain"] and {r.doc_id for r in rows} == {1, 4}


def test_sinks(spark, tmp_path):
    from factloom.plans.catalogue import Model

    obs = Model(spark, SF).observations().limit(40).persist()
    sinks.write_observations_csv(obs, f"{tmp_path}/csv")
    back = spark.read.option("header", True).csv(f"{tmp_path}/csv")
    assert back.columns == list(sinks.OBSERVATION) and back.count() == 40
    with pytest.raises(Exception, match="exists"):
        sinks.write_observations_csv(obs, f"{tmp_path}/csv")
    sinks.write_observations_json(obs, f"{tmp_path}/json")
    assert spark.read.json(f"{tmp_path}/json").count() == 40
    rules = spark.createDataFrame([("a.json", "x"), ("b.json", "y")], "name string, content string")
    sinks.write_manifest(obs.select("accession").distinct(), rules, f"{tmp_path}/manifest", "1", "2020-01-01T00:00:00Z")
    (doc,) = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/manifest").collect()]
    assert len(doc["rules"]) == 2 and doc["version"] == "1"
    sinks.publish_build({"observations": obs, "rules": rules}, f"{tmp_path}/build")
    assert spark.read.parquet(f"{tmp_path}/build/rules").count() == 2
    with pytest.raises(FileExistsError):
        sinks.publish_build({"rules": rules}, f"{tmp_path}/build")


def test_streams(spark, tmp_path):
    schema = "accession string, cik string, form string, filing_date string, fact_id long"
    day = lambda n, rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run = lambda: ingest.stream_ingest(spark, f"{tmp_path}/in", schema, f"{tmp_path}/catalogue", f"{tmp_path}/snap", f"{tmp_path}/cp").awaitTermination()
    day(1, [("a", "1", "10-K", "2020-01-01", 1), ("a", "1", "10-K", "2020-01-01", 2), ("b", "2", "10-Q", "2020-01-02", 3)])
    run()
    day(2, [("a", "1", "10-K", "2020-01-01", 9), ("b", "2", "10-K", "2020-01-02", 7), ("c", "3", "10-K", "2020-01-03", 4)])  # a again, b in conflict, c new
    run()
    got = sorted((r.accession, r.fact_id) for r in spark.read.parquet(f"{tmp_path}/snap").collect())
    assert got == [("a", 9), ("b", 3), ("c", 4)] and spark.read.parquet(f"{tmp_path}/catalogue").count() == 3
    revisions = "id long, supersedes_id long, status string"
    put = lambda rows: spark.createDataFrame(rows, revisions).coalesce(1).write.mode("append").parquet(f"{tmp_path}/rev")
    follow = lambda: ingest.stream_ledger(spark, f"{tmp_path}/rev", revisions, f"{tmp_path}/log", f"{tmp_path}/heads", f"{tmp_path}/cp2").awaitTermination()
    put([(1, None, "candidate"), (2, None, "candidate")])
    follow()
    put([(3, 1, "accepted"), (2, None, "candidate")])
    follow()
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/heads").collect()) == [2, 3] and spark.read.parquet(f"{tmp_path}/log").count() == 3


def test_snapshot_of_a_filing_with_a_fatal_issue_stays_out(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "accession string, fact_id long")
    issues = spark.createDataFrame([("b", "fatal")], "accession string, severity string")
    ingest.replace_snapshot(rows, f"{tmp_path}/s", issues)
    assert [r.accession for r in spark.read.parquet(f"{tmp_path}/s").collect()] == ["a"]


def test_nulls_and_empty_tables(spark):
    empty = spark.createDataFrame([], "accession string, path string")
    assert ax.reconcile(empty, empty, empty).count() == 0
    assert records.submissions_records(spark.createDataFrame([("not json", 0), (None, 1)], "json string, shard int")).count() == 0
    assert records.sgml_documents(spark.createDataFrame([("a", None), ("b", "")], "accession string, text string")).count() == 0
