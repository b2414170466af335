"""Quarters, continued texts, contracts and evidence: against SQL, and cases that the tables do not hold."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from factloom.operators import contracts as cx
from factloom.operators import corpus as px
from factloom.operators import quarters as tx
from factloom.plans import further
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
DURATION = "accession string, filing_date date, cik string, metric string, focus string, period_start date, period_end date, required_start date, required_end date, numeric decimal(28,10), decimals string"


@pytest.mark.parametrize("name", list(further.ORACLES))
def test_equals_sql(spark, name):
    assert compare(spark, connect(SF), name, further.QUERIES[name], further.ORACLES[name], SF) is None


def _row(accession, focus, start, end, required, value, decimals, filed="2021-03-01", metric="revenue"):
    d = datetime.date.fromisoformat
    return accession, d(filed), "1", metric, focus, d(start), d(end), d(required[0]), d(required[1]), Decimal(value), decimals


def test_quarters(spark):
    year, nine, six, first = ("2020-01-01", "2020-12-31"), ("2020-01-01", "2020-09-30"), ("2020-01-01", "2020-06-30"), ("2020-01-01", "2020-03-31")
    rows = [
        _row("a", "FY", *year, year, 100, "-1"), _row("b", "Q3", *nine, nine, 70, "0"), _row("b", "Q3", "2020-07-01", "2020-09-30", nine, 25, "0"), _row("c", "Q2", *six, six, 40, None), _row("d", "Q1", *first, first, 20, None),
        _row("e", "FY", *year, ("2021-01-01", "2021-12-31"), 104, "-1", "2022-03-01"), _row("f", "FY", *year, ("2021-01-01", "2021-12-31"), 150, "-1", "2021-02-01"),
        _row("a", "FY", *year, year, 9, "0", metric="tax"), _row("a", "FY", *year, year, 8, "0", metric="tax"), _row("b", "Q3", *nine, nine, 1, "0", metric="tax"),
    ]
    roles = tx.period_roles(spark.createDataFrame(rows, DURATION))
    assert {(r.accession, str(r.period_start)): r.role for r in roles.collect() if r.metric == "revenue"} == {("a", "2020-01-01"): "annual", ("b", "2020-01-01"): "ytd", ("b", "2020-07-01"): "quarter", ("c", "2020-01-01"): "ytd", ("d", "2020-01-01"): "quarter_ytd", ("e", "2020-01-01"): "other", ("f", "2020-01-01"): "other"}
    (q4,) = tx.derived_fourth_quarter(roles).collect()  # two values of tax derive nothing
    assert (q4.metric, str(q4.period_start), str(q4.period_end), q4.numeric, q4.half_width) == ("revenue", "2020-10-01", "2020-12-31", 30, Decimal("5.5"))
    (s,) = tx.slot_stability(roles).collect()  # the comparative of an earlier filing does not count
    assert (s.accession, s.comparatives, s.stability) == ("a", 1, "stable")
    assert tx.derived_fourth_quarter(roles.where("false")).count() == 0 and tx.slot_stability(roles.where("false")).count() == 0


def test_chains(spark):
    long = [("z", i, i + 1 if i < 300 else None) for i in range(1, 301)]
    nodes = [("x", 1, 2), ("x", 2, None), ("x", 3, 9), ("x", 4, 5), ("x", 5, 4), ("x", 6, 7), ("x", 7, None), ("x", 7, 1), ("x", 8, 2), ("y", 1, None), *long]
    roots = [("x", 100, 1), ("x", 101, 3), ("x", 102, 4), ("x", 103, 6), ("x", 104, 8), ("x", 105, 77), ("y", 106, 1), ("z", 107, 1), ("x", 108, None)]
    check = lambda n, r: cx.continuation_check(spark.createDataFrame(n, "doc string, node long, next long"), spark.createDataFrame(r, "doc string, root long, start long"))
    got = {r.root: r.code for r in check(nodes, roots).collect()}
    assert got == {100: "reuse", 104: "reuse", 101: "unresolved", 102: "cycle", 103: "ambiguous", 105: "unresolved", 108: "unresolved"}
    assert check([], []).count() == 0 and [r.code for r in check([], [("x", 1, 1)]).collect()] == ["unresolved"]


def test_contracts_and_evidence(spark):
    ok = (1, "net_sales", "Net sales", "reported", "income_statement", "duration", "numeric", "monetary", "All sales.", ["a", "b"], ["c"])
    change = lambda i, **kw: tuple({**dict(zip(names, ok, strict=True)), "row_id": i, "key": f"k{i}", "definition": f"d{i}", **kw}.values())
    names = "row_id key name kind statement period_type value_kind unit_dimension definition includes excludes".split()
    rows = [ok, change(2, key="Bad"), change(3, statement="balance_sheet"), change(4, statement="none"), change(5, includes=["a", " a"]), change(6, excludes=None), change(7, key="net_sales"), change(8, definition="All sales.", includes=["b", "a"]), change(9, name=None), change(10, kind="x", value_kind=None)]
    df = spark.createDataFrame(rows, "row_id long, key string, name string, kind string, statement string, period_type string, value_kind string, unit_dimension string, definition string, includes array<string>, excludes array<string>")
    got = {(r.row_id, r.code) for r in cx.metric_contract_checks(df).collect()}
    assert got == {(2, "malformed_key"), (3, "period_of_statement"), (4, "period_of_statement"), (4, "unit_of_statement"), (5, "repeated_entry"), (6, "empty_list"), (7, "duplicate_key"), (8, "duplicate_payload"), (9, "blank_text"), (10, "kind"), (10, "value_kind")}
    revisions = spark.createDataFrame([(1, "accepted"), (2, "accepted"), (3, "rejected"), (4, "candidate"), (5, "accepted")], "id long, status string")
    none = [None] * 5
    evidence = spark.createDataFrame([(1, "note", "a", "l", None, None, None), (2, "note", "a", "", None, None, None), (2, *none, None), (5, "taxonomy", *none)], "id long, kind string, accession string, locator string, concept string, quote string, artifact string")
    assert {(r.id, r.code) for r in cx.evidence_checks(revisions, evidence).collect()} == {(2, "not_substantive"), (3, "no_evidence")}


def test_nothing_known_of_a_filing(spark):
    filing = spark.createDataFrame([("a", datetime.date(2020, 5, 1)), ("b", None)], "accession string, filing_date date")
    periods = spark.createDataFrame([("b", "no date")], "accession string, period_end string")
    names = spark.createDataFrame([("a", "n", "x"), ("b", "n", "x")], "accession string, namespace_uri string, local_name string")
    got = {r.accession: (r.report_year, r.declared, r.filed) for r in cx.quality_source(filing, periods, names, names.where("accession = 'b'")).collect()}
    assert got == {"a": (2020, True, False), "b": (None, True, True)}
    frame = spark.createDataFrame([("a", "1", "10-K", "unknown"), ("b", "1", "10-Q", "2020")], "accession string, cik string, form string, release string")
    decisions = spark.createDataFrame([("d", "m", "us-gaap", "x", "", "exact", "accepted", False, "", "")], "decision_id string, metric string, family string, local_name string, issuer_cik string, relation string, status string, stale boolean, exclude_ciks string, exclude_qnames string")
    assert cx.decision_applicable_slots(frame, decisions, names.withColumn("namespace_uri", F.lit("http://fasb.org/us-gaap/2020"))).count() == 0


def test_report_members(spark):
    files = [
        ("a", "z.htm", "10-K", True, True, False), ("a", "b.htm", "EX-99", False, True, False), ("a", "fee.htm", "ex-filingfee", False, True, False), ("a", "c.htm", None, False, False, False),
        ("b", "z.htm", "10-K", True, False, False), ("b", "i.xml", "EX-101.INS", False, False, True), ("b", "i_htm.xml", "EX-101.INS", False, False, True),
        ("c", "z.htm", "10-K", True, None, None), ("d", "z.htm", "10-K", False, True, False), ("e", "z.htm", "EX-FILING FEES", True, True, False),
    ]
    df = spark.createDataFrame(files, "accession string, path string, doc_type string, is_primary boolean, is_inline boolean, is_instance boolean")
    got = sorted((r.accession, r.kind, r.place or 0, r.path or r.error) for r in px.report_members(df).collect())
    assert got == [
        ("a", "inline", 1, "z.htm"), ("a", "inline", 2, "b.htm"), ("b", "instance", 1, "i.xml"), ("c", "instance", 0, "not_one_instance"), ("d", "instance", 0, "not_one_primary"),
        ("e", "inline", 0, "primary_not_in_set"),
    ]


def test_bundles_and_corpora_without_rows(spark):
    files = spark.createDataFrame([("a", "p", "1"), ("a", "p", None)], "accession string, path string, digest string")
    bindings = spark.createDataFrame([("a", "u", "p", "1", None), ("a", "v", "q", "1", "u"), ("a", "w", "p", "2", None)], "accession string, uri string, path string, digest string, alias string")
    reports = spark.createDataFrame([("a", "u"), ("b", "u")], "accession string, uri string")
    got = {(r.accession, r.rule, r.name) for r in px.bundle_structure(files, bindings, reports, px.payload_hash(files)).collect()}
    assert got == {("a", "path_twice", "p"), ("a", "binding_without_file", "v"), ("a", "other_bytes", "w"), ("a", "alias_is_address", "u"), ("b", "report_unbound", "u")}
    none = spark.createDataFrame([], "bundle_id long, accession string, cik string, form string, filed date, role string, amends string, policy string")
    assert px.corpus_checks(none, none).count() == 0
