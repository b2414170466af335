"""Lines are met with their filings once a query and lie by accession; what is made of them is not shuffled again."""

from __future__ import annotations

import pytest

from factloom.operators import contracts as cx
from factloom.operators import corpus as px
from factloom.plans import batches, further
from factloom.plans.catalogue import Model
from factloom.sources import staging
from tests.test_filing_shuffles import SF, shuffles
from tests.test_repeated_accessions import folder, held  # noqa: F401

ALL = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax", "l_returnflag", "l_linestatus", "local_name", "period_kind", "years_back", "form", "fiscal_year")


@pytest.mark.parametrize("name", ["fact_wide", "declared", "file", "bundle_file", "binding", "arc", "continuation", "continuation_root"])
def test_views_of_written_lines_are_the_views(spark, folder, name):  # noqa: F811
    of, plain = getattr(Model(spark, folder).lined(*ALL), name), getattr(Model(spark, folder), name)
    assert of.schema.simpleString() == plain.schema.simpleString()
    assert of.exceptAll(plain).count() == 0 and of.count() == plain.count() > 0
    assert not shuffles(of.groupBy("accession").count())


def test_chains_are_written_by_document(spark, monkeypatch):
    """No table of a chain is shuffled on its way, nor are the roots."""
    plans = []
    monkeypatch.setattr(staging, "dealt_by", lambda df, key: plans.append(df.columns) or df.repartition(8, key))
    kept = cx.written
    monkeypatch.setattr(cx, "written", lambda df, name: plans.append(shuffles(df)) or kept(df, name))
    out = further.Q["continuation_check"](Model(spark, SF))
    assert "l_quantity" in plans[0] and len(plans) > 2 and not any(plans[1:])
    assert not shuffles(out)


def test_issues_shuffle_filings_alone(spark):
    """Documents are made of lines that lie by accession: one shuffle of the filings, none of facts, declarations or arcs."""
    m = Model(spark, SF)
    issues = batches.Q["acceptance_issues"](m)
    assert [s for s in shuffles(batches._documents(m)) if not s.startswith("accession#") or "," in s.removesuffix(", 8")] == [] and len(shuffles(batches._documents(m))) <= 1
    assert not [s for s in shuffles(issues) if any(c in s for c in ("l_orderkey", "fact_id", "context_id", "local_name"))]


@pytest.mark.parametrize("name", ["continuation_check", "batch_extract", "bundle_structure"])
def test_repeated_accessions_against_sql(spark, folder, name):  # noqa: F811
    held(spark, folder, name)


def test_bundles_are_not_shuffled(spark):
    assert not shuffles(further.Q["bundle_structure"](Model(spark, SF)))


def test_addresses_of_bundles(spark):
    """Each report without a binding is a row, also a repeated one; an alias may be repeated and an address at once."""
    files = spark.createDataFrame([("a", "p", "1"), ("a", "q", "2")], "accession string, path string, digest string")
    bindings = spark.createDataFrame([("a", "u:p", "p", "1", "u:q"), ("a", "u:q", "q", "2", "u:q"), ("a", "u:q", "q", "2", None), ("b", "u:q", "q", "2", "u:x")], "accession string, uri string, path string, digest string, alias string")
    reports = spark.createDataFrame([("a", "u:p"), ("a", "u:z"), ("a", "u:z"), ("b", "u:x"), ("b", None)], "accession string, uri string")
    got = sorted((r.accession, r.rule, r.name or "") for r in px.bundle_structure(files, bindings, reports, px.payload_hash(files)).collect())
    assert got == [("a", "alias_is_address", "u:q"), ("a", "alias_twice", "u:q"), ("a", "report_unbound", "u:z"), ("a", "report_unbound", "u:z"), ("a", "uri_twice", "u:q"), ("b", "binding_without_file", "u:q"), ("b", "report_unbound", ""), ("b", "report_unbound", "u:x")]


def test_chains_of_documents_without_a_name(spark):
    """A null document or node is nobody's target; a document that ends where another begins shares nothing with it."""
    nodes = spark.createDataFrame([(None, 1, None), ("x", None, None), ("x", 1, 2), ("x", 2, 3), ("y", 3, None)], "doc string, node long, next long")
    roots = spark.createDataFrame([(None, 10, 1), ("x", 11, None), ("x", 12, 1), ("y", 13, 3)], "doc string, root long, start long")
    assert {r.root: r.code for r in cx.continuation_check(nodes, roots).collect()} == {10: "unresolved", 11: "unresolved", 12: "unresolved"}
