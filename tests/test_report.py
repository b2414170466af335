"""The quality report: comparisons, slots, cells, faults, and what the job writes or refuses."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as e
from factloom.operators import external as ex
from factloom.operators import quality as qx
from factloom.plans import report
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
OBSERVATION = "accession string, metric string, status string, numeric decimal(28,10), period_start string, period_end string"
FACT = "accession string, metric string, fact_id long, family string, local_name string, cik string, value decimal(28,10)"
POINT = "cik string, family string, local_name string, unit string, accession string, start string, end string, value decimal(28,10)"


@pytest.mark.parametrize("name", ["quality_report", "report_faults", "value_without_decision", "oracle_findings"])
def test_equals_sql(spark, name):
    assert compare(spark, connect(SF), name, e.queries()[name], e.oracle_sql()[name], SF) is None


def test_comparisons(spark):
    d = Decimal
    year = ("2020-01-01", "2020-12-31")
    obs = [(a, "assets", "value", d(v), None if a == "i" else year[0], year[1]) for a, v in (("a", "100"), ("b", "1.5"), ("c", "7"), ("d", "0"), ("i", "9"), ("u", "5"), ("n", "3"))] + [("m", "assets", "missing", None, *year), ("a", "revenue", "conflict", None, *year)]
    facts = [(a, "assets", f, "us-gaap", name, "u" if a == "u" else "k", d(v)) for a, f, name, v in (("a", 2, "Late", "100"), ("a", 1, "Assets", "100"), ("b", 3, "Assets", "1.5"), ("c", 4, "Assets", "7"), ("d", 5, "Assets", "0"), ("i", 6, "Assets", "9"), ("u", 7, "Assets", "5"), ("n", 8, "Assets", "4"))]
    point = lambda a, v, start=year[0], unit="USD", name="Assets": ("k", "us-gaap", name, unit, a, start, year[1], None if v is None else d(v))
    points = [point("a", "100"), point("a", "100"), point("a", "8", name="Late"), point("b", "10"), point("b", "9"), point("b", None), point("c", "8"), point("c", "7", unit="EUR"), point("d", "0"), point("i", "1"), point("i", "9", None)]
    o, f, p = spark.createDataFrame(obs, OBSERVATION), spark.createDataFrame(facts, FACT), spark.createDataFrame(points, POINT)
    covered = spark.createDataFrame([("k",), ("k",)], "cik string")
    found = {(r.accession, r.metric): tuple(r)[2:] for r in ex.oracle_comparisons(o, f, p, covered).collect()}
    none = ("na", None, None, None, None)
    of = lambda label, value, held: (label, "us-gaap", "Assets", value, held)
    assert found == {
        ("a", "assets"): of("agree", "100", "100"), ("b", "assets"): of("ambiguous", "1.5", "9,10"), ("c", "assets"): of("differ", "7", "8"), ("d", "assets"): of("agree", "0", "0"), ("i", "assets"): of("agree", "9", "9"),
        ("u", "assets"): none, ("n", "assets"): none, ("m", "assets"): none, ("a", "revenue"): none,
    }
    assert {r.accession for r in ex.oracle_join(o, f, p).where("label = 'absent'").collect()} == {"u"}  # without a list of issuers each is covered
    assert [tuple(r) for r in ex.oracle_findings(ex.oracle_comparisons(o, f, p)).orderBy("accession").collect()] == [("b", "assets", "ambiguous", "us-gaap", "Assets", "1.5", "9,10"), ("c", "assets", "differ", "us-gaap", "Assets", "7", "8")]
    assert ex.oracle_comparisons(o.limit(0), f, p).count() == 0 and ex.oracle_comparisons(o, f.limit(0), p.limit(0)).where("label <> 'na'").count() == 0


def slots(spark, frame_rows, obs, applicable, labels):
    frame = spark.createDataFrame(frame_rows, "accession string, cik string, form string, fiscal_year string, industry string, release string, metric string")  # a column of a clashing name
    observations = spark.createDataFrame(obs, "accession string, metric string, status string, reason string")
    return qx.quality_slots(observations, frame, spark.createDataFrame(applicable, "accession string, metric string"), spark.createDataFrame(labels, "accession string, metric string, label string"))


def test_cells(spark):
    frame = [(a, "k", form, "2020", "steel", "2019", "x") for a, form in (("a", "10-K"), ("b", "10-K/A"), ("c", "10-K"), ("d", "10-K"), ("q", "10-Q"), ("z", None))]
    obs = [("a", "m", "value", None), ("b", "m", "unsupported", "decision_scope"), ("c", "m", "conflict", None), ("d", "m", "unsupported", None), ("q", "m", "unsupported", "wrong_form"), ("z", "m", None, None), ("a", "n", "missing", "broader_only"), ("lost", "m", "value", None)]
    s = slots(spark, frame, obs, [("a", "m"), ("a", "m"), ("c", "m")], [("a", "m", "agree"), ("b", "m", "na"), ("c", "m", "differ"), ("d", "m", "absent"), ("q", "m", "ambiguous")])
    identities = spark.createDataFrame([("a", "pass"), ("a", "fail"), ("c", "pass"), ("q", "not_applicable"), ("elsewhere", "fail")], "accession string, status string")
    cells = {(r.metric, r.fiscal_year): r for r in qx.quality_report(s, identities).collect()}
    whole = cells["m", "2020"].asDict()
    assert {k: v for k, v in whole.items() if k not in qx.CELL} == {
        "n_slots": 6, "n_slot_eligible": 4, "n_ineligible_wrong_form": 2, "n_value": 1, "n_missing": 0, "n_unsupported": 2, "n_conflict": 1, "n_reason_decision_scope": 1, "n_reason_other_unsupported": 1, "n_decision_applicable": 2,
        "n_no_applicable_decision": 2, "oracle_agree": 1, "oracle_differ": 1, "oracle_absent": 1, "oracle_ambiguous": 1, "oracle_na": 2, "identity_pass": 2, "identity_fail": 1, "identity_na": 1, "publication_rate": 0.25, "selector_yield": 0.5,
    }
    assert cells["n", "2020"].selector_yield is None and cells["n", "2020"].identity_pass == 1  # once more, as another cell has the filing too
    lost = cells["m", "unknown"]
    assert (lost.release, lost.industry, lost.n_ineligible_wrong_form, lost.publication_rate) == ("unknown", "unknown", 1, None)
    assert [tuple(r) for r in qx.value_without_decision(s).collect()] == [("lost", "m")]
    assert qx.report_faults(qx.quality_report(s, identities)).count() == 0
    assert qx.quality_report(s.limit(0), identities).count() == 0


def test_faults(spark):
    frame = [(a, "k", "10-K", "2020", "steel", a, "x") for a in "abc"]
    obs = [("a", "m", "value", None), ("b", "m", "missing", None), ("c", "m", "value", None)]
    s = slots(spark, frame, obs, [("c", "m")], [("b", "m", "other"), ("c", "m", "agree")])
    cells = qx.quality_report(s, spark.createDataFrame([], "accession string, status string"))
    assert {(r.release, r.code) for r in qx.report_faults(cells).collect()} == {("a", "values_over_decisions"), ("b", "labels")}
    odd = cells.where("release = 'c'").withColumns({"n_value": F.lit(3), "n_decision_applicable": F.lit(4), "n_unsupported": F.lit(1)})
    assert {r.code for r in qx.report_faults(odd).collect()} == {"statuses", "bounds", "reasons"}


def test_job(spark, tmp_path):
    with pytest.raises(report.QualityFault):
        report.quality_job(spark, SF, str(tmp_path / "strict"))
    assert not (tmp_path / "strict").exists()
    path = str(tmp_path / "open")
    cells = report.quality_job(spark, SF, path, strict=False)
    read = lambda name, at=path: spark.read.json(f"{at}/{name}")
    totals = cells.agg(*[F.sum(f"oracle_{x}").alias(x) for x in qx.ORACLE], F.sum("n_slots").alias("slots"), F.sum("n_decision_applicable").alias("applicable")).first()
    assert all(totals[x] > 0 for x in ("agree", "differ", "na", "applicable")) and sum(totals[x] for x in qx.ORACLE) == totals.slots
    assert read("cells").count() == cells.count() and read("oracle_findings").count() == totals.differ + totals.ambiguous
    assert {r.kind for r in read("sources").select("kind").distinct().collect()} == {"oracle", "taxonomy"} and read("by_qname").count() > 0 and read("name_reuse").count() > 0
    assert read("cells", path + "-faults").count() > 0 and read("slots", path + "-faults").count() > 0
    with pytest.raises(FileExistsError):
        report.quality_job(spark, SF, path, strict=False)
