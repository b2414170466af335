"""Readers of gold assertions, cohorts and samples, and what they refuse."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from factloom.operators import facts as fx
from factloom.operators import quality as qx
from factloom.sources import tables as tx


def test_gold(spark, tmp_path):
    good = {"id": "g1", "accession": "a", "metric": "assets", "period": {"kind": "instant", "end": "2020-12-31"}, "status": "value", "numeric": "12345678901234567.25"}
    number = good | {"id": "g2", "metric": "revenue", "period": {"kind": "duration", "start": "2020-01-01", "end": "2020-12-31"}, "numeric": 7, "reason": None}
    write = lambda name, body: (tmp_path / name).write_text(body if isinstance(body, str) else json.dumps(body))
    write("one.json", {"assertions": [good, number]})
    write("none.json", {"assertions": []})
    gold = tx.gold_table(spark, str(tmp_path / "*.json"))
    assert {(r.id, r.kind, r.period_start, str(r.numeric)) for r in gold.collect()} == {("g1", "instant", None, "12345678901234567.2500000000"), ("g2", "duration", "2020-01-01", "7.0000000000")}
    built = spark.createDataFrame([("a", "assets", "value", None, None, "2020-12-31"), ("a", "revenue", "missing", None, "2020-01-01", "2020-12-31")], "accession string, metric string, status string, reason string, period_start string, period_end string")
    found = qx.gold_join(gold, built.withColumn("numeric", F.when(F.col("metric") == "assets", F.lit("12345678901234567.25").cast("decimal(28,10)"))))
    assert {(r.metric, r.outcome) for r in found.collect()} == {("assets", "ok"), ("revenue", "status")}
    bad = {
        "b1": good | {"review_profile": 1}, "b2": good | {"colour": "x"}, "b3": good | {"metric": " "}, "b4": good | {"period": {"kind": "forever", "end": "x"}}, "b5": number | {"period": {"kind": "duration", "end": "x"}}, "b6": good | {"numeric": "many"},
        "b7": good | {"period": good["period"] | {"zone": "utc"}}, "b8": good | {"period": None},
    }
    write("bad.json", {"assertions": [v | {"id": k} for k, v in bad.items()]})
    write("broken.json", '{"assertions": [')
    codes = {(r.id, r.code) for r in tx.gold_faults(spark, str(tmp_path / "b*.json")).collect()}
    assert codes == {("b1", "forbidden_field"), ("b2", "unknown_field"), ("b3", "missing_field"), ("b4", "unknown_kind"), ("b5", "start_missing"), ("b6", "bad_numeric"), ("b7", "unknown_field"), ("b8", "missing_field"), ("b8", "unknown_kind"), (None, "malformed")}
    with pytest.raises(tx.RefusedFile, match="broken.json"):
        tx.gold_table(spark, str(tmp_path / "b*n.json"))


def test_cohort(spark, tmp_path):
    def cohort(metrics, order=()):
        (tmp_path / "c.json").write_text(json.dumps({"metrics": metrics, "slots": ["fy"]}, indent=1))
        return [tuple(r) for r in tx.cohort_table(spark, str(tmp_path / "c.json"), order).orderBy("position").collect()]

    assert cohort(["revenue", "assets"]) == cohort(["revenue", "assets"], ("revenue", "assets")) == [("revenue", 0), ("assets", 1)]
    for metrics, order in ((["assets", "revenue"], ("revenue", "assets")), (["a", "a"], ()), (["a", ""], ()), ([], ()), (None, ())):
        with pytest.raises(tx.RefusedFile):
            cohort(metrics, order)


def test_sample(spark, tmp_path):
    head = ",".join(tx.SAMPLE_COLUMNS)

    def sample(*lines):
        (tmp_path / "s.csv").write_text("\n".join(lines) + "\n")
        return tx.read_sample_csv(spark, str(tmp_path / "s.csv"))

    rows = sample(head + ",more", ' a-1 ,7,10-K,2020,1,, "x" ,y', 'b-2,8,10-Q,,2,"steel, ""hot""","two\nlines",', "c-3,9")
    assert {tuple(r) for r in rows.collect()} == {("a-1", "7", "10-K", "2020", "1", "unknown", '"x"'), ("b-2", "8", "10-Q", "", "2", 'steel, "hot"', "two\nlines"), ("c-3", "9", "", "", "", "unknown", "")}
    assert sample(head).count() == 0
    for lines in ((head.replace("sic", "code"), "a,1,1,1,1,1,1"), (head, "a,1,1,1,1,1,1", " a,1,1,1,1,1,1"), (head, " ,1,1,1,1,1,1")):
        with pytest.raises(tx.RefusedFile):
            sample(*lines)


def test_occurrences_of_concepts(spark):
    facts = spark.createDataFrame([(1, "a", "c1", 1), (2, "a", "c1", 9), (3, "a", "gone", 1), (4, "gone", "c1", 1), (5, "a", "c1", None), (6, "a", None, 1)], "fact_id long, accession string, context_id string, document_id long")
    facts = facts.withColumns({"namespace_uri": F.lit("http://n"), "local_name": F.lit("Assets"), "resolved_numeric": F.lit(1), "is_nil": F.lit(False), "unit_id": F.lit(1), "path": F.lit("clash"), "cik": F.lit("clash").cast("string")}).drop("cik")
    contexts = spark.createDataFrame([("c1", "instant", "2020-12-31", None, None, "x")], "context_id string, period_kind string, instant_lexical string, start_lexical string, end_lexical string, accession string")
    filing = spark.createDataFrame([("a", "7", "2020-12-31")], "accession string, cik string, report_period_end string")
    documents = spark.createDataFrame([(1, "a.htm")], "document_id long, path string")
    found = {(r.fact_id, r.concept, r.cik, r.instant_lexical, r.document) for r in fx.fact_context_join(facts, filing, contexts, documents).collect()}
    assert found == {(1, "{http://n}Assets", "7", "2020-12-31", "a.htm"), (2, "{http://n}Assets", "7", "2020-12-31", None), (5, "{http://n}Assets", "7", "2020-12-31", None)}
