"""Batches that partly fail, receipts, the acceptance of a corpus and the sync of metrics."""

from __future__ import annotations

import datetime
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from factloom.operators import batch as bx
from factloom.operators import ledger as lx
from factloom.plans import batches
from factloom.sources import sinks
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(batches.ORACLES))
def test_equals_sql(spark, name):
    assert compare(spark, connect(SF), name, batches.QUERIES[name], batches.ORACLES[name], SF) is None


def items(spark, rows):
    return spark.createDataFrame([(a, None if c is None else bytearray(c)) for a, c in rows], "accession string, content binary")


def test_a_failing_item_is_a_row(spark, tmp_path):
    page = b'<x xmlns:d="http://www.w3.org/2001/XMLSchema" xmlns:k="http://www.w3.org/1999/xlink"><a contextRef="c"/><b contextRef="c"><d:element name="n"/></b><d:element/><element name="n"/><r k:type="arc"/><r type="arc"/></x>'
    rows = [("a", page), ("b", page[:-3]), ("c", None), ("d", b""), ("a", b"<x/>"), (None, b"<x/>"), ("long", b"<x>" + b'<a contextRef="c">t</a>' * 50000 + b"</x>")]
    out = bx.batch_extract(items(spark, rows), "e7").withColumn("extra", F.lit(1)).persist()
    found = {(r.accession, r.success, r.fact_count, r.declaration_count, r.relationship_count, r.failure_class) for r in out.collect()}
    assert found == {("a", True, 2, 1, 1, None), ("a", True, 0, 0, 0, None), (None, True, 0, 0, 0, None), ("long", True, 50000, 0, 0, None), ("b", False, None, None, None, "ExpatError"), ("c", False, None, None, None, "NoContent"), ("d", False, None, None, None, "ExpatError")}
    assert all(r.extractor_version == "e7" and r.seconds >= 0 and (r.failure_message is None) == r.success for r in out.collect())
    sinks.write_batch_report(out.drop("extra"), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).where("not success").count() == 3
    assert bx.batch_extract(items(spark, []), "e7").count() == 0


def test_whatever_an_extractor_does(spark):
    def odd(content):
        if content == b"memory":
            raise MemoryError("full")
        return (1, 2) if content == b"two" else ("7", 8, 9) if content == b"text" else None

    found = {r.accession: (r.success, r.fact_count, r.failure_class) for r in bx.batch_extract(items(spark, [(n, n.encode()) for n in ("memory", "two", "text", "none")]), "e7", odd).collect()}
    assert found == {"memory": (False, None, "MemoryError"), "two": (False, None, "ValueError"), "text": (True, 7, None), "none": (False, None, "TypeError")}


ROW = "report_key string, accession string, cik string, form string, filed date, accepted_at timestamp, report_input struct<accession:string,inputs:array<string>,kind:string>, extractor_version string, engine_version string, receipt string, code string"


def test_receipts(spark):
    of = {"accession": "a1", "inputs": ["x", "b"], "kind": "inline"}
    key = hashlib.sha256(json.dumps(of | {"inputs": ["b", "x"]}, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    config = {"mode": 'st"rict', "cache": "off"}
    digest = hashlib.sha256(json.dumps(config, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    filing = {"accession": "a1", "cik": "7", "form": "10-K", "filed": "2020-02-03", "accepted_at": "2020-02-03T12:00:00+02:00"}
    good = {"report_input": of, "extractor_version": "e1", "engine_version": "v9", "semantic_config": config, "semantic_config_sha256": digest, "manifest": {"filing": filing, "report_inputs": [{"accession": "a2"}, of | {"inputs": ["b", "x"]}]}}
    manifest = lambda **x: {"manifest": good["manifest"] | x}
    told = {
        None: good, "config_form": good | {"semantic_config": {"mode": "strict"}}, "config_digest": good | {"semantic_config_sha256": "0"}, "report_input": good | {"report_input": of | {"kind": "instance"}}, "extractor_version": good | {"extractor_version": None},
        "engine_version": good | {"engine_version": "v8"}, "no_manifest_inputs": good | manifest(report_inputs=None), "not_once": good | manifest(report_inputs=[of, of]), "no_manifest_filing": good | manifest(filing=None),
        "filing": good | manifest(filing=filing | {"accepted_at": "2020-02-03T12:00:00"}), "malformed": None, "report_key": good,
    }
    rows = [("0" if code == "report_key" else key, code or "good", "7", "10-K", datetime.date(2020, 2, 3), None, ("a1", ["b", "x"], "inline"), "e1", "v9", None if told[code] is None else json.dumps(told[code])) for code in told]
    rows.append((key, "none stated", "7", "10-K", datetime.date(2020, 2, 3), None, ("a1", ["b", "x"], "inline"), "e1", "v9", json.dumps(good | {"semantic_config_sha256": None})))
    rows.append((key, "not json", "7", "10-K", None, None, None, None, None, "{"))
    df = spark.createDataFrame(rows, ROW.removesuffix(", code string")).withColumns({"accepted_at": F.expr("timestamp '2020-02-03 10:00:00Z'"), "case": F.col("accession"), "accession": F.when(F.col("accession") == "not json", "not json").otherwise("a1")})
    # the accession is every row's; the case is told by what its receipt states
    found = sorted(r.code for r in bx.receipt_checks(df, ("mode", "cache")).collect())
    assert found == sorted([c for c in told if c] + ["malformed"])
    clash = df.where("case = 'filing'").withColumns({"code": F.lit("x"), "manifest": F.lit("x"), "filing": F.lit("x")})  # columns of clashing names
    assert [tuple(r) for r in bx.receipt_checks(clash, ("mode", "cache")).collect()] == [("a1", key, "filing")]
    assert bx.receipt_checks(df.limit(0), ("mode",)).count() == 0


def test_acceptance(spark):
    t = lambda rows, schema: spark.createDataFrame(rows, schema)
    corpus = t([(a, form, ind) for a, form, ind in (("a", "10-K", "x"), ("b", "10-K", "y"), ("c", "10-Q", "x"), ("d", "10-Q", "x"), ("e", "10-Q/A", "x"))], "accession string, form string, industry string")
    run = lambda n: t([("a", n, 1), ("b", 2, n), ("c", 2, 2)], "accession string, facts long, contexts long")
    accessions = lambda *a: t([(x,) for x in a], "accession string")
    issues = bx.acceptance_issues(
        t([("a", True), ("b", True), ("d", False), ("d", False)], "accession string, success boolean"), accessions("c", "d"), accessions("c", "c"), run(1), run(3), t([("a", 5), ("e", 1)], "accession string, n_facts long"), {"n_facts": 2}
    ).persist()
    assert {tuple(r) for r in issues.collect()} == {
        ("d", "source", "SOURCE_EXTRACT_FAILED", 2), ("c", "completeness", "FACT_COUNT_MISMATCH", 1), ("c", "completeness", "DOCUMENT_INVENTORY_MISMATCH", 2), ("a", "idempotency", "FACT_COUNT_CHANGED", 1), ("b", "idempotency", "CANONICAL_SNAPSHOT_CHANGED", 1),
        ("e", "probe", "ROLE_PROBE_BELOW_MINIMUM", 1),
    }
    summary = bx.acceptance_summary(corpus, issues)
    assert {r.accession: tuple(r)[1:] for r in summary.collect()} == {"a": (True, True, False, False, 1), "b": (True, True, False, False, 1), "c": (True, False, True, False, 3), "d": (False, False, False, False, 2), "e": (True, True, True, False, 1)}
    assert tuple(bx.acceptance_gates(corpus, summary).first()) == (5, 0, "", False)
    clean = bx.acceptance_summary(corpus, issues.limit(0))
    assert tuple(bx.acceptance_gates(corpus, clean).first()) == (5, 5, "", True)
    assert tuple(bx.acceptance_gates(corpus.where("industry = 'x'"), clean).first())[2:] == ("two_10k,multiple_industries", False)
    assert not bx.acceptance_gates(corpus.limit(0), clean.limit(0)).first().passed


def test_acceptance_is_written(spark, tmp_path):
    path = str(tmp_path / "run")
    gates = batches.acceptance_job(spark, SF, path).first()
    assert not gates.passed and 0 < gates.accepted < gates.filings
    assert spark.read.json(f"{path}/filings").where("accepted").count() == gates.accepted and spark.read.json(f"{path}/issues").count() > 0
    with pytest.raises(FileExistsError):
        batches.acceptance_job(spark, SF, path)


def test_sync(spark):
    t = lambda rows: spark.createDataFrame(rows, "metric string, hash string")
    mirror, source = t([("same", "1"), ("null", None), ("new_hash", "1"), ("gone", "1"), ("named", "1")]), t([("same", "1"), ("null", None), ("new_hash", "2"), ("added", "1")])
    named = lambda *m: spark.createDataFrame([(x, 1) for x in m], "metric string, id int")
    actions = lx.sync_metrics(mirror, source, named("named", "named", "same"))
    assert {tuple(r) for r in actions.collect()} == {("same", "unchanged", "1"), ("null", "unchanged", None), ("new_hash", "changed", "2"), ("gone", "removed", None), ("named", "blocked", "1"), ("added", "added", "1")}
    with pytest.raises(lx.BlockedRemoval, match="named"):
        lx.synced_mirror(actions)
    after = lx.synced_mirror(lx.sync_metrics(mirror, source, named("same")))
    assert {tuple(r) for r in after.collect()} == {tuple(r) for r in source.collect()}
    assert {r.action for r in lx.sync_metrics(mirror.limit(0), source, named()).collect()} == {"added"}
