"""Cases that earlier code got wrong: refused claims in a batch, new ids, gold by period and reason, null lists, years of filings."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from factloom.operators import facts as fx
from factloom.operators import ledger as lx
from factloom.operators import quality as qx

REVISION = "id long, supersedes_id long, concept string, metric string, relation string, scope_kind string, issuer_cik string, valid_from date, valid_to date, status string"
REVIEW = "mapping_id long, rationale string, evidence int, metric_hash string"


def ledger(spark, claims):
    """claims: (id, concept, scope, issuer, from year, to year, status)."""
    rows = [(i, None, c, "assets", "exact", s, k, None if a is None else f"{a}-01-01", None if b is None else f"{b}-12-31", status) for i, c, s, k, a, b, status in claims]
    return spark.createDataFrame(rows, REVISION.replace(" date", " string")).withColumns({c: F.col(c).cast("date") for c in ("valid_from", "valid_to")})


def accept(spark, claims, reviewed=None):
    reviews = spark.createDataFrame([(i, "ok", 1, "h1") for i, *_, status in claims if status == "candidate"] if reviewed is None else reviewed, REVIEW)
    revisions = ledger(spark, claims)
    out = lx.apply_acceptances(revisions, reviews, spark.createDataFrame([("assets", "h1")], "metric string, hash string"))
    return revisions, reviews, out


def test_a_refused_claim_stands_in_nobodys_way(spark):
    """11 meets 1 and 21; 1 and 21 do not meet."""
    claims = [(1, "c", "global", None, 2000, 2001, "candidate"), (11, "c", "global", None, 2001, 2003, "candidate"), (21, "c", "global", None, 2002, 2004, "candidate"), (22, "d", "global", None, None, None, "accepted")]
    revisions, reviews, out = accept(spark, claims)
    assert {r.mapping_id: (r.error, r.successor_id) for r in out.collect()} == {1: (None, 23), 11: ("conflict", None), 21: (None, 24)}
    new = {r.id: r for r in lx.successors(revisions, out, reviews, "accepted").collect()}
    assert {i: (r.supersedes_id, r.status, r.concept, r.rationale) for i, r in new.items()} == {23: (1, "accepted", "c", "ok"), 24: (21, "accepted", "c", "ok")}


def test_batches_against_one_by_one(spark):
    rng = random.Random(5)
    claims = []
    for i in range(400):
        issuer = rng.choice([None, None, "1", "2", "3"])
        a = rng.choice([None, *range(2000, 2020)])
        b = rng.choice([None, (a or 2000) + rng.randint(0, 5)])
        claims.append((i, rng.choice("abcdefgh"), "issuer" if issuer else "global", issuer, a, b, "accepted" if rng.random() < 0.04 else "candidate"))
    accepted = [c for c in claims if c[6] == "accepted"]
    want = set()
    for c in claims:
        meets = any(c[1] == o[1] and not (c[2] == o[2] == "issuer" and c[3] != o[3]) and (c[4] or 0) <= (o[5] or 9999) and (o[4] or 0) <= (c[5] or 9999) for o in accepted)
        if c[6] == "candidate" and not meets:
            accepted.append(c)
            want.add(c[0])
    out = accept(spark, claims)[2].collect()
    assert {r.mapping_id for r in out if r.error is None} == want and {r.error for r in out} == {None, "conflict"}
    ids = sorted((r.mapping_id, r.successor_id) for r in out if r.error is None)
    assert [s for _, s in ids] == list(range(400, 400 + len(ids)))


def test_reviews_that_cannot_be_followed(spark):
    claims = [(1, "c", "global", None, None, None, "candidate"), (2, "c", "global", None, None, None, "rejected")]
    reviews = [(1, None, 1, "h1"), (2, "ok", 1, "h1"), (3, "ok", 1, "h1")]
    assert {r.mapping_id: r.error for r in accept(spark, claims, reviews)[2].collect()} == {1: "no_rationale", 2: "not_a_candidate", 3: "unknown_mapping"}
    assert accept(spark, claims, [(1, "ok", None, "h1")])[2].first().error == "no_evidence" and accept(spark, claims, [])[2].count() == 0


def test_gold_outcomes(spark):
    observed = [
        ("a", "m1", "value", None, 5, "2000-01-01", "2000-12-31"), ("a", "m2", "value", None, 5, None, "2000-12-31"), ("a", "m3", "missing", "broader_only", None, None, "2000-12-31"),
        ("a", "m4", "unsupported", "wrong_form", None, None, "2000-12-31"), ("a", "m5", "conflict", None, None, None, "2000-12-31"), ("a", "m6", "unsupported", "decision_scope", None, None, "2000-12-31"),
    ]
    o = spark.createDataFrame(observed, "accession string, metric string, status string, reason string, numeric int, period_start string, period_end string").withColumn("numeric", F.col("numeric").cast("decimal(28,10)"))
    gold = [
        ("a", "m1", "duration", "2000-01-01", "2000-12-31", "value", 5, None, "ok"), ("a", "m1", "duration", "1999-01-01", "2000-12-31", "value", 5, None, "period"), ("a", "m1", "instant", None, "2000-12-31", "value", 5, None, "period"),
        ("a", "m1", "duration", "2000-01-01", "2000-12-31", "value", 6, None, "numeric"), ("a", "m2", "instant", None, "2000-12-31", "value", 5, None, "ok"), ("a", "m2", "instant", None, "2000-12-31", "missing", None, None, "status"),
        ("a", "m3", "instant", None, "2000-12-31", "missing", None, "broader_only", "ok"), ("a", "m3", "instant", None, "2000-12-31", "missing", None, None, "reason"), ("a", "m4", "instant", None, "1990-12-31", "unsupported", None, "wrong_form", "ok"),
        ("a", "m4", "instant", None, "2000-12-31", "unsupported", None, "decision_scope", "reason"), ("a", "m5", "instant", None, "2000-12-31", "conflict", None, None, "unknown_status"), ("a", "m6", "instant", None, "2000-12-31", "unsupported", None, "wrong_form", "reason"),
        ("a", "m7", "instant", None, "2000-12-31", "value", 5, None, "absent"), ("b", "m1", "instant", None, "2000-12-31", "value", 5, None, None),
    ]
    for *row, want in gold:
        g = spark.createDataFrame([tuple(row)], "accession string, metric string, kind string, period_start string, period_end string, status string, numeric int, reason string").withColumn("numeric", F.col("numeric").cast("decimal(28,10)"))
        got = qx.gold_join(g, o).collect()
        assert [r.outcome for r in got] == ([] if want is None else [want]), row


def test_null_lists_leave_nobody_out(spark):
    rule = "decision_id string, metric string, family string, local_name string, issuer_cik string, relation string, status string, stale boolean, exclude_ciks string, exclude_qnames string"
    decisions = spark.createDataFrame([("d1", "assets", "us-gaap", "Assets", None, "exact", "accepted", False, None, None), ("d2", "debt", "us-gaap", "Debt", None, "exact", "accepted", False, "7", None)], rule)
    facts = spark.createDataFrame([(1, "acc", "7", "Assets", "us-gaap", "standard", "{u}Assets"), (2, "acc", "7", "Debt", "us-gaap", "standard", "{u}Debt")], "fact_id long, accession string, cik string, local_name string, family string, origin string, source_qname string")
    assert [(r.fact_id, r.decision_id) for r in fx.resolve_supports(facts, decisions).collect()] == [(1, "d1")]
    grid = spark.createDataFrame([("7", "assets"), ("7", "debt"), ("8", "debt"), ("7", "none")], "cik string, metric string")
    assert {(r.cik, r.metric): r.out_of_scope for r in fx.out_of_scope(grid, decisions).collect()} == {("7", "assets"): False, ("7", "debt"): True, ("8", "debt"): False, ("7", "none"): False}


def test_year_of_a_filing(spark):
    """Contexts of other years leave it alone: it is the period's, else that of the period's end, else of the filing date."""
    filing = spark.createDataFrame([("a", "1", "10-K", "2003-02-01"), ("b", "1", "10-K", "2003-02-01"), ("c", "2", "10-K", "2003-02-01"), ("d", "2", "10-K", None)], "accession string, cik string, form string, filing_date string").withColumn("filing_date", F.col("filing_date").cast("date"))
    facts = spark.createDataFrame([("a", "http://fasb.org/us-gaap/2002"), ("b", "http://fasb.org/us-gaap/2002"), ("b", "http://fasb.org/us-gaap/2001")], "accession string, namespace_uri string")
    periods = spark.createDataFrame([("a", "2001", "2002-12-31"), ("b", None, "2002-12-31"), ("c", None, None)], "accession string, year_focus string, period_end string")
    got = {r.accession: (r.fiscal_year, r.release, r.industry) for r in qx.filing_frame(filing, facts, spark.createDataFrame([("1", "retail")], "cik string, industry string"), periods).collect()}
    assert got == {"a": ("2001", "2002", "retail"), "b": ("2002", "mixed", "retail"), "c": ("2003", "unknown", "unknown"), "d": ("unknown", "unknown", "unknown")}
