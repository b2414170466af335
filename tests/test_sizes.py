"""How plans grow: what may be sent whole, what is counted before it is joined, how deep a walk goes."""

from __future__ import annotations

import datetime

from factloom.operators import audits, contracts, corpus, ledger
from factloom.operators import filing_sections as fs
from factloom.sources import staging


def test_tables_of_documents_are_not_sent_whole(spark):
    """Their files are tiny against their rows, so a plan by file sizes would broadcast them."""
    rows = [(d, n, t, None, False, False, 0, 0, 20) for d in range(50) for n, t in enumerate(("Item 1. Business", "Text", "Item 7. Results", "SIGNATURES"))]
    blocks = spark.createDataFrame(rows, "doc_id long, ordinal int, text string, heading_level int, is_bold boolean, has_anchor boolean, internal_links int, link_chars int, total_chars int")
    forms = spark.createDataFrame([(d, "10-K") for d in range(50)], "doc_id long, form string")
    out = fs.section_outcomes(blocks, forms)
    assert out.count() > 0
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_heads_of_one_claim_are_not_paired_with_facts(spark):
    """Two heads of one claim, one of another issuer, one out of its time: facts are touched once a claim, heads get the same sums and ranks."""
    day = datetime.date
    revisions = spark.createDataFrame(
        [(i, None, "c", "m", "exact", kind, cik, None, to, "accepted") for i, kind, cik, to in ((1, "global", None, None), (2, "global", None, None), (3, "issuer", "b", None), (4, "global", None, day(1990, 1, 1)))],
        "id long, supersedes_id long, concept string, metric string, relation string, scope_kind string, issuer_cik string, valid_from date, valid_to date, status string",
    )
    facts = spark.createDataFrame([(n, f"a{n % 2}", "b" if n % 2 else "a", "c", day(1995, 1, 1)) for n in range(6)], "fact_id long, accession string, cik string, concept string, period date")
    heads = ledger.claimed_heads(revisions)
    assert {r.mapping_id: r.claim for r in heads.collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert sorted(tuple(r)[:2] for r in ledger.claimed_facts(heads, facts).collect()) == sorted([(1, n) for n in range(6)] + [(3, n) for n in (1, 3, 5)])
    plain = ledger.affected_facts(revisions, facts)
    assert {tuple(r) for r in ledger.summary_by_head(heads, facts, 5).collect()} == {tuple(r) for r in ledger.affected_summary(plain, 5).collect()} == {(1, 6, 5, True, 2, 2), (2, 6, 5, True, 2, 2), (3, 3, 3, False, 1, 1)}
    top = {tuple(r) for r in ledger.top_by_head(heads, facts, 2).collect()}
    assert top == {tuple(r) for r in ledger.top_facts(plain, 2).select("mapping_id", "fact_id", "rank").collect()} == {(1, 0, 1), (1, 2, 2), (2, 0, 1), (2, 2, 2), (3, 1, 1), (3, 3, 2)}


def test_a_cycle_takes_no_more_rounds_than_its_document_needs(spark, monkeypatch):
    """Each of many documents has a chain of four and a cycle; rounds go by a document's nodes, not by all, and write only what is open."""
    rows = [(f"d{d}", n, {0: 1, 1: 2, 2: 3, 3: None, 4: 5, 5: 4}[n]) for d in range(200) for n in range(6)]
    roots = [(f"d{d}", r, r) for d in range(200) for r in (0, 4)]
    sizes = []

    def kept(df, name):
        out = staging.written(df, name)
        if name == "chains":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(contracts, "written", kept)
    out = contracts.continuation_check(spark.createDataFrame(rows, "doc string, node long, next long"), spark.createDataFrame(roots, "doc string, root long, start long"))
    assert {tuple(r)[1:] for r in out.collect()} == {(4, "cycle")} and out.count() == 200
    assert sizes == [1200, 1000, 800, 400]  # none is open but the cycles after three rounds


def test_differences_count_both_sides_in_one_pass(spark):
    t = lambda rows: spark.createDataFrame(rows, "k string, v int")
    out = audits.symmetric_difference(t([("a", 1), ("a", 1), ("a", 1), ("b", None), ("c", 2)]), t([("a", 1), ("b", None), ("d", None), ("d", None)]))
    assert sorted(tuple(r) for r in out.select("k", "side").collect()) == [("a", "left"), ("a", "left"), ("c", "left"), ("d", "right"), ("d", "right")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1


def test_rows_that_amend_nothing_do_not_meet_in_a_join(spark):
    members = spark.createDataFrame([(1, "a", "1", "10-K", None, "r1", None, "v"), (2, "b", "1", "10-K/A", None, "r2", "a", "v"), (3, "c", "1", "10-K/A", None, "r3", "x", "v")], "bundle_id long, accession string, cik string, form string, filed date, role string, amends string, policy string")
    bundles = members.drop("role", "amends")
    out = corpus.corpus_checks(members, bundles)
    assert [tuple(r) for r in out.collect()] == [("c", "AMENDS_UNKNOWN")]
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line and "amends" in line]
    assert len(joins) == 1 and "LeftAnti" in joins[0]
