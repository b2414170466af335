"""Checks of chains, metric contracts and evidence, and the slots that a decision could fill."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import scalars as S
from factloom.operators.facts import decision_applies
from factloom.sources.staging import dealt_by, written_by

#: The periods and the unit that a statement allows.
STATEMENTS = {
    "income_statement": (("duration",), "monetary"), "balance_sheet": (("instant",), "monetary"), "cash_flow": (("duration",), "monetary"),
    "per_share": (("duration",), "monetary_per_share"), "shares": (("instant", "duration"), "shares"),
}
KEY_PATTERN = r"^[a-z][a-z0-9_]*$"
SUBSTANTIVE_KINDS = ("filing_fact", "taxonomy", "metalinks")
ANNUAL_FORMS = ("10-K", "10-K/A")


def written(df: DataFrame, name: str) -> DataFrame:
    """df, whose rows lie by document, as a table whose rows do."""
    return written_by(df, name, "doc", lying=True)


def _far(asks: DataFrame, *at: DataFrame) -> DataFrame:
    """asks(doc, end, ...) with far: the end and code that one of the tables at(doc, node, end, code) has for that node, null where none has. All lie by document; they are joined one by one, as a union would be shuffled."""
    names = [f"far_{n}" for n in range(len(at))]
    for name, table in zip(names, at, strict=True):
        asks = asks.join(table.select("doc", F.col("node").alias("end"), F.struct("end", "code").alias(name)), ["doc", "end"], "left")
    return asks.withColumn("far", F.coalesce(*names)).drop(*names)


def continuation_check(nodes: DataFrame, roots: DataFrame, lying: bool = False) -> DataFrame:
    """doc, root, code of the roots whose chain fails: unresolved (a reference to no node), ambiguous (to several), cycle, else reuse (a node that another root's chain has too).

    nodes(doc, node, next), roots(doc, root, start). lying: whether both lie by document already; else they are shuffled so once, and nothing is shuffled after. Each round a node learns the end twice as far away, so a chain of n nodes takes log2(n) rounds; a chain has no more nodes than its
    document, and what is still open then is a cycle. A round writes the nodes alone that were open before it. A node has one successor, so whole chains share a node exactly if they share their end. A document's nodes are one task's, sorted on disk where they are many."""
    nodes, roots = (nodes, roots) if lying else (dealt_by(nodes, "doc"), dealt_by(roots, "doc"))
    once = F.count("*") == 1
    code = F.when(~once, "ambiguous").when(F.min("next").isNull(), "ok").alias("code")
    at = written(nodes.groupBy("doc", "node").agg(F.when(once, F.min("next")).alias("end"), code).withColumn("end", F.when(F.col("code").isNull(), F.col("end")).otherwise(F.col("node"))), "chains")
    step, most = 1, at.groupBy("doc").count().agg(F.max("count")).first()[0] or 0
    open_, done = at.where("code is null"), [at.where("code is not null")]
    known = lambda otherwise: F.when(F.col("far").isNull(), "unresolved").otherwise(otherwise).alias("code")
    while step <= most and not open_.isEmpty():
        now = written(_far(open_.drop("code"), open_, *done).select("doc", "node", F.coalesce("far.end", "end").alias("end"), known(F.col("far.code"))), "chains")
        open_, done = now.where("code is null"), [*done, now.where("code is not null")]
        step *= 2
    walked = _far(roots.select("doc", "root", F.col("start").alias("end")), open_, *done).select("doc", "root", F.col("far.end").alias("end"), known(F.coalesce("far.code", F.lit("cycle"))))
    shared = (F.col("code") == "ok") & (F.count("*").over(Window.partitionBy("doc", "end", "code")) > 1)
    return walked.withColumn("code", F.when(shared, "reuse").otherwise(F.col("code"))).where("code <> 'ok'").select("doc", "root", "code")


def metric_contract_checks(metrics: DataFrame) -> DataFrame:
    """row_id, code of the rules that a metric's contract breaks. metrics: row_id, key, name, kind, statement, period_type, value_kind, unit_dimension, definition, includes, excludes (arrays)."""
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    lists = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.trim(x))
    twice = lambda c: F.size(F.array_distinct(lists(c))) < F.size(lists(c))
    empty = lambda c: (F.size(lists(c)) == 0) | F.exists(lists(c), lambda x: x == "")
    allowed = reduce(lambda out, s: F.when(F.col("statement") == s[0], F.col("period_type").isin(*s[1][0])).otherwise(out), STATEMENTS.items(), F.lit(False))
    unit = reduce(lambda out, s: F.when(F.col("statement") == s[0], F.col("unit_dimension") == s[1][1]).otherwise(out), STATEMENTS.items(), F.lit(False))
    of_row = {
        "malformed_key": ~F.coalesce(F.trim("key").rlike(KEY_PATTERN), F.lit(False)), "blank_text": blank("name") | blank("definition"), "period_of_statement": ~F.coalesce(allowed, F.lit(False)), "unit_of_statement": ~F.coalesce(unit, F.lit(False)),
        "kind": ~F.coalesce(F.col("kind") == "reported", F.lit(False)), "value_kind": ~F.coalesce(F.col("value_kind") == "numeric", F.lit(False)), "empty_list": empty("includes") | empty("excludes"), "repeated_entry": twice("includes") | twice("excludes"),
    }
    rows = metrics.select("row_id", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in of_row.items()]))).alias("code"))
    payload = F.sha2(F.to_json(F.struct("kind", "statement", "period_type", "value_kind", "unit_dimension", "definition", F.array_sort(lists("includes")).alias("i"), F.array_sort(lists("excludes")).alias("e"))), 256)

    def repeats(of, code: str) -> DataFrame:
        """All rows but the first of a group."""
        at = metrics.select("row_id", of.alias("of")).where("of is not null")
        first = at.groupBy("of").agg(F.min("row_id").alias("first"), F.count("*").alias("n")).where("n > 1")
        return at.join(first, "of").where("row_id <> first").select("row_id", F.lit(code).alias("code"))

    return rows.unionByName(repeats(F.trim("key"), "duplicate_key")).unionByName(repeats(payload, "duplicate_payload"))


def evidence_checks(revisions: DataFrame, evidence: DataFrame) -> DataFrame:
    """id, code of accepted or rejected revisions without evidence, or with none that points at a filing or a taxonomy. evidence: id, kind, accession, locator, concept, quote, artifact."""
    there = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    good = (there("accession") & there("locator")) | (there("concept") & (there("quote") | there("artifact"))) | F.coalesce(F.col("kind").isin(*SUBSTANTIVE_KINDS), F.lit(False))
    by = evidence.groupBy("id").agg(F.some(good).alias("good"))
    code = F.when(F.col("good").isNull(), "no_evidence").when(~F.col("good"), "not_substantive")
    return revisions.where("status in ('accepted', 'rejected')").join(by, "id", "left").select("id", code.alias("code")).where("code is not null")


def quality_source(filing: DataFrame, periods: DataFrame, declared: DataFrame, plain_facts: DataFrame) -> DataFrame:
    """accession, report_year, namespace_uri, local_name, declared, filed: the names of a filing, whether it declares them and whether a fact without dimensions has them; once for filings that share an accession and a year."""
    names = ["accession", "namespace_uri", "local_name"]
    d, f = declared.select(*names).distinct().withColumn("d", F.lit(True)), plain_facts.select(*names).distinct().withColumn("f", F.lit(True))
    year = F.coalesce(F.year(F.col("period_end").try_cast("date")), F.year("filing_date"))
    report = filing.select("accession", "filing_date").join(periods.select("accession", "period_end"), "accession", "left").select("accession", year.alias("report_year")).distinct()
    no = F.lit(False)
    return d.join(f, names, "full").join(report, "accession").select(*names, "report_year", F.coalesce("d", no).alias("declared"), F.coalesce("f", no).alias("filed"))


def decision_applicable_slots(frame: DataFrame, decisions: DataFrame, declared: DataFrame) -> DataFrame:
    """accession, metric: slots of annual filings of a known release for which an accepted exact us-gaap decision applies to the issuer and names a concept that the filing
    declares, of its own release unless that is mixed."""
    active = decisions.where("status = 'accepted' and not stale and relation = 'exact' and family = 'us-gaap'").select("metric", "local_name", "family", "issuer_cik", "exclude_ciks", "exclude_qnames")
    annual = frame.where(F.col("form").isin(*ANNUAL_FORMS) & (F.col("release") != "unknown")).select("accession", "cik", "release")
    ns = F.col("namespace_uri")
    names = declared.where(S.namespace_family(ns) == "us-gaap").select("accession", "local_name", S.release_token(ns).alias("of"), S.clark_name(ns, F.col("local_name")).alias("qname")).distinct()
    both = annual.join(names, "accession").where("release = 'mixed' or of = release").join(active, "local_name")
    applies = decision_applies(F.col("cik"), F.col("family")) & ~F.array_contains(F.split("exclude_qnames", ","), F.col("qname"))
    return both.where(applies).select("accession", "metric").distinct()
