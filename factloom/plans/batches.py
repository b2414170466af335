"""Queries over batches of filings: extraction, receipts, the acceptance of a corpus, the sync of metrics; each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import scalars as S
from factloom.operators import audits as ax
from factloom.operators import batch as bx
from factloom.operators import facts as fx
from factloom.operators import integrity as ix
from factloom.operators import ledger as lx
from factloom.plans.catalogue import Model, _sql
from factloom.sources import sinks
from factloom.sources.staging import written

VERSION, SETTINGS, LEAST = "e1", ("cache", "mode"), {"n_facts": 2}
#: Columns of lines and filings that facts, declarations, arcs and files are made of.
OF_LINES = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_tax", "l_returnflag", "l_linestatus", "local_name", "period_kind", "years_back", "form", "fiscal_year")


def _documents(m: Model) -> DataFrame:
    """One XML document a filing, of its facts, declarations and arcs. Each thirteenth is cut off, each seventeenth is missing."""
    line = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("line")
    name = F.col("local_name")
    facts = m.fact.select("accession", line("<g:", name, ' contextRef="c', F.col("context_id").cast("string"), '">', F.coalesce(F.col("resolved_numeric").cast("string"), F.lit("")), "</g:", name, ">"))
    declared = m.declared.select("accession", line('<d:element name="', name, '"/>'))
    arcs = m.arc.select("accession", line('<g:arc x:type="arc" x:arcrole="', F.col("arcrole"), '"/>'))
    rows = m.filing.select("accession", "filing_id")
    parts = {"facts": facts, "declared": declared, "arcs": arcs}
    for part, lines in parts.items():  # each lies by accession; their union would be shuffled
        rows = rows.join(lines.groupBy("accession").agg(F.array_join(F.collect_list("line"), "").alias(part)), "accession", "left")
    head = '<g:xbrl xmlns:g="http://example.org/g" xmlns:d="http://www.w3.org/2001/XMLSchema" xmlns:x="http://www.w3.org/1999/xlink">'
    whole = F.concat(F.lit(head), *[F.coalesce(part, F.lit("")) for part in parts], F.lit("</g:xbrl>"))
    content = F.when(F.col("filing_id") % 17 == 0, None).when(F.col("filing_id") % 13 == 0, F.substring(whole, F.lit(1), F.length(whole) - 1)).otherwise(whole)
    return rows.select("accession", content.cast("binary").alias("content"))


def _outcomes(m: Model) -> DataFrame:
    return bx.batch_extract(_documents(m.lined(*OF_LINES)), VERSION)


def _receipts(m: Model) -> DataFrame:
    """Stored reports with their receipts as JSON: times with an offset, inputs in another order."""
    r = m.receipt
    files = [F.concat("accession", F.lit(".htm")), F.lit("extra.xml")]
    of = lambda accession, inputs: F.struct(accession.alias("accession"), F.array(*inputs).alias("inputs"), F.col("form").alias("kind"))
    stored, told, other = of(F.col("accession"), files), of(F.col("input_accession"), files[::-1]), of(F.lit("another"), files)
    config = F.when(F.col("setting_lost"), F.create_map(F.lit("mode"), F.lit("strict"))).otherwise(F.create_map(F.lit("mode"), F.lit("strict"), F.lit("cache"), F.lit("off")))
    digest = F.when(F.col("other_digest"), "0").when(F.col("filing_id") % 2 == 0, bx.canonical_digest(config))
    at = F.col("accepted_at").cast("timestamp")
    time = F.date_format(F.when(F.col("other_time"), at + F.expr("interval 1 hour")).otherwise(at), "yyyy-MM-dd'T'HH:mm:ssXXX")
    filing = F.when(~F.col("no_filing"), F.struct("accession", "cik", F.col("receipt_form").alias("form"), F.col("filing_date").cast("string").alias("filed"), time.alias("accepted_at")))
    inputs = F.when(F.col("n_inputs").isNotNull(), F.concat(F.array(other), F.array_repeat(told, F.col("n_inputs").cast("int"))))
    receipt = F.to_json(F.struct(told.alias("report_input"), F.col("extractor").alias("extractor_version"), F.col("engine").alias("engine_version"), config.alias("semantic_config"), digest.alias("semantic_config_sha256"), F.struct(filing.alias("filing"), inputs.alias("report_inputs")).alias("manifest")))
    key = F.when(F.col("other_key"), F.lit("0")).otherwise(S.report_key(F.col("input_accession"), F.col("form"), F.array(*files)))
    return r.select(
        key.alias("report_key"), "accession", "cik", "form", F.col("filing_date").alias("filed"), at.alias("accepted_at"), stored.alias("report_input"), F.lit("e1").alias("extractor_version"), F.lit("v9").alias("engine_version"),
        F.when(F.col("cut_off"), F.substring(receipt, 1, 30)).otherwise(receipt).alias("receipt"),
    )


def _state(facts: DataFrame) -> DataFrame:
    return facts.groupBy("accession").agg(F.count("*").alias("facts"), F.count_distinct("context_id").alias("contexts"))


def _issues(m: Model) -> DataFrame:
    outcomes = written(_outcomes(m).select("accession", "success"), "batch-outcomes")
    raw, stored = m.fact_wide, m.fact
    inventory = ax.inventory_equality(m.file, m.bundle_file, ["accession", "fact_id"], ["digest"])
    counts = m.filing.select("accession").join(stored.groupBy("accession").agg(F.count("*").alias("n")), "accession", "left").select("accession", F.coalesce("n", F.lit(0)).alias("n_facts"))
    return bx.acceptance_issues(outcomes, ix.fact_completeness(m.filing, raw, stored).select("accession"), inventory, _state(raw), _state(stored), counts, LEAST, each=True)


def _corpus(m: Model) -> DataFrame:
    return m.filing.join(m.issuer, "cik", "left").select("accession", "form", F.coalesce("industry", F.lit("unknown")).alias("industry"))


def acceptance_job(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Accepts or refuses a folder's filings: issues, a summary of each filing and the corpus' gates, written to the path as a whole; returns the gates' one row."""
    m = Model(spark, sf_dir)
    issues = written(_issues(m), "acceptance-issues")
    summary = written(bx.acceptance_summary(m.filing, issues), "acceptance-summary")
    gates = bx.acceptance_gates(_corpus(m), summary)
    sinks.publish_build({"issues": issues.orderBy("accession", "code"), "filings": summary.orderBy("accession"), "gates": gates}, path, "json")
    return gates


def _occurrences(m: Model) -> DataFrame:
    """A fact's document is the file of its line that states a type."""
    filing = m.filing.select("accession", "cik", F.concat(F.col("fiscal_year").cast("string"), F.lit("-12-31")).alias("report_period_end"))
    documents = m.file.where("doc_type is not null").select("accession", F.col("fact_id").alias("document_id"), "path")
    return fx.fact_context_join(m.shared().fact.withColumn("document_id", F.col("fact_id")), filing, m.context, documents, own=("accession",))


Q = {
    "fact_context_join_full": _occurrences,
    "batch_extract": lambda m: _outcomes(m).select("accession", "success", *bx.COUNTS, "failure_class"),
    "receipt_checks": lambda m: bx.receipt_checks(_receipts(m), SETTINGS).select("accession", "code"),
    "sync_metrics": lambda m: lx.sync_metrics(m.metric_mirror, m.metric_source, m.metric_use),
    "acceptance_issues": _issues,
    "acceptance_summary": lambda m: bx.acceptance_summary(m.filing, _issues(m)),
}
QUERIES = {k: (lambda f: lambda spark, sf_dir: f(Model(spark, sf_dir)))(f) for k, f in Q.items()}

_ISSUES = """
fl as (select accession from b_filing where filing_id % 17 = 0 or filing_id % 13 = 0),
st as (
  select accession, count(*) n, count(distinct context_id) c from b_fact group by 1),
sw as (select accession, count(*) n, count(distinct context_id) c from b_fact_wide group by 1),
cn as (select accession, coalesce(st.n, 0) n, coalesce(sw.n, 0) w, coalesce(st.c, 0) <> coalesce(sw.c, 0) other_contexts from b_filing left join st using (accession) left join sw using (accession)),
ai as (
  select accession, 'source' component, 'SOURCE_EXTRACT_FAILED' code, 1::bigint n from fl
  union all select * from (
    select accession, 'completeness' component, 'FACT_COUNT_MISMATCH' code, 1::bigint n from cn where n <> w union all select accession, 'idempotency', 'FACT_COUNT_CHANGED', 1 from cn where n <> w
    union all select accession, 'idempotency', 'CANONICAL_SNAPSHOT_CHANGED', 1 from cn where other_contexts union all select accession, 'probe', 'ROLE_PROBE_BELOW_MINIMUM', 1 from cn where n < 2
    union all select a.accession, 'completeness', 'DOCUMENT_INVENTORY_MISMATCH', count(*) from b_file a left join b_bundle_file b on b.accession = a.accession and b.fact_id = a.fact_id where b.fact_id is null or b.digest <> a.digest group by 1)
  where accession not in (select accession from fl))"""
_OF = ("b_filing", "b_fact", "b_fact_wide", "b_file", "b_bundle_file")

ORACLES = {
    "fact_context_join_full": _sql(
        ("b_fact", "b_filing", "b_context", "b_file"), """select f.fact_id, '{' || f.namespace_uri || '}' || f.local_name concept, f.accession, b.cik, b.fiscal_year::varchar || '-12-31' report_period_end, f.resolved_numeric, f.is_nil, f.unit_id, f.context_id, c.period_kind, c.instant_lexical, c.start_lexical,
          c.end_lexical, d.path "document" from b_fact f join b_filing b on b.accession = f.accession join b_context c on c.context_id = f.context_id left join (select fact_id, path from b_file where doc_type is not null) d on d.fact_id = f.fact_id""",
    ),
    "batch_extract": _sql(
        ("b_filing", "b_fact", "b_declared", "b_arc"), """select accession, w is null success, case when w is null then coalesce(a, 0) end fact_count, case when w is null then coalesce(b, 0) end declaration_count, case when w is null then coalesce(c, 0) end relationship_count, w failure_class
          from (select accession, case when filing_id % 17 = 0 then 'NoContent' when filing_id % 13 = 0 then 'ExpatError' end w from b_filing) left join (select accession, count(*) a from b_fact group by 1) using (accession)
          left join (select accession, count(*) b from b_declared group by 1) using (accession) left join (select accession, count(*) c from b_arc group by 1) using (accession)""",
    ),
    "receipt_checks": _sql(
        ("b_receipt",), """select * from (select accession, case when cut_off then 'malformed' when setting_lost then 'config_form' when other_digest then 'config_digest' when input_accession <> accession then 'report_input' when other_key then 'report_key'
          when extractor <> 'e1' then 'extractor_version' when engine <> 'v9' then 'engine_version' when n_inputs is null then 'no_manifest_inputs' when n_inputs <> 1 then 'not_once' when no_filing then 'no_manifest_filing'
          when receipt_form <> form or (other_time and accepted_at is not null) then 'filing' end code from b_receipt) where code is not null""",
    ),
    "sync_metrics": _sql(
        ("b_metric_source", "b_metric_mirror", "b_metric_use"), """select coalesce(s.metric, o.metric) metric, case when o.metric is null then 'added' when s.hash = o.hash then 'unchanged' when s.metric is not null then 'changed' when o.metric in (select metric from b_metric_use) then 'blocked' else 'removed' end "action",
          case when s.metric is null and o.metric in (select metric from b_metric_use) then o.hash else s.hash end hash from b_metric_source s full join b_metric_mirror o on o.metric = s.metric""",
    ),
    "acceptance_issues": _sql(_OF, "select * from ai", _ISSUES),
    "acceptance_summary": _sql(
        _OF, """select accession, coalesce(s, 0) = 0 extracted, coalesce(s, 0) = 0 and coalesce(c, 0) = 0 complete, coalesce(s, 0) = 0 and coalesce(i, 0) = 0 idempotent, coalesce(n, 0) = 0 accepted, coalesce(n, 0) issues
          from b_filing left join (select accession, count_if(component = 'source') s, count_if(component = 'completeness') c, count_if(component = 'idempotency') i, sum(n)::bigint n from ai group by 1) using (accession)""", _ISSUES,
    ),
}
