"""The quality report: slots with their decisions and external labels, cells, faults and findings; with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import contracts as cx
from factloom.operators import external as ex
from factloom.operators import quality as qx
from factloom.plans.catalogue import _FRAME, _IDENT, _OPERAND, _SLOT, Model, _sql
from factloom.plans.further import APPLICABLE
from factloom.plans.more import _OBSERVED, _POINTS, LABELS, OBSERVED_ONCE, eligible_values, payloads
from factloom.sources import sinks
from factloom.sources.staging import written, written_by


class QualityFault(Exception):
    """A report that breaks its own rules is not published."""


class Report:
    """The parts of one data folder's report; what several of them read is written once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.model = m = Model(spark, sf_dir)
        self.observations = m.written_observations()
        self.frame = written_by(m.frame(True), "report-frame", "accession")
        #: Every ninth issuer's document is cut off, so that its values cannot be held against anything.
        self.payloads = written(payloads(m).withColumn("json", F.when(F.col("cik").cast("long") % 9 == 0, F.substring("json", 1, 20)).otherwise(F.col("json"))), "report-payloads")
        points = ex.companyfacts_points(self.payloads)
        covered = self.payloads.where(F.get_json_object("json", "$.facts").isNotNull()).select("cik")
        self.comparisons = written_by(ex.oracle_comparisons(self.observations, eligible_values(m), points, covered), "report-comparisons", "accession")
        self.applicable = cx.decision_applicable_slots(self.frame, m.decision, m.declared)

    def slots(self) -> DataFrame:
        return qx.quality_slots(self.observations, self.frame, self.applicable, self.comparisons)

    def cells(self) -> DataFrame:
        return qx.quality_report(self.slots(), self.model.identities(True))


def quality_job(spark: SparkSession, sf_dir: str, path: str, strict: bool = True) -> DataFrame:
    """The whole report of a data folder, written to the path; returns its cells. strict: a broken rule, or a value without an applicable decision, raises QualityFault before anything is written; else they are parts of their own beside the report's."""
    r = Report(spark, sf_dir)
    slots = written(r.slots(), "report-slots")
    cells = written(qx.quality_report(slots, r.model.identities(True)), "report-cells")
    faults, bare = qx.report_faults(cells), qx.value_without_decision(slots)
    if strict and (n := faults.count() + bare.count()):
        raise QualityFault(f"{n} broken rules or values without an applicable decision")
    documents = r.payloads.select(F.lit("oracle").alias("kind"), F.col("cik").alias("key"), F.sha2("json", 256).alias("pin"))
    sources = documents.unionByName(r.frame.select(F.lit("taxonomy").alias("kind"), F.col("accession").alias("key"), F.col("release").alias("pin")))
    sinks.write_quality_report(cells, ex.oracle_findings(r.comparisons), sources, qx.qname_census(r.model.fact), qx.name_reuse(r.model.fact), path)
    if not strict:
        sinks.publish_build({"cells": faults, "slots": bare}, f"{path.rstrip('/')}-faults", "json")
    return cells


QUERIES = {
    "quality_report": lambda spark, sf_dir: Report(spark, sf_dir).cells(),
    "report_faults": lambda spark, sf_dir: qx.report_faults(Report(spark, sf_dir).cells()),
    "value_without_decision": lambda spark, sf_dir: qx.value_without_decision(Report(spark, sf_dir).slots()),
    "oracle_findings": lambda spark, sf_dir: ex.oracle_findings(Report(spark, sf_dir).comparisons),
}

_VIEWS = (*_OBSERVED[0], "b_fact_wide", "b_issuer", "b_declared")
#: Issuers without a readable document have no label.
_SLOTS = f"""
ap as materialized ({APPLICABLE}),
lc as (select accession, metric, case when f.cik::bigint % 9 <> 0 then label else 'na' end label, family, local_name, observation, oracle_values from lb join b_filing f using (accession)),
qs as materialized (
  select o.accession, o.metric, o.status, o.reason, ff.form in ('10-K', '10-K/A') ok, ap.metric is not null applies, lc.label, ff.fiscal_year, ff.release, ff.industry
  from obs o join ff on ff.accession = o.accession join lc on lc.accession = o.accession and lc.metric = o.metric left join ap on ap.accession = o.accession and ap.metric = o.metric)"""
_REPORT = """
ik as (select accession, count_if(status = 'pass') p, count_if(status = 'fail') x, count_if(status = 'not_applicable') n from idn group by accession),
rp as materialized (
  select metric, fiscal_year, release, industry, count(*) n_slots, count_if(ok) n_slot_eligible, count_if(not ok) n_ineligible_wrong_form, count_if(ok and status = 'value') n_value, count_if(ok and status = 'missing') n_missing,
    count_if(ok and status = 'conflict') n_conflict, count_if(ok and status = 'unsupported') n_unsupported, count_if(ok and status = 'unsupported' and reason = 'decision_scope') n_reason_decision_scope,
    count_if(ok and status = 'unsupported' and reason is distinct from 'decision_scope') n_reason_other_unsupported, count_if(applies) n_decision_applicable, count_if(ok) - count_if(applies) n_no_applicable_decision,
    count_if(label = 'agree') oracle_agree, count_if(label = 'differ') oracle_differ, count_if(label = 'absent') oracle_absent, count_if(label = 'ambiguous') oracle_ambiguous, count_if(label = 'na') oracle_na,
    sum(p)::bigint identity_pass, sum(x)::bigint identity_fail, sum(n)::bigint identity_na,
    round(count_if(ok and status = 'value')::double / nullif(count_if(ok), 0), 6) publication_rate, round(count_if(ok and status = 'value')::double / nullif(count_if(applies), 0), 6) selector_yield
  from qs join ik using (accession) group by all)"""
_COMPARED = (*OBSERVED_ONCE, _FRAME, _POINTS, LABELS, _SLOTS)
_CELLS = (*_COMPARED, _SLOT, _OPERAND, _IDENT, _REPORT)

ORACLES = {
    "quality_report": _sql(_VIEWS, "select * from rp", *_CELLS),
    "report_faults": _sql(
        _VIEWS, """select metric, fiscal_year, release, industry, unnest(list_filter([case when n_value + n_missing + n_unsupported + n_conflict <> n_slot_eligible then 'statuses' end, case when n_value > n_decision_applicable then 'values_over_decisions' end],
            lambda x: x is not null)) code from rp""", *_CELLS,
    ),
    "value_without_decision": _sql(_VIEWS, "select accession, metric from qs where status = 'value' and not applies", *_COMPARED),
    "oracle_findings": _sql(_VIEWS, "select accession, metric, label status, family, local_name, observation, oracle_values from lc where label in ('differ', 'ambiguous')", *_COMPARED),
}
