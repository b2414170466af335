"""Queries over quarters, continued texts, contracts and evidence; each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators import contracts as cx
from factloom.operators import corpus as px
from factloom.operators import facts as fx
from factloom.operators import quarters as tx
from factloom.plans.catalogue import _ALL, _FRAME, _PERIOD, _SCAN, Model, _sql


def _roles(m: Model) -> DataFrame:
    return tx.period_roles(m.duration)


def _source(m: Model) -> DataFrame:
    m.shared()
    plain = fx.undimensioned(m.fact, m.dimension)
    return cx.quality_source(m.filing, m.periods(False), m.declared, plain)


def _continuations(m: Model) -> DataFrame:
    m.lined("l_orderkey", "l_linenumber", "l_quantity")
    return cx.continuation_check(m.continuation.withColumnRenamed("accession", "doc"), m.continuation_root.withColumnRenamed("accession", "doc"), lying=True)


def _bundles(m: Model) -> DataFrame:
    m.lined("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "form", "fiscal_year")
    return px.bundle_structure(m.file, m.binding, m.file.where("is_primary").select("accession", F.concat(F.lit("u:"), "path").alias("uri")), px.payload_hash(m.bundle_file))


def _contracts(m: Model) -> DataFrame:
    lists = {c: F.split(c, ",") for c in ("includes", "excludes")}
    return cx.metric_contract_checks(m.contract.withColumns(lists))


Q = {
    "period_roles": lambda m: _roles(m).select("fact_id", "role"),
    "derived_fourth_quarter": lambda m: tx.derived_fourth_quarter(_roles(m)),
    "slot_stability": lambda m: tx.slot_stability(_roles(m)),
    "continuation_check": _continuations,
    "metric_contract_checks": _contracts,
    "evidence_checks": lambda m: cx.evidence_checks(m.mapping, m.evidence),
    "quality_source": _source,
    "bundle_structure": _bundles,
    "corpus_checks": lambda m: px.corpus_checks(m.member, m.identity),
    "report_members": lambda m: px.report_members(m.submitted),
    "decision_applicable_slots": lambda m: cx.decision_applicable_slots(m.frame(), m.decision, m.shared().declared),
}
QUERIES = {k: (lambda f: lambda spark, sf_dir: f(Model(spark, sf_dir)))(f) for k, f in Q.items()}

_WIDTH = "case when try_cast(decimals as int) is null then 0 else 0.5 * power(10::double, -try_cast(decimals as int)) end::decimal(28,10)"
_ROLE = f"""
ro as (
  select *, {_WIDTH} hw, case when period_start = required_start and period_end = required_end then case focus when 'FY' then 'annual' when 'Q1' then 'quarter_ytd' else 'ytd' end
    when period_end = required_end and period_start + interval 3 month = period_end + interval 1 day then 'quarter' else 'other' end "role" from b_duration)"""
_BROKEN = {
    "malformed_key": "not regexp_full_match(\"key\", '[a-z][a-z0-9_]*')", "blank_text": "trim(\"name\") = ''",
    "period_of_statement": "not (case statement when 'balance_sheet' then period_type = 'instant' when 'shares' then true else period_type = 'duration' end)",
    "unit_of_statement": "unit_dimension <> case statement when 'per_share' then 'monetary_per_share' when 'shares' then 'shares' else 'monetary' end",
    "kind": "kind <> 'reported'", "empty_list": "excludes = ''", "repeated_entry": "len(list_distinct(string_split(includes, ','))) < len(string_split(includes, ','))",
}

APPLICABLE = """select distinct ff.accession, d.metric from ff join b_declared k on k.accession = ff.accession and regexp_matches(k.namespace_uri, '^https?://(fasb[.]org|xbrl[.]us)/us-gaap/')
  join b_decision d on d.local_name = k.local_name and d.family = 'us-gaap' and d.status = 'accepted' and not d.stale and d.relation = 'exact'
  where ff.form in ('10-K', '10-K/A') and ff.release <> 'unknown' and (ff.release = 'mixed' or ff.release = string_split(k.namespace_uri, '/')[-1])
    and not list_contains(string_split(d.exclude_ciks, ','), ff.cik) and not list_contains(string_split(d.exclude_qnames, ','), '{' || k.namespace_uri || '}' || k.local_name)"""
ORACLES = {
    "period_roles": _sql(("b_duration",), 'select fact_id, "role" from ro', _ROLE),
    "derived_fourth_quarter": _sql(
        ("b_duration",), """select a.cik, a.metric, b.period_end + 1 period_start, a.period_end, (a.v - b.v)::decimal(28,10) "numeric", (a.h + b.h)::decimal(28,10) half_width, a.acc annual_accession, b.acc ytd_accession
          from g a join g b on a.k = 'annual' and b.k = 'ytd' and a.cik = b.cik and a.metric = b.metric and a.period_start = b.period_start and b.period_end < a.period_end""", _ROLE,
        """g as (select cik, metric, period_start, period_end, "role" k, min("numeric") v, min(hw) h, min(accession) acc from ro where "role" = 'annual' or ("role" = 'ytd' and focus = 'Q3') group by all having min("numeric") = max("numeric"))""",
    ),
    "slot_stability": _sql(
        ("b_duration",), """select a.accession, a.cik, a.metric, a.period_start, a.period_end, count(*) comparatives, case when bool_and(a.v - a.h <= b.v + b.h and b.v - b.h <= a.v + a.h) then 'stable' else 'changed' end stability
          from g a join g b on a.k = 'annual' and b.k = 'other' and a.cik = b.cik and a.metric = b.metric and a.period_start = b.period_start and a.period_end = b.period_end and b.filing_date > a.filing_date group by all""", _ROLE,
        """g as (select cik, metric, period_start, period_end, accession, filing_date, "role" k, min("numeric") v, min(hw) h from ro where focus = 'FY' group by all having min("numeric") = max("numeric"))""",
    ),
    "continuation_check": _sql(
        ("b_continuation", "b_continuation_root"), """select accession doc, root, code from (select *, case when c = 'ok' and count(*) over (partition by accession, cur, c) > 1 then 'reuse' else c end code from en) where code <> 'ok'""",
        "ids as (select accession, node, count(*) n, min(\"next\") nx from b_continuation group by all)",
        """wk(accession, root, cur, depth) as (select accession, root, "start", 0 from b_continuation_root union all select w.accession, w.root, i.nx, depth + 1 from wk w join ids i on i.accession = w.accession and i.node = w.cur and i.n = 1 where i.nx is not null and depth < 60)""",
        """en as (select w.accession, w.root, w.cur, case when depth = 60 then 'cycle' when i.n is null then 'unresolved' when i.n > 1 then 'ambiguous' else 'ok' end c
          from (select * from wk qualify row_number() over (partition by accession, root order by depth desc) = 1) w left join ids i on i.accession = w.accession and i.node = w.cur)""", recursive=True,
    ),
    "metric_contract_checks": _sql(
        ("b_contract",), " union all ".join(f"select row_id, '{k}' code from b_contract where {v}" for k, v in _BROKEN.items()) + """
          union all select row_id, 'duplicate_key' from b_contract qualify row_id > min(row_id) over (partition by "key")
          union all select row_id, 'duplicate_payload' from b_contract qualify row_id > min(row_id) over (partition by kind, statement, period_type, value_kind, unit_dimension, definition, list_sort(string_split(includes, ',')), excludes)""",
    ),
    "evidence_checks": _sql(
        ("b_mapping", "b_evidence"), """select m.id, case when e.id is null then 'no_evidence' else 'not_substantive' end code from b_mapping m left join b_evidence e on e.id = m.id
          where m.status in ('accepted', 'rejected') and (e.id is null or not ((e.accession is not null and e.locator is not null) or (e.concept <> '' and e.quote is not null) or e.kind = 'filing_fact'))""",
    ),
    "quality_source": _sql(
        ("b_fact", "b_dimension", "b_declared", "b_filing", "b_dei"), """select accession, namespace_uri, local_name, coalesce(try_cast(substr(p.period_end, 1, 4) as int), year(f.filing_date))::int report_year, bool_or(d) declared, bool_or(not d) filed
          from (select accession, namespace_uri, local_name, true d from b_declared union all select accession, namespace_uri, local_name, false from b_fact where context_id not in (select context_id from b_dimension)) n
          join b_filing f using (accession) left join period p using (accession) group by all""", _PERIOD,
    ),
    "bundle_structure": _sql(
        ("b_file", "b_bundle_file", "b_binding"), """select accession, 'payload_hash' rule, h "name" from pb left join pf using (accession) where h is distinct from h2
          union all select accession, 'path_twice', path from b_file group by accession, path having count(*) > 1 union all select accession, 'uri_twice', uri from b_binding group by accession, uri having count(*) > 1
          union all select distinct accession, case when (accession, path) in (select accession, path from b_file) then 'other_bytes' else 'binding_without_file' end, uri from (select distinct accession, uri, path, digest from b_binding) where (accession, path, digest) not in (select accession, path, digest from b_file)
          union all select accession, 'alias_twice', alias from b_binding where alias is not null group by accession, alias having count(*) > 1
          union all select distinct accession, 'alias_is_address', alias from b_binding where (accession, alias) in (select accession, uri from b_binding)
          union all select accession, 'report_unbound', 'u:' || path from b_file where is_primary and (accession, 'u:' || path) not in (select accession, uri from b_binding)""",
        "pb as (select accession, sha256(string_agg(path || '|' || digest, chr(10) order by path || '|' || digest)) h from b_bundle_file group by 1)", "pf as (select accession, sha256(string_agg(path || '|' || digest, chr(10) order by path || '|' || digest)) h2 from b_file group by 1)",
    ),
    "corpus_checks": _sql(
        ("b_member", "b_identity"), """select accession, 'DUPLICATE_ACCESSION' code from b_member qualify count(*) over (partition by accession) > 1 union all select accession, 'DUPLICATE_ROLE' from b_member qualify count(*) over (partition by "role") > 1
          union all select accession, 'AMENDS_MISSING' from b_member where form like '%/A' and amends is null union all select accession, 'AMENDS_ON_ORIGINAL' from b_member where form not like '%/A' and amends is not null
          union all select accession, 'AMENDS_UNKNOWN' from b_member where amends is not null and amends not in (select accession from b_member) union all select accession, 'BUNDLE_MISSING' from b_member where bundle_id not in (select bundle_id from b_identity)
          union all select m.accession, unnest(list_filter([case when m.accession <> b.accession then 'ACCESSION_MISMATCH' end, case when m.cik <> b.cik then 'CIK_MISMATCH' end, case when m.form <> b.form then 'FORM_MISMATCH' end,
            case when m.filed is not null and m.filed is distinct from b.filed then 'FILED_MISMATCH' end, case when m.policy <> b.policy then 'ACQUISITION_POLICY_MISMATCH' end], lambda x: x is not null)) from b_member m join b_identity b using (bundle_id)""",
    ),
    "report_members": _sql(
        ("b_submitted",), """select accession, kind, case when error is null then row_number() over (partition by accession order by is_primary desc, path)::int end place, path, error
          from (select s.accession, kind, path, error, is_primary from q join b_submitted s on s.accession = q.accession and q.error is null and case kind when 'inline' then is_inline and coalesce(doc_type, '') <> 'Ex-Filing Fees' else is_instance and doc_type = 'EX-101.INS' end
            union all select accession, kind, null, error, false from q where error is not null)""",
        """q as (select accession, case when bi then 'inline' else 'instance' end kind, case when np <> 1 then 'not_one_primary' when bi and fee then 'primary_not_in_set' when not bi and ni <> 1 then 'not_one_instance' end error
          from (select accession, count_if(is_primary) np, bool_or(is_primary and is_inline) bi, bool_or(is_primary and coalesce(doc_type, '') = 'Ex-Filing Fees') fee, count_if(is_instance and coalesce(doc_type, '') = 'EX-101.INS') ni from b_submitted group by 1))""",
    ),
    "decision_applicable_slots": _sql((*_ALL, "b_issuer", "b_declared", "b_decision", "b_dei"), APPLICABLE, _SCAN, _PERIOD, _FRAME),
}
