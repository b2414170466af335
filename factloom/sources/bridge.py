"""The filing model as views over the given tables: filings from orders, facts from lineitem, issuers from customer, revisions from supplier.

The texts hold in Spark SQL and in the checking engine alike. Each view's own text names the views it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = "region nation customer supplier part orders lineitem events documents pages".split()
#: Items of a report in their order, with the part of each.
_REPORT = {"annual": "1 1A 1B 1C 2 3 4/5 6 7 7A 8 9 9A 9B 9C/10 11 12 13 14/15 16", "quarterly": "1 2 3 4/1 1A 2 3 4 5 6"}
_REPORT_ITEMS = " union all ".join(
    f"select '{family}' as family, {100 * part + place} as k, {part} as part, '{item}' as item" for family, parts in _REPORT.items() for part, items in enumerate(parts.split("/"), 1) for place, item in enumerate(items.split(), 1)
)

VIEWS = {
    "b_filing": """
select o_orderkey as filing_id, lpad(cast(o_custkey as string), 10, '0') as cik,
  concat(lpad(cast(o_custkey as string), 10, '0'), '-', lpad(cast(year(o_orderdate) % 100 as string), 2, '0'), '-', lpad(cast(o_orderkey as string), 6, '0')) as accession,
  case o_orderpriority when '2-HIGH' then '10-K/A' when '3-MEDIUM' then '10-Q' when '4-NOT SPECIFIED' then '10-Q/A' else '10-K' end as form,
  cast(o_orderdate as date) as filing_date, case when o_orderstatus = 'P' then null else o_orderdate end as accepted_at,
  cast(year(o_orderdate) - 1 as int) as fiscal_year
from orders""",
    "b_issuer": "select lpad(cast(c_custkey as string), 10, '0') as cik, c_name as name, case when c_custkey % 11 = 0 then null else lower(c_mktsegment) end as industry from customer",
    # (l_orderkey, l_linenumber) repeats, so all columns order the facts
    "b_line": """
select l.*, l_orderkey * 1000 + row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey,
    l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) as fact_id,
  case when l_partkey % 60 = 2 then 'StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest' when l_partkey % 60 = 8 then 'MinorityInterest'
    when l_partkey % 12 = 9 then 'NetIncomeLossAttributableToNoncontrollingInterest' else case l_partkey % 6 when 0 then 'Assets' when 1 then 'Liabilities' when 2 then 'StockholdersEquity' when 3 then 'NetIncomeLoss' when 4 then 'Revenues' else 'ProfitLoss' end end as local_name,
  case when l_partkey % 6 < 3 then 'instant' else 'duration' end as period_kind,
  case when l_linenumber = 7 then 1 else 0 end as years_back
from lineitem l""",
    "b_fact_wide": """
select l.fact_id, f.filing_id, f.accession, f.cik, f.form, f.fiscal_year,
  case when l_suppkey % 10 = 0 then concat('http://www.issuer', f.cik, '.com/', cast(f.fiscal_year as string))
    else concat(case when l_suppkey % 10 = 1 then 'https' else 'http' end, '://fasb.org/us-gaap/', cast(f.fiscal_year - cast(l_suppkey % 2 as int) as string)) end as namespace_uri,
  l.local_name, concat(f.accession, '|', l.period_kind, '|', cast(l.years_back as string), '|', case when l_returnflag = 'R' and l_linestatus = 'F' then 'd' else 'u' end) as context_id,
  l.period_kind, l.years_back, (l_returnflag = 'R' and l_linestatus = 'F') as has_dimensions, l_quantity = 1 as is_nil,
  case when l_quantity = 2 then 'invalid' else 'valid' end as value_status, cast(round(l_tax * 100) as int) as unit_id,
  cast(floor(l_extendedprice / 20000) * 20000 as decimal(28,10)) as resolved_numeric,
  case l_linenumber when 1 then case when l_partkey % 2 = 0 then '-6' else '-06' end when 2 then '-3' when 3 then case when l_suppkey % 2 = 0 then 'INF' else 'inf' end when 4 then null when 5 then '0' when 6 then '-5' else '-4' end as decimals
from b_line l join b_filing f on f.filing_id = l.l_orderkey""",
    "b_fact": "select fact_id, accession, namespace_uri, local_name, context_id, unit_id, value_status, is_nil, resolved_numeric, decimals from b_fact_wide where fact_id % 97 <> 0",
    "b_concept": "select distinct namespace_uri, local_name from b_fact_wide where fact_id % 89 <> 0",
    "b_context": """
select distinct context_id, accession, case when fiscal_year % 7 = 0 and has_dimensions then 'http://example.org/id' else 'http://www.sec.gov/CIK' end as entity_scheme, cik as entity_identifier, period_kind,
  case when period_kind = 'instant' then concat(cast(fiscal_year - years_back as string), '-12-31') end as instant_lexical,
  case when period_kind = 'duration' then concat(cast(fiscal_year - years_back as string), '-01-01') end as start_lexical,
  case when period_kind = 'duration' then concat(cast(fiscal_year - years_back as string), '-12-31') end as end_lexical
from b_fact_wide where fact_id % 101 <> 0 or not has_dimensions""",
    "b_dimension": "select distinct context_id, 'us-gaap:StatementBusinessSegmentsAxis' as dimension, concat('seg', cast(filing_id % 3 as string)) as member from b_fact_wide where has_dimensions",
    "b_unit_measure": """
select u.unit_id, m.side, m.ordinal, m.ns, m.name from (select distinct unit_id from b_fact_wide) u join (
  select 'numerator' as side, 0 as ordinal, 'http://www.xbrl.org/2003/iso4217' as ns, 'USD' as name, 0 as lo, 6 as hi union all
  select 'numerator', 0, 'http://www.xbrl.org/2003/iso4217', 'USD', 7, 7 union all select 'denominator', 0, 'http://www.xbrl.org/2003/instance', 'shares', 7, 7 union all
  select 'numerator', 0, 'http://www.xbrl.org/2003/iso4217', 'EUR', 8, 8) m on u.unit_id between m.lo and m.hi""",
    "b_dei": """
select filing_id * 10 + n as fact_id, accession, cik, case when filing_id % 31 = 0 then 'http://example.org/id' else 'http://www.sec.gov/CIK' end as entity_scheme, cik as entity_identifier,
  case when filing_id % 29 = 0 then 'instant' else 'duration' end as period_kind,
  case when filing_id % 37 = 0 or filing_id % 29 = 0 then null else concat(cast(fiscal_year as string), '-01-01') end as start_lexical,
  concat(cast(fiscal_year - case when filing_id % 13 = 0 then n else 0 end as string), '-12-31') as end_lexical,
  concat(case when n = 1 then ' ' else '' end, cast(fiscal_year as string), case when filing_id % 17 = 0 or filing_id % 19 = 0 then '-12-30' else '-12-31' end) as value,
  cast(fiscal_year as string) as year_focus, case when form in ('10-K', '10-K/A') then 'FY' else 'Q1' end as period_focus
from b_filing, (select 0 as n union all select 1) where filing_id % 23 <> 0 and (n = 0 or filing_id % 13 = 0 or filing_id % 19 = 0 or filing_id % 5 = 0)""",
    "b_metric": """
select 'assets' as metric, 'instant' as period_type, 1 as position union all select 'liabilities', 'instant', 2 union all select 'equity', 'instant', 3 union all
select 'net_income', 'duration', 4 union all select 'revenue', 'duration', 5""",
    "b_decision": """
select 'd1' as decision_id, 'assets' as metric, 'us-gaap' as family, 'Assets' as local_name, '' as issuer_cik, 'exact' as relation, 'accepted' as status, false as stale, '' as exclude_ciks, '' as exclude_qnames union all
select 'd2', 'liabilities', 'us-gaap', 'Liabilities', '', 'exact', 'accepted', false, '', '{http://fasb.org/us-gaap/1994}Liabilities' union all
select 'd3', 'equity', 'us-gaap', 'StockholdersEquity', '', 'exact', 'accepted', false, '', '' union all
select 'd4', 'net_income', 'us-gaap', 'NetIncomeLoss', '', 'exact', 'accepted', false, '0000000002,0000000005,0000000010', '' union all
select 'd5', 'net_income', 'us-gaap', 'ProfitLoss', '', 'broader', 'accepted', false, '', '' union all
select 'd6', 'revenue', 'us-gaap', 'Revenues', '', 'exact', 'accepted', false, '0000000001,0000000004,0000000007,0000000008', '' union all
select 'd7', 'revenue', 'issuer', 'Revenues', '0000000007', 'exact', 'accepted', false, '', '' union all
select 'd8', 'assets', 'us-gaap', 'Liabilities', '', 'exact', 'accepted', true, '', '' union all
select 'd9', 'equity', 'us-gaap', 'Assets', '', 'exact', 'candidate', false, '', ''""",
    # the files of a filing, as its directory has them; and the same as a bundle recorded them: some lost, some of other bytes
    "b_file": """
select f.filing_id, f.accession, f.form, l.fact_id, case l_linenumber when 1 then concat(f.accession, case when l_suppkey % 2 = 0 then '.txt' else '-index.htm' end) when 2 then concat('R', cast(l_suppkey as string), '.htm')
    when 3 then concat('abc-', cast(f.fiscal_year as string), case l_suppkey % 3 when 0 then '_pre.xml' when 1 then '_cal.xml' else '.xsd' end) when 4 then concat('form', cast(l_suppkey as string), '.htm')
    when 5 then concat('img', cast(l_suppkey as string), '.JPG') when 6 then case when l_suppkey % 2 = 0 then 'MetaLinks.json' else 'report_viewer.css' end else concat('ex', cast(l_suppkey as string), '.pdf') end as path,
  case when l_linenumber = 4 then f.form when l_linenumber = 7 then case when l_suppkey % 2 = 0 then 'EX-99' end end as doc_type, case when l_linenumber = 7 and l_suppkey % 4 = 1 then 'Graphic of the year' end as description,
  l_linenumber = 4 as is_primary, cast(l_partkey as string) as digest, cast(floor(l_extendedprice) as bigint) as size
from b_line l join b_filing f on f.filing_id = l.l_orderkey""",
    "b_bundle_file": "select accession, path, case when fact_id % 13 = 0 then concat(digest, 'x') else digest end as digest, size, fact_id from b_file where fact_id % 17 <> 0",
    "b_arc": """
select l.fact_id, f.accession, l.local_name as source_name, case l_suppkey % 5 when 0 then 'Segment' when 1 then 'Assets' else case when l_linenumber % 2 = 0 then 'Revenues' else 'ProfitLoss' end end as target_name,
  case l_linenumber when 1 then 'http://www.xbrl.org/2003/arcrole/parent-child' when 2 then 'http://www.xbrl.org/2003/arcrole/summation-item' when 3 then 'http://xbrl.org/int/dim/arcrole/domain-member'
    when 4 then 'http://www.xbrl.org/2003/arcrole/concept-label' when 5 then 'http://www.xbrl.org/2003/arcrole/fact-footnote' when 6 then 'http://xbrl.org/arcrole/2008/element-label' else 'http://example.org/arcrole/own' end as arcrole,
  case when l_suppkey % 2 = 0 then 'link:definitionLink' else 'link:presentationLink' end as link_tag
from b_line l join b_filing f on f.filing_id = l.l_orderkey""",
    "b_declared": "select distinct accession, namespace_uri, local_name, case when local_name in ('Assets', 'Liabilities') then 'debit' when local_name = 'Revenues' then 'credit' end as balance, period_kind as period_type from b_fact_wide where fact_id % 5 <> 0",
    "b_issue": """
select f.accession, case l_linenumber when 1 then 'xbrl' when 2 then 'html' else 'source' end as component, concat('E', cast(l_suppkey % 9 as string)) as code,
  case when l_quantity = 3 then 'fatal' when l_quantity < 20 then 'warning' when l_quantity < 40 then 'info' else 'error' end as severity, cast(l_quantity as int) as occurrences, l.fact_id as id
from b_line l join b_filing f on f.filing_id = l.l_orderkey where l_quantity % 2 = 1""",
    # blocks of long documents: a supplier's lines, some of which open an item or a part, close the document or head its contents
    "b_block": """
select l_suppkey as doc_id, cast(row_number() over (partition by l_suppkey order by fact_id) - 1 as int) as ordinal,
  case when l_quantity = 5 then concat('Item ', cast(l_partkey % 15 + 1 as string), case when l_linenumber = 1 then 'A' else '' end, '. Overview', case when l_linestatus = 'F' then ' 12' else '' end)
    when l_quantity = 6 then concat('Item 7. Results Item ', cast(l_partkey % 15 + 1 as string), '. More') when l_quantity = 7 then concat('PART ', case l_partkey % 4 when 0 then 'I' when 1 then 'II' when 2 then 'III' else 'IV' end)
    when l_quantity = 8 then 'SIGNATURES' when l_quantity = 9 and l_linenumber = 1 then 'Table of Contents' else concat('Text of line ', cast(fact_id as string)) end as text,
  case when l_discount >= 0.08 then 2 end as heading_level, l_tax = 0.01 as is_bold, l_tax = 0.02 as has_anchor, cast(l_linenumber % 4 as int) as internal_links,
  cast(l_partkey % 40 as int) as link_chars, cast(20 + l_partkey % 300 as int) as total_chars
from b_line""",
    # reports made of documents: a contents table (even ids), parts and items in the form's order with their text, a closing marker. Some lack their part lines, open two items at once or have two places for the second part
    "b_report": "select doc_id, text as body, case doc_id % 5 when 0 then '10-K' when 1 then '10-Q' when 2 then '10-K/A' when 3 then '10-Q/A' else '10-Q' end as form, case when doc_id % 5 in (0, 2) then 'annual' else 'quarterly' end as family from documents",
    "b_report_item": f"""
select r.doc_id, r.family, i.k, i.part, i.item, r.body from b_report r join ({_REPORT_ITEMS}) i on i.family = r.family where (r.doc_id * 31 + i.k) % 17 <> 0""",
    "b_report_line": """
select doc_id, k * 10 + 1000 as spot, case when doc_id % 11 = 0 and item = '7' then 'Item 7. Discussion and Item 8. Statements' else concat('Item ', item, '. Heading') end as text, true as heading, 0 as links from b_report_item union all
select doc_id, k * 10 + 1001, case when item = '1' then body else concat('Text of item ', item) end, false, 0 from b_report_item union all
select doc_id, k, concat('Item ', item, '. Heading ', cast(k as string)), false, 1 from b_report_item where doc_id % 2 = 0 union all
select doc_id, 0, 'Table of Contents', false, 0 from b_report where doc_id % 2 = 0 union all
select doc_id, n * 1000 + 1005, concat('PART ', case n when 1 then 'I' when 2 then 'II' when 3 then 'III' else 'IV' end), true, 0 from b_report, (select 1 as n union all select 2 union all select 3 union all select 4) p where doc_id % 7 <> n % 4 and (n < 3 or family = 'annual') union all
select doc_id, 3065, 'Part II (continued)', true, 0 from b_report where doc_id % 13 = 3 union all
select doc_id, 9000, 'SIGNATURES', doc_id % 3 = 0, 0 from b_report where doc_id % 9 <> 0 union all
select doc_id, 9001, 'Signed.', false, 0 from b_report""",
    "b_report_block": """
select doc_id, cast(row_number() over (partition by doc_id order by spot) - 1 as int) as ordinal, text, cast(case when heading then 2 end as int) as heading_level, false as is_bold, false as has_anchor,
  links as internal_links, cast(case when links > 0 then length(text) else 0 end as int) as link_chars, cast(length(text) as int) as total_chars
from b_report_line""",
    # proposals, acceptances and rejections of mapping revisions, one batch of each
    "b_proposal": """
select s_suppkey as proposal_id, concat('{http://fasb.org/us-gaap/', cast(1990 + s_nationkey % 10 as string), '}', case s_suppkey % 3 when 0 then 'Assets' when 1 then 'Revenues' else 'Nothing' end) as concept,
  case s_suppkey % 4 when 0 then 'assets' when 1 then 'revenue' when 2 then 'equity' else 'none' end as metric, case when s_suppkey % 5 = 0 then 'old' else 'h1' end as metric_hash,
  case when s_suppkey % 6 = 1 then lpad(cast(s_suppkey * 40 as string), 10, '0') end as issuer_cik
from supplier""",
    # chains of up to four revisions for each supplier and metric; the last may be rejected
    "b_mapping": """
select s_suppkey * 100 + m.position * 10 + k as id, case when k > 0 then s_suppkey * 100 + m.position * 10 + k - 1 end as supersedes_id,
  concat('{http://fasb.org/us-gaap/', cast(1990 + s_nationkey % 8 as string), '}', m.name) as concept, m.metric, case when s_suppkey % 3 = 0 then 'broader' else 'exact' end as relation,
  case when s_suppkey % 4 = 1 then 'issuer' else 'global' end as scope_kind, case when s_suppkey % 4 = 1 then lpad(cast(s_nationkey as string), 10, '0') end as issuer_cik,
  case when s_nationkey % 5 = 0 then null else make_date(1990 + s_nationkey % 6, 1, 1) end as valid_from, case when s_nationkey % 3 = 0 then null else make_date(1994 + s_nationkey % 4, 12, 31) end as valid_to,
  case when k = s_suppkey % 4 and s_suppkey % 5 = 0 then 'rejected' when k > 0 then 'accepted' else 'candidate' end as status
from supplier, (select 'assets' as metric, 'Assets' as name, 1 as position union all select 'revenue', 'Revenues', 2) m, (select 0 as k union all select 1 union all select 2 union all select 3) r
where k <= s_suppkey % 4""",
    "b_review": """
select id as mapping_id, case when id % 7 = 0 then '' else 'reviewed' end as rationale, case when id % 11 = 0 then 0 else 1 end as evidence, case when id % 13 = 0 then 'old' else 'h1' end as metric_hash from b_mapping""",
    # durations as quarterly and annual filings report them: the required one, three months in the second and third quarter, and those of the year before
    "b_duration": """
select fact_id, accession, cik, filing_date, metric, focus, make_date(y - years_back, case when focus = 'Q2' and fact_id % 2 = 0 then 4 when focus = 'Q3' and fact_id % 2 = 0 then 7 else 1 end, 1) as period_start,
  make_date(y - years_back, m, case when m in (6, 9) then 30 else 31 end) as period_end, make_date(y, 1, 1) as required_start, make_date(y, m, case when m in (6, 9) then 30 else 31 end) as required_end, resolved_numeric as numeric, decimals
from (
  select w.*, f.filing_date, w.local_name as metric, w.fiscal_year as y, case when w.form in ('10-K', '10-K/A') then 'FY' when w.filing_id % 3 = 0 then 'Q1' when w.filing_id % 3 = 1 then 'Q2' else 'Q3' end as focus,
    case when w.form in ('10-K', '10-K/A') then 12 when w.filing_id % 3 = 0 then 3 when w.filing_id % 3 = 1 then 6 else 9 end as m
  from b_fact_wide w join b_filing f on f.filing_id = w.filing_id where period_kind = 'duration' and not has_dimensions and not is_nil and value_status = 'valid') x""",
    # continued texts of a filing: some ids are there twice, some chains lead nowhere or into themselves
    "b_continuation": """
select f.accession, case when fact_id % 41 = 0 then fact_id - 1 else fact_id end as node,
  case when l_quantity < 15 then null when l_quantity = 15 then l_orderkey * 1000 + 1 when l_quantity = 16 then -1 else fact_id + 1 end as next
from b_line l join b_filing f on f.filing_id = l.l_orderkey""",
    "b_continuation_root": """
select f.accession, fact_id as root, case when l_linenumber = 3 then l_orderkey * 1000 + 2 else fact_id + 1 end as start from b_line l join b_filing f on f.filing_id = l.l_orderkey where l_linenumber in (1, 3, 5)""",
    # contracts of metrics, some of them broken, and lists as texts
    "b_contract": """
select p_partkey as row_id, case when p_partkey % 19 = 0 then 'Bad Key' when p_partkey % 23 = 0 then concat('m', cast(p_partkey - 1 as string)) else concat('m', cast(p_partkey as string)) end as key, case when p_partkey % 29 = 0 then ' ' else p_name end as name,
  case when p_partkey % 31 = 0 then 'derived' else 'reported' end as kind, case p_size % 5 when 0 then 'income_statement' when 1 then 'balance_sheet' when 2 then 'cash_flow' when 3 then 'per_share' else 'shares' end as statement,
  case when p_size % 5 = 1 or (p_size % 5 = 4 and p_partkey % 2 = 0) or p_partkey % 37 = 0 then 'instant' else 'duration' end as period_type, 'numeric' as value_kind,
  case when p_partkey % 17 = 0 then 'pure' when p_size % 5 = 3 then 'monetary_per_share' when p_size % 5 = 4 then 'shares' else 'monetary' end as unit_dimension, p_type as definition,
  case when p_partkey % 13 = 0 then concat(lower(p_brand), ',', lower(p_brand)) else concat(lower(p_brand), ',all') end as includes, case when p_partkey % 11 = 0 then '' else 'none' end as excludes
from part""",
    "b_evidence": """
select id, case id % 6 when 0 then 'metric_definition' when 1 then 'filing_fact' else 'note' end as kind, case when id % 4 = 0 then 'x' end as accession, case when id % 8 < 6 then 'line 1' end as locator,
  case when id % 3 = 0 then concept else '' end as concept, case when id % 9 = 0 then 'as said' end as quote, cast(null as string) as artifact
from b_mapping where id % 5 <> 0""",
    # the manifest of a corpus, what its bundles say of themselves, how they bind addresses to files, and what the filer submitted
    "b_member": """
select filing_id as bundle_id, case when filing_id % 59 = 0 then 'a-twice' else accession end as accession, cik, form, case when filing_id % 3 <> 0 then filing_date end as filed, case when filing_id % 43 = 0 then 'annual' else concat('role', cast(filing_id as string)) end as role,
  case when form in ('10-K/A', '10-Q/A') and filing_id % 7 <> 0 then case when filing_id % 5 = 0 then 'none' else accession end when filing_id % 53 = 0 then accession end as amends, 'v1' as policy
from b_filing""",
    "b_identity": """
select filing_id as bundle_id, accession, case when filing_id % 13 = 0 then '0000000000' else cik end as cik, case when filing_id % 17 = 0 then '8-K' else form end as form, case when filing_id % 19 = 0 then null else filing_date end as filed,
  case when filing_id % 23 = 0 then 'v0' else 'v1' end as policy
from b_filing where filing_id % 29 <> 0""",
    # what an extraction stored of a filing, and what its receipt states of it: some of other inputs, versions, forms or times, some with settings lost
    "b_receipt": """
select f.filing_id, f.accession, f.cik, f.form, f.filing_date, f.accepted_at, case when f.filing_id % 11 = 0 then concat(f.accession, 'x') else f.accession end as input_accession, case when f.filing_id % 13 = 0 then 'e0' else 'e1' end as extractor,
  case when f.filing_id % 17 = 0 then 'v8' else 'v9' end as engine, case when f.filing_id % 43 = 0 then null when f.filing_id % 47 = 0 then 2 when f.filing_id % 53 = 0 then 0 else 1 end as n_inputs, case when f.filing_id % 19 = 0 then '8-K' else f.form end as receipt_form, f.filing_id % 23 = 0 as other_time, f.filing_id % 29 = 0 as setting_lost,
  f.filing_id % 31 = 0 as other_digest, f.filing_id % 37 = 0 as other_key, f.filing_id % 41 = 0 as cut_off, f.filing_id % 59 = 0 as no_filing
from b_filing f""",
    # metrics as a source and its mirror have them, and revisions that name some
    "b_metric_source": "select concat('m', cast(p_partkey as string)) as metric, p_name as hash from part where p_partkey % 7 <> 0",
    "b_metric_mirror": "select concat('m', cast(p_partkey as string)) as metric, case when p_partkey % 5 = 0 then p_brand else p_name end as hash from part where p_partkey % 11 <> 0",
    "b_metric_use": "select concat('m', cast(l_partkey as string)) as metric from lineitem where l_partkey % 3 = 0",
    "b_binding": "select accession, concat('u:', path) as uri, path, digest, case when fact_id % 10 = 0 then 'u:all' when fact_id % 19 = 0 then concat('u:', path) end as alias from b_bundle_file",
    "b_submitted": """
select f.accession, concat('d', cast(l.fact_id % 1000 * 7 % 10 as string), cast(l_suppkey as string), '.htm') as path, case l_linenumber when 2 then 'Ex-Filing Fees' when 3 then 'EX-101.INS' when 5 then null else f.form end as doc_type,
  l.fact_id % 1000 = 1 as is_primary, l_quantity > 20 as is_inline, l_quantity <= 45 as is_instance
from b_line l join b_filing f on f.filing_id = l.l_orderkey where l.fact_id % 31 <> 0""",
}


def text(*names: str, given: tuple[str, ...] = ()) -> str:
    """WITH clause of the named views and all that they need, in the order above, but for those given."""
    need: set[str] = set()

    def add(n: str) -> None:
        if n not in need and n not in given:
            need.add(n)
            for v in VIEWS:
                if v != n and f"{v} " in f"{VIEWS[n]} ".replace("\n", " ").replace(")", " ").replace(",", " "):
                    add(v)

    for n in names:
        add(n)
    return "with " + ",\n".join(f"{v} as ({VIEWS[v]})" for v in VIEWS if v in need)


#: How the texts above meet a line with its filing, and the same with a table that has both already: its column f is the filing.
_FILED, _HELD = "from b_line l join b_filing f on f.filing_id = l.l_orderkey", "from b_filed_line l"


def filed_lines(spark: SparkSession, sf_dir: str, columns: tuple[str, ...]) -> DataFrame:
    """accession, fact_id and those columns of a line and of its filing."""
    sql = f"{text('b_line', 'b_filing')} select f.accession, l.fact_id, {', '.join(columns)} {_FILED}"
    return _over(spark, sf_dir, sql)


def view(spark: SparkSession, sf_dir: str, name: str, given: dict[str, DataFrame] | None = None) -> DataFrame:
    """The named view; those given are taken as they are, in place of their own text. b_filed_line: of filed_lines, in place of lines that meet their filings."""
    given = dict(given or {})
    sql = f"{text(name, given=tuple(given))} select * from {name}"
    if "b_filed_line" in given:
        lines = given["b_filed_line"]
        given["b_filed_line"] = lines.withColumn("f", F.struct(*[c for c in lines.columns if not c.startswith("l_")]))
        sql = sql.replace(_FILED, _HELD)
    return _over(spark, sf_dir, sql, given)


def _over(spark: SparkSession, sf_dir: str, sql: str, given: dict[str, DataFrame] | None = None) -> DataFrame:
    for other, df in (given or {}).items():
        df.createOrReplaceTempView(other)
    for t in TABLES:
        if f" {t}" in sql:
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    return spark.sql(sql)
