"""Queries over documents: sections of reports and what stands in their way; with SQL for the parts that it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators import filing_sections as fs
from factloom.plans.catalogue import Model, _sql
from factloom.sources.staging import written


def _marks(m: Model) -> DataFrame:
    blocks = written(m.report_block, "report-blocks")
    return fs.contents_marks(blocks, fs.markers(blocks))


def _outcomes(m: Model) -> DataFrame:
    return fs.section_outcomes(written(m.report_block, "report-blocks"), m.report.select("doc_id", "form"))


def _cutoffs(m: Model) -> DataFrame:
    """Items of quarterly reports, with the first part's line and the second one's where there is one alone; two of them are ambiguous."""
    marks = written(fs.markers(m.report_block).join(m.report.where("family = 'quarterly'").select("doc_id"), "doc_id"), "report-markers")
    items = marks.where("kind = 'item'").select("doc_id", "ordinal", F.posexplode("tokens").alias("place", "token"))
    at = lambda part, f: f(F.when(F.col("tokens")[0] == part, F.col("ordinal")))
    parts = marks.where("kind = 'part'").groupBy("doc_id").agg(at("I", F.min).alias("part_1"), at("II", F.min).alias("first"), at("II", F.max).alias("last"))
    alone = F.col("first") == F.col("last")
    parts = parts.select("doc_id", "part_1", F.when(alone, F.col("first")).alias("part_2"), F.coalesce(~alone, F.lit(False)).alias("part_2_ambiguous"), F.when(~alone, F.col("first")).alias("part_2_earliest"))
    return fs.part_cutoffs(items, parts).select("doc_id", "ordinal", "place", "token", "part")


def _projection(m: Model) -> DataFrame:
    """Blocks, sections and issues of every page, each third of which is its filing's primary document; forms by page."""
    pages = m._at[0].read.parquet(f"{m._at[1]}/pages.parquet")
    form = F.element_at(F.array(*[F.lit(f) for f in fs.FAMILIES]), (F.col("page_id") % 4 + 1).cast("int"))
    documents = pages.select(F.col("page_id").alias("doc_id"), F.concat(F.lit("p"), F.col("page_id").cast("string"), F.when(F.col("page_id") % 7 == 0, ".HTML").when(F.col("page_id") % 11 == 0, ".txt").otherwise(".htm")).alias("path"), (F.col("page_id") % 3 == 0).alias("is_primary"), form.alias("form"), "html")
    blocks, outcomes = fs.document_projection(documents)
    per = blocks.groupBy("doc_id").agg(F.count("*").alias("blocks"), F.count("text").alias("texts"))
    found = outcomes.groupBy(F.col("doc_id").alias("of_doc")).agg(F.count_if(F.col("code").isNull()).alias("sections"), F.count("code").alias("issues"))
    return per.join(found, F.col("doc_id") == F.col("of_doc"), "left").select("doc_id", "blocks", "texts", F.coalesce("sections", F.lit(0)).alias("sections"), F.coalesce("issues", F.lit(0)).alias("issues"))


Q = {
    "document_projection": _projection,
    "contents_marks": lambda m: _marks(m).select("doc_id", "ordinal", "kind", "score", "contents"),
    "part_cutoffs": _cutoffs,
    "filing_sections": lambda m: fs.filing_sections(_outcomes(m)),
    "section_issues": lambda m: fs.section_issues(_outcomes(m)),
}
QUERIES = {k: (lambda f: lambda spark, sf_dir: f(Model(spark, sf_dir)))(f) for k, f in Q.items()}

_MARKERS = r"""
bx as (select *, count(*) over (partition by doc_id) n, regexp_matches(trim(text), '\s+[0-9]+\s*$') sfx, internal_links >= 1 and total_chars > 0 and link_chars * 2 >= total_chars heavy from b_report_block),
pt as (
  select *, case when heading_level is not null then 25 else 0 end + case when is_bold then 15 else 0 end + case when has_anchor then 20 else 0 end + case when total_chars <= 160 then 10 else 0 end - case when heavy then 40 else 0 end
    - case when internal_links >= 3 then 25 else 0 end - case when sfx then 20 else 0 end - case when (sfx or heavy) and ordinal * 10 < n then 5 else 0 end pts from bx where trim(text) <> ''),
mk as (
  select *, 'item' kind, regexp_extract_all(text, '(?i)\bitem\s+(\d+[a-z]?)', 1) tk from pt where regexp_matches(trim(text), '(?i)^\W*item\s+\d+[a-z]?\b')
  union all select *, 'part', regexp_extract_all(trim(text), '(?i)^\W*part\s+([ivx]+)\b', 1) from pt where regexp_matches(trim(text), '(?i)^\W*part\s+(i|ii|iii|iv)\b')
  union all select *, 'terminal', [] from pt where regexp_matches(text, '(?i)^\s*signatures?\b')),
ms as (select *, case kind when 'terminal' then 50 + pts when 'item' then case when len(tk) > 1 then least(40 + pts, 25) else 40 + pts end else 40 + pts end raw from mk)"""
#: Contents tables by who stands near whom: an entry, with a seed within reach; parts and closing markers between two entries of one cluster or after its heading.
_CONTENTS = r"""
hd as (select doc_id, ordinal from b_report_block where regexp_matches(text, '(?i)table\s+of\s+contents')),
nh as (select ms.*, exists (select 1 from hd where hd.doc_id = ms.doc_id and abs(hd.ordinal - ms.ordinal) <= 15) near from ms),
en as (
  select distinct doc_id, ordinal from nh x where kind = 'item' and (heavy or sfx or (near and not (heading_level is not null or is_bold or has_anchor)))
    and exists (select 1 from nh s where s.kind = 'item' and s.doc_id = x.doc_id and abs(s.ordinal - x.ordinal) <= 30 and (s.near or s.heavy))),
cl as (select *, sum(brk) over (partition by doc_id order by ordinal) c from (select *, case when ordinal - lag(ordinal) over (partition by doc_id order by ordinal) > 30 then 1 else 0 end brk from en)),
sp as (select doc_id, coalesce((select max(ordinal) from hd where hd.doc_id = g.doc_id and hd.ordinal between lo - 15 and lo), lo) lo, hi from (select doc_id, c, min(ordinal) lo, max(ordinal) hi from cl group by all) g),
ct as (
  select doc_id, ordinal, kind, raw, case when kind = 'item' then (doc_id, ordinal) in (select (doc_id, ordinal) from en) else exists (select 1 from sp where sp.doc_id = ms.doc_id and ms.ordinal between lo and hi) or (doc_id, ordinal) in (select (doc_id, ordinal) from en) end con from ms)"""
#: An item is in the first part while no item up to it breaks the order: one that the part does not have, or one with a later item before it.
_CUTOFFS = """
it as (select doc_id, ordinal, u.place - 1 place, lower(u.t) tok from ms join b_report using (doc_id), (select unnest(range(1, len(tk) + 1)) place, unnest(tk) t) u where kind = 'item' and family = 'quarterly'),
pp as (select doc_id, min(ordinal) filter (upper(tk[1]) = 'I') p1, min(ordinal) filter (upper(tk[1]) = 'II') lo, max(ordinal) filter (upper(tk[1]) = 'II') hi from ms where kind = 'part' group by 1),
io as (select it.*, p1, case when lo = hi then lo end p2, case when lo < hi then lo end early, case when tok in ('1', '2', '3', '4') then tok::int end rk, ordinal * 100 + place pos from it left join pp using (doc_id)),
br as (
  select doc_id, min(pos) cut from io x where p1 is not null and p2 is null and (ordinal >= early or (ordinal >= p1 and (rk is null or exists (select 1 from io y where y.doc_id = x.doc_id and y.ordinal >= y.p1 and y.pos < x.pos and y.rk > x.rk)))) group by 1)"""
ORACLES = {
    "contents_marks": _sql(("b_report_block",), "select doc_id, ordinal, kind, raw - case when con then 60 else 0 end score, con contents from ct", _MARKERS, _CONTENTS),
    "part_cutoffs": _sql(
        ("b_report", "b_report_block"), """select doc_id, ordinal, place::int place, tok "token", case when ordinal >= p2 then 2 when p2 is not null and ordinal >= p1 then 1 when p2 is null and ordinal >= p1 and (cut is null or pos < cut) then 1 end part
          from io left join br using (doc_id)""", _MARKERS, _CUTOFFS,
    ),
}
