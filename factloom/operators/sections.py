"""Section markers of documents, as windows over ordered blocks: candidates, contents tables, body parts, ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import scalars as S

#: Scores and distances.
ITEM, PART, SIGNATURE = 40, 40, 50
HEADING, BOLD, ANCHOR, SHORT, SHORT_CHARS = 25, 15, 20, 10, 160
LINK_HEAVY, MANY_LINKS, PAGE_SUFFIX, EARLY, SEVERAL_ITEMS_CAP = 40, 25, 20, 5, 25
ITEM_REACH, HEADING_REACH, BASELINE, GAP = 30, 15, 30, 15
ROMAN = {"I": 1, "II": 2, "III": 3, "IV": 4}
ITEM_START, ITEM_ANY, PART_START = r"(?i)^item\s+(\d{1,2}[a-c]?)\b", r"(?i)\bitem\s+(\d{1,2}[a-c]?)\b", r"(?i)^part\s+(iv|iii|ii|i)\b"
SIGNATURE_START, CONTENTS, PAGE_END = r"(?i)^signatures?\b", r"(?i)^(table of )?contents$", r"\s\d{1,3}$"


def marker_candidates(blocks: DataFrame) -> DataFrame:
    """doc_id, ordinal, kind (item, part, terminal), token, score: blocks that open an item or a part or close the document, scored by how they are set.

    blocks: doc_id, ordinal, text, heading_level, is_bold, has_anchor, internal_links, link_chars, total_chars."""
    n = blocks.groupBy("doc_id").agg(F.count("*").alias("blocks"))
    b = blocks.withColumn("text", F.trim("text")).where("text <> ''").join(n, "doc_id")
    chars = F.when(F.col("total_chars") > 0, F.col("total_chars")).otherwise(F.length("text"))
    some = lambda c, x: F.when(c, x).otherwise(0)
    heavy = (F.col("internal_links") >= 1) & (F.col("total_chars") > 0) & (F.col("link_chars") * 2 >= F.col("total_chars"))
    suffix = F.col("text").rlike(PAGE_END)
    bonus = some(F.col("heading_level").isNotNull(), HEADING) + some(F.col("is_bold"), BOLD) + some(F.col("has_anchor"), ANCHOR) + some(chars <= SHORT_CHARS, SHORT)
    penalty = some(heavy, LINK_HEAVY) + some(F.col("internal_links") >= 3, MANY_LINKS) + some(suffix, PAGE_SUFFIX) + some((heavy | suffix) & (F.col("ordinal") * 10 < F.col("blocks")), EARLY)
    items = F.transform(F.regexp_extract_all("text", F.lit(ITEM_ANY), 1), F.upper)
    item_score = F.when(F.size(items) > 1, F.least(F.lit(ITEM) + bonus - penalty, F.lit(SEVERAL_ITEMS_CAP))).otherwise(F.lit(ITEM) + bonus - penalty)
    part = F.upper(F.regexp_extract("text", PART_START, 1))
    marks = F.array(
        F.when(F.col("text").rlike(ITEM_START), F.struct(F.lit("item").alias("kind"), F.array_join(items, ",").alias("token"), item_score.alias("score"))),
        F.when(part != "", F.struct(F.lit("part").alias("kind"), part.alias("token"), (F.lit(PART) + bonus - penalty).alias("score"))),
        F.when(F.col("text").rlike(SIGNATURE_START), F.struct(F.lit("terminal").alias("kind"), F.lit("").alias("token"), (F.lit(SIGNATURE) + bonus - penalty).alias("score"))),
    )
    return b.select("doc_id", "ordinal", F.inline(F.array_compact(marks)))


def part_number(token):
    return F.create_map(*[F.lit(x) for kv in ROMAN.items() for x in kv])[token]


def item_neighbourhood(blocks: DataFrame, markers: DataFrame) -> DataFrame:
    """doc_id, ordinal, near_items (other item markers within 30 blocks), near_heading (a contents heading within 15)."""
    heads = blocks.where(F.trim("text").rlike(CONTENTS)).select("doc_id", "ordinal", F.lit(1).alias("head"), F.lit(0).alias("item"))
    marks = markers.where("kind = 'item'").select("doc_id", "ordinal", F.lit(0).alias("head"), F.lit(1).alias("item")).unionByName(heads)
    near = lambda n: Window.partitionBy("doc_id").orderBy("ordinal").rangeBetween(-n, n)
    out = marks.withColumns({"near_items": F.sum("item").over(near(ITEM_REACH)) - 1, "near_heading": F.max("head").over(near(HEADING_REACH)) > 0})
    return out.where("item = 1").select("doc_id", "ordinal", "near_items", "near_heading")


def toc_clusters(marked: DataFrame) -> DataFrame:
    """marked(doc_id, ordinal) with cluster, from 0: a gap of more than 30 blocks begins another."""
    w = Window.partitionBy("doc_id").orderBy("ordinal")
    opens = F.when(F.col("ordinal") - F.lag("ordinal").over(w) > ITEM_REACH, 1).otherwise(0)
    return marked.select("doc_id", "ordinal", opens.alias("opens")).withColumn("cluster", F.sum("opens").over(w)).drop("opens")


def toc_spans(blocks: DataFrame, clusters: DataFrame, headings: DataFrame | None = None) -> DataFrame:
    """doc_id, cluster, first, last: a cluster's range, pulled back to the nearest contents heading within 15 blocks before it. headings(doc_id, ordinal): these instead of the blocks that are one by themselves."""
    span = clusters.groupBy("doc_id", "cluster").agg(F.min("ordinal").alias("low"), F.max("ordinal").alias("last"))
    heads = (blocks.where(F.trim("text").rlike(CONTENTS)) if headings is None else headings).select(F.col("doc_id").alias("of_doc"), F.col("ordinal").alias("head"))
    both = span.join(heads.hint("merge"), (F.col("doc_id") == F.col("of_doc")) & F.col("head").between(F.col("low") - HEADING_REACH, F.col("low")), "left")
    return both.groupBy("doc_id", "cluster", "last").agg(F.min(F.coalesce("head", "low")).alias("any"), F.max("head").alias("nearest"), F.min("low").alias("low")).select("doc_id", "cluster", F.coalesce("nearest", "low").alias("first"), "last")


def first_body_parts(markers: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, part_1, part_2: the first markers of parts I and II over the baseline that lie in no contents span."""
    parts = markers.where((F.col("kind") == "part") & (F.col("score") > BASELINE))
    inside = (parts.doc_id == spans.doc_id) & F.col("ordinal").between(F.col("first"), F.col("last"))
    body = parts.join(spans, inside, "left_anti")
    at = lambda n: F.min(F.when(part_number(F.col("token")) == n, F.col("ordinal"))).alias(f"part_{n}")
    return body.groupBy("doc_id").agg(at(1), at(2))


def section_ends(boundaries: DataFrame, terminals: DataFrame, blocks: DataFrame) -> DataFrame:
    """boundaries(doc_id, ordinal) with end: the next boundary or the document's closing marker after it, whichever comes first, or the number of blocks.

    terminals(doc_id, terminal): one a document."""
    n = blocks.groupBy("doc_id").agg(F.count("*").cast("int").alias("blocks"))
    out = boundaries.withColumn("next", F.lead("ordinal").over(Window.partitionBy("doc_id").orderBy("ordinal"))).join(terminals, "doc_id", "left").join(n, "doc_id")
    closing = F.when(F.col("terminal") > F.col("ordinal"), F.col("terminal"))
    return out.select("doc_id", "ordinal", F.coalesce(F.least("next", closing), F.col("blocks")).alias("end"))


def terminal_pick(markers: DataFrame, after: DataFrame) -> DataFrame:
    """doc_id, terminal, ambiguous: the best scored closing marker after the last section, the earlier of equal ones; ambiguous if the second best is within 15. after(doc_id, last)."""
    t = markers.where((F.col("kind") == "terminal") & (F.col("score") > BASELINE)).join(after, "doc_id", "left").where("last is null or ordinal > last")
    ranked = t.withColumn("rank", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("score"), "ordinal"))).where("rank <= 2")
    best, second = F.max(F.when(F.col("rank") == 1, F.col("score"))), F.max(F.when(F.col("rank") == 2, F.col("score")))
    return ranked.groupBy("doc_id").agg(F.max(F.when(F.col("rank") == 1, F.col("ordinal"))).alias("terminal"), F.coalesce(best - second <= GAP, F.lit(False)).alias("ambiguous"))


def same_ordinal_collapse(markers: DataFrame) -> DataFrame:
    """doc_id, ordinal, keys of the blocks that open several items at once."""
    keys = markers.where("kind = 'item'").select("doc_id", "ordinal", F.explode(F.split("token", ",")).alias("key")).groupBy("doc_id", "ordinal").agg(F.count_distinct("key").alias("keys"))
    return keys.where("keys > 1")


def default_parts(markers: DataFrame) -> DataFrame:
    """Item markers of one item with the part that an annual form puts it in."""
    return markers.where("kind = 'item' and not token like '%,%'").select("doc_id", "ordinal", "token", S.default_part_for_item(F.col("token")).alias("part"))


def section_text(blocks: DataFrame, sections: DataFrame) -> DataFrame:
    """doc_id, start, end, blocks, chars: each section [start, end) with what its blocks hold; a block's rows meet their section by document and range."""
    s = sections.select(F.col("doc_id").alias("of_doc"), "start", "end")
    both = blocks.join(s, (F.col("doc_id") == F.col("of_doc")) & (F.col("ordinal") >= F.col("start")) & (F.col("ordinal") < F.col("end")))
    return both.groupBy("doc_id", "start", "end").agg(F.count("*").alias("blocks"), F.sum(F.length("text")).cast("long").alias("chars"))


def sections_of_document(sections: DataFrame, doc_id: int | None = None) -> DataFrame:
    """Sections with their place, from 1, in their document; of one document in that order, where it is given."""
    out = sections if doc_id is None else sections.where(F.col("doc_id") == doc_id)
    placed = out.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy("start")))
    return placed if doc_id is None else placed.orderBy("start")
