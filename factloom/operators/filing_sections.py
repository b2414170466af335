"""Regulatory sections of filings: markers over blocks, contents tables, parts, the best increasing sequence of boundaries, ends and issues.

Everything but the sequence is windows and joins by document. The sequence is a choice per document: each boundary of the form takes one of its candidates or none, ordinals increase, and the sum of scores over a
baseline is the highest. What matters of it is, for each boundary and option, the best sum that any sequence with that option reaches; a boundary is
settled if its best option is ahead of all others by more than a gap, and ambiguous if not. These sums come from two passes, one from either end.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.operators import sections as sx
from factloom.sources import html as hx
from factloom.sources.staging import written

#: What opens an item or a part, closes a document, heads a contents table and ends in a page number.
ITEM_START, ITEM_ANY, PART_START = r"(?i)^\W*item\s+\d+[a-z]?\b", r"(?i)\bitem\s+(\d+[a-z]?)", r"(?i)^\W*part\s+([ivx]+)\b"
CLOSING, CONTENTS, PAGE_END = r"(?i)^\s*signatures?\b", r"(?i)table\s+of\s+contents", r"\s+\d+\s*$"
CONTENTS_PENALTY = 60
#: Items of each part in the order of the form, and the sections that are published, by part and item.
ORDER = {
    "annual": {1: "1 1a 1b 1c 2 3 4", 2: "5 6 7 7a 8 9 9a 9b 9c", 3: "10 11 12 13 14", 4: "15 16"},
    "quarterly": {1: "1 2 3 4", 2: "1 1a 2 3 4 5 6"},
}
PUBLISHED = {
    "annual": {(1, "1"): "business", (1, "1a"): "risk_factors", (1, "1b"): "unresolved_staff_comments", (1, "1c"): "cybersecurity", (2, "7"): "mda", (2, "7a"): "market_risk", (2, "8"): "financial_statements"},
    "quarterly": {(1, "1"): "financial_statements", (1, "2"): "mda", (1, "3"): "market_risk", (1, "4"): "controls_and_procedures", (2, "1"): "legal_proceedings", (2, "1a"): "risk_factors"},
}
FAMILIES = {"10-K": "annual", "10-K/A": "annual", "10-Q": "quarterly", "10-Q/A": "quarterly"}
#: The order of items in the first part of a quarterly report, which tells where that part ends.
FIRST_PART_ORDER = ("1", "2", "3", "4")
#: Codes of issues.
NOT_FOUND, AMBIGUOUS, CONTENTS_ONLY, UNRESOLVED = "SECTION_NOT_FOUND", "SECTION_AMBIGUOUS", "TOC_ONLY_SECTION_MATCH", "SECTION_BOUNDARY_UNRESOLVED"


def _merged(df: DataFrame) -> DataFrame:
    """A table with rows for every document, joined by its sorted keys. Its files are so small against its rows that Spark, which goes by files, would send it whole to the driver and to all executors."""
    return df.hint("merge")


def boundaries(family: str) -> list[tuple[int, str]]:
    """(part, item) in the order of the form."""
    return [(part, item) for part, items in ORDER[family].items() for item in items.split()]


def _lookup(values: dict[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def _boundary(family: Column, part: Column, item: Column) -> Column:
    """The boundary's place in its form's order, null for none."""
    places = {f"{f} {p} {i}": n for f in ORDER for n, (p, i) in enumerate(boundaries(f))}
    return F.try_element_at(_lookup(places), F.concat_ws(" ", family, part.cast("string"), item))


def markers(blocks: DataFrame) -> DataFrame:
    """doc_id, ordinal, kind (item, part, terminal), tokens, score, heavy, suffix, strong: what opens an item or a part or closes the document.

    blocks: doc_id, ordinal, text, heading_level, is_bold, has_anchor, internal_links, link_chars, total_chars. Blank and null texts mark nothing."""
    n = blocks.groupBy("doc_id").agg(F.count("*").alias("blocks"))
    b = blocks.withColumn("text", F.regexp_replace("text", r"^\s+|\s+$", "")).where("text <> ''").join(_merged(n), "doc_id")
    count = lambda c, x: F.when(c, x).otherwise(0)
    heavy = F.coalesce((F.col("internal_links") >= 1) & (F.col("total_chars") > 0) & (F.col("link_chars") * 2 >= F.col("total_chars")), F.lit(False))
    bold, anchor = F.coalesce("is_bold", F.lit(False)), F.coalesce("has_anchor", F.lit(False))
    suffix = F.col("text").rlike(PAGE_END)
    chars = F.when(F.col("total_chars") > 0, F.col("total_chars")).otherwise(F.length("text"))
    points = count(F.col("heading_level").isNotNull(), sx.HEADING) + count(bold, sx.BOLD) + count(anchor, sx.ANCHOR) + count(chars <= sx.SHORT_CHARS, sx.SHORT)
    points = points - count(heavy, sx.LINK_HEAVY) - count(F.col("internal_links") >= 3, sx.MANY_LINKS) - count(suffix, sx.PAGE_SUFFIX) - count((heavy | suffix) & (F.col("ordinal") * 10 < F.col("blocks")), sx.EARLY)
    b = b.withColumns({"points": points, "heavy": heavy, "suffix": suffix, "strong": ~heavy & (F.col("heading_level").isNotNull() | bold | anchor)})
    items = F.transform(F.regexp_extract_all("text", F.lit(ITEM_ANY), 1), F.lower)
    part = F.upper(F.regexp_extract("text", PART_START, 1))
    mark = lambda when, kind, tokens, score: F.when(when, F.struct(F.lit(kind).alias("kind"), tokens.alias("tokens"), score.cast("int").alias("score")))
    item_score = F.lit(sx.ITEM) + F.col("points")
    marks = F.array(
        mark(F.col("text").rlike(ITEM_START), "item", items, F.when(F.size(items) > 1, F.least(item_score, F.lit(sx.SEVERAL_ITEMS_CAP))).otherwise(item_score)),
        mark(part.isin(*sx.ROMAN), "part", F.array(part), F.lit(sx.PART) + F.col("points")),
        mark(F.col("text").rlike(CLOSING), "terminal", F.array().cast("array<string>"), F.lit(sx.SIGNATURE) + F.col("points")),
    )
    return b.select("doc_id", "ordinal", "heavy", "suffix", "strong", F.inline(F.array_compact(marks)))


def contents_marks(blocks: DataFrame, marks: DataFrame) -> DataFrame:
    """markers with contents: whether they belong to a contents table; a marker that does has its score lowered.

    An item does if one within reach lies near a contents heading or is mostly links, and it shows itself as an entry: by links, by a page number, or, unless it is set as a heading of the body, by lying
    near the heading. Parts and closing markers do if they lie in the span of a cluster of such items."""
    heads = blocks.where(F.col("text").rlike(CONTENTS)).select("doc_id", "ordinal")
    items = marks.where("kind = 'item'").select("doc_id", "ordinal", "heavy", "suffix", "strong", F.lit(False).alias("head"))
    both = items.unionByName(heads.withColumn("head", F.lit(True)), allowMissingColumns=True)
    near = lambda n: Window.partitionBy("doc_id").orderBy("ordinal").rangeBetween(-n, n)
    both = both.withColumn("near", F.max("head").over(near(sx.HEADING_REACH))).withColumn("seed", ~F.col("head") & (F.col("near") | F.col("heavy")))
    both = both.withColumn("reached", F.max("seed").over(near(sx.ITEM_REACH)))
    entry = F.col("heavy") | F.col("suffix") | (~F.col("strong") & F.col("near"))
    listed = both.where(~F.col("head") & F.col("reached") & entry).select("doc_id", "ordinal").distinct()
    spans = sx.toc_spans(blocks, sx.toc_clusters(listed), heads)
    others = marks.where("kind <> 'item'").select("doc_id", "ordinal").distinct()
    inside = others.join(_merged(spans.withColumnRenamed("doc_id", "of_doc")), (F.col("doc_id") == F.col("of_doc")) & F.col("ordinal").between(F.col("first"), F.col("last")), "left_semi")
    flagged = listed.unionByName(inside).distinct().withColumn("contents", F.lit(True))
    out = marks.join(_merged(flagged), ["doc_id", "ordinal"], "left").withColumn("contents", F.coalesce("contents", F.lit(False)))
    return out.withColumn("score", F.col("score") - F.when(F.col("contents"), CONTENTS_PENALTY).otherwise(0)).drop("heavy", "suffix", "strong")


def best_sums(options: list[tuple[int, int, int]], places: int) -> list[dict[int | None, int]]:
    """For each boundary, by option (an ordinal, or None for going without): the highest sum of gains of any sequence with it. options: (boundary, ordinal, gain), gains over 0."""
    ordinals = sorted({o for _, o, _ in options})
    at = {o: p for p, o in enumerate(ordinals)}
    own: list[dict[int, int]] = [{} for _ in range(places)]
    for b, o, gain in options:
        own[b][at[o]] = max(gain, own[b].get(at[o], 0))
    n = len(ordinals)
    # before[b][p]: best sum of boundaries before b with all ordinals under the p-th; after[b][p]: of those after b, from the p-th on
    before, after = [[0] * (n + 1)], [[0] * (n + 1)]
    for b in range(places - 1):
        here, run = before[-1], 0
        row = here.copy()
        for p in range(n):
            run = max(run, here[p] + own[b][p] if p in own[b] else 0)
            row[p + 1] = max(row[p + 1], run)
        before.append(row)
    for b in range(places - 1, 0, -1):
        here, run = after[-1], 0
        row = here.copy()
        for p in range(n - 1, -1, -1):
            run = max(run, here[p + 1] + own[b][p] if p in own[b] else 0)
            row[p] = max(row[p], run)
        after.append(row)
    after.reverse()
    out: list[dict[int | None, int]] = []
    for b in range(places):
        sums: dict[int | None, int] = {ordinals[p]: before[b][p] + gain + after[b][p + 1] for p, gain in own[b].items()}
        sums[None] = max(before[b][p] + after[b][p] for p in range(n + 1))
        out.append(sums)
    return out


SETTLED = "doc_id long, boundary int, ordinal int, ambiguous boolean, alternatives array<int>"


def sequence_choice(options: DataFrame, places: int, gap: int = sx.GAP) -> DataFrame:
    """options(doc_id, boundary, ordinal, gain) -> a row per document and boundary with an option: the settled ordinal (null: none), ambiguous, and the ordinals within the gap of the best where it is.

    A document's options are gathered to one row; they are markers, few for any text. Equal sums are ambiguous, so no order of ties matters. No options give no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, found in zip(batch.column("doc_id").to_pylist(), batch.column("options").to_pylist(), strict=True):
                taken = {o["boundary"] for o in found}
                for b, sums in enumerate(best_sums([(o["boundary"], o["ordinal"], o["gain"]) for o in found], places)):
                    if b not in taken:
                        continue
                    top = max(sums.values())
                    close = [o for o, s in sums.items() if top - s <= gap]
                    ambiguous = len(close) > 1
                    rows.append((doc, b, None if ambiguous else close[0], ambiguous, sorted(o for o in close if o is not None) if ambiguous else []))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "boundary", "ordinal", "ambiguous", "alternatives"])

    gathered = options.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.collect_list(F.struct(F.col("boundary").cast("int").alias("boundary"), F.col("ordinal").cast("int").alias("ordinal"), F.col("gain").cast("int").alias("gain"))).alias("options"))
    return gathered.mapInArrow(run, SETTLED)


def quarterly_parts(marks: DataFrame) -> DataFrame:
    """doc_id, part_1, part_2 (ordinals, null where none or ambiguous), part_2_ambiguous, part_2_earliest: the parts of quarterly reports, as the best sequence of their markers."""
    parts = marks.where(f"kind = 'part' and not contents and score > {sx.BASELINE}").withColumn("boundary", sx.part_number(F.col("tokens")[0]) - 1).where("boundary < 2")
    chosen = sequence_choice(parts.select("doc_id", "boundary", "ordinal", (F.col("score") - sx.BASELINE).alias("gain")), 2)
    of = lambda b, c: F.max(F.when(F.col("boundary") == b, F.col(c)))
    return chosen.groupBy("doc_id").agg(
        of(0, "ordinal").alias("part_1"), of(1, "ordinal").alias("part_2"), F.coalesce(of(1, "ambiguous"), F.lit(False)).alias("part_2_ambiguous"), F.max(F.when(F.col("boundary") == 1, F.array_min("alternatives"))).alias("part_2_earliest")
    )


def part_cutoffs(items: DataFrame, parts: DataFrame) -> DataFrame:
    """items(doc_id, ordinal, place, token) of quarterly reports with part: 1, 2, or null where it is unresolved.

    A settled second part holds all from it on, and the first part all from a settled first part to there. Without a settled second part the first one ends at the first item that breaks its order (an item
    that it does not have, or one before an item seen already) or that lies at or after the earliest place where the second part may begin.
    parts(doc_id, part_1, part_2, part_2_ambiguous, part_2_earliest); documents without a row there have nothing settled."""
    rank = F.try_element_at(_lookup({t: i for i, t in enumerate(FIRST_PART_ORDER)}), F.col("token"))
    j = items.join(_merged(parts), "doc_id", "left").withColumn("open", F.col("part_1").isNotNull() & F.col("part_2").isNull() & (F.col("ordinal") >= F.col("part_1")))
    w = Window.partitionBy("doc_id").orderBy("ordinal", "place")
    seen = F.max(F.when(F.col("open"), rank)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    late = F.col("part_2_ambiguous") & (F.col("ordinal") >= F.col("part_2_earliest"))
    breaks = F.coalesce(late, F.lit(False)) | (F.col("open") & (rank.isNull() | F.coalesce(rank < seen, F.lit(False))))
    j = j.withColumn("breaks", breaks).withColumn("ended", F.max("breaks").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    part = F.when(F.col("ordinal") >= F.col("part_2"), 2).when(F.col("part_2").isNotNull() & (F.col("ordinal") >= F.col("part_1")), 1).when(F.col("open") & ~F.col("ended"), 1)
    return j.select(*items.columns, part.alias("part"))


def closing_markers(marks: DataFrame, after: DataFrame) -> DataFrame:
    """doc_id, terminal, candidates: the best scored closing marker of the body after the last settled boundary, the earlier of equal ones; null with both candidates if the second best is within the gap.

    Markers under the baseline count only where a document has no other. after(doc_id, last)."""
    t = marks.where("kind = 'terminal' and not contents").join(_merged(after), "doc_id", "left").where("last is null or ordinal > last").withColumn("weak", F.col("score") <= sx.BASELINE)
    ranked = t.withColumn("rank", F.row_number().over(Window.partitionBy("doc_id").orderBy("weak", F.desc("score"), "ordinal"))).where("rank <= 2")
    of = lambda r, c: F.max(F.when(F.col("rank") == r, F.col(c)))
    close = F.coalesce((of(1, "weak") == of(2, "weak")) & (of(1, "score") - of(2, "score") <= sx.GAP), F.lit(False))
    return ranked.groupBy("doc_id").agg(F.when(~close, of(1, "ordinal")).alias("terminal"), F.when(close, F.array(of(1, "ordinal"), of(2, "ordinal"))).alias("candidates"))


def _published(forms: DataFrame) -> DataFrame:
    """A row per document and published section: doc_id, form, section_key, boundary, token."""
    by_family = {f: [F.struct(F.lit(f"part_{p}.item_{i}.{name}").alias("section_key"), F.lit(boundaries(f).index((p, i))).alias("boundary"), F.lit(i).alias("token")) for (p, i), name in keys.items()] for f, keys in PUBLISHED.items()}
    rows = F.when(F.col("family") == "annual", F.array(*by_family["annual"])).otherwise(F.array(*by_family["quarterly"]))
    return forms.select("doc_id", "form", F.inline(rows))


def section_outcomes(blocks: DataFrame, forms: DataFrame) -> DataFrame:
    """doc_id, section_key, start, end, confidence, code, role, reason, candidates: a row per published section of a document, and one for a closing marker that is ambiguous.

    forms(doc_id, form), a row per document; other forms than annual and quarterly ones have no rows. A section that is found has a start, an end and a confidence and no code; one that is not has the first of: several boundaries in one block,
    ambiguous, part unresolved, in the contents alone, not found (amendments may leave it out and have no row then). Its end is the next settled boundary or the closing marker, whichever comes first,
    and unresolved if a later boundary of the form has a shared block, an ambiguous candidate or an unresolved item before it."""
    forms = forms.select(F.col("doc_id").cast("long").alias("doc_id"), "form", F.try_element_at(_lookup(FAMILIES), F.upper(F.trim("form"))).alias("family")).where("family is not null")
    marks = written(contents_marks(blocks, written(markers(blocks), "section-markers")).join(_merged(forms.select("doc_id", "family")), "doc_id"), "section-marks")
    items = marks.where("kind = 'item'").select("doc_id", "family", "ordinal", "score", "contents", F.posexplode("tokens").alias("place", "token"))
    quarterly = part_cutoffs(items.where("family = 'quarterly'"), quarterly_parts(marks.where("family = 'quarterly'")))
    default = _lookup({i: p for p, i in boundaries("annual")})
    items = items.where("family = 'annual'").withColumn("part", F.try_element_at(default, F.col("token"))).unionByName(quarterly)
    items = written(items, "section-items")
    placed = items.where("part is not null").withColumn("boundary", _boundary(F.col("family"), F.col("part"), F.col("token"))).where("boundary is not null")
    body = placed.where("not contents").select("doc_id", "boundary", "ordinal", "score")
    shared = body.withColumn("keys", F.size(F.collect_set("boundary").over(Window.partitionBy("doc_id", "ordinal")))).where("keys > 1").select("doc_id", "boundary", "ordinal").distinct()
    free = body.where(f"score > {sx.BASELINE}").join(_merged(shared), ["doc_id", "boundary"], "left_anti")
    settled = written(sequence_choice(free.select("doc_id", "boundary", "ordinal", (F.col("score") - sx.BASELINE).alias("gain")), max(len(boundaries(f)) for f in ORDER)), "section-sequence")
    unresolved = items.where("family = 'quarterly' and part is null").withColumn("part", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("boundary", _boundary(F.col("family"), F.col("part"), F.col("token"))).where("boundary is not null").select("doc_id", "boundary", "ordinal").distinct()
    starts = settled.where("ordinal is not null").select("doc_id", "boundary", F.col("ordinal").alias("start"))
    closing = written(closing_markers(marks, starts.groupBy("doc_id").agg(F.max("start").alias("last"))), "section-closings")

    # what stands in the way of a section's start or end: kind by precedence, boundary, ordinals
    blocker = lambda df, kind, ordinals: df.groupBy("doc_id", "boundary").agg(ordinals.alias("at")).withColumn("kind", F.lit(kind))
    every = F.array_sort(F.collect_set("ordinal"))
    blockers = blocker(shared, 1, every).unionByName(settled.where("ambiguous").select("doc_id", "boundary", F.col("alternatives").alias("at"), F.lit(2).alias("kind"))).unionByName(blocker(unresolved, 3, every))
    blockers = written(blockers, "section-blockers")
    in_contents = items.where("contents").groupBy("doc_id", "token").agg(every.alias("listed"))
    in_body = body.select("doc_id", "boundary", F.lit(True).alias("in_body")).distinct()
    score = free.groupBy("doc_id", "boundary", F.col("ordinal").alias("start")).agg(F.max("score").alias("score"))
    mine = blockers.groupBy("doc_id", "boundary").agg(F.min(F.struct("kind", "at")).alias("b")).select("doc_id", "boundary", "b.kind", "b.at")
    rows = _published(forms).join(_merged(starts), ["doc_id", "boundary"], "left").join(_merged(score), ["doc_id", "boundary", "start"], "left").join(_merged(mine), ["doc_id", "boundary"], "left")
    rows = rows.join(_merged(in_contents), ["doc_id", "token"], "left").join(_merged(in_body), ["doc_id", "boundary"], "left")

    later = starts.select(F.col("doc_id").alias("of_doc"), F.col("start").alias("next"))
    follow = rows.where("start is not null").select("doc_id", "boundary", "start").join(_merged(later), (F.col("doc_id") == F.col("of_doc")) & (F.col("next") > F.col("start")), "left").groupBy("doc_id", "boundary", "start").agg(F.min("next").alias("next"))
    follow = follow.join(_merged(closing.select("doc_id", "terminal")), "doc_id", "left").withColumn("terminal", F.when(F.col("terminal") > F.col("start"), F.col("terminal"))).withColumn("limit", F.coalesce("next", "terminal"))
    theirs = blockers.select(F.col("doc_id").alias("of_doc"), F.col("boundary").alias("other"), F.col("kind").alias("end_kind"), "at")
    met = follow.join(_merged(theirs), (F.col("doc_id") == F.col("of_doc")) & (F.col("other") > F.col("boundary")))
    met = met.withColumn("inside", F.filter("at", lambda o: (o > F.col("start")) & (F.col("limit").isNull() | (o < F.col("limit"))))).where("size(inside) > 0")
    # the first kind; of ambiguous ones the first boundary's ordinals, of others the first ordinal
    order = F.struct("end_kind", F.when(F.col("end_kind") == 2, F.col("other")).otherwise(F.col("inside")[0]).alias("first"), F.when(F.col("end_kind") == 2, F.col("inside")).otherwise(F.slice("inside", 1, 1)).alias("inside"))
    met = met.groupBy("doc_id", "boundary").agg(F.min(order).alias("m")).select("doc_id", "boundary", "m.end_kind", "m.inside")
    ends = follow.join(_merged(met), ["doc_id", "boundary"], "left").select("doc_id", "boundary", "end_kind", "inside", F.when(F.col("end_kind").isNull(), F.least("next", "terminal")).alias("end"))

    rows = rows.join(_merged(ends), ["doc_id", "boundary"], "left")
    reason = lambda kind: F.when(kind == 1, "same_ordinal_collapse").when(kind == 3, "part_context_unresolved")
    found, only_listed = F.col("start").isNotNull(), F.col("listed").isNotNull() & F.col("in_body").isNull()
    code = (
        F.when(found & F.col("end").isNotNull(), None).when(found, UNRESOLVED).when(F.col("kind") == 1, UNRESOLVED).when(F.col("kind").isin(2, 3), AMBIGUOUS).when(only_listed, CONTENTS_ONLY).otherwise(NOT_FOUND)
    )
    role = F.when(found, "end").when(F.col("kind") == 1, "start")
    candidates = F.when(found, F.col("inside")).when(F.col("kind").isNotNull(), F.col("at")).when(only_listed, F.col("listed"))
    rows = rows.withColumns({"code": code, "ok": found & F.col("end").isNotNull()}).where(~((F.col("code") == NOT_FOUND) & F.upper(F.trim("form")).endswith("/A")) | F.col("ok"))
    none = F.array().cast("array<int>")
    out = rows.select(
        "doc_id", "section_key", F.when(F.col("ok"), F.col("start")).alias("start"), F.when(F.col("ok"), F.col("end")).alias("end"), F.when(F.col("ok"), F.greatest(F.lit(0), F.least(F.lit(100), "score"))).alias("confidence"), "code",
        F.when(~F.col("ok"), role).alias("role"), F.when(~F.col("ok"), F.when(found, reason(F.col("end_kind"))).otherwise(reason(F.col("kind")))).alias("reason"), F.when(F.col("ok"), none).otherwise(F.coalesce(candidates, none)).alias("candidates"),
    )
    none_int, none_text = F.lit(None).cast("int"), F.lit(None).cast("string")
    unclear = closing.where("candidates is not null").select(
        "doc_id", none_text.alias("section_key"), none_int.alias("start"), none_int.alias("end"), none_int.alias("confidence"), F.lit(UNRESOLVED).alias("code"), F.lit("terminal").alias("role"), none_text.alias("reason"), "candidates"
    )
    return out.unionByName(unclear)


def filing_sections(outcomes: DataFrame) -> DataFrame:
    """doc_id, section_key, start, end (exclusive), confidence (0 to 100) of the sections that are found."""
    return outcomes.where("code is null").select("doc_id", "section_key", "start", "end", "confidence")


def section_issues(outcomes: DataFrame) -> DataFrame:
    """doc_id, code, section_key, role, reason, candidates: warnings about sections, and incomplete: whether one makes the document's result incomplete (one that is merely not found, or an unclear closing marker, does not)."""
    return outcomes.where("code is not null").select("doc_id", "code", "section_key", "role", "reason", "candidates", ((F.col("code") != NOT_FOUND) & ~F.col("role").eqNullSafe(F.lit("terminal"))).alias("incomplete"))


def document_projection(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """documents(doc_id, path, is_primary, form, html) -> blocks of every document whose path ends in .htm or .html, and section outcomes of the primary ones of annual and quarterly forms. Blocks are written once."""
    eligible = documents.where(F.lower("path").rlike(r"\.html?$"))
    blocks = written(hx.html_blocks(eligible.select("doc_id", "html")), "document-blocks")
    primary = eligible.where("is_primary").select(F.col("doc_id").cast("long").alias("doc_id"), "form")
    own = blocks.join(_merged(primary.select("doc_id")), "doc_id", "left_semi").withColumn("has_anchor", F.col("anchor_id").isNotNull())
    return blocks, section_outcomes(own, primary)
