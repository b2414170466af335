"""Facts to observations: scans, slots, supports, duplicate reduction, selection, periods and identities, for all filings at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import scalars as S
from factloom.sources.staging import written

#: Values reach the operators as decimal(28,10), which sums and bounds keep exactly.


def filing_metadata(filing: DataFrame, accessions: DataFrame | None = None) -> DataFrame:
    out = filing.select("filing_id", "accession", "cik", "form", "accepted_at")
    return out if accessions is None else out.join(accessions.select("accession").distinct(), "accession", "left_semi")


def measures_by_unit(unit_measure: DataFrame) -> DataFrame:
    """unit_id, measures: ordered by side and ordinal."""
    m = F.sort_array(F.collect_list(F.struct("side", "ordinal", "ns", "name"))).alias("measures")
    return unit_measure.groupBy("unit_id").agg(m)


def is_pure_usd(measures: Column) -> Column:
    usd = (F.size(measures) == 1) & (measures[0]["side"] == "numerator") & (measures[0]["ns"] == S.ISO4217) & (measures[0]["name"] == "USD")
    return F.coalesce(usd, F.lit(False))


def fact_scan(fact: DataFrame, concept: DataFrame, context: DataFrame, unit_measure: DataFrame, dimension: DataFrame) -> DataFrame:
    """Facts with their concept, context, measures, names and whether their context has dimensions."""
    return with_names(known_facts(fact, concept, context, dimension), unit_measure)


def known_facts(fact: DataFrame, concept: DataFrame, context: DataFrame, dimension: DataFrame) -> DataFrame:
    """Facts that have their concept and context, with the context and whether it has dimensions. A context is its filing's, so facts meet it by both, and are not shuffled again where they lie by accession: the names that lack a concept are told by the distinct names, as
    a few names have most facts, and those are written, so that Spark knows their size and broadcasts them where it allows."""
    names = ["namespace_uri", "local_name"]
    lacking = written(fact.select(*names).distinct().join(concept.select(*names), names, "left_anti"), "scan-lacking-names")
    own = [c for c in ("accession", "context_id") if c in dimension.columns]
    ctx = context.join(dimension.select(*own, F.lit(True).alias("has_dimensions")).distinct(), own, "left").withColumn("has_dimensions", F.coalesce("has_dimensions", F.lit(False)))
    known = fact.where("namespace_uri is not null and local_name is not null").join(lacking, names, "left_anti")
    return known.join(ctx, ["accession", "context_id"])


def with_names(facts: DataFrame, unit_measure: DataFrame) -> DataFrame:
    """known_facts with their measures and names. Units are written, as the names that lack a concept are."""
    units = written(measures_by_unit(unit_measure), "scan-units")
    return facts.withColumns(classified(F.col("namespace_uri"), F.col("local_name"))).join(units, "unit_id", "left")


def classified(ns: Column, local: Column) -> dict[str, Column]:
    return {"source_qname": S.clark_name(ns, local), "family": S.namespace_family(ns), "origin": S.namespace_origin(ns)}


def undimensioned(fact: DataFrame, dimension: DataFrame) -> DataFrame:
    return fact.join(dimension.select("context_id").distinct(), "context_id", "left_anti")


def entity_matches(scheme: Column, identifier: Column, cik: Column) -> Column:
    return F.coalesce((scheme == S.SEC_SCHEME) & (F.lpad(identifier, 10, "0") == cik), F.lit(False))


def period_matches(period_type: Column, kind: Column, instant: Column, start: Column, end: Column, want_start: Column, want_end: Column) -> Column:
    by_kind = F.when(period_type == "instant", (kind == "instant") & (instant == want_end)).otherwise((kind == "duration") & (start == want_start) & (end == want_end))
    return F.coalesce(by_kind, F.lit(False))


def reporting_periods(filing: DataFrame, candidates: DataFrame) -> DataFrame:
    """accession, period_status, start, end, year and period focus of every filing. Candidates are one group only if all their fields and the trimmed value agree and
    the value is the context's end; any other is a group of its own. The focus is that of the largest fact_id."""
    value = F.trim("value")
    sec = entity_matches(F.col("entity_scheme"), F.col("entity_identifier"), F.col("c.cik"))
    named = F.concat_ws("|", "entity_identifier", "entity_scheme", "period_kind", F.coalesce("start_lexical", F.lit("~")), "end_lexical", value)
    group = F.when(value == F.col("end_lexical"), named).otherwise(F.concat(F.lit("fact "), F.col("fact_id").cast("string")))
    c = candidates.alias("c").withColumns({"sec": sec, "grp": F.when(sec, group)})
    last = F.max_by(F.struct("period_kind", "start_lexical", "end_lexical", "year_focus", "period_focus"), F.when(F.col("sec"), F.col("fact_id")))
    agg = c.groupBy("accession").agg(F.count("*").alias("n"), F.count_if("sec").alias("n_sec"), (F.min("grp") != F.max("grp")).alias("groups_differ"), last.alias("p"))
    out = filing.select("accession").join(agg, "accession", "left")
    status = (
        F.when(F.coalesce("n", F.lit(0)) == 0, "no_candidate").when(F.col("n_sec") == 0, "no_sec_entity").when(F.col("groups_differ"), "conflict")
        .when(F.col("p.period_kind") != "duration", "not_duration").when(F.col("p.start_lexical").isNull(), "missing_start").otherwise("ok")
    )
    ok = lambda c: F.when(F.col("period_status") == "ok", F.col(c))
    out = out.withColumn("period_status", status)
    return out.select("accession", "period_status", ok("p.start_lexical").alias("period_start"), ok("p.end_lexical").alias("period_end"), ok("p.year_focus").alias("year_focus"), ok("p.period_focus").alias("period_focus"))


def _listed(column: str) -> Column:
    return F.split(F.coalesce(column, F.lit("")), ",")


def decision_applies(cik: Column, family: Column) -> Column:
    """Of the columns of a decision of that family: its issuer exclusions, of which a null list has none, and its issuer scope."""
    return ~F.array_contains(_listed("exclude_ciks"), cik) & ((family != "issuer") | (F.col("issuer_cik") == cik))


def active(decisions: DataFrame) -> DataFrame:
    return decisions.where("status = 'accepted' and not stale")


def supported(facts: DataFrame, decisions: DataFrame) -> DataFrame:
    """facts with metric, decision_id and relation of each decision that they support: an equi-join on family and local name, then the names and issuers left out.

    facts: with accession, cik, local_name and the columns of classified(). Decisions are a rule table; Spark broadcasts it where its size allows.
    """
    f = facts.withColumn("rule_family", F.when(F.col("origin") == "issuer", "issuer").otherwise(F.col("family")))
    rules = active(decisions).select("metric", "decision_id", "relation", "issuer_cik", "exclude_ciks", "exclude_qnames", F.col("family").alias("rule_family"), F.col("local_name").alias("rule_name"))
    both = f.join(rules, (f["rule_family"] == rules["rule_family"]) & (F.col("local_name") == F.col("rule_name"))).drop(rules["rule_family"])
    both = both.where(~F.array_contains(_listed("exclude_qnames"), F.col("source_qname")) & decision_applies(F.col("cik"), F.col("rule_family")))
    return both.drop("rule_family", "rule_name", "issuer_cik", "exclude_ciks", "exclude_qnames")


def resolve_supports(facts: DataFrame, decisions: DataFrame) -> DataFrame:
    """fact_id with metric, decision, relation and tier, which is 1 for every support."""
    return supported(facts, decisions).select("fact_id", "accession", "metric", "decision_id", "relation", F.lit(1).alias("tier"), "source_qname")


def in_periods(facts: DataFrame, periods: DataFrame) -> DataFrame:
    """facts of filings whose reporting period is known, with its period_start and period_end."""
    return facts.join(periods.where("period_status = 'ok'").select("accession", "period_start", "period_end"), "accession")


def with_value() -> Column:
    return (F.col("value_status") == "valid") & ~F.col("is_nil") & F.col("resolved_numeric").isNotNull()


def qualify_slot(facts: DataFrame, periods: DataFrame, metrics: DataFrame) -> DataFrame:
    """Facts that fill a slot of their filing for a metric. facts: fact_scan with metric and cik, of all filings or already of in_periods."""
    f = facts.join(metrics.select("metric", "period_type"), "metric")
    f = f if "period_end" in facts.columns else in_periods(f, periods)
    fits = period_matches(F.col("period_type"), F.col("period_kind"), F.col("instant_lexical"), F.col("start_lexical"), F.col("end_lexical"), F.col("period_start"), F.col("period_end"))
    good = ~F.col("has_dimensions") & with_value()
    return f.where(good & entity_matches(F.col("entity_scheme"), F.col("entity_identifier"), F.col("cik")) & is_pure_usd(F.col("measures")) & fits)


def rank_key(d: Column) -> Column:
    """Best precision first: INF, then finite ones by places, then null; ties to the smaller fact_id. d: of parse_decimals."""
    return F.struct(d["rank"].alias("r"), (-F.coalesce(d["digits"], F.lit(0))).alias("d"), F.col("fact_id").alias("f"))


def oim_reduce(facts: DataFrame, *keys: str, with_ids: bool = True, sets: tuple[str, ...] = ()) -> DataFrame:
    """Duplicate facts of a key to an interval and a survivor; conflict if no value fits all, or equal places, however written, carry unlike values. The slice by
    places comes first. Places are read once a fact, before the slices. Without fact_ids a hot key is summed before it is shuffled; the list of them is a row of the key's size, so it is gathered only where a caller asks. sets: columns whose distinct values are gathered too."""
    value = F.col("resolved_numeric")
    facts = facts.withColumns({"parsed": S.parse_decimals(F.col("decimals")), "half": S.half_width(F.col("decimals"))})
    rank = rank_key(F.col("parsed"))
    ids = [*([F.collect_list("fact_id").alias("ids")] if with_ids else []), *[F.collect_set(c).alias(c) for c in sets]]
    by_places = facts.groupBy(*keys, "parsed").agg(
        F.max(value - F.col("half")).alias("lo"), F.min(value + F.col("half")).alias("hi"), (F.min(value) != F.max(value)).alias("unlike"),
        F.min(F.struct(rank.alias("rank"), value.alias("value"), F.col("decimals").alias("places"))).alias("best"), F.count("*").alias("n"), *ids,
    )
    ids = [*([F.sort_array(F.flatten(F.collect_list("ids"))).alias("fact_ids")] if with_ids else []), *[F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in sets]]
    out = by_places.groupBy(*keys).agg(F.max("lo").alias("lo"), F.min("hi").alias("hi"), F.max("unlike").alias("unlike"), F.min("best").alias("best"), F.sum("n").alias("n"), *ids)
    return out.select(*keys, "lo", "hi", (F.col("unlike") | (F.col("lo") > F.col("hi"))).alias("conflict"), F.col("best.value").alias("value"), F.col("best.places").alias("decimals"), F.col("best.rank").alias("rank"), "n", *(["fact_ids"] if with_ids else []), *sets)


def slot_grid(filing: DataFrame, metrics: DataFrame) -> DataFrame:
    """Every filing with every metric of the cohort, a rule table of a few rows."""
    return filing.select("accession", "cik", "form").crossJoin(metrics.select("metric", "period_type", "position"))


def out_of_scope(grid: DataFrame, decisions: DataFrame) -> DataFrame:
    """grid with out_of_scope: whether exact decisions exist for the metric but none applies to the issuer. Decisions meet the grid by metric and issuer: those for all issuers are
    counted, and with them how many leave the issuer out."""
    exact = active(decisions).where("relation = 'exact'").select("decision_id", "metric", "family", "issuer_cik", F.array_distinct(_listed("exclude_ciks")).alias("left_out"))
    wide = exact.where("family <> 'issuer'")
    counts = exact.groupBy("metric").agg(F.count_if(F.col("family") != "issuer").alias("n"))
    without = wide.select("metric", F.explode("left_out").alias("cik")).groupBy("metric", "cik").agg(F.count("*").alias("n_without"))
    own = exact.where((F.col("family") == "issuer") & ~F.array_contains("left_out", F.col("issuer_cik"))).select("metric", F.col("issuer_cik").alias("cik"), F.lit(True).alias("own")).distinct()
    both = grid.join(counts, "metric", "left").join(without, ["metric", "cik"], "left").join(own, ["metric", "cik"], "left")
    none = F.col("n").isNotNull() & (F.col("n") <= F.coalesce("n_without", F.lit(0))) & F.col("own").isNull()
    return both.withColumn("out_of_scope", none).drop("n", "n_without", "own")


def scope_by_metric(decisions: DataFrame, filing: DataFrame) -> DataFrame:
    """(metric, cik) pairs out of scope, of all metrics of the decisions, which are a rule table, and all issuers of the filings."""
    grid = filing.select("cik").distinct().crossJoin(active(decisions).select("metric").distinct())
    return out_of_scope(grid, decisions).where("out_of_scope")


def select_observations(filing: DataFrame, metrics: DataFrame, decisions: DataFrame, periods: DataFrame, facts: DataFrame) -> DataFrame:
    """One row per filing and metric: status, reason, value, places, unit, ids. facts: fact_scan with cik; those of filings of other than annual forms fill no slot and may be left out.

    The facts that fill a slot are shuffled by filing, once for all that follows, and meet the filings as one row each, before the filings are laid out by metric. A fact that several decisions take, or
    several filings of one accession, is one id."""
    columns = ["accession", "metric", "fact_id", "source_qname", "resolved_numeric", "decimals", "decision_id", (F.col("relation") == "exact").alias("exact")]
    slots = qualify_slot(supported(facts, decisions), periods, metrics).select(*columns).repartition("accession")
    names = oim_reduce(slots, "accession", "metric", "exact", "source_qname", sets=("decision_id",))
    of = lambda c: F.when(F.col("exact"), c)
    all_of = lambda c: F.array_distinct(F.sort_array(F.flatten(F.collect_list(of(F.col(c))))))
    over = names.groupBy("accession", "metric").agg(
        F.max(of(F.col("conflict"))).alias("conflict"), (F.min(of(F.col("value"))) != F.max(of(F.col("value")))).alias("unlike"), F.min(of(F.struct("rank", "value", "decimals"))).alias("best"), all_of("fact_ids").alias("fact_ids"),
        F.max(~F.col("exact")).alias("broader"), all_of("decision_id").alias("decision_ids"),
    )
    found = ["conflict", "unlike", "best", "fact_ids", "broader", "decision_ids"]
    per_filing = over.groupBy("accession").agg(F.map_from_entries(F.collect_list(F.struct("metric", F.struct(*found)))).alias("found"))
    rows = filing.select("accession", "cik", "form").join(periods.select("accession", "period_start", "period_end"), "accession", "left").join(per_filing, "accession", "left")
    grid = rows.crossJoin(metrics.select("metric", "period_type", "position")).withColumn("found", F.try_element_at("found", "metric"))
    out = out_of_scope(grid.select("*", *[F.col(f"found.{c}").alias(c) for c in found]).drop("found"), decisions)
    wrong, scope, none = ~F.col("form").isin(*S.ANNUAL_FORMS), F.col("out_of_scope"), F.col("best").isNull()
    status = F.when(wrong | scope, "unsupported").when(none, "missing").when(F.col("conflict") | F.col("unlike"), "conflict").otherwise("value")
    reason = F.when(wrong, "wrong_form").when(scope, "decision_scope").when(none & F.col("broader"), "broader_only")
    out = out.withColumns({"status": status, "reason": reason})
    if_value = lambda c: F.when(F.col("status") == "value", c)
    found = F.col("status").isin("value", "conflict")
    return out.select(
        "accession", "cik", "metric", "position", "status", "reason", if_value(F.col("best.value")).alias("numeric"), if_value(F.col("best.decimals")).alias("decimals"), if_value(F.lit("USD")).alias("unit"),
        F.when(F.col("period_type") == "duration", F.col("period_start")).alias("period_start"), "period_end", F.when(found, F.array_join(F.transform("fact_ids", lambda x: x.cast("string")), ",")).alias("fact_ids"),
        F.when(found, F.array_join("decision_ids", ",")).alias("decision_ids"), if_value(F.lit("exact")).alias("relation"), if_value(F.lit(1)).alias("tier"),
    )


def operand_intervals(slots: DataFrame) -> DataFrame:
    """accession, local_name, lo, hi, bad: across expanded names; bad if one conflicts, survivors differ or intervals do not meet. Facts are shuffled by filing, once for all that follows."""
    names = oim_reduce(slots.repartition("accession"), "accession", "local_name", "source_qname", with_ids=False)
    out = names.groupBy("accession", "local_name").agg(F.max("conflict").alias("conflict"), (F.min("value") != F.max("value")).alias("unlike"), F.max("lo").alias("lo"), F.min("hi").alias("hi"))
    return out.select("accession", "local_name", "lo", "hi", (F.col("conflict") | F.col("unlike") | (F.col("lo") > F.col("hi"))).alias("bad"))


#: Operands of the identities, by the kind of their period.
INSTANT_OPERANDS = {"a": "Assets", "l": "Liabilities", "e": "StockholdersEquity", "t": "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest", "m": "MinorityInterest"}
DURATION_OPERANDS = {"p": "ProfitLoss", "n": "NetIncomeLoss", "c": "NetIncomeLossAttributableToNoncontrollingInterest"}


def operand_facts(facts: DataFrame) -> DataFrame:
    """Facts with the names of operands, of the us-gaap family; those alone need a context where nothing but identities is asked for."""
    return facts.where(F.col("local_name").isin(*INSTANT_OPERANDS.values(), *DURATION_OPERANDS.values()) & (S.namespace_family(F.col("namespace_uri")) == "us-gaap"))


def operand_slots(slots: DataFrame) -> DataFrame:
    """Of the facts that fill a slot, those of the us-gaap family that an identity takes, each in its kind of period."""
    fits = ((F.col("period_kind") == "instant") & F.col("local_name").isin(*INSTANT_OPERANDS.values())) | ((F.col("period_kind") == "duration") & F.col("local_name").isin(*DURATION_OPERANDS.values()))
    return slots.where((F.col("family") == "us-gaap") & fits)


def identity_checks(filing: DataFrame, operands: DataFrame) -> DataFrame:
    """accession, name, status, by interval sums. nci_split: ProfitLoss against NetIncomeLoss and the non-controlling interest's. balance_sheet: assets against liabilities and equity,
    which is the total with non-controlling interest or, where neither a balance nor an income of that interest is there, the parent's. A missing operand makes an identity not applicable;
    an operand whose facts contradict each other makes it fail."""
    pick = lambda n, c: F.max(F.when(F.col("local_name") == n, F.col(c)))
    wide = operands.groupBy("accession").agg(*[pick(v, c).alias(f"{k}_{c}") for k, v in (INSTANT_OPERANDS | DURATION_OPERANDS).items() for c in ("lo", "hi", "bad")])
    out = filing.select("accession").join(wide, "accession", "left")
    there = lambda k: F.col(f"{k}_bad").isNotNull()
    parent = there("e") & ~there("m") & ~there("c")
    out = out.withColumns({f"q_{c}": F.when(there("t"), F.col(f"t_{c}")).when(parent, F.col(f"e_{c}")) for c in ("lo", "hi", "bad")})

    def finding(name: str, whole: str, one: str, other: str) -> Column:
        bad = F.col(f"{whole}_bad") | F.col(f"{one}_bad") | F.col(f"{other}_bad")
        lo, hi = F.col(f"{one}_lo") + F.col(f"{other}_lo"), F.col(f"{one}_hi") + F.col(f"{other}_hi")
        meets = (F.col(f"{whole}_lo") <= hi) & (lo <= F.col(f"{whole}_hi"))
        status = F.when(~(there(whole) & there(one) & there(other)), "not_applicable").when(bad | ~meets, "fail").otherwise("pass")
        return F.struct(F.lit(name).alias("name"), status.alias("status"))

    return out.select("accession", F.inline(F.array(finding("nci_split", "p", "n", "c"), finding("balance_sheet", "a", "l", "q"))))


def first_reported(values: DataFrame) -> DataFrame:
    """The earliest accepted value of each slot; one without an acceptance time cannot be it. values: cik, accession, accepted_at, metric, period_end, numeric."""
    first = F.min(F.struct("accepted_at", "accession", "numeric")).alias("f")
    return values.where("accepted_at is not null").groupBy("cik", "metric", "period_end").agg(first).select("cik", "metric", "period_end", "f.accession", "f.numeric")


def latest_as_of(values: DataFrame, time: str) -> DataFrame:
    """The last value of each slot that was accepted by a time, whether it had been reported before and whether it then had another value."""
    slot = ["cik", "metric", "period_end"]
    w = Window.partitionBy(*slot).orderBy("accepted_at", "accession")
    known = values.where(F.col("accepted_at") <= F.lit(time).cast("timestamp"))
    seen = known.withColumns({"before": F.lag("numeric").over(w), "place": F.row_number().over(w)})
    last = seen.groupBy(*slot).agg(F.max_by(F.struct("accession", "numeric", "before"), "place").alias("l"), F.count("*").alias("n"))
    return last.select(*slot, "l.accession", "l.numeric", (F.col("n") > 1).alias("reported_again"), F.coalesce(F.col("l.numeric") != F.col("l.before"), F.lit(False)).alias("value_changed"))


def period_anchors(filing: DataFrame, periods: DataFrame) -> DataFrame:
    """cik, period_end with the year and period focus that all filings of that end agree on, else unknown."""
    ok = periods.where("period_status = 'ok'").join(filing.select("accession", "cik"), "accession")
    one = F.count_distinct(F.struct("year_focus", "period_focus")) == 1
    return ok.groupBy("cik", "period_end").agg(*[F.when(one, F.min(c)).otherwise("unknown").alias(c) for c in ("year_focus", "period_focus")])


def fact_context_join(facts: DataFrame, filing: DataFrame, contexts: DataFrame, documents: DataFrame, own: tuple[str, ...] = ()) -> DataFrame:
    """Every occurrence of each concept: fact_id, concept, accession, cik, report_period_end, value and unit, its context's period, and the path of its document, null where it has none. Facts without their filing or context are left out.

    facts: with document_id; filing(accession, cik, report_period_end); contexts: b_context's columns; documents(document_id, path), one row an id. own: columns by which contexts and documents are known as well as by their ids; with accession, facts that lie by accession are not shuffled again."""
    period = contexts.select(*own, "context_id", "period_kind", "instant_lexical", "start_lexical", "end_lexical")
    rows = facts.join(filing.select("accession", "cik", "report_period_end"), "accession").join(period, [*own, "context_id"]).join(documents.select(*own, "document_id", F.col("path").alias("document")), [*own, "document_id"], "left")
    return rows.select(
        "fact_id", S.clark_name(F.col("namespace_uri"), F.col("local_name")).alias("concept"), "accession", "cik", "report_period_end", "resolved_numeric", "is_nil", "unit_id", "context_id", "period_kind", "instant_lexical", "start_lexical", "end_lexical", "document"
    )
