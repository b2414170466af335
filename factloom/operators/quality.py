"""Quality cells over slots, with their counters and rates, and the censuses of names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import scalars as S


def single_or_mixed(values: Column, fallback: Column) -> Column:
    """Aggregate: the one distinct value, 'mixed' if there are more, else the fallback."""
    low, high = F.min(values), F.max(values)
    return F.when(low.isNull(), fallback).when(low == high, low).otherwise("mixed")


def share(part: Column, whole: Column) -> Column:
    """part / whole to six places, null without a whole. The millionths are rounded as a double, as SQL engines do; Spark's own round takes the double's decimal text, and differs where that ends in a 5."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 1e6) / 1e6


def filing_frame(filing: DataFrame, facts: DataFrame, issuers: DataFrame, periods: DataFrame) -> DataFrame:
    """accession, cik, form, fiscal_year, industry, release: one row per filing. The year is that of the filing's observations, which is their reporting period's, else the report's own: where its period ends, or the filing date.

    filing: accession, cik, form, filing_date; facts: accession, namespace_uri; periods: accession, year_focus, period_end."""
    us_gaap = F.when(S.namespace_family(F.col("namespace_uri")) == "us-gaap", S.release_token(F.col("namespace_uri")))
    agg = facts.groupBy("accession").agg(single_or_mixed(us_gaap, F.lit(None).cast("string")).alias("release"))
    years = periods.select("accession", F.coalesce(F.nullif("year_focus", F.lit("")), F.substring("period_end", 1, 4)).alias("year"))
    out = filing.join(agg, "accession", "left").join(years, "accession", "left").join(issuers.select("cik", "industry"), "cik", "left")
    none = F.lit("unknown")
    return out.select("accession", "cik", "form", F.coalesce(F.col("year"), F.year("filing_date").cast("string"), none).alias("fiscal_year"), F.coalesce("industry", none).alias("industry"), F.coalesce("release", none).alias("release"))


def quality_cells(observations: DataFrame, frame: DataFrame, identities: DataFrame) -> DataFrame:
    """Counters by metric, year, release and industry. Identity findings count once per filing of a cell, which has one row a filing and metric."""
    per_filing = identities.groupBy("accession").agg(*[F.count_if(F.col("status") == s).alias(f"identity_{s}") for s in ("pass", "fail", "not_applicable")])
    rows = observations.select("accession", "metric", "status", "reason").join(frame, "accession").join(per_filing, "accession", "left")
    count = lambda c: F.count_if(c)
    wrong = F.coalesce(F.col("reason") == "wrong_form", F.lit(False))
    out = rows.groupBy("metric", "fiscal_year", "release", "industry").agg(
        F.count("*").alias("slots"), count(wrong).alias("wrong_form"), count(~wrong).alias("eligible"), *[count((F.col("status") == s) & ~wrong).alias(s) for s in ("value", "missing", "conflict", "unsupported")],
        *[F.coalesce(F.sum(f"identity_{s}"), F.lit(0)).alias(f"identity_{s}") for s in ("pass", "fail", "not_applicable")],
    )
    return out.withColumn("publication_rate", share(F.col("value"), F.col("eligible")))


def partition_faults(cells: DataFrame) -> DataFrame:
    """Cells whose counters do not add up; none is expected."""
    sums = (F.col("eligible") == F.col("value") + F.col("missing") + F.col("conflict") + F.col("unsupported")) & (F.col("slots") == F.col("eligible") + F.col("wrong_form")) & (F.col("value") <= F.col("eligible"))
    return cells.where(~sums)


CELL = ("metric", "fiscal_year", "release", "industry")
IDENTITY = {"pass": "identity_pass", "fail": "identity_fail", "not_applicable": "identity_na"}
ORACLE = ("agree", "differ", "absent", "ambiguous", "na")


def quality_slots(observations: DataFrame, frame: DataFrame, applicable: DataFrame, labels: DataFrame) -> DataFrame:
    """accession, metric, status, reason, eligible (of an annual form), applicable (a decision applies), label and the cell's fiscal_year, release and industry: a row per observation.

    A filing without a frame has the form '' and unknown year, release and industry; a slot without a label is na. frame, applicable(accession, metric) and labels(accession, metric, label) have one row a key; repeated rows of applicable count once."""
    slot = ["accession", "metric"]
    rows = observations.select(*slot, "status", "reason").join(frame.select("accession", "form", "fiscal_year", "release", "industry"), "accession", "left")
    rows = rows.join(applicable.select(*slot).distinct().withColumn("applicable", F.lit(True)), slot, "left").join(labels.select(*slot, "label"), slot, "left")
    known = lambda c: F.coalesce(F.col(c), F.lit("unknown")).alias(c)
    no = F.lit(False)
    return rows.select(
        *slot, "status", "reason", F.coalesce(F.col("form").isin(*S.ANNUAL_FORMS), no).alias("eligible"), F.coalesce("applicable", no).alias("applicable"), F.coalesce("label", F.lit("na")).alias("label"), *[known(c) for c in CELL[1:]]
    )


def quality_report(slots: DataFrame, identities: DataFrame) -> DataFrame:
    """All counters and both rates of each cell. slots: of quality_slots; identities(accession, status).

    The statuses divide the eligible slots (any other status counts as a conflict), the reasons the unsupported ones, the labels all slots. Identity findings count once per filing of a cell. A rate without a denominator is null.
    Slots are summed per filing before the findings are joined, and a filing's sums per cell after, so a cell that holds most filings is summed before its shuffle."""
    status, ok = F.coalesce("status", F.lit("")), F.col("eligible")
    scope = F.coalesce(F.col("reason") == "decision_scope", F.lit(False))
    counts = {
        "n_slots": F.lit(True), "n_slot_eligible": ok, "n_ineligible_wrong_form": ~ok, **{f"n_{s}": ok & (status == s) for s in ("value", "missing", "unsupported")}, "n_conflict": ok & ~status.isin("value", "missing", "unsupported"),
        "n_reason_decision_scope": ok & (status == "unsupported") & scope, "n_reason_other_unsupported": ok & (status == "unsupported") & ~scope, "n_decision_applicable": F.col("applicable"), **{f"oracle_{s}": F.col("label") == s for s in ORACLE},
    }
    per_filing = slots.groupBy("accession", *CELL).agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    findings = identities.groupBy("accession").agg(*[F.count_if(F.col("status") == s).alias(n) for s, n in IDENTITY.items()])
    total = lambda n: F.coalesce(F.sum(n), F.lit(0)).alias(n)
    cells = per_filing.join(findings, "accession", "left").groupBy(*CELL).agg(*[total(n) for n in (*counts, *IDENTITY.values())])
    rate = lambda n: share(F.col("n_value"), F.col(n))
    return cells.withColumns({"n_no_applicable_decision": F.col("n_slot_eligible") - F.col("n_decision_applicable"), "publication_rate": rate("n_slot_eligible"), "selector_yield": rate("n_decision_applicable")})


def report_faults(cells: DataFrame) -> DataFrame:
    """A cell's key and code for each rule that its counters break: statuses, forms, labels and reasons that do not add up, bounds (applicable within eligible within all), and more values than applicable decisions."""
    total = lambda *names: reduce(Column.__add__, [F.col(n) for n in names])
    must = {
        "statuses": total("n_value", "n_missing", "n_unsupported", "n_conflict") == F.col("n_slot_eligible"), "forms": total("n_ineligible_wrong_form", "n_slot_eligible") == F.col("n_slots"), "labels": total(*[f"oracle_{s}" for s in ORACLE]) == F.col("n_slots"),
        "reasons": total("n_reason_decision_scope", "n_reason_other_unsupported") == F.col("n_unsupported"), "bounds": (F.col("n_decision_applicable") <= F.col("n_slot_eligible")) & (F.col("n_slot_eligible") <= F.col("n_slots")),
        "values_over_decisions": F.col("n_value") <= F.col("n_decision_applicable"),
    }
    return cells.select(*CELL, F.explode(F.array_compact(F.array(*[F.when(~c, F.lit(n)) for n, c in must.items()]))).alias("code"))


def value_without_decision(slots: DataFrame) -> DataFrame:
    """accession, metric of published values to which no decision applies; none may stand in a report."""
    return slots.where("status = 'value' and not applicable").select("accession", "metric")


def qname_census(facts: DataFrame) -> DataFrame:
    """Distinct filings per expanded name; summed per name and filing first, so that a common name is no hot key."""
    return facts.groupBy(S.clark_name(F.col("namespace_uri"), F.col("local_name")).alias("qname")).agg(F.count_distinct("accession").alias("accessions"))


def name_reuse(facts: DataFrame) -> DataFrame:
    keys = [S.namespace_family(F.col("namespace_uri")).alias("family"), S.release_token(F.col("namespace_uri")).alias("release"), F.col("local_name")]
    return facts.groupBy(*keys).agg(F.count_distinct("accession").alias("accessions"))


def gold_join(gold: DataFrame, observations: DataFrame) -> DataFrame:
    """accession, metric, outcome of each gold assertion on a filing of the build: ok, or the first that differs of status, period, numeric and reason; absent where the build has no such slot, unknown_status
    where gold states a status that is none of value, missing and unsupported. Assertions on filings outside the build are skipped.

    gold: accession, metric, kind (duration, instant), period_start, period_end, status, numeric, reason. A value is compared by period and numeric; a missing one must have the period, no numeric and the same reason, as must an unsupported
    one, but for one of the wrong form, of which the reason alone counts."""
    o = observations.select("accession", "metric", *[F.col(c).alias(f"got_{c}") for c in ("status", "reason", "numeric", "period_start", "period_end")])
    both = gold.join(observations.select("accession").distinct(), "accession", "left_semi").join(o, ["accession", "metric"], "left")
    start = F.when(F.col("kind") == "duration", F.col("period_start"))
    period = start.eqNullSafe(F.col("got_period_start")) & F.col("period_end").eqNullSafe(F.col("got_period_end"))
    same_reason = F.nullif("reason", F.lit("")).eqNullSafe(F.nullif("got_reason", F.lit("")))
    numeric = F.when(F.col("status") == "value", F.col("numeric").eqNullSafe(F.col("got_numeric"))).otherwise(F.col("got_numeric").isNull())
    wrong_form = F.coalesce((F.col("status") == "unsupported") & (F.col("reason") == "wrong_form"), F.lit(False))
    outcome = (
        F.when(F.col("got_status").isNull(), "absent").when(~F.col("status").eqNullSafe(F.col("got_status")), "status").when(~F.col("status").isin("value", "missing", "unsupported"), "unknown_status")
        .when(~wrong_form & ~period, "period").when(~wrong_form & ~numeric, "numeric").when((F.col("status") != "value") & ~same_reason, "reason").otherwise("ok")
    )
    return both.select("accession", "metric", outcome.alias("outcome"))
