"""The append-only mapping ledger: heads, positions, history, conflicts and the facts that a mapping touches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import scalars as S
from factloom.sources.staging import written


def current_heads(revisions: DataFrame) -> DataFrame:
    """Revisions that no other supersedes."""
    followed = revisions.where("supersedes_id is not null").select(F.col("supersedes_id").alias("id"))
    return revisions.join(followed, "id", "left_anti")


def revision_positions(revisions: DataFrame) -> DataFrame:
    """id, root, revision (from 1), is_current, by doubling: each round a row learns the ancestor twice as far away, until none has one left, so a chain
    of n revisions takes log2(n) joins. A revision that is its own ancestor is refused."""
    at = revisions.select("id", F.col("supersedes_id").alias("up"), F.lit(1).alias("depth"), F.col("id").alias("root"))
    at = written(at, "ledger-chains")
    step, most = 1, at.count()
    while not at.where("up is not null").isEmpty():
        if step > 2 * most:
            raise ValueError("a revision supersedes itself by way of others")
        up = at.select(F.col("id").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("d2"), F.col("root").alias("r2"))
        at = written(at.join(up, "up", "left").select("id", F.col("up2").alias("up"), (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth"), F.coalesce("r2", "root").alias("root")), "ledger-chains")
        step *= 2
    heads = current_heads(revisions).select("id", F.lit(True).alias("is_current"))
    return at.join(heads, "id", "left").select("id", "root", F.col("depth").alias("revision"), F.coalesce("is_current", F.lit(False)).alias("is_current"))


def mapping_history(revisions: DataFrame) -> DataFrame:
    """One row per head with its chain, oldest first."""
    at = revision_positions(revisions).join(revisions.select("id", "status"), "id")
    chain = at.groupBy("root").agg(F.sort_array(F.collect_list(F.struct("revision", "id", "status"))).alias("chain"), F.max(F.when(F.col("is_current"), F.col("id"))).alias("head"))
    return chain.select("head", "root", F.size("chain").cast("long").alias("revisions"), F.array_join(F.transform("chain", lambda c: F.concat_ws(":", c["id"].cast("string"), c["status"])), ",").alias("history"))


def mapping_conflicts(revisions: DataFrame) -> DataFrame:
    """Pairs of accepted exact heads of one concept with overlapping scopes and validity."""
    heads = current_heads(revisions).where("status = 'accepted' and relation = 'exact'").select("id", "concept", "metric", "scope_kind", "issuer_cik", "valid_from", "valid_to")
    a, b = heads.alias("a"), heads.alias("b")
    overlap = S.intervals_overlap(F.col("a.valid_from"), F.col("a.valid_to"), F.col("b.valid_from"), F.col("b.valid_to"))
    scope = S.scopes_overlap(F.col("a.scope_kind"), F.col("a.issuer_cik"), F.col("b.scope_kind"), F.col("b.issuer_cik"))
    return a.join(b, (F.col("a.concept") == F.col("b.concept")) & (F.col("a.id") < F.col("b.id")) & overlap & F.coalesce(scope, F.lit(True))).select(F.col("a.concept").alias("concept"), F.col("a.id").alias("id"), F.col("b.id").alias("other_id"))


def affected_facts(revisions: DataFrame, facts: DataFrame) -> DataFrame:
    """mapping_id, fact_id, accession, cik: facts of an accepted head's concept, in its issuer scope, whose filing's period lies in its validity.

    facts: fact_id, accession, cik, concept, period (date)."""
    heads = claimed_heads(revisions)
    return claimed_facts(heads, facts).join(heads.select("mapping_id", "claim"), "claim").select("mapping_id", "fact_id", "accession", "cik")


def claimed_heads(revisions: DataFrame) -> DataFrame:
    """mapping_id, concept, issuer, valid_from, valid_to, claim of the accepted heads: heads of one concept, issuer scope and validity touch the same facts, and their claim is the smallest of their ids. Written once. issuer: the one it
    is for after an '=', or '*' for all."""
    issuer = F.when(F.col("scope_kind") == "global", "*").otherwise(F.concat(F.lit("="), "issuer_cik"))
    heads = current_heads(revisions).where("status = 'accepted'").select(F.col("id").alias("mapping_id"), "concept", issuer.alias("issuer"), "valid_from", "valid_to")
    same = Window.partitionBy("concept", "issuer", "valid_from", "valid_to")
    return written(heads.withColumn("claim", F.min("mapping_id").over(same)), "ledger-heads")


def claimed_facts(heads: DataFrame, facts: DataFrame) -> DataFrame:
    """claim, fact_id, accession, cik: facts that a claim of the heads touches, once however many heads share it. A fact meets the claims on its issuer and those on all by key."""
    claims = written(heads.where("mapping_id = claim").drop("mapping_id"), "ledger-distinct-claims")
    keyed = facts.withColumn("issuer", F.explode(F.array(F.lit("*"), F.concat(F.lit("="), "cik"))))
    inside = S.interval_contains(F.col("valid_from"), F.col("valid_to"), F.col("period"))
    return keyed.join(claims, ["concept", "issuer"]).where(inside).select("claim", "fact_id", "accession", "cik")


def summary_by_head(heads: DataFrame, facts: DataFrame, shown: int = 25) -> DataFrame:
    """affected_summary of the heads, summed once a claim, so that neither heads nor facts are paired."""
    by_claim = affected_summary(claimed_facts(heads, facts).withColumnRenamed("claim", "mapping_id"), shown).withColumnRenamed("mapping_id", "claim")
    return heads.select("mapping_id", "claim").join(by_claim, "claim").drop("claim")


def top_by_head(heads: DataFrame, facts: DataFrame, n: int = 25) -> DataFrame:
    """mapping_id, fact_id, rank: top_facts of the heads, ranked once a claim."""
    top = written(top_facts(claimed_facts(heads, facts).withColumnRenamed("claim", "mapping_id"), n).select(F.col("mapping_id").alias("claim"), "fact_id", "rank"), "ledger-top")
    return heads.select("mapping_id", "claim").join(top, "claim").select("mapping_id", "fact_id", "rank")


def affected_summary(affected: DataFrame, shown: int = 25) -> DataFrame:
    out = affected.groupBy("mapping_id").agg(F.count("*").alias("facts"), F.count_distinct("accession").alias("accessions"), F.count_distinct("cik").alias("issuers"))
    return out.select("mapping_id", "facts", F.least("facts", F.lit(shown).cast("long")).alias("shown"), (F.col("facts") > shown).alias("truncated"), "accessions", "issuers")


def sync_counts(mirror: DataFrame, source: DataFrame, key: str, digest: str) -> DataFrame:
    """kind, n: keys added, changed, removed and unchanged between the mirror and its source."""
    both = mirror.select(key, F.col(digest).alias("m")).join(source.select(key, F.col(digest).alias("s")), key, "full")
    kind = F.when(F.col("m").isNull(), "added").when(F.col("s").isNull(), "removed").when(F.col("m") == F.col("s"), "unchanged").otherwise("changed")
    return both.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def list_mappings(revisions: DataFrame, status: str | None = None, relation: str | None = None, metric: str | None = None, issuer: str | None = None, concept: str | None = None) -> DataFrame:
    """Current heads that meet all filters given."""
    out = current_heads(revisions)
    for column, value in (("status", status), ("relation", relation), ("metric", metric), ("issuer_cik", issuer), ("concept", concept)):
        out = out if value is None else out.where(F.col(column) == value)
    return out


def mapping_sort(mappings: DataFrame) -> DataFrame:
    """By namespace, local name, scope, issuer, metric, relation and id; a global issuer scope comes first."""
    ns, local = F.regexp_extract("concept", r"^\{(.*)\}", 1), F.regexp_extract("concept", r"\}(.*)$", 1)
    return mappings.orderBy(ns, local, "scope_kind", F.asc_nulls_first("issuer_cik"), "metric", "relation", "id")


def top_facts(affected: DataFrame, n: int = 25) -> DataFrame:
    """affected_facts with rank: the first n facts of each mapping, by accession and fact. A window limit keeps a mapping's best n of each partition before the shuffle."""
    w = Window.partitionBy("mapping_id").orderBy("accession", "fact_id")
    return affected.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def apply_proposals(proposals: DataFrame, concepts: DataFrame, metrics: DataFrame, issuers: DataFrame) -> DataFrame:
    """proposals with error: the first of unknown_concept, unknown_issuer, unknown_metric and metric_out_of_sync, or null for those that become candidates.

    concepts(concept), metrics(metric, hash), issuers(cik)."""
    known = lambda df, c, k: df.select(F.col(c).alias(k), F.lit(True).alias(f"has_{k}")).distinct()
    out = proposals.join(known(concepts, "concept", "concept"), "concept", "left").join(known(issuers, "cik", "issuer_cik"), "issuer_cik", "left").join(metrics.select("metric", F.col("hash").alias("now")), "metric", "left")
    error = (
        F.when(F.col("has_concept").isNull(), "unknown_concept").when(F.col("issuer_cik").isNotNull() & F.col("has_issuer_cik").isNull(), "unknown_issuer")
        .when(F.col("now").isNull(), "unknown_metric").when(F.col("now") != F.col("metric_hash"), "metric_out_of_sync")
    )
    return out.select(*proposals.columns, error.alias("error"))


CLAIM = ["concept", "scope_kind", "issuer_cik", "valid_from", "valid_to"]


def _meeting(claims: DataFrame, others: DataFrame) -> DataFrame:
    """Claims (mapping_id and CLAIM) that overlap one of the others (CLAIM) of their concept: those of one issuer meet by issuer, and only claims on all issuers meet every other of the concept."""
    o = others.select(*[F.col(c).alias(f"o_{c}") for c in CLAIM])
    dates = S.intervals_overlap(F.col("valid_from"), F.col("valid_to"), F.col("o_valid_from"), F.col("o_valid_to"))
    meet = (F.col("concept") == F.col("o_concept")) & dates
    own, every = claims.where("scope_kind = 'issuer' and issuer_cik is not null"), claims.where("not (scope_kind = 'issuer' and issuer_cik is not null)")
    o_own, o_every = o.where("o_scope_kind = 'issuer' and o_issuer_cik is not null"), o.where("not (o_scope_kind = 'issuer' and o_issuer_cik is not null)")
    found = [own.join(o_own, meet & (F.col("issuer_cik") == F.col("o_issuer_cik")), "left_semi"), own.join(o_every, meet, "left_semi"), every.join(o, meet, "left_semi")]
    return found[0].unionByName(found[1]).unionByName(found[2]).select("mapping_id").distinct()


def first_come(claims: DataFrame) -> DataFrame:
    """mapping_id of the claims that are accepted when they are taken one by one in the order of their ids and each is refused that overlaps an accepted one.

    In rounds: a claim with no smaller undecided one that it could meet is accepted (the smallest of its concept and issuer, if it is smaller than the smallest on all issuers, and the other way round), and what overlaps it
    is refused. A round decides at least the smallest claim of each concept; each round's tables are written. claims(mapping_id, CLAIM): unique ids."""
    left = written(claims.select("mapping_id", *CLAIM), "ledger-claims")
    accepted: DataFrame | None = None
    alone = F.coalesce((F.col("scope_kind") == "issuer") & F.col("issuer_cik").isNotNull(), F.lit(False))
    while not left.isEmpty():
        concept = Window.partitionBy("concept")
        least = lambda c: F.min(F.when(c, F.col("mapping_id")))
        by_issuer = left.groupBy("concept", F.when(alone, F.col("issuer_cik")).alias("issuer")).agg(F.min("mapping_id").alias("least"))
        by_issuer = by_issuer.withColumns({"every": F.min(F.when(F.col("issuer").isNull(), F.col("least"))).over(concept), "any": F.min(F.when(F.col("issuer").isNotNull(), F.col("least"))).over(concept)})
        rival = F.when(F.col("issuer").isNull(), F.col("any")).otherwise(F.col("every"))
        now = by_issuer.where(rival.isNull() | (F.col("least") < rival)).select(F.col("least").alias("mapping_id"))
        now = written(left.join(now, "mapping_id", "left_semi"), "ledger-accepted")
        rest = left.join(now.select("mapping_id"), "mapping_id", "left_anti")
        left = written(rest.join(_meeting(rest, now), "mapping_id", "left_anti"), "ledger-claims")
        accepted = now if accepted is None else accepted.unionByName(now)
    return (left if accepted is None else accepted).select("mapping_id")


def with_successors(revisions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """outcomes(mapping_id, error) with successor_id for those without an error: ids after the largest of the revisions, in the order of mapping_id. Places are counted within ranges of ids and the ranges' counts added up."""
    last = revisions.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last"))
    good = outcomes.where("error is null").select("mapping_id", F.floor(F.col("mapping_id") / 65536).alias("range"))
    before = good.groupBy("range").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(Window.orderBy("range")) - F.col("n")).drop("n")
    placed = good.join(before, "range").withColumn("place", F.col("before") + F.row_number().over(Window.partitionBy("range").orderBy("mapping_id")))
    placed = placed.crossJoin(F.broadcast(last)).select("mapping_id", (F.col("last") + F.col("place")).alias("successor_id"))
    return outcomes.join(placed, "mapping_id", "left")


def apply_acceptances(revisions: DataFrame, reviews: DataFrame, metrics: DataFrame) -> DataFrame:
    """mapping_id, error, successor_id: a review accepts a current candidate of an unchanged metric with a rationale and evidence, if its exact mapping conflicts neither with an accepted head nor with a
    candidate of a smaller id that the batch accepts; one that the batch refuses stands in nobody's way. Successors get new ids.

    reviews(mapping_id, rationale, evidence, metric_hash), metrics(metric, hash)."""
    heads = current_heads(revisions).select("id", F.lit(True).alias("current"))
    rows = reviews.join(revisions.drop(*[c for c in reviews.columns if c != "mapping_id"]).withColumnRenamed("id", "mapping_id"), "mapping_id", "left").join(heads.withColumnRenamed("id", "mapping_id"), "mapping_id", "left")
    rows = rows.join(metrics.select("metric", F.col("hash").alias("now")), "metric", "left")
    error = (
        F.when(F.col("status").isNull(), "unknown_mapping").when(F.col("current").isNull(), "not_current").when(F.col("status") != "candidate", "not_a_candidate").when(~F.col("now").eqNullSafe(F.col("metric_hash")), "metric_changed")
        .when(F.coalesce(F.trim("rationale"), F.lit("")) == "", "no_rationale").when(F.coalesce("evidence", F.lit(0)) < 1, "no_evidence")
    )
    rows = written(rows.withColumn("error", error), "ledger-reviews")
    fit = rows.where("error is null and relation = 'exact'").select("mapping_id", *CLAIM)
    taken = _meeting(fit, current_heads(revisions).where("status = 'accepted' and relation = 'exact'"))
    free = written(fit.join(taken, "mapping_id", "left_anti"), "ledger-free")
    clash = fit.join(first_come(free), "mapping_id", "left_anti").select("mapping_id", F.lit(True).alias("clash"))
    out = rows.join(clash, "mapping_id", "left").select("mapping_id", F.coalesce("error", F.when(F.col("clash"), "conflict")).alias("error"))
    return with_successors(revisions, written(out, "ledger-outcomes"))


def successors(revisions: DataFrame, outcomes: DataFrame, reviews: DataFrame, status: str) -> DataFrame:
    """The revisions that decisions append: each is a copy of its mapping's claim with its own id, supersedes_id, status and rationale. outcomes(mapping_id, error, successor_id)."""
    decided = outcomes.where("error is null").select("mapping_id", "successor_id").join(reviews.select("mapping_id", "rationale"), "mapping_id")
    old = revisions.drop("supersedes_id", "status", "rationale").withColumnRenamed("id", "supersedes_id")
    return old.join(decided.withColumnRenamed("mapping_id", "supersedes_id"), "supersedes_id").withColumnRenamed("successor_id", "id").withColumn("status", F.lit(status))


def apply_rejections(revisions: DataFrame, reviews: DataFrame) -> DataFrame:
    """mapping_id, error: a current candidate or accepted mapping is rejected with a rationale; rejected ones stay so."""
    heads = current_heads(revisions).select(F.col("id").alias("mapping_id"), F.lit(True).alias("current"))
    rows = reviews.join(revisions.select(F.col("id").alias("mapping_id"), "status"), "mapping_id", "left").join(heads, "mapping_id", "left")
    error = F.when(F.col("status").isNull(), "unknown_mapping").when(F.col("current").isNull(), "not_current").when(F.col("status") == "rejected", "is_rejected").when(F.trim("rationale") == "", "no_rationale")
    return rows.select("mapping_id", error.alias("error"))


def mapping_report(revisions: DataFrame, facts: DataFrame, metrics: DataFrame, mirror: DataFrame) -> DataFrame:
    """A row per head: concept, metric, whether its metric changed since or is out of step with the mirror, its history and what it touches. metrics and mirror: (metric, hash)."""
    heads = current_heads(revisions).select(F.col("id").alias("head"), "concept", "metric", "status")
    touched = summary_by_head(claimed_heads(revisions), facts).withColumnRenamed("mapping_id", "head")
    out = heads.join(metrics.select("metric", F.col("hash").alias("now")), "metric", "left").join(mirror.select("metric", F.col("hash").alias("then")), "metric", "left")
    out = out.join(mapping_history(revisions).drop("root"), "head", "left").join(touched, "head", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return out.select("head", "concept", "metric", "status", F.col("now").isNull().alias("metric_gone"), (~F.col("now").eqNullSafe(F.col("then"))).alias("out_of_sync"), "revisions", "history", zero("facts"), zero("accessions"), zero("issuers"))


def removed_metrics(mirror: DataFrame, source: DataFrame, revisions: DataFrame) -> DataFrame:
    """metric, blocked: metrics of the mirror that the source lacks; those that a head still names cannot go."""
    used = current_heads(revisions).select("metric", F.lit(True).alias("used")).distinct()
    return mirror.select("metric").subtract(source.select("metric")).join(used, "metric", "left").select("metric", F.coalesce("used", F.lit(False)).alias("blocked"))


def sync_metrics(mirror: DataFrame, source: DataFrame, revisions: DataFrame) -> DataFrame:
    """metric, action, hash: what a sync does with each metric of the mirror or the source: added, changed, unchanged, removed, or blocked, where the source lacks it and some revision, current or not, names it. hash: the one it has
    afterwards, null for a removed one. mirror and source: (metric, hash), one row a metric; revisions: metric."""
    both = mirror.select("metric", F.col("hash").alias("old"), F.lit(True).alias("had")).join(source.select("metric", F.col("hash").alias("new"), F.lit(True).alias("has")), "metric", "full")
    used = revisions.select("metric").distinct().withColumn("used", F.lit(True))
    action = F.when(F.col("had").isNull(), "added").when(F.col("has") & F.col("old").eqNullSafe(F.col("new")), "unchanged").when(F.col("has"), "changed").when(F.col("used"), "blocked").otherwise("removed")
    out = both.join(used, "metric", "left").withColumn("action", action)
    return out.select("metric", "action", F.when(F.col("action") == "blocked", F.col("old")).otherwise(F.col("new")).alias("hash"))


class BlockedRemoval(Exception):
    """A metric that revisions name cannot be removed."""


def synced_mirror(actions: DataFrame) -> DataFrame:
    """The mirror (metric, hash) after a sync, of the actions of sync_metrics. One blocked metric refuses the whole sync: BlockedRemoval, naming up to 20 of them."""
    if blocked := actions.where("action = 'blocked'").select("metric").orderBy("metric").limit(20).collect():
        raise BlockedRemoval(", ".join(r.metric for r in blocked))
    return actions.where("action <> 'removed'").select("metric", "hash")
