"""Checks of bundles and of a corpus's manifest, and the documents that make up a filing's report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Types of exhibits.
FEE_TYPES, INSTANCE_TYPE = ("EX-FILING FEES", "EX-FILINGFEE"), "EX-101.INS"


def payload_hash(artifacts: DataFrame) -> DataFrame:
    """accession, payload_hash: of a filing's paths and digests, in order."""
    line = F.concat_ws("|", "path", "digest")
    return artifacts.groupBy("accession").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("payload_hash"))


def bundle_structure(artifacts: DataFrame, bindings: DataFrame, reports: DataFrame, stored: DataFrame) -> DataFrame:
    """accession, rule, name of what is wrong with bundles: the payload's hash, repeated paths, repeated or unbound addresses, bindings to no file or to other bytes, aliases
    that several bindings have or that are an address themselves.

    artifacts(accession, path, digest), bindings(accession, uri, path, digest, alias), reports(accession, uri), stored(accession, payload_hash)."""
    rule = lambda df, code, name: df.select("accession", code.alias("rule"), F.col(name).cast("string").alias("name"))
    times = lambda df, key, n: df.groupBy("accession", F.col(key).alias("address")).agg(F.count("*").alias(n))
    again = stored.join(payload_hash(artifacts).withColumnRenamed("payload_hash", "now"), "accession", "left").where(~F.col("now").eqNullSafe(F.col("payload_hash")))
    files = artifacts.select("accession", "path", F.col("digest").alias("held")).distinct()
    bound = bindings.join(files, ["accession", "path"], "left")
    matched = bound.groupBy("accession", "uri", "path", "digest").agg(F.max(F.col("held").eqNullSafe(F.col("digest"))).alias("same"), F.count("held").alias("n_held"))
    unlike = F.when(F.col("n_held") == 0, "binding_without_file").when(~F.col("same"), "other_bytes")
    # an address that is a binding's or an alias is one row with how often it is either; rows of a full join lie nowhere, so reports are met apart
    addresses = times(bindings, "uri", "n_uri").join(times(bindings.where("alias is not null"), "alias", "n_alias"), ["accession", "address"], "full")
    found = {"uri_twice": F.col("n_uri") > 1, "alias_twice": F.col("n_alias") > 1, "alias_is_address": F.col("n_alias").isNotNull() & F.col("n_uri").isNotNull()}
    parts = [
        rule(again, F.lit("payload_hash"), "payload_hash"), rule(artifacts.groupBy("accession", "path").agg(F.count("*").alias("n")).where("n > 1"), F.lit("path_twice"), "path"), rule(matched.withColumn("rule", unlike).where("rule is not null"), F.col("rule"), "uri").distinct(),
        rule(addresses.withColumn("rule", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(code)) for code, c in found.items()])))), F.col("rule"), "address"),
        rule(reports.join(bindings.select("accession", "uri"), ["accession", "uri"], "left_anti"), F.lit("report_unbound"), "uri"),
    ]
    return reduce(DataFrame.unionByName, parts)


def corpus_checks(members: DataFrame, bundles: DataFrame) -> DataFrame:
    """accession, code of a manifest's rows that break a rule of their own, repeat an accession or a role, amend what the corpus lacks, or differ from their bundle. A null filing date is not compared.

    members(bundle_id, accession, cik, form, filed, role, amends, policy), bundles(bundle_id, accession, cik, form, filed, policy)."""
    b = bundles.select("bundle_id", *[F.col(c).alias(f"b_{c}") for c in ("accession", "cik", "form", "filed", "policy")], F.lit(True).alias("there"))
    times = lambda key: members.groupBy(key).agg(F.count("*").alias(f"n_{key}"))
    # most rows amend nothing; they would all meet in one task of a join on what is amended
    known = members.select(F.col("accession").alias("amends")).distinct()
    unknown = members.where("amends is not null").select("accession", "amends").join(known, "amends", "left_anti").select("accession", F.lit("AMENDS_UNKNOWN").alias("code"))
    rows = members.join(times("accession"), "accession", "left").join(times("role"), "role", "left").join(b, "bundle_id", "left")
    amendment = F.col("form").endswith("/A")
    differs: dict[str, Column] = {c: ~F.col(f"b_{c}").eqNullSafe(F.col(c)) for c in ("accession", "cik", "form", "policy")}
    rules = {
        "DUPLICATE_ACCESSION": F.col("n_accession") > 1, "DUPLICATE_ROLE": F.col("n_role") > 1, "AMENDS_MISSING": amendment & F.col("amends").isNull(), "AMENDS_ON_ORIGINAL": ~amendment & F.col("amends").isNotNull(),
        "BUNDLE_MISSING": F.col("there").isNull(), "ACCESSION_MISMATCH": F.col("there") & differs["accession"], "CIK_MISMATCH": F.col("there") & differs["cik"],
        "FORM_MISMATCH": F.col("there") & differs["form"], "FILED_MISMATCH": F.col("there") & F.col("filed").isNotNull() & ~F.col("b_filed").eqNullSafe(F.col("filed")), "ACQUISITION_POLICY_MISMATCH": F.col("there") & differs["policy"],
    }
    return rows.select("accession", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]))).alias("code")).unionByName(unknown)


def report_members(files: DataFrame) -> DataFrame:
    """accession, kind, place, path, error. With an inline primary document: it first, then the other inline documents but fee exhibits, by path. Else the one instance exhibit. A filing
    for which neither holds is a row with an error.

    files(accession, path, doc_type, is_primary, is_inline, is_instance): those that the filer submitted."""
    kind = F.upper(F.coalesce("doc_type", F.lit("")))
    inline = F.col("is_inline") & ~kind.isin(*FEE_TYPES)
    instance = F.col("is_instance") & (kind == INSTANCE_TYPE) & ~F.lower("path").contains("htm.xml")
    marked = files.withColumns({"inline": F.coalesce(inline, F.lit(False)), "instance": F.coalesce(instance, F.lit(False))})
    first = F.col("is_primary")
    of = marked.groupBy("accession").agg(
        F.count_if(first).alias("n_primary"), F.coalesce(F.some(first & F.col("is_inline")), F.lit(False)).alias("by_inline"), F.coalesce(F.some(first & F.col("inline")), F.lit(False)).alias("primary_in"), F.count_if("instance").alias("n_instance")
    )
    error = F.when(F.col("n_primary") != 1, "not_one_primary").when(F.col("by_inline") & ~F.col("primary_in"), "primary_not_in_set").when(~F.col("by_inline") & (F.col("n_instance") != 1), "not_one_instance")
    of = of.select("accession", F.when(F.col("by_inline"), "inline").otherwise("instance").alias("kind"), error.alias("error"))
    good = marked.join(of.where("error is null"), "accession").where("(kind = 'inline' and inline) or (kind = 'instance' and instance)")
    place = F.row_number().over(Window.partitionBy("accession").orderBy(F.desc(F.coalesce("is_primary", F.lit(False))), "path"))
    return good.select("accession", "kind", place.alias("place"), "path", "error").unionByName(of.where("error is not null").select("accession", "kind", F.lit(None).cast("int").alias("place"), F.lit(None).cast("string").alias("path"), "error"))
