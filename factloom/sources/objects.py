"""Captured bytes: bundle descriptors, content-addressed objects, taxonomy schemas and inline reports."""

from __future__ import annotations

from collections.abc import Iterator
from xml.etree import ElementTree
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import scalars as S
from factloom.sources.html import _bounded

#: Namespaces of schemas, instances and inline reports (which carry a year).
SCHEMA, INSTANCE, INLINE = "http://www.w3.org/2001/XMLSchema", "http://www.xbrl.org/2003/instance", "inlinexbrl"
ITEMS = ("nonNumeric", "nonFraction", "fraction")
BUNDLE = (
    "struct<bundle_id:string,filing:struct<cik:string,accession:string,form:string>,artifacts:array<struct<logical_path:string,content:struct<sha256:string,byte_size:bigint>>>,"
    "uri_bindings:array<struct<uri:string,content_sha256:string,alias:string>>>"
)


def bundle_descriptors(spark: SparkSession, glob: str) -> DataFrame:
    """Descriptors at the paths: file, accession, cik, form, artifacts, uri_bindings; malformed: whether a file is no such JSON. A file is read whole."""
    raw = spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.from_json("value", BUNDLE).alias("b"))
    return raw.select("file", F.col("b.filing.accession").alias("accession"), F.col("b.filing.cik").alias("cik"), F.col("b.filing.form").alias("form"), "b.artifacts", "b.uri_bindings", F.col("b.filing.accession").isNull().alias("malformed"))


def bundle_artifacts(bundles: DataFrame) -> DataFrame:
    """accession, path, digest, size: a row per artifact of each descriptor."""
    return bundles.select("accession", F.inline("artifacts")).select("accession", F.col("logical_path").alias("path"), F.lower("content.sha256").alias("digest"), F.col("content.byte_size").alias("size"))


def bundle_bindings(bundles: DataFrame) -> DataFrame:
    """accession, uri, digest, alias: a row per bound address."""
    return bundles.select("accession", F.inline("uri_bindings")).select("accession", "uri", F.lower("content_sha256").alias("digest"), "alias")


def binary_objects(spark: SparkSession, root: str) -> DataFrame:
    """Every file under the root: name (the digest that its path states), digest (of its bytes), size, content. A reader that leaves content out does not carry it along."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(F.lower(F.element_at(F.split("path", "/"), -1)).alias("name"), F.sha2("content", 256).alias("digest"), F.col("length").alias("size"), "content")


def object_integrity(artifacts: DataFrame, objects: DataFrame) -> DataFrame:
    """accession, path, code: artifacts whose object is missing_object, holds other bytes than its name states (digest_mismatch), or is of another size (size_mismatch).

    artifacts(accession, path, digest, size), objects(name, digest, size). An object that many artifacts name is read once."""
    o = objects.select(F.col("name").alias("digest"), F.col("digest").alias("held"), F.col("size").alias("held_size")).dropDuplicates(["digest"])
    code = F.when(F.col("held").isNull(), "missing_object").when(F.col("held") != F.col("digest"), "digest_mismatch").when(~F.col("held_size").eqNullSafe(F.col("size")), "size_mismatch")
    return artifacts.join(o, "digest", "left").select("accession", "path", code.alias("code")).where("code is not null")


class _Refused(Exception):
    """A document with declarations of its own."""


class _Plain(ElementTree.TreeBuilder):
    """A tree of a document that declares no type, and with it no entities."""

    def doctype(self, *_) -> None:
        raise _Refused


def _schema(content: bytes | None) -> tuple[str | None, list[str], str | None]:
    """Target namespace, names of the global elements, and what is wrong: not_xml, not_schema, no_target."""
    try:
        root = ElementTree.fromstring(content or b"", parser=ElementTree.XMLParser(target=_Plain()))
    except (ElementTree.ParseError, expat.ExpatError, _Refused, ValueError, LookupError):
        return None, [], "not_xml"
    if root.tag != f"{{{SCHEMA}}}schema":
        return None, [], "not_schema"
    target = root.get("targetNamespace")
    names = [e.get("name") for e in root.findall(f"{{{SCHEMA}}}element")]
    return (target, [n for n in names if n], None) if target else (None, [], "no_target")


def taxonomy_schemas(objects: DataFrame) -> DataFrame:
    """objects(digest, content) -> digest, namespace, names (global elements of a schema), error: not_xml (also one with a document type), not_schema or no_target. Elements within types are not global."""
    _bounded(objects.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(d, *_schema(c)) for d, c in zip(b.column("digest").to_pylist(), b.column("content").to_pylist(), strict=True)]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.string(), pa.string(), pa.list_(pa.string()), pa.string()], strict=True)], ["digest", "namespace", "names", "error"])

    return objects.select("digest", "content").mapInArrow(run, "digest string, namespace string, names array<string>, error string")


def taxonomy_concepts(objects: DataFrame, bindings: DataFrame) -> DataFrame:
    """accession, namespace_uri, local_name, release: the us-gaap concepts that the schemas bound to a filing declare. Each object is parsed once, however many filings bind it."""
    bound = bindings.select("accession", "digest").distinct()
    parsed = taxonomy_schemas(objects.join(bound.select("digest").distinct(), "digest", "left_semi").dropDuplicates(["digest"])).where("error is null")
    parsed = parsed.where(S.namespace_family(F.col("namespace")) == "us-gaap")
    return bound.join(parsed, "digest").select("accession", F.col("namespace").alias("namespace_uri"), F.explode(F.array_distinct("names")).alias("local_name"), S.release_token(F.col("namespace")).alias("release")).distinct()


def taxonomy_faults(objects: DataFrame, bindings: DataFrame, filing: DataFrame, annual: tuple[str, ...] = ("10-K", "10-K/A")) -> DataFrame:
    """accession, digest, code: bound objects that are missing (missing_object) or a schema without a target (no_target), and annual filings without a us-gaap schema (no_us_gaap_schema, no digest). filing(accession, form)."""
    bound = bindings.select("accession", "digest").distinct()
    parsed = taxonomy_schemas(objects.join(bound.select("digest").distinct(), "digest", "left_semi").dropDuplicates(["digest"])).select("digest", "namespace", "error", F.lit(True).alias("there"))
    both = bound.join(parsed, "digest", "left")
    code = F.when(F.col("there").isNull(), "missing_object").when(F.col("error") == "no_target", "no_target")
    covered = both.where(S.namespace_family(F.col("namespace")) == "us-gaap").select("accession").distinct()
    bare = filing.where(F.col("form").isin(*annual)).join(covered, "accession", "left_anti").select("accession", F.lit(None).cast("string").alias("digest"), F.lit("no_us_gaap_schema").alias("code"))
    return both.select("accession", "digest", code.alias("code")).where("code is not null").unionByName(bare)


OCCURRENCE = "report_key string, path string, place int, kind string, id string, target string, context_ref string, unit_ref string, continued_at string"


def _occurrences(content: bytes | None) -> list[tuple]:
    """place, kind, id, target, context, unit, continued: elements of an inline report or an instance, as they come; one row of the kind malformed ends a broken one."""
    rows: list[tuple] = []
    place, instance = 0, False

    def start(tag: str, attributes: dict[str, str]) -> None:
        nonlocal place, instance
        namespace, _, name = tag.rpartition("}")
        if place == 0:
            instance = (namespace, name) == (INSTANCE, "xbrl")
        place += 1
        get = attributes.get
        if namespace == INSTANCE and name in ("context", "unit"):
            if get("id"):
                rows.append((place, name, get("id"), None, None, None, None))
        elif INLINE in namespace.lower() and name in (*ITEMS, "tuple", "continuation", "footnote"):
            rows.append((place, name, get("id"), get("target"), get("contextRef"), get("unitRef"), get("continuedAt")))
        elif instance and get("contextRef") is not None:
            rows.append((place, "item", get("id"), None, get("contextRef"), get("unitRef"), None))

    def refuse(*_) -> None:
        raise _Refused

    parser = expat.ParserCreate(namespace_separator="}")
    parser.StartElementHandler, parser.StartDoctypeDeclHandler = start, refuse
    try:
        parser.Parse(content or b"", True)
    except (expat.ExpatError, _Refused, ValueError, LookupError):
        rows.append((place, "malformed", None, None, None, None, None))
    return rows


def occurrences(members: DataFrame) -> DataFrame:
    """members(report_key, path, content) -> a row per context, unit, item, tuple, continuation and footnote of each member, with its place among all elements. Comments and instructions are none; elements of other namespaces are none, but
    for what has a context in an instance. No tree is built. A member with a document type is not read."""
    _bounded(members.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, p, *o) for k, p, c in zip(*(b.column(x).to_pylist() for x in ("report_key", "path", "content")), strict=True) for o in _occurrences(c)]
            cols = list(zip(*rows, strict=True)) or [()] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 2 else pa.string()) for i, c in enumerate(cols)], [c.split()[0] for c in OCCURRENCE.split(", ")])

    return members.select("report_key", "path", "content").mapInArrow(run, OCCURRENCE)
