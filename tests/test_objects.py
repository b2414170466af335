"""Bundles, objects, schemas and inline reports on small files; documents to blocks and sections."""

from __future__ import annotations

import hashlib
import json

from factloom.operators import filing_sections as fs
from factloom.operators import inventory as ix
from factloom.sources import objects as ox

NS = "http://fasb.org/us-gaap/2023"
SCHEMA = f'<?xml version="1.0"?><xs:schema xmlns:xs="{ox.SCHEMA}" targetNamespace="{{}}"><xs:element name="Assets"/><xs:element name="Assets"/><!-- c --><xs:complexType><xs:sequence><xs:element name="Inner"/></xs:sequence></xs:complexType><xs:element ref="x"/></xs:schema>'


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_bundles_and_objects(spark, tmp_path):
    good, other = b"<a/>", SCHEMA.format(NS).encode()
    for name, data in ((digest(good), good), (digest(other), other), (digest(b"lost bytes"), b"wrong bytes")):
        (tmp_path / "objects" / name[:2]).mkdir(parents=True, exist_ok=True)
        (tmp_path / "objects" / name[:2] / name).write_bytes(data)
    artifacts = [("a.xml", good, 4), ("b.xsd", other, 1), ("c.txt", b"lost bytes", 10), ("d.txt", b"nowhere", 7), ("e.xml", good, 4)]
    bundle = {"bundle_id": "1", "filing": {"cik": "0000000001", "accession": "acc", "form": "10-K"}, "artifacts": [{"logical_path": p, "content": {"sha256": digest(d).upper(), "byte_size": n}} for p, d, n in artifacts], "uri_bindings": [{"uri": "u:b", "content_sha256": digest(other)}]}
    (tmp_path / "one").mkdir()
    (tmp_path / "two").mkdir()
    (tmp_path / "one" / "bundle.json").write_text(json.dumps(bundle, indent=1))
    (tmp_path / "two" / "bundle.json").write_text("{ not json")
    bundles = ox.bundle_descriptors(spark, f"{tmp_path}/*/bundle.json")
    assert sorted((r.accession or "", r.malformed) for r in bundles.collect()) == [("", True), ("acc", False)]
    objects = ox.binary_objects(spark, f"{tmp_path}/objects")
    faults = ox.object_integrity(ox.bundle_artifacts(bundles), objects.drop("content")).collect()
    assert {r.path: r.code for r in faults} == {"b.xsd": "size_mismatch", "c.txt": "digest_mismatch", "d.txt": "missing_object"}
    concepts = ox.taxonomy_concepts(objects.where("name = digest"), ox.bundle_bindings(bundles))
    assert [tuple(r) for r in concepts.collect()] == [("acc", NS, "Assets", "2023")]


def test_schemas(spark):
    documents = {
        "good": SCHEMA.format(NS), "issuer": SCHEMA.format("http://issuer.com/2023"), "no target": f'<schema xmlns="{ox.SCHEMA}"/>', "other root": "<a/>", "broken": "<a>", "declares": '<!DOCTYPE a [<!ENTITY e "x">]><a>&e;</a>', "empty": "", "null": None,
    }
    objects = spark.createDataFrame([(k, None if v is None else bytearray(v.encode())) for k, v in documents.items()], "digest string, content binary")
    got = {r.digest: (r.namespace, r.names, r.error) for r in ox.taxonomy_schemas(objects).collect()}
    assert got["good"] == (NS, ["Assets", "Assets"], None) and got["no target"][2] == "no_target" and got["other root"][2] == "not_schema" and {got[k][2] for k in ("broken", "declares", "empty", "null")} == {"not_xml"}
    bindings = spark.createDataFrame([("f1", "good"), ("f1", "good"), ("f2", "issuer"), ("f2", "gone"), ("f3", "no target")], "accession string, digest string")
    assert [(r.accession, r.local_name) for r in ox.taxonomy_concepts(objects, bindings).collect()] == [("f1", "Assets")]
    filing = spark.createDataFrame([("f1", "10-K"), ("f2", "10-K"), ("f3", "10-Q")], "accession string, form string")
    assert {tuple(r) for r in ox.taxonomy_faults(objects, bindings, filing).collect()} == {("f2", "gone", "missing_object"), ("f3", "no target", "no_target"), ("f2", None, "no_us_gaap_schema")}


INLINE = 'xmlns="http://www.w3.org/1999/xhtml" xmlns:ix="http://www.xbrl.org/2013/inlineXBRL" xmlns:i="http://www.xbrl.org/2003/instance" xmlns:o="http://other.org"'


def report(body: str) -> bytearray:
    return bytearray(f"<html {INLINE}><body>{body}</body></html>".encode())


def test_inline_reports(spark):
    members = [
        ("r1", "a.htm", report('<i:context id="c1"/><i:context/><i:unit id="u1"/><ix:nonFraction contextRef="c1" unitRef="u1">1</ix:nonFraction><ix:nonNumeric contextRef="c2" target="t" continuedAt="k1">x</ix:nonNumeric><!-- <ix:tuple/> --><?pi x?><o:nonFraction contextRef="c9"/><context id="c1"/>')),
        ("r1", "b.htm", report('<i:context id="c1"/><ix:continuation id="k1" continuedAt="k2">y</ix:continuation><ix:continuation id="k2">z</ix:continuation><ix:nonFraction contextRef="c1">2</ix:nonFraction>')),
        ("r2", "c.htm", report('<ix:fraction contextRef="c1"/><ix:tuple target="t"/><ix:nonNumeric contextRef="c1" continuedAt="gone"/>')),
        ("r3", "d.htm", report('<ix:nonNumeric contextRef="c" continuedAt="k1"/><ix:footnote continuedAt="k1"/><ix:continuation id="k1" continuedAt="k2"/><ix:continuation id="k2"/>')),
        ("r4", "e.htm", report('<ix:nonNumeric contextRef="c" continuedAt="k1"/><ix:continuation id="k1" continuedAt="k2"/><ix:continuation id="k2" continuedAt="k1"/>')),
        ("r5", "f.xml", bytearray(b'<x:xbrl xmlns:x="http://www.xbrl.org/2003/instance" xmlns:g="http://g"><x:context id="c"/><g:Assets contextRef="c" unitRef="u"/><g:Other/></x:xbrl>')),
        ("r6", "g.htm", report('<ix:nonNumeric contextRef="c"/>')[:-9]), ("r7", "h.htm", None),
    ]
    found = ox.occurrences(spark.createDataFrame(members, "report_key string, path string, content binary")).persist()
    inventory = {(r.report_key, r.target): (r.items, r.fractions, r.tuples, r.contexts, r.units) for r in ix.occurrence_inventory(found).collect()}
    assert inventory == {("r1", ""): (2, 0, 0, 1, 1), ("r1", "t"): (1, 0, 0, 1, 0), ("r2", ""): (2, 1, 0, 1, 0), ("r2", "t"): (0, 0, 1, 0, 0), ("r3", ""): (1, 0, 0, 1, 0), ("r4", ""): (1, 0, 0, 1, 0), ("r5", ""): (1, 0, 0, 1, 1), ("r6", ""): (1, 0, 0, 1, 0)}
    totals = {r.report_key: (r.contexts, r.units, r.continuations, r.malformed) for r in ix.report_totals(found).collect()}
    assert totals["r1"] == (2, 1, 2, 0) and totals["r6"][3] == totals["r7"][3] == 1
    assert [tuple(r) for r in ix.id_collisions(found).collect()] == [("r1", "CONTEXT_ID_COLLISION", "c1", 2)]
    assert {tuple(r) for r in ix.target_faults(found).collect()} == {("r2", "UNSUPPORTED_INLINE_FRACTION_OR_TUPLE"), ("r2", "CONTINUATION_UNRESOLVED"), ("r3", "CONTINUATION_REUSE"), ("r4", "CONTINUATION_CYCLE")}
    assert {tuple(r) for r in ix.target_faults(found, "t").collect()} == {("r2", "UNSUPPORTED_INLINE_FRACTION_OR_TUPLE")}


def test_documents_to_sections(spark):
    page = "<h1>Item 1. Business</h1><p>We sell.</p><h1>Item 1A. Risk Factors</h1><p>Risks.</p><h1>SIGNATURES</h1>"
    rows = [(1, "a.htm", True, "10-K", page), (2, "ex.HTML", False, "10-K", page), (3, "c.pdf", True, "10-K", page), (4, "d.htm", True, "8-K", page), (5, "e.htm", True, "10-K", None)]
    blocks, outcomes = fs.document_projection(spark.createDataFrame(rows, "doc_id long, path string, is_primary boolean, form string, html string"))
    assert {r.doc_id: r["count"] for r in blocks.groupBy("doc_id").count().collect()} == {1: 5, 2: 5, 4: 5}
    found = {(r.doc_id, r.section_key): (r.start, r.end) for r in fs.filing_sections(outcomes).collect()}
    assert found == {(1, "part_1.item_1.business"): (0, 2), (1, "part_1.item_1a.risk_factors"): (2, 4)}
    assert {r.doc_id for r in fs.section_issues(outcomes).collect()} == {1, 5}
