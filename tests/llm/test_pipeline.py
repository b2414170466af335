"""The pipeline's stages on odd rows, and the whole of it against a plain version, stage by stage."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline as cp
from pyspark.sql import functions as F

from factloom.llm import near_dedup, quality_rules, secrets

from .test_operators import DOCS, ROWS, brute_components, clash, docs, labels  # noqa: F401


def write(df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")


def test_stages_on_odd_rows(spark, docs, labels, tmp_path):  # noqa: F811
    write(labels, tmp_path, "labels")
    write(docs, tmp_path, "documents")
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, clash(docs, "doc", "kept", "spans", "copy"), str(tmp_path))
        assert {r.copy for r in out.collect()} == {"x"}
        assert out.columns[:5] == [f.split()[0] for f in DOCS.split(", ")]
        out.collect()
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert cp.packed(spark, docs, "").count() >= len(ROWS)
    assert cp.run(spark, str(tmp_path)).columns[:2] == ["doc_id", "piece"]


def test_against_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    docs = spark.createDataFrame(rows, DOCS)  # noqa: F811
    kept = {r.doc_id: r for r in cp.quality(spark, docs, sf).collect()}
    verdicts = {r.doc_id for r in quality_rules.quality_verdicts(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("kept").collect()}
    assert set(kept) == verdicts
    for d, t, *_ in rows:
        n, *_, repeats = quality_rules.measure_text(t)
        assert d not in kept or (n >= 50 and 2 * repeats <= n)
    left = [tuple(kept[d]) for d in sorted(kept)]
    stay = {r.doc_id for r in cp.near_duplicates(spark, spark.createDataFrame(left, DOCS), sf).collect()}
    assert stay == {d for d, c in brute_components(left, near_dedup.SHINGLE_WORDS).items() if d == c}
    clean = cp.secret_scan(spark, docs, sf).collect()
    assert len(clean) == len(rows) and not any(secrets.base_spans(r.text) for r in clean)
    plain = {d for d, t, *_ in rows if not secrets.base_spans(t)}
    texts = {d: t for d, t, *_ in rows}
    assert sum(r.text != texts[r.doc_id] for r in clean if r.doc_id in plain) <= 1
    mixed = cp.mixed_sources(spark, docs, sf)
    assert mixed.columns == docs.columns and abs(mixed.count() - len(rows)) < 60
    pieces = cp.packed(spark, docs, sf).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert max(r.n for r in pieces) <= 2048 and Counter(r.sequence_id for r in pieces).most_common(1)[0][1] == 1
