"""Issuers with one filing each: some report liabilities alone, of which the external source has no points."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as e
from factloom.plans.catalogue import Model
from factloom.plans.more import payloads
from tests.oracle import TABLES, compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest tables with an issuer an order."""
    out = tmp_path_factory.mktemp("lone")
    for t in TABLES:
        if t != "orders":
            (out / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    spark.read.parquet(f"{SF}/orders.parquet").withColumn("o_custkey", F.col("o_orderkey")).coalesce(1).write.parquet(f"{out}/orders.parquet")
    return str(out)


@pytest.mark.parametrize("name", ["quality_report", "companyfacts_points"])
def test_against_sql(spark, folder, name):
    assert compare(spark, connect(folder), name, e.queries()[name], e.oracle_sql()[name], folder) is None


def test_every_issuer_has_a_document(spark, folder):
    m = Model(spark, folder)
    held = payloads(m)
    assert held.count() == m.filing.select("cik").distinct().count()
    bare = held.where("json not like '%units%'").select("cik", "json").first()
    assert bare.json == f'{{"cik":"{int(bare.cik)}","facts":{{}}}}'
