"""Filings that share an accession: the numbers of order keys are cut to six digits, so from seven digits on some do."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from factloom.operators import quality as qx
from tests.oracle import TABLES, compare, connect

SF = "/root/testdata/sf0.001"
SHIFT = 100_000_000


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest tables with order keys of nine digits and every tenth customer's orders as customer 1's: accessions repeat."""
    out = tmp_path_factory.mktemp("repeated")
    for t in TABLES:
        if t not in ("orders", "lineitem"):
            (out / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
            continue
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        if t == "orders":
            df = df.withColumns({"o_orderkey": F.col("o_orderkey") + SHIFT, "o_custkey": F.when(F.col("o_custkey") % 10 == 0, 1).otherwise(F.col("o_custkey")).cast("long")})
        if t == "lineitem":
            df = df.withColumn("l_orderkey", F.col("l_orderkey") + SHIFT)
        df.coalesce(1).write.parquet(f"{out}/{t}.parquet")
    return str(out)


def held(spark, folder, name):
    con = connect(folder)
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], folder) is None


def test_there_are_repeated_accessions(folder):
    sql = entry.oracle_sql()["filing_metadata"]
    assert connect(folder).sql(f"select count(*) from (select accession from ({sql}) group by 1 having count(*) > 1)").fetchall()[0][0] > 20


@pytest.mark.parametrize("name", ["acceptance_summary", "gold_join", "quality_source", "submissions_records", "report_key_coverage", "catalog_filings", "acceptance_issues"])
def test_against_sql(spark, folder, name):
    held(spark, folder, name)


def test_shares_are_rounded_as_in_sql(spark):
    """41 / 640 is 0.0640625, a little less as a double."""
    df = spark.createDataFrame([(41, 640), (323, 640), (1, 3), (0, 5), (2, 0)], "n long, d long")
    want = connect(SF).sql("select round(n::double / nullif(d, 0), 6) from (values (41, 640), (323, 640), (1, 3), (0, 5), (2, 0)) t(n, d)").fetchall()
    assert [r[0] for r in df.select(qx.share(F.col("n"), F.col("d"))).collect()] == [r[0] for r in want]
