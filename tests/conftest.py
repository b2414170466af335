from __future__ import annotations

import pytest
from pyspark.sql import SparkSession


def session() -> SparkSession:
    conf = {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g", "spark.sql.adaptive.enabled": "true",
    }
    spark = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return session()
