"""Durations within a year: their roles, the fourth quarter that no filing reports, and values that later filings repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions import scalars as S

SLOT = ["cik", "metric", "period_start", "period_end"]


def day_after(day: str):
    return F.date_add(day, 1)


def period_roles(durations: DataFrame) -> DataFrame:
    """durations with role. The required duration is annual, quarter_ytd in a first quarter, else ytd; another that ends with it and is three months long is the quarter; all others are other.

    durations: focus (FY, Q1 to Q3), period_start, period_end, required_start, required_end."""
    required = (F.col("period_start") == F.col("required_start")) & (F.col("period_end") == F.col("required_end"))
    quarter = (F.col("period_end") == F.col("required_end")) & (F.add_months(day_after("period_end"), -3) == F.col("period_start"))
    named = F.when(F.col("focus") == "FY", "annual").when(F.col("focus") == "Q1", "quarter_ytd").when(F.col("focus").isin("Q2", "Q3"), "ytd").otherwise("other")
    return durations.withColumn("role", F.when(required, named).when(quarter, "quarter").otherwise("other"))


def _agreed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, numeric, half_width of the groups whose facts all have one value; the narrowest half-width is theirs."""
    agg = rows.groupBy(*keys).agg(F.min("numeric").alias("numeric"), F.max("numeric").alias("most"), F.min(S.half_width(F.col("decimals"))).alias("half_width"), F.min("accession").alias("first_accession"))
    return agg.where(F.col("numeric") == F.col("most")).drop("most")


def derived_fourth_quarter(roles: DataFrame) -> DataFrame:
    """cik, metric, period_start, period_end, numeric, half_width, annual_accession, ytd_accession: a year less its first nine months, from the day after these. Half-widths add; a slot
    whose facts differ derives nothing. roles: of duration metrics alone."""
    year = _agreed(roles.where("role = 'annual'"), SLOT).select("cik", "metric", "period_start", F.col("period_end").alias("end"), F.col("numeric").alias("y"), F.col("half_width").alias("hy"), F.col("first_accession").alias("annual_accession"))
    nine = _agreed(roles.where("role = 'ytd' and focus = 'Q3'"), SLOT).select("cik", "metric", "period_start", F.col("period_end").alias("ytd_end"), F.col("numeric").alias("n"), F.col("half_width").alias("hn"), F.col("first_accession").alias("ytd_accession"))
    both = year.join(nine, ["cik", "metric", "period_start"]).where("ytd_end < end")
    ten = "decimal(28,10)"
    return both.select("cik", "metric", day_after("ytd_end").alias("period_start"), F.col("end").alias("period_end"), (F.col("y") - F.col("n")).cast(ten).alias("numeric"), (F.col("hy") + F.col("hn")).cast(ten).alias("half_width"), "annual_accession", "ytd_accession")


def slot_stability(roles: DataFrame) -> DataFrame:
    """accession, cik, metric, period_start, period_end, comparatives, stability: values of annual filings that later annual filings repeat. changed if the interval of one of these does not meet the first's."""
    keys = [*SLOT, "accession", "filing_date"]
    annual = roles.where("focus = 'FY'")
    filed = _agreed(annual.where("role = 'annual'"), keys)
    later = _agreed(annual.where("role = 'other'"), keys).select(*SLOT, F.col("accession").alias("other"), F.col("filing_date").alias("later"), F.col("numeric").alias("v"), F.col("half_width").alias("h"))
    both = filed.join(later, SLOT).where("later > filing_date")
    meets = F.abs(F.col("numeric") - F.col("v")) <= F.col("half_width") + F.col("h")
    return both.groupBy(*SLOT, "accession").agg(F.count("*").alias("comparatives"), F.when(F.every(meets), "stable").otherwise("changed").alias("stability"))
