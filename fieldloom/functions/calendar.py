"""Weeks, seasons and ten-day periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def monday(d: Column) -> Column:
    return F.date_trunc("week", d).cast("date")


def iso_year(d: Column) -> Column:
    return F.date_part(F.lit("YEAROFWEEK"), d).cast("int")


def weeks(spark: SparkSession, first: str, last: str) -> DataFrame:
    """week_start (every Monday from first on), week_end, iso_year and iso_week."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 7 days"))).alias("week_start"))
    return days.select("week_start", F.date_add("week_start", 6).alias("week_end"), iso_year(F.col("week_start")).alias("iso_year"), F.weekofyear("week_start").alias("iso_week"))


def season_bounds(code: Column) -> tuple[Column, Column]:
    """First and last day of YYYY_lr (March to August) and YYYY_sr (October to the end of February)."""
    year, kind = F.substring(code, 1, 4).cast("int"), F.substring(code, 6, 2)
    first = F.when(kind == "lr", F.make_date(year, F.lit(3), F.lit(1))).when(kind == "sr", F.make_date(year, F.lit(10), F.lit(1)))
    last = F.when(kind == "lr", F.make_date(year, F.lit(8), F.lit(31))).when(kind == "sr", F.last_day(F.make_date(year + 1, F.lit(2), F.lit(1))))
    return first, last


def dekads(table: DataFrame, first: str, last: str) -> DataFrame:
    """A row for each ten-day period that overlaps [first, last] of each row: period_start, period_end, code, days."""
    month = F.explode(F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month")))
    rows = table.withColumn("_month", month)
    parts = F.array(*(F.struct(F.lit(k).alias("number"), F.date_add("_month", 10 * (k - 1)).alias("period_start"), (F.date_add("_month", 10 * k - 1) if k < 3 else F.last_day("_month")).alias("period_end")) for k in (1, 2, 3)))
    rows = rows.withColumn("_d", F.explode(parts)).select(*table.columns, "_month", "_d.*")
    rows = rows.filter((F.col("period_start") <= F.col(last)) & (F.col("period_end") >= F.col(first)))
    code = F.format_string("%s-D%d", F.date_format("_month", "yyyy-MM"), "number")
    return rows.select(*table.columns, "period_start", "period_end", code.alias("dekad"), (F.datediff("period_end", "period_start") + 1).alias("days"))


def overlap_days(a_first: Column, a_last: Column, b_first: Column, b_last: Column) -> Column:
    """Days that two closed periods share; NULL if a bound is."""
    return F.when(a_first.isNotNull() & a_last.isNotNull() & b_first.isNotNull() & b_last.isNotNull(), F.greatest(F.lit(0), F.datediff(F.least(a_last, b_last), F.greatest(a_first, b_first)) + 1))
