"""Values on a tie of a rounding, or on a bound, come out as in SQL."""

import duckdb
from pyspark.sql import functions as F

from fieldloom.functions.expr import nearest
from fieldloom.operators import timeseries, yields


def test_nearest_rounds_as_sql_does(spark):
    ties = [float(f"0.{i:06d}5") for i in range(500_000, 600_000, 499)]
    table = spark.createDataFrame([(x,) for x in ties] + [(-x,) for x in ties] + [(None,)], "x double")
    rows = table.select("x", nearest(F.col("x"), 6).alias("found"), F.round("x", 6).alias("plain")).collect()
    want = [duckdb.execute("select round(?::double, 6)", [r["x"]]).fetchone()[0] for r in rows]
    assert [r["found"] for r in rows] == want
    assert [r["plain"] for r in rows] != want  # which is why


def test_bounds_of_phenology_round_as_sql_does(spark):
    """Fields whose base is a tie at six places, against the bounds of the SQL."""
    from fieldloom.plans import registry, series

    weeks = [r["w"] for r in series._grid(registry.Tables(spark, "/root/testdata/sf0.001"), *series.SEASON).select("w").distinct().orderBy("w").collect()]
    rows = [(f, w, min(1.0, 0.05 + (f * 2 + 1) * 5e-7 + max(0.0, 0.9 - abs(i - 12) * 0.15))) for f in range(40) for i, w in enumerate(weeks)]
    b = timeseries.boundaries(spark.createDataFrame(rows, "field_id long, w date, smoothed double"), "field_id", "w", "smoothed")
    found = sorted(tuple(r) for r in b.select("field_id", nearest(F.col("base"), 6)).collect())
    con = duckdb.connect()
    con.execute("create table smooth (field_id bigint, w date, smoothed double)")
    con.executemany("insert into smooth values (?, ?, ?)", rows)
    assert found == sorted(con.execute(f"with {series._bound_sql} select field_id, round(base, 6) from z").fetchall())


def test_a_share_on_its_bound_is_enough_whatever_the_order_of_a_sum(spark):
    fields = spark.createDataFrame([(i, 1, 2.0, "no", "maize") for i in range(5)], "field_id long, county int, area_ha double, intercrop_status string, survey_crop_text string")
    labels = spark.createDataFrame([(i, 1, "maize", 0.9, "final") for i in range(5)], "field_id long, county int, seasonal_label string, seasonal_confidence double, status string")
    seasons = spark.sql("select id as field_id, date '2020-03-01' as sos, date '2020-05-01' as peak_date, date '2020-07-01' as eos, 'm' as method, 0.5D as confidence, 'detected' as qa_status, 9L as optical_valid_weeks, 0L as sar_supported_weeks from range(5)")
    shares = [(0.8, 0.8), (0.7999999999999999, 0.8), (0.8, 0.7999999999999998), (0.7999, 0.9), (0.9, 0.7999)]
    metrics = spark.createDataFrame([(i, 100.0, 90.0, 110.0, 50, 5, a, b) for i, (a, b) in enumerate(shares)], "field_id long, npp_central double, npp_narrow double, npp_wide double, days_central long, periods_central long, temporal_central double, spatial_central double").withColumns({"sos": F.lit(None).cast("date"), "eos": F.lit(None).cast("date")})
    found = yields.season_yield(fields, labels, seasons, metrics, yields.crop_factors(spark)).orderBy("field_id").collect()
    assert [r["qa_flags"] for r in found] == ["", "", "", "low_npp_temporal_coverage", "low_npp_spatial_coverage"]
    assert [r["yield_central"] is not None for r in found] == [True, True, True, False, False]


def test_dry_share_is_the_decimal_one(spark):
    row = yields.crop_factors(spark).filter("crop = 'potatoes'").select(yields.crop_yield(F.lit(1.0), "high").alias("y")).first()
    assert row["y"] == duckdb.execute("select 1.0::double * 1.0 * 1.0 * 0.85 / (1 - 0.8)").fetchone()[0] == 0.85 / 0.2


def test_season_yield_holds_doubles_against_its_bounds_as_its_sql_does(spark, tmp_path):
    """Fields with one line item each, so that sums have no order, whose spatial share is 0.8 or the double below it."""
    from fieldloom.plans import registry

    con, share = duckdb.connect(), 0.8 / 18
    con.execute("create table supplier as select id as s_suppkey, 'S' as s_name, 1 as s_nationkey from range(60) t(id)")
    con.execute("create table lineitem as select s_suppkey as l_suppkey, timestamp '1996-06-05' as l_shipdate, 30.0::double as l_quantity, case s_suppkey % 2 when 0 then ?::double else ?::double end as l_discount, 0.01::double as l_tax, 1.0::double as l_extendedprice from supplier", [share, share - 2e-17])
    for t in ("supplier", "lineitem"):
        con.execute(f"copy {t} to '{tmp_path}/{t}.parquet'")
    want = con.execute(registry.ORACLE_SQL["season_yield"])
    names = [c[0] for c in want.description]
    want = sorted(want.fetchall())
    found = registry.QUERIES["season_yield"](spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(tuple, found)) == want
    assert {k % 2 for k, *_, flags in want if "low_npp_spatial_coverage" in flags} == {1}
