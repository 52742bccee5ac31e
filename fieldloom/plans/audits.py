"""Rules of loaded parts, exports, model batches and seasons; grids, names and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr, geometry
from ..functions.calendar import monday
from ..operators import checks, quality, zonal
from ..sources import store
from .fields import rounded
from .registry import Tables, query

_parts_sql = """parts as (select l_suppkey as field_id, cast(date_trunc('week', l_shipdate) as date) as start_date, count(*) as pixel_count_before, count(*) filter (l_quantity > 5) - cast(l_suppkey % 50 = 3 as int) as pixel_count_after,
case l_suppkey % 4 when 0 then 0 when 1 then 5 when 2 then 10 else 7 end as buffer_width_m, count(*) filter (l_discount > 0) as ndvi_count, avg(l_tax) * 10 as evi_count from lineitem group by 1, 2)"""


def _parts(t: Tables) -> DataFrame:
    k = F.col("l_suppkey")
    n = t.lineitem.groupBy(k.alias("field_id"), monday(F.col("l_shipdate")).alias("start_date")).agg(F.count("*").alias("pixel_count_before"), F.count_if(F.col("l_quantity") > 5).alias("_after"), F.count_if(F.col("l_discount") > 0).alias("ndvi_count"), (F.avg("l_tax") * 10).alias("evi_count"))
    f = F.col("field_id")
    return n.withColumn("pixel_count_after", F.col("_after") - F.when(f % 50 == 3, 1).otherwise(0)).withColumn("buffer_width_m", F.when(f % 4 == 0, 0).when(f % 4 == 1, 5).when(f % 4 == 2, 10).otherwise(7)).drop("_after")


@query(f"with {_parts_sql} select year(start_date) as year, count(*) as n_rows, count(*) filter (buffer_width_m not in (0, 5, 10)) as bad_buffer, count(*) filter (pixel_count_after > pixel_count_before or pixel_count_after < 0) as bad_geometry_count, count(*) filter (ndvi_count < 0 or ndvi_count > pixel_count_after or evi_count < 0 or evi_count > pixel_count_after or evi_count <> trunc(evi_count)) as bad_valid_count from parts group by 1")
def part_checks(t: Tables) -> DataFrame:
    return quality.violations(_parts(t).withColumn("year", F.year("start_date").cast("long")), checks.part_rules(["ndvi", "evi"]), ["year"])


_radar_sql = """v as (select l_suppkey, cast(date_trunc('week', l_shipdate) as date) as w, case when l_discount > 0.01 then l_discount - 0.02 end as vh, l_tax + 0.02 as vv from lineitem),
radar as (select l_suppkey, w, count(vh) as vh_n, avg(vh) as vh_mean, count(vv) as vv_n, count(vh / vv) as p_n, count(4 * vh / (vh + vv)) + cast(l_suppkey % 20 = 1 as int) as rvi_n, count((vv - vh) / (vv + vh)) as rc_n, min(vh / vv) as p_min, avg(vh / vv) as p_mean,
  min(4 * vh / (vh + vv)) as rvi_min, max(4 * vh / (vh + vv)) as rvi_max, avg(4 * vh / (vh + vv)) as rvi_mean, min((vv - vh) / (vv + vh)) as rc_min, max((vv - vh) / (vv + vh)) as rc_max, case when l_suppkey % 10 = 2 then 0.5 else avg((vv - vh) / (vv + vh)) end as rc_mean from v group by 1, 2)"""


@query(f"with {_radar_sql} select count(*) as n_rows, count(*) filter (p_n <> rvi_n or p_n <> rc_n or p_n > vv_n or p_n > vh_n) as bad_counts, count(*) filter (p_min < 0 or rvi_min < -0.00001 or rvi_max > 4.00001 or rc_min < -1.00001 or rc_max > 1.00001) as bad_domain, count(*) filter (abs(rvi_mean - 2 * (1 - rc_mean)) > 0.00002) as bad_identity, count(*) filter (vh_mean is null and (p_mean is not null or rvi_mean is not null or rc_mean is not null)) as index_without_vh from radar")
def radar_checks(t: Tables) -> DataFrame:
    """Some fields' index counts and means are made wrong."""
    v = t.lineitem.select("l_suppkey", monday(F.col("l_shipdate")).alias("w"), F.when(F.col("l_discount") > 0.01, F.col("l_discount") - 0.02).alias("sigma_vh_linear"), (F.col("l_tax") + 0.02).alias("sigma_vv_linear"))
    v = v.select("*", *(c.alias(k) for k, c in expr.radar_indices(F.col("sigma_vv_linear"), F.col("sigma_vh_linear")).items()))
    bands = ["sigma_vh_linear", "sigma_vv_linear", "p_ratio", "rvi", "rcspr"]
    s = v.groupBy("l_suppkey", "w").agg(*(x for b in bands for x in (F.count(b).alias(f"{b}_count"), F.avg(b).alias(f"{b}_mean"), F.min(b).alias(f"{b}_min"), F.max(b).alias(f"{b}_max"))))
    k = F.col("l_suppkey")
    s = s.withColumn("rvi_count", F.col("rvi_count") + F.when(k % 20 == 1, 1).otherwise(0)).withColumn("rcspr_mean", F.when(k % 10 == 2, 0.5).otherwise(F.col("rcspr_mean")))
    return quality.violations(s, checks.radar_rules())


_export_sql = """x as (select c_custkey as field_id, case c_custkey % 5 when 0 then 0 when 1 then 5 when 2 then 10 when 3 then 7 end as buffer, case when c_custkey % 6 > 0 then 5 end as b1, case when c_custkey % 7 > 0 then 10 end as b2, c_custkey % 9 - 1 as n1, c_custkey % 8 as m1, c_custkey % 11 as n2, c_custkey % 10 - 1 as m2, c_custkey % 4 = 0 as no1, c_custkey % 3 = 0 as no2 from customer)"""


@query(f"with {_export_sql} select count(*) as n_rows, count(*) filter (buffer not in (0, 5, 10) or buffer is null) as bad_buffer, count(*) filter (b1 <> buffer) as s1_buffer_mismatch, count(*) filter (b2 <> buffer) as s2_buffer_mismatch, count(*) filter (n1 < 0 or m1 < 0 or m1 > n1) as bad_s1_pixel_count, count(*) filter (n2 < 0 or m2 < 0 or m2 > n2) as bad_s2_pixel_count, count(*) filter (no1) as s1_null_rows, count(*) filter (no2) as s2_null_rows from x")
def export_checks(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    x = t.customer.select(
        F.when(k % 5 == 0, 0).when(k % 5 == 1, 5).when(k % 5 == 2, 10).when(k % 5 == 3, 7).alias("buffer_width_m"), F.when(k % 6 > 0, 5).alias("s1_buffer_width_m"), F.when(k % 7 > 0, 10).alias("s2_buffer_width_m"),
        (k % 9 - 1).alias("s1_pixel_count_before"), (k % 8).alias("s1_pixel_count_after"), (k % 11).alias("s2_pixel_count_before"), (k % 10 - 1).alias("s2_pixel_count_after"), F.when(k % 4 > 0, k).alias("s1_field_id"), F.when(k % 3 > 0, k).alias("s2_field_id"),
    )
    return quality.violations(x, checks.export_rules())


@query("with x as (select l_suppkey % 60 as week, l_quantity as a, l_linenumber * 10 as b, l_tax as s, l_discount as e, l_linenumber * 5 as buffer from lineitem) select count(*) as n_rows, count(*) filter (week not between 1 and 53) as bad_week, count(*) filter (e < s) as bad_dates, count(*) filter (buffer not in (0, 5, 10)) as bad_buffer, count(*) filter (b < 0 or a < 0 or a > b) as bad_pixels from x")
def row_checks(t: Tables) -> DataFrame:
    x = t.lineitem.select((F.col("l_suppkey") % 60).alias("week_no"), F.col("l_quantity").alias("pixel_count_after"), (F.col("l_linenumber") * 10).alias("pixel_count_before"), F.col("l_tax").alias("start_date"), F.col("l_discount").alias("end_date"), (F.col("l_linenumber") * 5).alias("buffer_width_m"))
    return quality.violations(x, checks.row_rules())


@query("with n as (select l_suppkey, l_linenumber, count(*) as n from lineitem group by 1, 2) select cast(sum(n) as bigint) as n_rows, count(*) as n_keys, cast(sum(n - 1) as bigint) as n_repeated from n")
def key_counts(t: Tables) -> DataFrame:
    return checks.key_counts(t.lineitem, ["l_suppkey", "l_linenumber"])


@query("with f as (select l_suppkey as field_id, count(*) as n, count(distinct l_linenumber) as w from lineitem where l_suppkey % 7 <> 3 and l_shipdate < timestamp '1993-06-01' group by 1), e as (select s_suppkey as field_id from supplier where s_suppkey % 9 <> 2), j as (select coalesce(e.field_id, f.field_id) as field_id, coalesce(n, 0) as n, case when n is null then 'missing' when e.field_id is null then 'unexpected' when n <> 7 or w <> 7 then 'incomplete' end as fault from e full join f on e.field_id = f.field_id) select * from j where fault is not null")
def history_checks(t: Tables) -> DataFrame:
    x = t.lineitem.filter((F.col("l_suppkey") % 7 != 3) & (F.col("l_shipdate") < F.lit("1993-06-01").cast("timestamp_ntz"))).select(F.col("l_suppkey").alias("field_id"), F.col("l_linenumber").alias("week_start"))
    return checks.history(x, t.supplier.filter("s_suppkey % 9 <> 2").select(F.col("s_suppkey").alias("field_id")), "field_id", 7)


@query("with x as (select case l_linenumber when 1 then 'classified' when 2 then 'made up' when 3 then null else 'out_of_range' end as reason, case when l_linenumber < 6 then l_discount * 5 end as a, case when l_linenumber < 6 then 1 - l_discount * 5 + (l_linenumber = 5)::int * 0.001 end as b from lineitem) select count(*) as n_rows, count(*) filter (reason = 'made up') as unexpected_reason, count(*) filter ((a is not null or b is not null) and abs(coalesce(a, 0) + coalesce(b, 0) - 1) > 0.00001) as bad_probability_sum from x")
def model_checks(t: Tables) -> DataFrame:
    n, d = F.col("l_linenumber"), F.col("l_discount") * 5
    reason = F.when(n == 1, "classified").when(n == 2, "made up").when(n != 3, "out_of_range")
    x = t.lineitem.select(reason.alias("reason"), F.when(n < 6, d).alias("p_maize"), F.when(n < 6, 1 - d + F.when(n == 5, 0.001).otherwise(0.0)).alias("p_beans"), F.lit(None).cast("double").alias("p_potatoes"))
    return quality.violations(x, checks.model_rules(["p_maize", "p_beans", "p_potatoes"]))


_batch_sql = "s as (select o_orderkey as batch_id, case o_orderstatus when 'F' then 'passed' when 'O' then 'failed' else 'scoring' end as status, case when o_custkey % 10 > 0 then o_custkey end as n, o_custkey from orders where o_orderkey % 6 > 0), b as (select o_orderkey as batch_id, status, n from orders left join s on s.batch_id = o_orderkey)"


@query(f"with {_batch_sql} select count(*) as n_batches, count(*) filter (status = 'passed' and n is not null) as passed, count(*) filter (status = 'failed') as failed, count(*) filter (status = 'scoring' or (status = 'passed' and n is null)) as running, count(*) filter (status is null) as pending, cast(coalesce(sum(n) filter (status = 'passed'), 0) as bigint) as passed_rows from b")
def batch_summary(t: Tables) -> DataFrame:
    s = F.col("o_orderstatus")
    statuses = t.orders.filter("o_orderkey % 6 > 0").select(F.col("o_orderkey").alias("batch_id"), F.when(s == "F", "passed").when(s == "O", "failed").otherwise("scoring").alias("status"), F.when(F.col("o_custkey") % 10 > 0, F.col("o_custkey")).alias("rows"))
    return checks.batch_summary(t.orders.select(F.col("o_orderkey").alias("batch_id")), statuses)


@query("select o_orderpriority as county, count(*) as n_batches, cast(sum(case when o_custkey % 10 > 0 then o_custkey else 0 end) as bigint) as n_rows, cast(sum(o_orderkey % 3) as bigint) as n_outside from orders group by 1")
def batch_roll_up(t: Tables) -> DataFrame:
    b = t.orders.select(F.col("o_orderpriority").alias("county"), F.when(F.col("o_custkey") % 10 > 0, F.col("o_custkey")).alias("n_rows"), (F.col("o_orderkey") % 3).alias("n_outside"))
    return checks.roll_up(b, "county", ["n_rows", "n_outside"])


@query("with m as (select s_suppkey as part, 600 as n from supplier where s_suppkey % 8 > 0), d as (select l_suppkey as part, count(*) as n from lineitem where l_suppkey % 6 > 0 group by 1), c as (select l_suppkey as part, count(*) + cast(l_suppkey % 9 = 1 as int) as n from lineitem group by 1), p as (select part from m union select part from d union select part from c) select p.part, cast(coalesce(m.n, 0) as bigint) as expected, coalesce(d.n, 0) as stored, coalesce(c.n, 0) as recorded from p left join m using (part) left join d using (part) left join c using (part) where coalesce(m.n, 0) <> coalesce(d.n, 0) or coalesce(m.n, 0) <> coalesce(c.n, 0)")
def load_checks(t: Tables) -> DataFrame:
    manifest = t.supplier.filter("s_suppkey % 8 > 0").select(F.col("s_suppkey").alias("part"), F.lit(600).cast("long").alias("rows"))
    n = t.lineitem.groupBy(F.col("l_suppkey").alias("part")).agg(F.count("*").alias("rows"))
    return checks.loads(manifest, n.filter("part % 6 > 0"), n.withColumn("rows", F.col("rows") + F.when(F.col("part") % 9 == 1, 1).otherwise(0)), "part")


@query("with x as (select s_suppkey as grid, s_nationkey as a, s_acctbal as b from supplier where s_suppkey % 7 > 0), y as (select s_suppkey as grid, case when s_suppkey % 11 = 0 then -1 when s_suppkey % 13 = 0 then null else s_nationkey end as a, s_acctbal + case when s_suppkey % 5 = 0 then 0.001 else 1e-7 end as b from supplier where s_suppkey % 9 > 0), j as (select coalesce(x.grid, y.grid) as grid, case when y.grid is null then 'only_first' when x.grid is null then 'only_second' when x.a is distinct from y.a or abs(x.b - y.b) > 0.00001 then 'differs' end as fault from x full join y on x.grid = y.grid) select * from j where fault is not null")
def grid_equality(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    x = t.supplier.select(k.alias("grid"), F.col("s_nationkey").alias("columns"), F.col("s_acctbal").alias("weight"))
    g = F.col("grid")
    y = x.withColumn("columns", F.when(g % 11 == 0, -1).when(g % 13 == 0, None).otherwise(F.col("columns"))).withColumn("weight", F.col("weight") + F.when(g % 5 == 0, 0.001).otherwise(1e-7))
    return checks.differing(x.filter(g % 7 > 0), y.filter(g % 9 > 0), "grid", ["columns"], {"weight": 1e-5})


@query("select p_partkey as path, case when p_size % 5 = 1 then 'band_count' when p_size % 7 = 2 then 'type' when p_size % 3 = 1 then 'names' end as fault from part where p_size % 5 = 1 or p_size % 7 = 2 or p_size % 3 = 1")
def layout_audit(t: Tables) -> DataFrame:
    k, text = F.col("p_size"), lambda *xs: F.array(*map(F.lit, xs))
    names = F.when(k % 5 == 1, text("vv")).when(k % 3 == 1, text("vh", "vv")).otherwise(text("VV", "vh"))
    return checks.layout_faults(t.part.select(F.col("p_partkey").alias("path"), names.alias("names"), F.when(k % 7 == 2, text("float32", "int16")).otherwise(text("float32", "float32")).alias("kinds")), ["vv", "vh"], "float32")


@query("with w as (select cast(date_trunc('month', o_orderdate) as date) as week, o_orderpriority as region, max(o_custkey % 100 / 100.0) as share from orders where o_orderkey % 20 = 0 group by 1, 2), g as (select * from (select distinct week from w), (select distinct o_orderpriority as region from orders)) select cast(g.week as varchar) as week, g.region, round(coalesce(share, 0), 6) as share from g left join w using (week, region) where coalesce(share, 0) < 0.6")
def cover_checks(t: Tables) -> DataFrame:
    w = t.orders.filter("o_orderkey % 20 = 0").select(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("week"), F.col("o_orderpriority").alias("region"), (F.col("o_custkey") % 100 / 100.0).alias("share"))
    return checks.cover_faults(w, t.orders.select(F.col("o_orderpriority").alias("region")), 0.6).select(F.col("week").cast("string").alias("week"), "region", F.round("share", 6).alias("share"))


_yields_sql = "y as (select c_custkey, case when c_custkey % 9 > 0 then c_acctbal end as area, case when c_custkey % 4 > 0 then c_custkey % 30 * 1.0 end as central, c_custkey % 7 > 0 as ordered, c_custkey % 8 > 0 as right_amount from customer)"


@query(f"with {_yields_sql} select count(*) as n_rows, count(*) filter (area is null or area <= 0) as bad_area, count(*) filter (central is not null and not ordered) as bad_order, count(*) filter (central is not null and (area is null or (not right_amount))) as bad_production, count(*) filter (central > 20) as warn_yield_over_20 from y")
def yield_checks(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    y = t.customer.select(F.when(k % 9 > 0, F.col("c_acctbal")).alias("area_ha"), F.when(k % 4 > 0, k % 30 * 1.0).alias("yield_central"), k.alias("k"))
    low, made = F.col("yield_central") + F.when(F.col("k") % 7 == 0, 1.0).otherwise(0.0), F.col("yield_central") * F.col("area_ha")
    y = y.select("*", low.alias("yield_low"), (F.col("yield_central") + 1).alias("yield_high"), (made + F.when(F.col("k") % 8 == 0, 1.0).otherwise(0.0)).alias("production_central"))
    return quality.violations(y, checks.yield_rules())


@query("select l_linenumber, count(*) as n_rows, count(*) filter (l_quantity - 2 < 0) as bad_rate, count(*) filter (l_quantity - 2 > 14.4) as warn_rate_over_14_4 from lineitem group by 1")
def rate_checks(t: Tables) -> DataFrame:
    return quality.violations(t.lineitem.withColumn("rate", F.col("l_quantity") - 2), checks.rate_rules(), ["l_linenumber"])


@query("with b as (select s_suppkey, s_suppkey % 40 - 5.5 as x0, s_nationkey * 1.5 - 3 as y0, s_suppkey % 40 + s_nationkey % 3 as x1, s_nationkey * 1.5 + 2.25 as y1 from supplier), w as (select s_suppkey, greatest(0, floor((x0 - 2) / 2)) as l, least(12, ceil((x1 - 2) / 2)) as r, greatest(0, floor((30 - y1) / 2)) as t, least(10, ceil((30 - y0) / 2)) as u from b) select s_suppkey, cast(case when r > l and u > t then l end as bigint) as col, cast(case when r > l and u > t then t end as bigint) as row, cast(case when r > l and u > t then r - l end as bigint) as n_cols, cast(case when r > l and u > t then u - t end as bigint) as n_rows, floor(x0 / 4) * 4.0 as snap_x0, ceil(y1 / 4) * 4.0 as snap_y1 from w join b using (s_suppkey)")
def grid_windows(t: Tables) -> DataFrame:
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    b = t.supplier.select("s_suppkey", (k % 40 - 5.5).alias("x0"), (n * 1.5 - 3).alias("y0"), (k % 40 + n % 3).cast("double").alias("x1"), (n * 1.5 + 2.25).alias("y1"))
    box = {c: F.col(c) for c in ("x0", "y0", "x1", "y1")}
    near = geometry.snapped(box, 4.0)
    return b.select("s_suppkey", *(v.cast("long").alias(c) for c, v in geometry.pixel_window(box, 2.0, 30.0, 2.0, 12, 10).items()), near["x0"].alias("snap_x0"), near["y1"].alias("snap_y1"))


@query("with b as (select n_nationkey as id, n_nationkey * 1.0 as x0, n_regionkey - 2.5 as y0, n_nationkey + 3.0 as x1, n_regionkey + 0.5 as y1 from nation), q as (select id, unnest([0, 1, 2, 3]) as quarter, * exclude (id) from b), r as (select id, quarter, x0 + quarter % 2 * (x1 - x0) / 2 as a, y0 + quarter // 2 * (y1 - y0) / 2 as b, x0 + (quarter % 2 + 1) * (x1 - x0) / 2 as c, y0 + (quarter // 2 + 1) * (y1 - y0) / 2 as d from q) select id, quarter, printf('POLYGON((%.2f %.2f, %.2f %.2f, %.2f %.2f, %.2f %.2f, %.2f %.2f))', a, b, c, b, c, d, a, d, a, b) as wkt from r")
def bounds_quarters(t: Tables) -> DataFrame:
    k, r = F.col("n_nationkey"), F.col("n_regionkey")
    b = t.nation.select(k.alias("id"), F.posexplode(geometry.quarters({"x0": k * 1.0, "y0": r - 2.5, "x1": k + 3.0, "y1": r + 0.5})).alias("quarter", "q"))
    return b.select("id", "quarter", geometry.rectangle_wkt({c: F.col(f"q.{c}") for c in ("x0", "y0", "x1", "y1")}, 2).alias("wkt"))


@query("select s_nationkey as county, round(min(s_suppkey / 10) - 0.02, 6) as x0, round(min(s_acctbal) - 0.02, 6) as y0, round(max(s_suppkey / 10) + 0.02, 6) as x1, round(max(s_acctbal) + 0.02, 6) as y1 from supplier group by 1")
def county_bounds(t: Tables) -> DataFrame:
    x, y = F.col("s_suppkey") / 10, F.col("s_acctbal")
    return rounded(t.supplier.groupBy(F.col("s_nationkey").alias("county")).agg((F.min(x) - 0.02).alias("x0"), (F.min(y) - 0.02).alias("y0"), (F.max(x) + 0.02).alias("x1"), (F.max(y) + 0.02).alias("y1")))


@query("with n as (select p_partkey, p_size, case p_size % 5 when 0 then 'Mean NDVI' when 1 then 'rvi_index' when 2 then '  ' when 3 then 'EVI-2' else p_brand end as raw, p_size % 4 + 1 as position from part) select p_partkey, raw, case when regexp_replace(lower(raw), '[^a-z0-9]+', '', 'g') in ('ndvi', 'meanndvi') then 'ndvi' when regexp_replace(lower(raw), '[^a-z0-9]+', '', 'g') in ('evi', 'evi2') then 'evi' when position = 1 then 'ndvi' when position = 2 then 'evi' else raw end as band from n")
def band_names(t: Tables) -> DataFrame:
    k = F.col("p_size")
    raw = F.when(k % 5 == 0, "Mean NDVI").when(k % 5 == 1, "rvi_index").when(k % 5 == 2, "  ").when(k % 5 == 3, "EVI-2").otherwise(F.col("p_brand"))
    return t.part.select("p_partkey", raw.alias("raw"), expr.band_name(raw, (k % 4 + 1).cast("int"), {"ndvi": ("ndvi", "mean_ndvi"), "evi": ("evi", "EVI 2")}).alias("band"))


@query("select p_partkey, case when p_size % 3 = 0 then 1 when p_size % 3 = 1 then 2 else 1 end as vv, case when p_size % 3 = 0 then 2 when p_size % 3 = 1 then 1 end as vh, case p_size % 3 when 0 then 'band-descriptions' when 1 then 'audited-dual-vh-vv' else 'safe-single-vv' end as how from part")
def product_bands(t: Tables) -> DataFrame:
    k, none = F.col("p_size") % 3, F.lit(None).cast("string")
    names = F.when(k == 0, F.array(F.lit("Sigma0_VV"), F.lit("sigma0-vh"))).when(k == 1, F.array(none, none)).otherwise(F.array(none))
    found = expr.product_bands(names, F.when(k == 2, "S1A_IW_GRDH_1SSV_x").otherwise("S1A_IW_GRDH_1SDV_x"))
    return t.part.select("p_partkey", found.alias("b")).select("p_partkey", "b.vv", "b.vh", "b.how")


@query("select event_id, strftime(ts, '%Y-%m-%d') || 'T00:00:00.000Z' as starts, strftime(ts, '%Y-%m-%d') || 'T23:59:59.999Z' as ends, case event_type when 'click' then 'Clicked' else upper(event_type[1]) || lower(event_type[2:]) end as shown from events")
def shown_names(t: Tables) -> DataFrame:
    first, last = expr.day_bounds(F.col("ts"))
    return t.events.select("event_id", first.alias("starts"), last.alias("ends"), expr.display_name(F.col("event_type"), {"click": "Clicked"}).alias("shown"))


@query("with v as (select l_suppkey, l_linenumber, case when l_discount > 0.03 then l_discount end as v, l_orderkey * 10 + l_linenumber as pos from lineitem) select l_suppkey, round(avg(v), 6) as nanmean, round(median(v), 6) as nanmedian, round(max_by(v, pos) filter (v is not null), 6) as lastvalid, round(min_by(v, pos) filter (v is not null), 6) as firstvalid from v group by 1")
def reducers(t: Tables) -> DataFrame:
    v, at = F.when(F.col("l_discount") > 0.03, F.col("l_discount")), F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return rounded(t.lineitem.groupBy("l_suppkey").agg(*(expr.reduced(n, v, at).alias(n) for n in expr.REDUCERS)))


_cells_sql = "w as (select s_suppkey as field_id, (s_suppkey * 7 + i * 13) % 200 as cell_id, (i + 1) / 5.0 as coverage from supplier, (select unnest([0, 1, 2, 3]) as i)), r as (select p_partkey % 200 as cell_id, p_size as dekad, max(cast(floor(p_retailprice) as int) % 50) as raw from part group by 1, 2)"


@query(f"with {_cells_sql}, s as (select field_id, dekad, sum(coverage) filter (raw <> 7) as w, sum(coverage * (raw * 0.1 + 1)) filter (raw <> 7) as total, count(*) filter (raw <> 7) as source_pixel_count from w join r using (cell_id) group by 1, 2), a as (select field_id, sum(coverage) as whole from w group by 1) select field_id, dekad, round(total / w, 6) as rate, source_pixel_count, round(coalesce(w, 0), 6) as effective_pixel_count, round(coalesce(w, 0) / whole, 6) as coverage_fraction from s join a using (field_id)")
def npp_extraction(t: Tables) -> DataFrame:
    """Four cells a field with their coverage, and a raster of cells by period."""
    w = t.supplier.select(F.col("s_suppkey").alias("field_id"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("i"))
    w = w.select("field_id", ((F.col("field_id") * 7 + F.col("i") * 13) % 200).alias("cell_id"), ((F.col("i") + 1) / 5.0).alias("coverage"))
    r = t.part.groupBy((F.col("p_partkey") % 200).alias("cell_id"), F.col("p_size").alias("dekad")).agg(F.max(F.floor("p_retailprice").cast("int") % 50).alias("raw"))
    return rounded(zonal.cell_rates(w, r, "field_id", "dekad", 0.1, 1.0, 7))


@query(None)
def sampled_series(t: Tables) -> DataFrame:
    """Both sensors' weeks of ten fields that both have: a sampling operator."""
    side = {s: t.lineitem.filter(F.col("l_linestatus") == s).groupBy(F.col("l_suppkey").alias("field_id"), monday(F.col("l_shipdate")).alias("w")).agg(F.count("*").alias("n")) for s in ("O", "F")}
    ids = quality.sampled(side["O"], side["F"], "field_id", 10)
    parts = [d.join(F.broadcast(ids), "field_id", "left_semi").withColumn("sensor", F.lit(s)) for s, d in side.items()]  # ten ids
    return parts[0].unionByName(parts[1]).withColumn("w", F.col("w").cast("string"))


@query(None)
def sampled_blocks(t: Tables) -> DataFrame:
    """Blocks of each file by a seeded hash until there are pairs enough: a sampling operator."""
    b = t.lineitem.groupBy(F.col("l_suppkey").alias("file_id"), F.col("l_linenumber").alias("block")).agg(F.count_if((F.col("l_discount") > 0) & (F.col("l_tax") > 0)).alias("pairs"))
    return quality.sampled_blocks(b, "file_id", "block", "pairs", target=200, least=2, most=4)


@query("select cast(o_orderdate as date)::varchar as day, len(list(distinct o_orderpriority)) as n_tiles, array_to_string(list_sort(list(distinct o_orderpriority)), ',') as tiles from orders group by 1")
def tiles_by_day(t: Tables) -> DataFrame:
    tiles = F.array_sort(F.collect_set("o_orderpriority"))
    return t.orders.groupBy(F.col("o_orderdate").cast("date").cast("string").alias("day")).agg(F.size(tiles).cast("long").alias("n_tiles"), F.array_join(tiles, ",").alias("tiles"))


@query("select o_orderkey, cast(o_orderdate as date)::varchar as day from orders where o_orderstatus = 'F' order by o_orderdate desc, o_orderkey limit 1")
def newest_run(t: Tables) -> DataFrame:
    return t.orders.filter("o_orderstatus = 'F'").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(1).select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("day"))


@query("with c as (select c_nationkey as county, case when c_nationkey % 4 > 0 then c_mktsegment end as segment, count(*) as n from customer group by 1, 2), r as (select *, row_number() over (partition by county order by segment asc nulls first) as place from c) select county, segment, n, place from r")
def nulls_first(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    c = t.customer.groupBy(F.col("c_nationkey").alias("county"), F.when(F.col("c_nationkey") % 4 > 0, F.col("c_mktsegment")).alias("segment")).agg(F.count("*").alias("n"))
    return c.withColumn("place", F.row_number().over(Window.partitionBy("county").orderBy(F.col("segment").asc_nulls_first())).cast("long"))


@query("with f as (select o_custkey % 200 as region, o_orderkey % 40 as week, case when o_orderkey % 31 = 0 then 2 else 1 end as grid from orders where o_custkey < 400), n as (select region, week, count(*) as n, min(grid) as g from f group by 1, 2), u as (select region, grid from (select region, grid, row_number() over (partition by region order by count(*) desc, grid) as k from f group by 1, 2) where k = 1) select region, week, n, case when n > 1 then 'duplicate' else 'grid' end as fault from n join u using (region) where n > 1 or g <> grid")
def inventory_faults(t: Tables) -> DataFrame:
    f = t.orders.filter("o_custkey < 400").select((F.col("o_custkey") % 200).alias("region"), (F.col("o_orderkey") % 40).alias("week"), F.when(F.col("o_orderkey") % 31 == 0, 2).otherwise(1).alias("grid"))
    return store.inventory_faults(f, ["region", "week"], "grid")
