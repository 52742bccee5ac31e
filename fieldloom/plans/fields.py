"""Zonal statistics, indices, composites and geometry.

The tables have no rasters: a line item stands for a pixel of a field (its part or supplier), its numbers for bands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr, geometry
from ..functions.calendar import monday
from ..functions.expr import ratio
from ..operators import quality, zonal
from ..operators.scenes import first_of
from .registry import Tables, query


def rounded(df: DataFrame, *keep: str, places: int = 6, nudge: float = 0.0) -> DataFrame:
    """Doubles to so many places; nudge moves halves off the tie, which sums in another order could fall either side of."""
    return df.select(*(F.col(c) if c in keep or t not in ("double", "float") else F.round(F.col(c) + nudge, places).alias(c) for c, t in df.dtypes))


def _stats_sql(bands: list[str]) -> str:
    return ", ".join(f"round(avg({b}) + 1e-8, 6) as {b}_mean, round(median({b}) + 1e-8, 6) as {b}_median, round(min({b}) + 1e-8, 6) as {b}_min, round(max({b}) + 1e-8, 6) as {b}_max, round(stddev_pop({b}) + 1e-8, 6) as {b}_std, count({b}) as {b}_count" for b in bands)


BANDS = ["l_quantity", "l_extendedprice"]


@query(f"select l_partkey, {_stats_sql(BANDS)} from lineitem group by l_partkey")
def zonal_stats_part(t: Tables) -> DataFrame:
    return rounded(zonal.zonal_stats(t.lineitem, ["l_partkey"], BANDS), nudge=1e-8)


_filled = ", ".join(f"{b}_mean, {b}_median, {b}_min, {b}_max, {b}_std, coalesce({b}_count, 0) as {b}_count" for b in BANDS)


@query(f"select p_partkey, p_brand, {_filled} from part left join (select l_partkey, {_stats_sql(BANDS)} from lineitem where l_quantity > 45 and l_linestatus = 'O' group by 1) s on s.l_partkey = p_partkey")
def zonal_stats_dim_preserving(t: Tables) -> DataFrame:
    pixels = t.lineitem.filter("l_quantity > 45 and l_linestatus = 'O'").withColumnRenamed("l_partkey", "p_partkey")
    return rounded(zonal.with_every_field(t.part.select("p_partkey", "p_brand"), zonal.zonal_stats(pixels, ["p_partkey"], BANDS), "p_partkey", BANDS), nudge=1e-8)


@query("""with p as (select l_suppkey, nullif(l_extendedprice, 0) as v, case when l_linenumber = 1 then 0 else l_discount + 0.01 end as w from lineitem),
s as (select l_suppkey, sum(w) filter (w > 0) as effective, sum(w * v) filter (w > 0) as total, sum(w * v * v) filter (w > 0) as squares, count(*) filter (w > 0) as n_pixels, sum(w) as all_weight from p group by 1),
m as (select l_suppkey, v, sum(w) as w, sum(sum(w)) over (partition by l_suppkey order by v) as upto, sum(sum(w)) over (partition by l_suppkey) / 2 as half from p where w > 0 and v is not null group by 1, 2),
n as (select l_suppkey, min(v) filter (upto >= half * (1 - 1e-12)) as w_median, min(v) as w_min, max(v) as w_max from m group by 1)
select l_suppkey, round(total / effective, 3) as w_mean, round(w_median, 3) as w_median, round(w_min, 3) as w_min, round(w_max, 3) as w_max, round(sqrt(greatest(0, squares / effective - (total / effective) * (total / effective))), 3) as w_std, n_pixels, round(effective, 6) as effective_count, round(effective / all_weight, 6) as coverage_fraction from s left join n using (l_suppkey)""")
def zonal_weighted(t: Tables) -> DataFrame:
    pixels = t.lineitem.withColumn("w", F.when(F.col("l_linenumber") == 1, 0.0).otherwise(F.col("l_discount") + 0.01))
    out = zonal.weighted_stats(pixels, ["l_suppkey"], "l_extendedprice", "w")
    return rounded(rounded(out, "effective_count", "coverage_fraction", places=3))


_b = {"b02": "l_tax + 0.02", "b03": "l_tax + 0.05", "b04": "l_discount + 0.03", "b05": "l_discount + 0.08", "b08": "l_quantity / 50", "b8a": "l_quantity / 45", "b11": "l_extendedprice / 200000"}
_zeroed = {k: f"case when l_linenumber = {i + 1} then null else {v} - 0.01 end" for i, (k, v) in enumerate(_b.items())}
_bands_sql = ", ".join(f"{v} as {k}" for k, v in _zeroed.items())


def _nd(a: str, b: str) -> str:
    return f"case when {a} is not null and {b} is not null and {a} + {b} <> 0 then greatest(-1, least(1, ({a} - {b}) / ({a} + {b}))) end"


_index_sql = {
    "ndvi": _nd("b08", "b04"), "ndmi": _nd("b08", "b11"), "ndre": _nd("b8a", "b05"), "pvr": _nd("b03", "b02"),
    "evi": "case when b08 is not null and b04 is not null and b02 is not null and b08 + 6 * b04 - 7.5 * b02 + 1 <> 0 then greatest(-1, least(1, 2.5 * (b08 - b04) / (b08 + 6 * b04 - 7.5 * b02 + 1))) end",
    "msi": "case when b11 is not null and b08 is not null and b08 <> 0 then greatest(0, least(10, b11 / b08)) end",
    "lai": f"case when ({_nd('b08', 'b04')}) is not null then greatest(0, least(10, 3.618 * ({_nd('b08', 'b04')}) - 0.118)) end",
}
INDICES = ["ndvi", "evi", "ndmi", "ndre", "msi", "pvr", "lai"]


@query(f"with p as (select l_suppkey, {_bands_sql} from lineitem), i as (select l_suppkey, {', '.join(f'{v} as {k}' for k, v in _index_sql.items())} from p) select l_suppkey, {', '.join(f'round(avg({k}), 6) as {k}_mean, count({k}) as {k}_count' for k in INDICES)} from i group by 1")
def s2_indices(t: Tables) -> DataFrame:
    stored = {k: F.when(F.col("l_linenumber") == i + 1, 0.0).otherwise(F.expr(v) + 0.09) for i, (k, v) in enumerate(_b.items())}  # 0: no data
    bands = {k: expr.offset_corrected(v) for k, v in stored.items()}
    pixels = t.lineitem.select("l_suppkey", *(v.alias(k) for k, v in expr.optical_indices(bands).items()))
    return rounded(pixels.groupBy("l_suppkey").agg(*(x for k in INDICES for x in (F.avg(k).alias(f"{k}_mean"), F.count(k).alias(f"{k}_count")))))


@query("""with p as (select l_suppkey, case when l_linenumber = 1 then null else l_discount + 0.01 end as b1, case when l_linenumber = 2 then null else l_tax + 0.02 end as b2 from lineitem),
r as (select l_suppkey, coalesce(b2, b1) as vv, case when b1 is not null and b2 is not null then b1 end as vh from p)
select l_suppkey, count(vv) as vv_count, count(vh) as vh_count, round(avg(vv), 6) as vv_mean, round(avg(vh / vv), 6) as p_ratio, round(avg(4 * vh / (vv + vh)), 6) as rvi, round(avg((vv - vh) / (vv + vh)), 6) as rcspr from r group by 1""")
def s1_remap_indices(t: Tables) -> DataFrame:
    vv, vh = expr.remapped(F.when(F.col("l_linenumber") != 1, F.col("l_discount") + 0.01), F.when(F.col("l_linenumber") != 2, F.col("l_tax") + 0.02))
    p = t.lineitem.select("l_suppkey", vv.alias("vv"), vh.alias("vh"))
    i = p.select("l_suppkey", "vv", "vh", *(v.alias(k) for k, v in expr.radar_indices(F.col("vv"), F.col("vh")).items()))
    return rounded(i.groupBy("l_suppkey").agg(F.count("vv").alias("vv_count"), F.count("vh").alias("vh_count"), F.avg("vv").alias("vv_mean"), *(F.avg(k).alias(k) for k in ("p_ratio", "rvi", "rcspr"))))


@query("select l_linenumber, round(avg(greatest(-100, least(100, l_tax - l_discount))), 6) as difference, round(avg(case when l_discount <> 0 then greatest(-100, least(100, l_tax / l_discount)) end), 6) as quotient, count(l_tax / nullif(l_discount, 0)) as n_quotient from lineitem group by 1")
def s1_diff_ratio(t: Tables) -> DataFrame:
    out = t.lineitem.groupBy("l_linenumber").agg(F.avg(expr.clip(F.col("l_tax") - F.col("l_discount"), -100.0, 100.0)).alias("difference"), F.avg(expr.clip(expr.ratio(F.col("l_tax"), F.col("l_discount")), -100.0, 100.0)).alias("quotient"), F.count(expr.ratio(F.col("l_tax"), F.col("l_discount"))).alias("n_quotient"))
    return rounded(out)


@query("select l_suppkey, round(avg(case when l_linenumber in (4, 5, 6, 7) and l_returnflag <> 'R' then l_quantity / 10000 end), 9) as reflectance, count(case when l_linenumber in (4, 5, 6, 7) and l_returnflag <> 'R' then 1 end) as n_clear, round(avg(case when l_quantity <> 50 then l_quantity * 0.001 + 0.5 end), 6) as physical from lineitem group by 1")
def dn_decode(t: Tables) -> DataFrame:
    r = expr.reflectance(F.col("l_quantity"), F.col("l_linenumber"), F.col("l_returnflag") != "R")
    return t.lineitem.groupBy("l_suppkey").agg(F.round(F.avg(r), 9).alias("reflectance"), F.count(r).alias("n_clear"), F.round(F.avg(expr.decoded(F.col("l_quantity"), 0.001, 0.5, 50)), 6).alias("physical"))


@query("select cast(floor(p_size / 4) * 250 + floor(p_partkey % 1000 / 4) as bigint) as tile_id, count(*) as n_pixels, min(p_size * 1000 + p_partkey % 1000) as first_pixel from part group by 1")
def tile_addressing(t: Tables) -> DataFrame:
    row, col = F.col("p_size"), F.col("p_partkey") % 1000
    return t.part.groupBy(geometry.tile(row, col, 4, 1000).alias("tile_id")).agg(F.count("*").alias("n_pixels"), F.min(geometry.flat_pixel(row, col, 1000)).alias("first_pixel"))


@query("with n as (select p_size as tile_id, count(*) as n from part group by 1) select tile_id, n, cast(sum(n) over (order by tile_id) - n as bigint) as offset_start from n")
def tile_run_lengths(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    n = t.part.groupBy(F.col("p_size").alias("tile_id")).agg(F.count("*").alias("n"))  # a row for each tile
    return n.withColumn("offset_start", F.sum("n").over(Window.orderBy("tile_id")) - F.col("n"))


@query("select c_custkey, cast(floor((60 - (c_acctbal / 1000)) / 0.0009765625) * 368640 + floor((c_nationkey + 180) / 0.0009765625) as bigint) as cell_id from customer")
def global_cell_id(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", geometry.global_cell(F.col("c_nationkey"), F.col("c_acctbal") / 1000).alias("cell_id"))


_composite = "select l_suppkey, cast(date_trunc('week', l_shipdate) as date) as week, cast(l_shipdate as date) as day, case when l_discount <> 0.05 then l_discount end as v from lineitem"


@query(f"with p as ({_composite}) select l_suppkey, cast(week as varchar) as week, round(avg(v), 6) as nanmean, round(median(v), 6) as nanmedian, count(v) as n_valid from p group by 1, 2")
def weekly_nanmean_nanmedian(t: Tables) -> DataFrame:
    p = _pixels(t)
    return rounded(p.groupBy("l_suppkey", F.col("week").cast("string").alias("week")).agg(F.avg("v").alias("nanmean"), F.median("v").alias("nanmedian"), F.count("v").alias("n_valid")))


def _pixels(t: Tables) -> DataFrame:
    return t.lineitem.select("l_suppkey", monday(F.col("l_shipdate")).alias("week"), F.col("l_shipdate").cast("date").alias("day"), F.when(F.col("l_discount") != 0.05, F.col("l_discount")).alias("v"))


@query(f"with p as ({_composite}), d as (select l_suppkey, week, day, min(v) as v from p group by 1, 2, 3), r as (select *, row_number() over (partition by l_suppkey, week order by day) as a, row_number() over (partition by l_suppkey, week order by day desc) as z from d where v is not null) select l_suppkey, cast(week as varchar) as week, max(v) filter (a = 1) as firstvalid, max(v) filter (z = 1) as lastvalid from r group by 1, 2")
def weekly_firstvalid_lastvalid(t: Tables) -> DataFrame:
    daily = _pixels(t).groupBy("l_suppkey", "week", "day").agg(F.min("v").alias("v")).filter("v is not null")
    out = daily.groupBy("l_suppkey", "week").agg(F.min(F.struct("day", "v")).alias("a"), F.max(F.struct("day", "v")).alias("z"))
    return out.select("l_suppkey", F.col("week").cast("string").alias("week"), F.col("a.v").alias("firstvalid"), F.col("z.v").alias("lastvalid"))


@query("select l_partkey, cast(cast(l_shipdate as date) as varchar) as day, arg_min(l_discount, l_suppkey * 100 + l_linenumber + l_discount / 10) as mosaic from lineitem where l_discount <> 0.05 group by 1, 2")
def daily_first_valid(t: Tables) -> DataFrame:
    valid = t.lineitem.filter("l_discount <> 0.05")
    return valid.groupBy("l_partkey", F.col("l_shipdate").cast("date").cast("string").alias("day")).agg(F.min_by("l_discount", F.col("l_suppkey") * 100 + F.col("l_linenumber") + F.col("l_discount") / 10).alias("mosaic"))


@query("select l_suppkey, round(count(*) filter (l_discount <> 0 and l_tax <> 0) / count(*), 6) as coverage from lineitem group by 1")
def aoi_valid_coverage(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey").agg(F.round(F.count_if(F.expr("l_discount <> 0 and l_tax <> 0")) / F.count("*"), 6).alias("coverage"))


@query("select l_suppkey, round(sum(l_quantity * w) filter (l_quantity <> 50) / nullif(sum(w) filter (l_quantity <> 50), 0), 6) as rate, count(*) filter (l_quantity <> 50) as pixels, round(sum(w) filter (l_quantity <> 50), 6) as effective, round(sum(w) filter (l_quantity <> 50) / sum(w), 6) as fraction from (select *, l_tax + 0.1 as w from lineitem) group by 1")
def coverage_weighted_mean(t: Tables) -> DataFrame:
    w, ok = F.col("l_tax") + 0.1, F.col("l_quantity") != 50
    out = t.lineitem.groupBy("l_suppkey").agg(F.sum(F.when(ok, F.col("l_quantity") * w)).alias("a"), F.sum(F.when(ok, w)).alias("effective"), F.count_if(ok).alias("pixels"), F.sum(w).alias("whole"))
    return rounded(out.select("l_suppkey", expr.ratio(F.col("a"), F.col("effective")).alias("rate"), "pixels", "effective", expr.ratio(F.col("effective"), F.col("whole")).alias("fraction")))


def _ring(cx, cy):
    """A quadrilateral that isn't convex, around a centre."""
    corner = lambda dx, dy: F.struct((cx + dx).alias("x"), (cy + dy).alias("y"))
    return F.array(corner(F.lit(-20.0), F.lit(-20.0)), corner(F.lit(25.0), F.lit(-15.0)), corner(F.lit(5.0), F.lit(0.0)), corner(F.lit(20.0), F.lit(25.0)))


_edges_sql = "(values (-20.0, -20.0, 25.0, -15.0), (25.0, -15.0, 5.0, 0.0), (5.0, 0.0, 20.0, 25.0), (20.0, 25.0, -20.0, -20.0)) e(px, py, qx, qy)"
_points_sql = f"""points as (select s_suppkey, x, y from supplier, (select unnest(range(-24, 25, 4)) as x), (select unnest(range(-24, 25, 4)) as y)),
each as (select s_suppkey, x, y, ((py > y) <> (qy > y)) and x < (qx - px) * (y - py) / nullif(qy - py, 0) + px as crosses,
  greatest(0, least(1, ((x - px) * (qx - px) + (y - py) * (qy - py)) / ((qx - px) * (qx - px) + (qy - py) * (qy - py)))) as k, px, py, qx, qy from points, {_edges_sql}),
judged as (select s_suppkey, x, y, count(*) filter (crosses) % 2 = 1 as inside, min(sqrt(pow(x - px - k * (qx - px), 2) + pow(y - py - k * (qy - py), 2))) as distance from each group by 1, 2, 3)"""


def _judged(t: Tables) -> DataFrame:
    """Candidate pixel centres come from the field's bounds, not from a join with all pixels."""
    axis = F.sequence(F.lit(-24), F.lit(24), F.lit(4))
    rows = t.supplier.select("s_suppkey", F.explode(axis).alias("x")).withColumn("y", F.explode(axis))
    ring = _ring(F.lit(0.0), F.lit(0.0))
    return rows.select("s_suppkey", "x", "y", geometry.inside(ring, F.col("x").cast("double"), F.col("y").cast("double")).alias("inside"), geometry.boundary_distance(ring, F.col("x").cast("double"), F.col("y").cast("double")).alias("distance"))


@query(f"with {_points_sql} select s_suppkey, count(*) filter (inside) as n_inside, round(sum(distance) filter (inside), 6) as total_distance from judged group by 1")
def point_in_polygon(t: Tables) -> DataFrame:
    return rounded(_judged(t).groupBy("s_suppkey").agg(F.count_if("inside").alias("n_inside"), F.sum(F.when(F.col("inside"), F.col("distance"))).alias("total_distance")))


_counts_sql = ", ".join(f"count(*) filter (inside and distance > {d} and {where}) as {sensor}_{d}" for sensor, where in (("s1", "x % 8 = 0"), ("s2", "true")) for d in (0, 5, 10)).replace("distance > 0", "true")
_choice_sql = "case when s1_10 >= least and s2_10 >= least then {}10 when s1_5 >= least and s2_5 >= least then {}5 else {}0 end"


@query(f"with {_points_sql}, n as (select s_suppkey, {_counts_sql}, s_suppkey % 20 as least from judged group by 1), c as (select *, {_choice_sql.format('', '', '')} as width, {_choice_sql.format(*['s1_'] * 3)} as s1_after, {_choice_sql.format(*['s2_'] * 3)} as s2_after from n) select s_suppkey, cast(width as int) as buffer_width_m, s1_0 as s1_before, s1_after, s2_0 as s2_before, s2_after, s1_after < least or s2_after < least as below_min_pixel_threshold from c")
def adaptive_buffer(t: Tables) -> DataFrame:
    """Both sensors see the points; the first has every other column of them only."""
    seen = _judged(t).withColumn("s1", F.col("x") % 8 == 0).withColumn("s2", F.lit(True))
    return zonal.buffers(seen, ["s_suppkey"], ["s1", "s2"], F.col("s_suppkey") % 20)


@query("select s_suppkey, round(abs((-20 * -15 - 25 * -20) + (25 * 0 - 5 * -15) + (5 * 25 - 20 * 0) + (20 * -20 - -20 * 25)) / 2, 6) as area_m2, s_acctbal > 0 as has_area, round(case when s_acctbal > 0 then s_acctbal else 550.0 end, 6) as area_used from supplier")
def ring_area(t: Tables) -> DataFrame:
    area = geometry.ring_area(_ring(F.lit(0.0), F.lit(0.0)))
    return rounded(t.supplier.select("s_suppkey", area.alias("area_m2"), (F.col("s_acctbal") > 0).alias("has_area"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).otherwise(area).alias("area_used")))


@query("select o_orderkey, round(greatest(0, least(x + 30, 60) - greatest(x, 20)) * greatest(0, least(y + 25, 70) - greatest(y, 10)) / (30.0 * 25), 6) as share from (select o_orderkey, o_custkey % 100 as x, o_orderkey % 90 as y from orders) where x < 60 and x + 30 > 20 and y < 70 and y + 25 > 10")
def footprint_overlap(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", (F.col("o_custkey") % 100).alias("x"), (F.col("o_orderkey") % 90).alias("y"))
    o = o.filter("x < 60 and x + 30 > 20 and y < 70 and y + 25 > 10")
    area = geometry.rectangle_overlap({"x0": F.col("x"), "y0": F.col("y"), "x1": F.col("x") + 30, "y1": F.col("y") + 25}, {k: F.lit(v) for k, v in zip(("x0", "y0", "x1", "y1"), (20, 10, 60, 70))})
    return o.select("o_orderkey", F.round(area / (30.0 * 25), 6).alias("share"))


_bands_sql = """f as (select l_suppkey as file_id, nullif(case when l_suppkey % 5 = 1 then 0 else l_tax * (1 + l_suppkey % 3) end, 0) as b1, nullif(case when l_suppkey % 7 = 1 then 0 else l_discount end, 0) as b2 from lineitem),
a as (select file_id, count(b1) as valid_1, count(b2) as valid_2, count(*) filter (b1 > 0 and b2 > 0) as paired, median(b1) filter (b2 > 0) as m1, median(b2) filter (b1 > 0) as m2, avg((b2 > b1)::int) as greater from f group by 1)"""


@query(f"with {_bands_sql} select file_id, valid_1, valid_2, paired, round(m2 / m1, 6) as share, round(greater, 6) as greater, case when valid_1 = 0 and valid_2 = 0 then 'both_empty' when valid_2 = 0 then 'band1_only' when valid_1 = 0 then 'band2_only' when paired < 10 or m2 / m1 is null then 'insufficient_paired_samples' when m2 / m1 >= 1.25 and greater >= 0.70 then 'band1_likely_vh_band2_likely_vv' when m2 / m1 <= 0.80 and greater <= 0.30 then 'band1_likely_vv_band2_likely_vh' else 'ambiguous' end as polarisation from a")
def polarisation_class(t: Tables) -> DataFrame:
    """Seven classes, by file; ten pairs are enough here, since the files are small."""
    k = F.col("l_suppkey")
    f = t.lineitem.select(k.alias("file_id"), F.when(k % 5 != 1, F.col("l_tax") * (1 + k % 3)).alias("b1"), F.when(k % 7 != 1, F.col("l_discount")).alias("b2"))
    f = f.select("file_id", *(F.when(F.col(b) > 0, F.col(b)).alias(b) for b in ("b1", "b2")))
    both = F.col("b1").isNotNull() & F.col("b2").isNotNull()
    a = f.groupBy("file_id").agg(
        F.count("b1").alias("valid_1"), F.count("b2").alias("valid_2"), F.count(F.when(both, 1)).alias("paired"),
        ratio(F.median(F.when(both, F.col("b2"))), F.median(F.when(both, F.col("b1")))).alias("share"), F.avg((F.col("b2") > F.col("b1")).cast("int")).alias("greater"),
    )
    kind = quality.polarisation(*(F.col(c) for c in ("valid_1", "valid_2", "paired", "share", "greater")), least=10)
    return rounded(a.withColumn("polarisation", kind))


@query("with r as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderdate desc, o_orderkey) as k from orders) select o_custkey, o_orderkey from r where k <= 2")
def scene_topn(t: Tables) -> DataFrame:
    return first_of(t.orders, ["o_custkey"], F.desc("o_totalprice"), F.desc("o_orderdate"), F.col("o_orderkey"), n=2).select("o_custkey", "o_orderkey")


@query("select c_nationkey, o_orderpriority, min(o_orderkey) as o_orderkey from orders join customer on c_custkey = o_custkey group by 1, 2")
def scene_dedup(t: Tables) -> DataFrame:
    scenes = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    return first_of(scenes, ["c_nationkey", "o_orderpriority"], F.col("o_orderkey")).select("c_nationkey", "o_orderpriority", "o_orderkey")


@query(None)
def scene_greedy_cover(t: Tables) -> DataFrame:
    from ..operators.scenes import greedy_cover

    x, y = F.col("o_custkey") % 70 / 100, F.col("o_orderkey") % 80 / 100
    scenes = t.orders.select(F.col("o_orderpriority").alias("region"), F.year("o_orderdate").alias("year"), F.col("o_orderkey").alias("scene_id"), x.alias("x0"), y.alias("y0"), (x + 0.3).alias("x1"), (y + 0.25).alias("y1"))
    return greedy_cover(scenes, ["region", "year"])


@query("select s_nationkey, count(*) as n_rows, count(distinct (s_nationkey, s_suppkey)) as n_keys from supplier group by 1")
def tuple_distinct(t: Tables) -> DataFrame:
    return t.supplier.groupBy("s_nationkey").agg(F.count("*").alias("n_rows"), quality.distinct_keys("s_nationkey", "s_suppkey").alias("n_keys"))
