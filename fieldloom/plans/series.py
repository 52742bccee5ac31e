"""Grids of fields and weeks, seasons, phenology, productivity and yield."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar
from ..functions.calendar import monday
from ..functions.expr import middle, nearest
from ..operators import timeseries, yields
from ..operators.scenes import first_of, scored
from .fields import rounded
from .registry import Tables, query

_side = "select l_suppkey as field_id, cast(date_trunc('week', l_shipdate) as date) as w, round(avg(l_discount), 6) as v, count(*) as n from lineitem where l_linestatus = '{}' group by 1, 2"
_axis = "select cast(unnest(generate_series(timestamp '{}', timestamp '{}', interval 7 days)) as date) as w"
YEAR = ("1996-01-01", "1996-12-30")


def _sensor(t: Tables, status: str) -> DataFrame:
    return t.lineitem.filter(F.col("l_linestatus") == status).groupBy(F.col("l_suppkey").alias("field_id"), monday(F.col("l_shipdate")).alias("w")).agg(F.round(F.avg("l_discount"), 6).alias("v"), F.count("*").alias("n"))


def _grid(t: Tables, first: str, last: str) -> DataFrame:
    axis = calendar.weeks(t.spark, first, last).select(F.col("week_start").alias("w"))
    return t.supplier.select(F.col("s_suppkey").alias("field_id")).crossJoin(F.broadcast(axis))


@query(f"with g as (select s_suppkey as field_id, w from supplier, ({_axis.format(*YEAR)})), a as ({_side.format('O')}), b as ({_side.format('F')}) select g.field_id, cast(g.w as varchar) as w, a.v as s2_v, a.n as s2_n, b.v as s1_v, b.n as s1_n from g left join a on a.field_id = g.field_id and a.w = g.w left join b on b.field_id = g.field_id and b.w = g.w")
def weekly_grid_wide(t: Tables) -> DataFrame:
    out = _grid(t, *YEAR)
    for prefix, status in (("s2", "O"), ("s1", "F")):
        side = _sensor(t, status).filter(F.col("w").between(*YEAR))
        out = out.join(side.select("field_id", "w", *(F.col(c).alias(f"{prefix}_{c}") for c in ("v", "n"))), ["field_id", "w"], "left")
    return out.withColumn("w", F.col("w").cast("string"))


@query(f"with a as ({_side.format('O')}), b as ({_side.format('F')}) select coalesce(a.field_id, b.field_id) as field_id, cast(coalesce(a.w, b.w) as varchar) as w, a.v as s2_v, b.v as s1_v from a full join b on a.field_id = b.field_id and a.w = b.w")
def sensors_full_outer(t: Tables) -> DataFrame:
    a, b = (_sensor(t, s).select("field_id", "w", F.col("v").alias(f"{p}_v")) for s, p in (("O", "s2"), ("F", "s1")))
    return a.join(b, ["field_id", "w"], "outer").withColumn("w", F.col("w").cast("string"))


@query("with f as (select l_suppkey, cast(l_shipdate as date) as d, l_linenumber, l_quantity, row_number() over (partition by l_suppkey order by l_shipdate, l_linenumber, l_quantity) as k from lineitem) select s_suppkey, cast(d as varchar) as first_day, coalesce(l_linenumber, -1) as buffer, l_quantity from supplier left join f on l_suppkey = s_suppkey and k = 1")
def earliest_buffer_lateral(t: Tables) -> DataFrame:
    first = first_of(t.lineitem, ["l_suppkey"], F.col("l_shipdate"), F.col("l_linenumber"), F.col("l_quantity"))
    out = t.supplier.join(first, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return out.select("s_suppkey", F.col("l_shipdate").cast("date").cast("string").alias("first_day"), F.coalesce("l_linenumber", F.lit(-1)).alias("buffer"), "l_quantity")


@query("with r as (select c_custkey, c_nationkey, row_number() over (partition by c_nationkey order by c_custkey) - 1 as k from customer) select c_custkey, c_nationkey, cast(k // 25 as bigint) as batch_number, 'n' || c_nationkey || '_' || lpad(cast(k // 25 as varchar), 4, '0') as batch_id from r")
def batch_plan(t: Tables) -> DataFrame:
    k = F.floor((F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")) - 1) / 25)
    out = t.customer.select("c_custkey", "c_nationkey", k.alias("batch_number"))
    return out.withColumn("batch_id", F.concat(F.lit("n"), F.col("c_nationkey").cast("string"), F.lit("_"), F.lpad(F.col("batch_number").cast("string"), 4, "0")))


@query("with w as (select distinct l_suppkey, cast(date_trunc('week', l_shipdate) as date) as w from lineitem), n as (select *, lead(w) over (partition by l_suppkey order by w) as later from w) select l_suppkey, cast(w as varchar) as last_before, date_diff('day', w, later) // 7 - 1 as missing_weeks from n where date_diff('day', w, later) > 7")
def week_gaps(t: Tables) -> DataFrame:
    w = t.lineitem.select("l_suppkey", monday(F.col("l_shipdate")).alias("w")).distinct()
    w = w.withColumn("days", F.datediff(F.lead("w").over(Window.partitionBy("l_suppkey").orderBy("w")), "w")).filter("days > 7")
    return w.select("l_suppkey", F.col("w").cast("string").alias("last_before"), (F.col("days") / 7 - 1).cast("long").alias("missing_weeks"))


@query("with c as (select distinct year(o_orderdate) || case when o_custkey % 2 = 0 then '_lr' else '_sr' end as code from orders), p as (select code, cast(left(code, 4) as int) as y, right(code, 2) as k from c) select code, cast(case when k = 'lr' then make_date(y, 3, 1) else make_date(y, 10, 1) end as varchar) as first_day, cast(case when k = 'lr' then make_date(y, 8, 31) else last_day(make_date(y + 1, 2, 1)) end as varchar) as last_day from p")
def season_bounds(t: Tables) -> DataFrame:
    code = F.concat(F.year("o_orderdate").cast("string"), F.when(F.col("o_custkey") % 2 == 0, "_lr").otherwise("_sr"))
    first, last = calendar.season_bounds(F.col("code"))
    return t.orders.select(code.alias("code")).distinct().select("code", first.cast("string").alias("first_day"), last.cast("string").alias("last_day"))


@query("with s as (select s_suppkey, date '1996-02-05' + cast(s_suppkey % 40 as int) as a, date '1996-02-05' + cast(s_suppkey % 40 + 33 as int) as z from supplier), m as (select *, unnest(generate_series(date_trunc('month', a), date_trunc('month', z), interval 1 month)) as m from s), d as (select *, unnest([1, 2, 3]) as k from m), p as (select s_suppkey, a, z, m, k, cast(m as date) + 10 * (k - 1) as x, case when k < 3 then cast(m as date) + 10 * k - 1 else last_day(m) end as y from d) select s_suppkey, strftime(m, '%Y-%m') || '-D' || k as dekad, date_diff('day', x, y) + 1 as days, greatest(0, date_diff('day', greatest(x, a), least(y, z)) + 1) as shared from p where x <= z and y >= a")
def dekads_overlap(t: Tables) -> DataFrame:
    k = (F.col("s_suppkey") % 40).cast("int")
    s = t.supplier.select("s_suppkey", F.date_add(F.lit("1996-02-05").cast("date"), k).alias("a"), F.date_add(F.lit("1996-02-05").cast("date"), k + 33).alias("z"))
    d = calendar.dekads(s, "a", "z")
    return d.select("s_suppkey", "dekad", F.col("days").cast("long").alias("days"), calendar.overlap_days(F.col("period_start"), F.col("period_end"), F.col("a"), F.col("z")).cast("long").alias("shared"))


@query(f"with w as ({_axis.format('1995-01-02', '2001-12-31')}) select cast(w as varchar) as week_start, cast(w + 6 as varchar) as week_end, cast(isoyear(w) as int) as iso_year, cast(weekofyear(w) as int) as iso_week from w")
def iso_weeks(t: Tables) -> DataFrame:
    return calendar.weeks(t.spark, "1995-01-02", "2001-12-31").select(F.col("week_start").cast("string"), F.col("week_end").cast("string"), "iso_year", "iso_week")


@query("select year(o_orderdate) as y, count(*) as requested, count(*) filter (o_orderstatus <> 'P') as available, count(*) = count(*) filter (o_orderstatus <> 'P') as complete from orders group by 1")
def season_completeness(t: Tables) -> DataFrame:
    out = t.orders.groupBy(F.year("o_orderdate").cast("long").alias("y")).agg(F.count("*").alias("requested"), F.count_if(F.expr("o_orderstatus <> 'P'")).alias("available"))
    return out.withColumn("complete", F.col("requested") == F.col("available"))


SEASON = ("1996-03-04", "1996-08-26")
_signal_sql = f"g as (select s_suppkey as field_id, w from supplier, ({_axis.format(*SEASON)})), o as (select l_suppkey as field_id, cast(date_trunc('week', l_shipdate) as date) as w, avg(l_discount) as a, avg(l_tax) as b from lineitem where l_quantity > 20 group by 1, 2), s as (select g.field_id, g.w, a, b from g left join o on o.field_id = g.field_id and o.w = g.w)"


def _norm_sql(v: str) -> str:
    return f"case when count({v}) over f >= 3 and quantile_cont({v}, 0.9) over f - quantile_cont({v}, 0.1) over f > 1e-8 and {v} is not null then greatest(0, least(1, ({v} - quantile_cont({v}, 0.1) over f) / (quantile_cont({v}, 0.9) over f - quantile_cont({v}, 0.1) over f))) end"


_norms_sql = f"{_signal_sql}, m as (select field_id, w, {_norm_sql('a')} as na, {_norm_sql('b')} as nb from s window f as (partition by field_id)), x as (select field_id, w, na, nb, round(case when na is not null and nb is not null then (na + nb) / 2 else coalesce(na, nb) end, 9) as signal from m)"
_fill_sql = f"""{_norms_sql}, i as (select field_id, w, signal, row_number() over o as i from x window o as (partition by field_id order by w)),
k as (select *, last_value(case when signal is not null then i end ignore nulls) over b as pi, last_value(signal ignore nulls) over b as pv, first_value(case when signal is not null then i end ignore nulls) over a as ni, first_value(signal ignore nulls) over a as nv from i
      window b as (partition by field_id order by w rows between unbounded preceding and current row), a as (partition by field_id order by w rows between current row and unbounded following)),
fill as (select field_id, w, round(case when signal is not null then signal when pi is not null and ni is not null then case when ni - pi - 1 <= 2 then pv + (nv - pv) * (i - pi) / (ni - pi) end when ni is not null then case when ni - 1 <= 2 then nv end when pi is not null then case when i - pi <= 2 then pv end end, 9) as filled from k),
smooth as (select field_id, w, filled, round(median(filled) over (partition by field_id order by w rows between 1 preceding and 1 following), 9) as smoothed from fill)"""


def _signal(t: Tables) -> DataFrame:
    o = t.lineitem.filter("l_quantity > 20").groupBy(F.col("l_suppkey").alias("field_id"), monday(F.col("l_shipdate")).alias("w")).agg(F.avg("l_discount").alias("a"), F.avg("l_tax").alias("b"))
    s = _grid(t, *SEASON).join(o, ["field_id", "w"], "left")
    for c in ("a", "b"):
        s = timeseries.normalised(s, "field_id", c, f"n{c}")
    return s.withColumn("signal", nearest(middle(F.array("na", "nb")), 9))


@query(f"with {_norms_sql} select field_id, cast(w as varchar) as w, round(na, 6) as na, round(nb, 6) as nb, round(signal, 6) as signal from x")
def robust_normalize(t: Tables) -> DataFrame:
    return _signal(t).select("field_id", F.col("w").cast("string").alias("w"), *(nearest(F.col(c), 6).alias(c) for c in ("na", "nb", "signal")))


def _smooth(t: Tables) -> DataFrame:
    f = timeseries.filled(_signal(t).select("field_id", "w", "signal"), "field_id", "w", "signal", "filled").withColumn("filled", nearest(F.col("filled"), 9))
    return timeseries.smoothed(f, "field_id", "w", "filled", "smoothed").withColumn("smoothed", nearest(F.col("smoothed"), 9))


@query(f"with {_fill_sql} select field_id, cast(w as varchar) as w, round(filled, 6) as filled, round(smoothed, 6) as smoothed from smooth")
def gap_fill_rolling_median(t: Tables) -> DataFrame:
    return _smooth(t).select("field_id", F.col("w").cast("string").alias("w"), *(nearest(F.col(c), 6).alias(c) for c in ("filled", "smoothed")))


_bound_sql = """r as (select *, count(smoothed) over (partition by field_id order by w) as f, count(smoothed) over (partition by field_id order by w desc) as b from smooth),
e as (select field_id, count(smoothed) as valid_weeks, max(smoothed) as peak_value, median(smoothed) filter (f <= 3 or b <= 3) as base from r group by 1),
p as (select r.*, e.valid_weeks, e.peak_value, e.base, round(e.base + 0.2 * (e.peak_value - e.base), 9) as threshold, min(case when smoothed = peak_value then w end) over (partition by field_id) as peak_week from r join e using (field_id)),
h as (select *, coalesce(smoothed >= threshold and w <= peak_week, false) as above, coalesce(smoothed <= threshold and w >= peak_week, false) as below from p),
q as (select *, above and coalesce(lead(above) over o, false) as up, below and coalesce(lead(below) over o, false) as down from h window o as (partition by field_id order by w)),
z as (select field_id, valid_weeks, peak_value, base, peak_week, min(w) filter (up) as sos, min(w) filter (down) as eos from q group by 1, 2, 3, 4, 5)"""


@query(f"""with {_fill_sql}, {_bound_sql}
select field_id, valid_weeks, round(peak_value, 6) as peak_value, round(base, 6) as base, cast(peak_week as varchar) as peak_week, cast(sos as varchar) as sos, cast(eos as varchar) as eos,
case when valid_weeks = 0 then 'no_data' when valid_weeks < 6 then 'too_few_weeks' when peak_value - base < 0.2 then 'low_amplitude' when sos is null and eos is null then 'no_boundary' when sos is null or eos is null then 'one_boundary' else 'detected' end as qa_status from z""")
def phenology(t: Tables) -> DataFrame:
    b = timeseries.boundaries(_smooth(t), "field_id", "w", "smoothed")
    return b.select("field_id", "valid_weeks", *(nearest(F.col(c), 6).alias(c) for c in ("peak_value", "base")), *(F.col(c).cast("string").alias(c) for c in ("peak_week", "sos", "eos")), "qa_status")


_season_sql = "seasons as (select s_suppkey as field_id, date '1996-03-11' + cast(s_suppkey % 30 as int) as sos, date '1996-06-01' + cast(s_suppkey % 25 as int) as eos from supplier)"
_dekad_sql = """d as (select l_suppkey as field_id, cast(l_shipdate as date) as day, l_quantity, l_discount from lineitem where year(l_shipdate) = 1996),
periods as (select field_id, cast(date_trunc('month', day) as date) + cast(10 * least(2, (day(day) - 1) // 10) as int) as period_start, avg(l_quantity) as rate, avg(l_discount) * 10 as coverage from d group by 1, 2),
ends as (select *, case when day(period_start) < 21 then period_start + 9 else last_day(period_start) end as period_end from periods)"""


_SEASON = ("date '1996-03-01'", "date '1996-08-31'")
_bounds_sql = {
    "central": ("sos", "eos"),
    "narrow": ("least(eos, sos + 10)", "greatest(least(eos, sos + 10), eos - 10)"),
    "wide": (f"greatest({_SEASON[0]}, sos - 10)", f"least({_SEASON[1]}, eos + 10)"),
}


def _variant_sql(name: str) -> str:
    start, end = _bounds_sql[name]
    d = f"greatest(0, date_diff('day', greatest({start}, period_start), least({end}, period_end)) + 1)"
    return f"sum(rate * {d}) as npp_{name}, sum({d}) filter (period_start is not null) as days_{name}, sum(coverage * {d}) as c_{name}, count(*) filter (period_start is not null and {d} > 0) as periods_{name}"


def _variant_out(n: str) -> str:
    start, end = _bounds_sql[n]
    return f"round(npp_{n}, 4) as npp_{n}, cast(days_{n} as bigint) as days_{n}, periods_{n}, round(coalesce(days_{n}, 0) / (date_diff('day', {start}, {end}) + 1), 6) as temporal_{n}, round(c_{n} / nullif(days_{n}, 0), 6) as spatial_{n}"


def _dekads(t: Tables, share: int = 10) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    start = F.date_add(F.trunc(day, "month"), (10 * F.least(F.lit(2), F.floor((F.dayofmonth(day) - 1) / 10))).cast("int"))
    p = t.lineitem.filter(F.year("l_shipdate") == 1996).groupBy(F.col("l_suppkey").alias("field_id"), start.alias("period_start")).agg(F.avg("l_quantity").alias("rate"), (F.avg("l_discount") * share).alias("coverage"))
    return p.withColumn("period_end", F.when(F.dayofmonth("period_start") < 21, F.date_add("period_start", 9)).otherwise(F.last_day("period_start")))


@query(f"with {_season_sql}, {_dekad_sql}, a as (select field_id, sos, eos, {', '.join(map(_variant_sql, _bounds_sql))} from seasons left join ends using (field_id) group by 1, 2, 3) select field_id, " + ", ".join(map(_variant_out, _bounds_sql)) + " from a")
def npp_integration(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    seasons = t.supplier.select(k.alias("field_id"), F.date_add(F.lit("1996-03-11").cast("date"), (k % 30).cast("int")).alias("sos"), F.date_add(F.lit("1996-06-01").cast("date"), (k % 25).cast("int")).alias("eos"), F.lit("1996-03-01").cast("date").alias("season_first"), F.lit("1996-08-31").cast("date").alias("season_last"))
    p = _dekads(t)
    out = yields.integrated(seasons, p, "field_id").drop("sos", "eos")
    npp = ["npp_central", "npp_narrow", "npp_wide"]
    return rounded(rounded(out, *(c for c in out.columns if c not in npp), places=4))


_optics_sql = f"""g as (select s_suppkey as field_id, w from supplier, ({_axis.format(*SEASON)})),
o as (select l_suppkey as field_id, cast(date_trunc('week', l_shipdate) as date) as w, avg(l_discount) filter (l_quantity > 20) as a, avg(l_tax) filter (l_quantity > 20) as b, avg(l_extendedprice) filter (l_quantity > 20) as c, avg(l_quantity) as r from lineitem group by 1, 2),
s as (select g.field_id, g.w, a, b, c, r from g left join o on o.field_id = g.field_id and o.w = g.w),
m as (select field_id, w, {", ".join(f"{_norm_sql(v)} as n{v}" for v in "abcr")} from s window f as (partition by field_id)),
x as (select field_id, w, nr, list_aggregate([na, nb, nc], 'median') as optical, round(coalesce(list_aggregate([na, nb, nc], 'median'), nr), 9) as signal from m)"""
_seasons_sql = f"""{_optics_sql}{_fill_sql.removeprefix(_norms_sql)}, {_bound_sql},
c as (select field_id, count(optical) as optical_valid_weeks, count(*) filter (optical is null and nr is not null) as sar_supported_weeks, count(*) as n_weeks from x group by 1),
u as (select *, {_SEASON[0]} as first_day, {_SEASON[1]} as last_day, peak_value - base as amplitude, optical_valid_weeks < 6 or valid_weeks < 6 as few from z join c using (field_id)),
u2 as (select *, not few and coalesce(amplitude < 0.2, true) as weak, valid_weeks > 0 and (coalesce(sos, first_day) > peak_week or coalesce(eos, last_day) < peak_week or coalesce(sos, first_day) >= coalesce(eos, last_day)) as wrong from u),
u3 as (select *, not wrong and sos is not null and eos is not null as both_found, least(0.95, 0.35 + 0.35 * least(1.0, optical_valid_weeks / greatest(1, n_weeks)) + 0.25 * least(1.0, amplitude)) as score from u2),
found as (select field_id, case when few or weak or wrong then first_day else coalesce(sos, first_day) end as sos, peak_week as peak_date, case when few or weak or wrong then last_day else coalesce(eos, last_day) end as eos,
  case when few or weak then 'full-season-fallback' when both_found then 'optical-rvi-relative-threshold-v1-matrix' else 'optical-rvi-relative-threshold-v1-matrix-one-boundary-fallback' end as method,
  round(case when few and valid_weeks = 0 then 0.0 when few then 0.15 when weak then 0.2 when both_found then score else score * 0.65 end, 4) as confidence,
  case when few and valid_weeks = 0 then 'no_weekly_signal' when few then 'insufficient_optical_weeks' when weak then 'weak_seasonal_amplitude' when both_found then 'detected' else 'partial_boundary_fallback' end as qa_status, optical_valid_weeks, sar_supported_weeks from u3)"""
_dates = ", ".join(f"cast({c} as varchar) as {c}" for c in ("sos", "peak_date", "eos"))


def _seasons(t: Tables) -> DataFrame:
    seen = F.col("l_quantity") > 20
    o = t.lineitem.groupBy(F.col("l_suppkey").alias("field_id"), monday(F.col("l_shipdate")).alias("w")).agg(
        F.avg(F.when(seen, F.col("l_discount"))).alias("a"), F.avg(F.when(seen, F.col("l_tax"))).alias("b"), F.avg(F.when(seen, F.col("l_extendedprice"))).alias("c"), F.avg("l_quantity").alias("r")
    )
    first, last = (F.lit(d).cast("date") for d in ("1996-03-01", "1996-08-31"))
    return timeseries.seasons(_grid(t, *SEASON).join(o, ["field_id", "w"], "left"), "field_id", "w", ["a", "b", "c"], "r", first, last)


@query(f"with {_seasons_sql} select field_id, {_dates}, method, confidence, qa_status, optical_valid_weeks, sar_supported_weeks from found")
def season_phenology(t: Tables) -> DataFrame:
    return _seasons(t).withColumns({c: F.col(c).cast("string") for c in ("sos", "peak_date", "eos")})


_crop_rows = ", ".join("('" + c + "', " + ", ".join(str(x) for f in yields.FACTORS for x in v[f]) + ")" for c, v in yields.CROPS.items())
_crop_sql = f"""crops(crop, {", ".join(f"{f}_{x}" for f in yields.FACTORS for x in yields.LEVELS)}) as (values {_crop_rows}),
f as (select c_custkey, c_nationkey, case c_custkey % 4 when 0 then 'maize' when 1 then 'beans' when 2 then 'potatoes' else 'tea' end as crop, c_acctbal, case when c_acctbal > 0 then c_acctbal / 1000 end as area_ha, c_mktsegment from customer),
y as (select f.*, {", ".join(f"abs(c_acctbal) * 0.022222 * fc_{x} * aot_{x} * hi_{x} / (1 - moisture_{x}) as {x}" for x in yields.LEVELS)} from f left join crops using (crop))"""


def _yields(t: Tables) -> DataFrame:
    k = F.col("c_custkey") % 4
    f = t.customer.select("c_custkey", "c_nationkey", F.when(k == 0, "maize").when(k == 1, "beans").when(k == 2, "potatoes").otherwise("tea").alias("crop"), "c_acctbal", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / 1000).alias("area_ha"), "c_mktsegment")
    joined = f.join(F.broadcast(yields.crop_factors(t.spark)), "crop", "left")  # a row for each crop
    biomass = F.abs("c_acctbal") * yields.NPP_TO_BIOMASS
    return joined.select(*f.columns, *(yields.crop_yield(biomass, level).alias(level) for level in yields.LEVELS))


@query(f"with {_crop_sql} select c_custkey, crop, round(low, 6) as low, round(central, 6) as central, round(high, 6) as high, round(central * area_ha, 6) as production from y")
def crop_yield(t: Tables) -> DataFrame:
    return rounded(_yields(t).select("c_custkey", "crop", "low", "central", "high", (F.col("central") * F.col("area_ha")).alias("production")))


@query(f"with {_crop_sql} select c_custkey, concat_ws(';', case when central is null then 'unsupported_crop' end, case when area_ha is null then 'no_area' end, case when central > 20 then 'yield_high' end, case when c_mktsegment = 'BUILDING' then 'coverage_low' end) as qa_reasons, case when central is null or area_ha is null then 'not_available' when c_mktsegment = 'BUILDING' then 'review' else 'ok' end as status from y")
def yield_flags(t: Tables) -> DataFrame:
    none, area, low = F.col("central").isNull(), F.col("area_ha").isNull(), F.col("c_mktsegment") == "BUILDING"
    reasons = yields.joined_reasons({"unsupported_crop": none, "no_area": area, "yield_high": F.col("central") > 20, "coverage_low": low})
    return _yields(t).select("c_custkey", reasons.alias("qa_reasons"), F.when(none | area, "not_available").when(low, "review").otherwise("ok").alias("status"))


@query(f"with {_crop_sql} select nullif(c_nationkey, 3) as county, crop, count(*) as n, count(central) as n_yield, round(avg(central), 6) as mean, round(median(central), 6) as median, round(min(central), 6) as least, round(max(central), 6) as most, round(sum(central * area_ha), 4) as production from y group by 1, 2")
def yield_summary(t: Tables) -> DataFrame:
    y = _yields(t).groupBy(F.nullif("c_nationkey", F.lit(3)).alias("county"), "crop").agg(F.count("*").alias("n"), F.count("central").alias("n_yield"), F.avg("central").alias("mean"), F.median("central").alias("median"), F.min("central").alias("least"), F.max("central").alias("most"), F.round(F.sum(F.col("central") * F.col("area_ha")), 4).alias("production"))
    return rounded(y)


_levels = ", ".join(f"round(case when eligible then tbp * fc_{x} * aot_{x} * hi_{x} / (1 - moisture_{x}) end, 4) as yield_{x}, round(case when eligible then tbp * fc_{x} * aot_{x} * hi_{x} / (1 - moisture_{x}) * area_ha end, 3) as production_{x}" for x in yields.LEVELS)
_moved = ", ".join(f"round(case when eligible then npp_{v} * 0.022222 * fc_central * aot_central * hi_central / (1 - moisture_central) end, 4) as yield_{v}" for v in ("narrow", "wide"))
_yield_sql = f"""{_seasons_sql}, {_dekad_sql.replace("10 as coverage", "18 as coverage")}, sums as (select field_id, sos, eos, {", ".join(map(_variant_sql, _bounds_sql))} from found left join ends using (field_id) group by 1, 2, 3),
metrics as (select field_id, npp_central, npp_narrow, npp_wide, coalesce(days_central, 0) / (date_diff('day', sos, eos) + 1) as temporal, c_central / nullif(days_central, 0) as spatial from sums),
crops(crop, {", ".join(f"{f}_{x}" for f in yields.FACTORS for x in yields.LEVELS)}) as (values {{rows}}),
plots as (select s_suppkey as field_id, s_nationkey as county, s_suppkey % 9 + 0.5 as area_ha, case s_suppkey % 4 when 0 then 'yes' when 1 then 'no' when 2 then 'unknown' end as intercrop, case s_suppkey % 3 when 0 then 'Sweet_Corn' when 1 then 'bean-plot' end as survey from supplier),
labels_ as (select s_suppkey as field_id, case s_suppkey % 5 when 0 then 'Maize' when 1 then 'beans' when 2 then 'POTATOES' when 3 then 'tea' end as label, case when s_suppkey % 13 > 0 then (s_suppkey % 10) / 10.0 end as sure, case when s_suppkey % 11 = 0 then 'provisional' else 'final' end as status from supplier where s_suppkey % 17 > 0),
joined as (select plots.*, lower(coalesce(label, 'unclassified')) as crop, sure, status, npp_central, npp_narrow, npp_wide, npp_central * 0.022222 as tbp, temporal, spatial, coalesce(intercrop, 'unknown') as mix from plots left join labels_ using (field_id) left join metrics using (field_id)),
rated as (select joined.*, crops.* exclude (crop), fc_central is not null as supported, coalesce(status = 'final', false) as final, coalesce(sure >= 0.2, false) as confident, mix = 'no' and coalesce(not list_has_any(string_split_regex(translate(lower(trim(survey)), '_-', '  '), '\\s+'), case crop when 'maize' then ['maize', 'corn'] when 'beans' then ['bean', 'beans'] when 'potatoes' then ['potato', 'potatoes'] else [crop] end), false) as mismatch, coalesce(temporal >= 0.8, false) as long_enough, coalesce(spatial >= 0.8, false) as wide_enough, npp_central is not null as known from joined left join crops using (crop)),
judged as (select *, supported and final and confident and mix <> 'yes' and not mismatch and long_enough and wide_enough and known as eligible from rated)"""
_yield_sql = _yield_sql.replace("{rows}", _crop_rows)
_flags = {
    "unsupported_or_unclassified_crop": "not supported", "seasonal_status_not_final": "not final", "crop_confidence_below_threshold": "not confident", "mixed_crop_biomass_only": "mix = 'yes'", "survey_crop_mismatch": "mismatch",
    "low_npp_temporal_coverage": "not long_enough and supported and final", "low_npp_spatial_coverage": "not wide_enough and supported and final", "missing_npp": "not known and supported and final", "intercrop_unknown": "eligible and mix = 'unknown'",
}
_flag_sql = ", ".join(f"case when {c} then '{name}' end" for name, c in _flags.items())


def _season_yield(t: Tables) -> DataFrame:
    """Labels and survey answers stand in for what a model and a survey say of each field."""
    k = F.col("s_suppkey")
    fields = t.supplier.select(k.alias("field_id"), F.col("s_nationkey").alias("county"), (k % 9 + 0.5).alias("area_ha"), F.when(k % 4 == 0, "yes").when(k % 4 == 1, "no").when(k % 4 == 2, "unknown").alias("intercrop_status"), F.when(k % 3 == 0, "Sweet_Corn").when(k % 3 == 1, "bean-plot").alias("survey_crop_text"))
    label = F.when(k % 5 == 0, "Maize").when(k % 5 == 1, "beans").when(k % 5 == 2, "POTATOES").when(k % 5 == 3, "tea")
    labels = t.supplier.filter(k % 17 > 0).select(k.alias("field_id"), F.col("s_nationkey").alias("county"), label.alias("seasonal_label"), F.when(k % 13 > 0, (k % 10) / 10.0).alias("seasonal_confidence"), F.when(k % 11 == 0, "provisional").otherwise("final").alias("status"))
    found = _seasons(t)
    first, last = (F.lit(d).cast("date") for d in ("1996-03-01", "1996-08-31"))
    periods = _dekads(t, 18)
    metrics = yields.integrated(found.select("field_id", "sos", "eos", first.alias("season_first"), last.alias("season_last")), periods, "field_id")
    return yields.season_yield(fields, labels, found, metrics, yields.crop_factors(t.spark), confidence=0.2, places=None)  # its SQL compares the doubles as they are


@query(f"with {_yield_sql} select field_id, county, crop, {_levels}, {_moved}, case when eligible and mix = 'unknown' then 'calculated_unvalidated_intercrop_unknown' when eligible then 'calculated_unvalidated' else 'not_calculated' end as yield_status, concat_ws(';', {_flag_sql}) as qa_flags from judged")
def season_yield(t: Tables) -> DataFrame:
    y = _season_yield(t)
    amounts = [c for x in yields.LEVELS for c in (f"yield_{x}", f"production_{x}")] + ["yield_narrow", "yield_wide"]
    return y.select("field_id", "county", F.when(F.col("crop_label") == "Unclassified", "unclassified").otherwise(F.col("crop_label")).alias("crop"), *(nearest(F.col(c), 3 if c.startswith("production") else 4).alias(c) for c in amounts), "yield_status", "qa_flags")


@query(f"with {_side.format('O').join(['a as (', ')'])} select l.c_nationkey as county, r.field_id, count(*) as n_weeks from a r join (select s_suppkey, s_nationkey as c_nationkey from supplier where lower(substr(s_name, -1)) in ('1', '3', '5', '7')) l on l.s_suppkey = r.field_id group by 1, 2")
def predictions_join(t: Tables) -> DataFrame:
    fields = t.supplier.filter(F.lower(F.substring("s_name", -1, 1)).isin("1", "3", "5", "7")).select(F.col("s_suppkey").alias("field_id"), F.col("s_nationkey").alias("county"))
    return _sensor(t, "O").join(fields, "field_id").groupBy("county", "field_id").agg(F.count("*").alias("n_weeks"))


@query("with f as (select s_suppkey as field_id, count(*) over (partition by s_nationkey) as n_sharing from supplier) select field_id, n_sharing from f")
def shared_cell_counts(t: Tables) -> DataFrame:
    n = t.supplier.groupBy("s_nationkey").agg(F.count("*").alias("n_sharing"))
    return t.supplier.join(n, "s_nationkey").select(F.col("s_suppkey").alias("field_id"), "n_sharing")


@query(None)
def scorer_plugin(t: Tables) -> DataFrame:
    """A stand-in for a model that needs each field's whole history."""

    def score(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("w")
        trend = group["v"].rolling(3, min_periods=1).mean()
        return pd.DataFrame({"field_id": group["field_id"], "week_start": group["w"].astype(str), "label": ["high" if x > 0.05 else "low" for x in trend], "confidence": trend})

    return scored(_sensor(t, "O"), "field_id", score, "field_id long, week_start string, label string, confidence double")
