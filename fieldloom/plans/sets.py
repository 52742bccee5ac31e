"""Loads, audits, set comparisons and text rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr
from ..functions.calendar import monday
from ..operators import quality, yields
from ..sources import store
from ..streaming.weekly import weekly
from .fields import rounded
from .registry import Tables, query


@query("with s as (select o_custkey, cast(o_orderdate as date) as d, min(o_orderkey) as o_orderkey from orders where trim(o_orderpriority) <> '' group by 1, 2) select s.o_custkey, cast(d as varchar) as d, s.o_orderkey from s where not exists (select 1 from orders t where t.o_orderstatus = 'F' and t.o_custkey = s.o_custkey and cast(t.o_orderdate as date) = s.d)")
def staging_upsert(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("d"), "o_orderkey", "o_orderpriority", "o_orderstatus")
    clean = store.staged(rows, ["o_custkey", "d"], ["o_orderpriority"], F.col("o_orderkey"))
    return store.absent(clean, rows.filter("o_orderstatus = 'F'"), ["o_custkey", "d"]).select("o_custkey", F.col("d").cast("string").alias("d"), "o_orderkey")


@query("select year(l_shipdate) as year, count(*) as n, count(distinct l_suppkey) as n_fields, cast(cast(min(l_shipdate) as date) as varchar) as first_day, cast(cast(max(l_shipdate) as date) as varchar) as last_day from lineitem group by 1")
def year_load_summary(t: Tables) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    return t.lineitem.groupBy(F.year("l_shipdate").cast("long").alias("year")).agg(F.count("*").alias("n"), F.count_distinct("l_suppkey").alias("n_fields"), F.min(day).cast("string").alias("first_day"), F.max(day).cast("string").alias("last_day"))


@query("select distinct o_custkey, year(o_orderdate) as y from orders a where not exists (select 1 from orders b where b.o_orderstatus = 'F' and a.o_custkey = b.o_custkey and year(a.o_orderdate) = year(b.o_orderdate))")
def checkpoint_resume(t: Tables) -> DataFrame:
    tasks = t.orders.select("o_custkey", F.year("o_orderdate").cast("long").alias("y"), F.when(F.col("o_orderstatus") == "F", "done").otherwise("open").alias("status"))
    return store.pending(tasks.select("o_custkey", "y").distinct(), tasks, ["o_custkey", "y"])


_rules = {"bad_quantity": "l_quantity > 49", "bad_discount": "l_discount < 0 or l_discount > 0.09", "tax_over_discount": "l_tax > l_discount", "null_ratio": "l_tax / nullif(l_discount, 0) is null"}


@query("select year(l_shipdate) as year, count(*) as n_rows, " + ", ".join(f"count(*) filter ({v}) as {k}" for k, v in _rules.items()) + " from lineitem group by 1")
def validation_counts(t: Tables) -> DataFrame:
    return quality.violations(t.lineitem.withColumn("year", F.year("l_shipdate").cast("long")), {k: F.expr(v) for k, v in _rules.items()}, ["year"])


@query("select l_orderkey, count(*) as n from lineitem group by 1 having count(*) <> 4")
def bad_group_counts(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n")).filter("n <> 4")


@query("""with x as (select l_suppkey, l_discount + 0.01 as vh, case when l_linenumber = 3 then null else l_tax + 0.02 end as vv from lineitem),
i as (select *, 4 * vh / (vv + vh) as rvi, (vv - vh) / (vv + vh) as rcspr, vh / vv as p from x)
select count(*) as n_rows, count(*) filter (p < 0) as negative, count(*) filter (rvi < 0 or rvi > 4) as rvi_domain, count(*) filter (abs(rvi - 2 * (1 - rcspr)) > 0.00002) as identity, count(*) filter (vv is null and rvi is not null) as orphans, count(*) filter (p > 1) as vv_below_vh from i""")
def s1_semantic_checks(t: Tables) -> DataFrame:
    x = t.lineitem.select((F.col("l_discount") + 0.01).alias("vh"), F.when(F.col("l_linenumber") != 3, F.col("l_tax") + 0.02).alias("vv"))
    i = x.select("*", *(v.alias(k) for k, v in expr.radar_indices(F.col("vv"), F.col("vh")).items()))
    return quality.violations(i, {"negative": F.expr("p_ratio < 0"), "rvi_domain": F.expr("rvi < 0 or rvi > 4"), "identity": F.expr("abs(rvi - 2 * (1 - rcspr)) > 0.00002"), "orphans": F.expr("vv is null and rvi is not null"), "vv_below_vh": F.expr("p_ratio > 1")})


@query("with n as (select count(*) filter (l_discount = 0) as a, count(*) filter (l_tax = 0) as b, count(*) filter (l_quantity > 40) as c, 0 as d from lineitem) select 'discount' as column_name, a as n_null from n union all select 'tax', b from n union all select 'quantity', c from n union all select 'price', d from n")
def null_profile(t: Tables) -> DataFrame:
    x = t.lineitem.select(F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("discount"), F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("tax"), F.when(F.col("l_quantity") <= 40, F.col("l_quantity")).alias("quantity"), F.col("l_extendedprice").alias("price"))
    return quality.null_profile(x, x.columns)


@query("with w as (select l_linestatus as sensor, min(date_trunc('week', l_shipdate))::date as a, max(date_trunc('week', l_shipdate))::date as z, count(*) filter (dayofweek(l_shipdate) <> 1) as off_monday from lineitem group by 1) select sensor, cast(a as varchar) as first_week, cast(z as varchar) as last_week, off_monday, date_diff('day', a, z) // 7 + 1 as weeks from w")
def source_facts(t: Tables) -> DataFrame:
    w = t.lineitem.groupBy(F.col("l_linestatus").alias("sensor")).agg(F.min(monday(F.col("l_shipdate"))).alias("a"), F.max(monday(F.col("l_shipdate"))).alias("z"), F.count_if(F.weekday("l_shipdate") != 0).alias("off_monday"))
    return w.select("sensor", F.col("a").cast("string").alias("first_week"), F.col("z").cast("string").alias("last_week"), "off_monday", (F.floor(F.datediff("z", "a") / 7) + 1).cast("long").alias("weeks"))


@query("select case when grouping(l_returnflag) = 1 then 'all' else l_returnflag end as region, case when grouping(year(l_shipdate)) = 1 then -1 else year(l_shipdate) end as year, count(*) as n, round(avg(l_quantity), 6) as mean_quantity from lineitem group by grouping sets ((), (l_returnflag, year(l_shipdate)))")
def semantic_grouping_sets(t: Tables) -> DataFrame:
    x = t.lineitem.select("l_returnflag", F.year("l_shipdate").cast("long").alias("y"), "l_quantity")
    g = x.groupingSets([[], [F.col("l_returnflag"), F.col("y")]], F.col("l_returnflag"), F.col("y")).agg(F.count("*").alias("n"), F.round(F.avg("l_quantity"), 6).alias("mean_quantity"), F.grouping("l_returnflag").alias("g"))
    return g.select(F.when(F.col("g") == 1, "all").otherwise(F.col("l_returnflag")).alias("region"), F.when(F.col("g") == 1, F.lit(-1).cast("long")).otherwise(F.col("y")).alias("year"), "n", "mean_quantity")


@query("select cast(date_trunc('week', l_shipdate)::date as varchar) as week, l_linestatus, count(*) as n, count(nullif(l_discount, 0)) as n_valid, count(*) filter (l_quantity > 25) as n_large, round(avg(l_discount), 6) as mean_discount from lineitem group by 1, 2")
def weekly_db_audit(t: Tables) -> DataFrame:
    return rounded(t.lineitem.groupBy(monday(F.col("l_shipdate")).cast("string").alias("week"), "l_linestatus").agg(F.count("*").alias("n"), F.count_if(F.expr("l_discount <> 0")).alias("n_valid"), F.count_if(F.expr("l_quantity > 25")).alias("n_large"), F.avg("l_discount").alias("mean_discount")))


_versions = "select l_suppkey, cast(date_trunc('week', l_shipdate) as date) as w, avg(l_discount) filter (l_linestatus = 'O') as a, avg(l_discount) filter (l_linestatus = 'F') as b from lineitem group by 1, 2"


@query(f"with v as ({_versions}) select count(*) as n, round(avg(abs(a - b)), 6) as mae, round(max(abs(a - b)), 6) as worst from v where a is not null and b is not null")
def version_comparison(t: Tables) -> DataFrame:
    both = t.lineitem.groupBy("l_suppkey", monday(F.col("l_shipdate")).alias("w"), "l_linestatus").agg(F.avg("l_discount").alias("v"))
    a = both.filter("l_linestatus = 'O'").select("l_suppkey", "w", F.col("v").alias("a"))
    b = both.filter("l_linestatus = 'F'").select("l_suppkey", "w", F.col("v").alias("b"))
    return rounded(a.join(b, ["l_suppkey", "w"]).agg(F.count("*").alias("n"), F.avg(F.abs(F.col("a") - F.col("b"))).alias("mae"), F.max(F.abs(F.col("a") - F.col("b"))).alias("worst")))


@query("select l_suppkey, count(*) as n, coalesce(count(*) filter (l_quantity > 45), 0) as n_quantity, count(*) filter (l_discount > 0.08) as n_discount from lineitem where l_quantity > 45 or l_quantity < 1 or l_discount > 0.08 or l_discount < 0 group by 1")
def out_of_range_audit(t: Tables) -> DataFrame:
    bad = t.lineitem.select("l_suppkey", "l_quantity", "l_discount").filter(expr.any_outside({"l_quantity": (1, 45), "l_discount": (0, 0.08)}))
    return bad.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.count_if(F.expr("l_quantity > 45")).alias("n_quantity"), F.count_if(F.expr("l_discount > 0.08")).alias("n_discount"))


@query("select nullif(o_orderstatus, 'P') as reason, count(*) as n from orders group by 1")
def reason_counts(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.nullif("o_orderstatus", F.lit("P")).alias("reason")).agg(F.count("*").alias("n"))


@query("select o_custkey as id from orders where o_orderstatus = 'F' union select c_custkey from customer where c_acctbal < 0")
def id_union(t: Tables) -> DataFrame:
    return t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id")).union(t.customer.filter("c_acctbal < 0").select("c_custkey")).distinct()


@query("select o_custkey as id from orders where o_orderstatus = 'F' intersect select c_custkey from customer where c_acctbal < 0")
def id_intersect(t: Tables) -> DataFrame:
    return t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id")).intersect(t.customer.filter("c_acctbal < 0").select("c_custkey"))


@query("select c_custkey as id from customer except select o_custkey from orders where o_orderstatus = 'P'")
def id_except(t: Tables) -> DataFrame:
    return quality.missing(t.customer.select(F.col("c_custkey").alias("id")), t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id")), ["id"])


@query("select cast(c_name as varchar) as name, cast(c_nationkey as bigint) as nation, cast(c_acctbal as double) as balance, cast(null as double) as size from customer union all select s_name, s_nationkey, s_acctbal, null from supplier union all select p_name, null, null, p_size from part")
def schema_union_merge(t: Tables) -> DataFrame:
    parts = [t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")), t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")), t.part.select(F.col("p_name").alias("name"), F.col("p_size").alias("size"))]
    return store.standardised(parts, ["name"], ["nation"])


@query(None)
def deterministic_sample(t: Tables) -> DataFrame:
    """Ten of the ids that both sensors have, by a seeded hash: a sampling operator."""
    both = t.lineitem.filter("l_linestatus = 'O'").select("l_suppkey").intersect(t.lineitem.filter("l_linestatus = 'F'").select("l_suppkey"))
    return both.orderBy(F.xxhash64("l_suppkey", F.lit(42))).limit(10)


@query("select p_partkey, regexp_replace(lower(coalesce(p_name, '')), '[^a-z0-9]+', '', 'g') as norm, case when regexp_matches(p_type, '^[A-Z]') then 'upper' else 'other' end as kind from part")
def name_normalize(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.regexp_replace(F.lower(F.coalesce("p_name", F.lit(""))), "[^a-z0-9]+", "").alias("norm"), F.when(F.col("p_type").rlike("^[A-Z]"), "upper").otherwise("other").alias("kind"))


_file = "r{}_s2_{}_{}.tif"


@query("select o_orderkey, regexp_extract(f, '^(r[0-9]+)_s2_', 1) as region, regexp_extract(f, '_([0-9]{4}-[0-9]{2}-[0-9]{2})_', 1) as start_date, regexp_matches(f, '^(r[1-4])_') as known from (select o_orderkey, 'r' || (o_custkey % 9) || '_s2_' || strftime(o_orderdate, '%Y-%m-%d') || '_w.tif' as f from orders)")
def filename_parse(t: Tables) -> DataFrame:
    f = t.orders.select("o_orderkey", F.concat(F.lit("r"), (F.col("o_custkey") % 9).cast("string"), F.lit("_s2_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("_w.tif")).alias("f"))
    return f.select("o_orderkey", F.regexp_extract("f", r"^(r[0-9]+)_s2_", 1).alias("region"), F.regexp_extract("f", r"_([0-9]{4}-[0-9]{2}-[0-9]{2})_", 1).alias("start_date"), F.col("f").rlike(r"^(r[1-4])_").alias("known"))


@query("select c_custkey, string_split(n, '_')[1] as platform, string_split(n, '_')[2] as sensor_mode, left(string_split(n, '_')[3], 8) as acq from (select c_custkey, 'S1' || left(c_mktsegment, 1) || '_IW_' || lpad(cast(c_custkey as varchar), 8, '0') || 'T000000_x' as n from customer)")
def safe_name_parse(t: Tables) -> DataFrame:
    n = F.concat(F.lit("S1"), F.substring("c_mktsegment", 1, 1), F.lit("_IW_"), F.lpad(F.col("c_custkey").cast("string"), 8, "0"), F.lit("T000000_x"))
    part = F.split(n, "_")
    return t.customer.select("c_custkey", part[0].alias("platform"), part[1].alias("sensor_mode"), F.substring(part[2], 1, 8).alias("acq"))


@query("""with s as (select p_partkey, case p_size % 4 when 0 then 'Mono_culture' when 1 then 'mixed_cropping' when 2 then '' else 'other' end as p, case when p_size % 7 = 0 then 'maize beans' else ' ' end as m, case when p_size % 5 = 0 then ' maize ' end as o from part)
select p_partkey, case when trim(m) <> '' or regexp_matches(lower(p), 'mix|intercrop') then 'yes' when trim(o) <> '' or regexp_matches(lower(p), 'mono|single') then 'no' else 'unknown' end as intercrop, coalesce(nullif(trim(m), ''), trim(o)) as crop_text from s""")
def intercrop_class(t: Tables) -> DataFrame:
    k = F.col("p_size") % 4
    pattern = F.when(k == 0, "Mono_culture").when(k == 1, "mixed_cropping").when(k == 2, "").otherwise("other")
    s = t.part.select("p_partkey", pattern.alias("cropping_pattern_2"), F.when(F.col("p_size") % 7 == 0, "maize beans").otherwise(" ").alias("croptype_mixed_2"), F.when(F.col("p_size") % 5 == 0, " maize ").alias("croptype_mono_2"))
    kind, text = yields.survey_answers(s, "lr")
    return s.select("p_partkey", kind.alias("intercrop"), text.alias("crop_text"))


@query("select p_partkey, case when trim(s) <> '' then len(list_intersect(string_split_regex(translate(lower(trim(s)), '_-', '  '), '\\s+'), ['maize', 'corn'])) > 0 end as matches from (select p_partkey, case p_size % 3 when 0 then 'Sweet_Corn' when 1 then 'irish-potato' else null end as s from part)")
def survey_match(t: Tables) -> DataFrame:
    k = F.col("p_size") % 3
    return t.part.select("p_partkey", yields.survey_match(F.when(k == 0, "Sweet_Corn").when(k == 1, "irish-potato"), ["maize", "corn"]).alias("matches"))


@query("select cast(date_trunc('week', ts)::date as varchar) as week_start, event_type, count(*) as n_events, round(sum(value), 4) as total from events group by 1, 2")
def events_weekly(t: Tables) -> DataFrame:
    return weekly(t.events).select(F.col("week_start").cast("string").alias("week_start"), "event_type", "n_events", F.round("total", 4).alias("total"))


@query("select o_orderstatus, coalesce(nullif(case when upper(o_orderpriority) = '1-URGENT' or contains(upper(o_orderpriority), 'HIGH') then 'fast' else '' end, ''), 'slow') as kind, count(*) as n from orders group by 1, 2")
def contains_filter(t: Tables) -> DataFrame:
    p = F.upper("o_orderpriority")
    return t.orders.groupBy("o_orderstatus", F.when((p == "1-URGENT") | F.contains(p, F.lit("HIGH")), "fast").otherwise("slow").alias("kind")).agg(F.count("*").alias("n"))
