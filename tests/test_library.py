"""Golden values, plans, sources and the stream."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fieldloom.functions import calendar, expr, geometry
from fieldloom.operators import quality, timeseries, yields, zonal
from fieldloom.operators.scenes import first_of, greedy_cover
from fieldloom.plans import registry
from fieldloom.sources import store
from fieldloom.streaming.weekly import weekly


def test_seasons_and_dekads(spark):
    t = spark.createDataFrame([("2023_lr",), ("2023_sr",)], "code string")
    a, b = calendar.season_bounds(F.col("code"))
    assert [tuple(r) for r in t.select(a.cast("string"), b.cast("string")).collect()] == [("2023-03-01", "2023-08-31"), ("2023-10-01", "2024-02-29")]
    march = spark.createDataFrame([(dt.date(2023, 3, 1), dt.date(2023, 3, 31))], "a date, b date")
    assert [r["days"] for r in calendar.dekads(march, "a", "b").orderBy("period_start").collect()] == [10, 10, 11]


def test_maize(spark):
    r = yields.crop_factors(spark).filter("crop = 'maize'").select(*(yields.crop_yield(F.lit(300 * yields.NPP_TO_BIOMASS), x).alias(x) for x in ("low", "central", "high"))).first()
    assert [round(r[x], 6) for x in ("low", "central", "high")] == [4.159958, 4.457098, 4.771717]
    potatoes = yields.crop_factors(spark).filter("crop = 'potatoes'").select(*(yields.crop_yield(F.lit(2.1), x).alias(x) for x in yields.LEVELS)).first()
    assert [round(x, 6) for x in potatoes] == [5.88, 7.9, 8.925]


def test_integration_of_part_periods(spark):
    d = dt.date
    seasons = spark.createDataFrame([(1, d(2023, 3, 5), d(2023, 3, 25), d(2023, 3, 1), d(2023, 8, 31))], "f long, sos date, eos date, season_first date, season_last date")
    periods = spark.createDataFrame([(1, d(2023, 3, 1), d(2023, 3, 10), 1.0, 1.0), (1, d(2023, 3, 11), d(2023, 3, 20), 2.0, 1.0), (1, d(2023, 3, 21), d(2023, 3, 31), 3.0, 1.0)], "f long, period_start date, period_end date, rate double, coverage double")
    r = yields.integrated(seasons, periods, "f").first()
    assert (r["npp_central"], r["days_central"], r["temporal_central"], r["periods_central"]) == (41.0, 21, 1.0, 3)
    assert (r["npp_narrow"], r["days_narrow"], r["temporal_narrow"], r["periods_narrow"]) == (2.0, 1, 1.0, 1)  # one day is left
    assert (r["npp_wide"], r["days_wide"], r["periods_wide"]) == (10 + 20 + 33.0, 31, 3)  # no further back than the season


def test_radar_remap(spark):
    rows = [(0.02, 0.10), (0.12, float("nan")), (float("nan"), 0.09), (0.03, 0.15)]
    vv, vh = expr.remapped(F.col("a"), F.col("b"))
    t = spark.createDataFrame(rows, "a double, b double").select(vv.alias("vv"), vh.alias("vh"))
    r = t.agg(F.count("vv"), F.avg("vv"), F.count("vh"), F.avg("vh"), F.avg(expr.radar_indices(F.col("vv"), F.col("vh"))["p_ratio"])).first()
    assert r[0] == 4 and r[2] == 2 and [round(x, 6) for x in (r[1], r[3], r[4])] == [0.115, 0.025, 0.2]


def test_radar_validity(spark):
    rows = [(0.0, 0.1), (-1.0, 0.2), (0.02, 0.0), (0.02, 0.1), (None, -0.1)]
    vv, vh = expr.remapped(F.col("a"), F.col("b"))
    got = [tuple(r) for r in spark.createDataFrame(rows, "a double, b double").coalesce(1).select(vv, vh).collect()]
    assert got == [(0.1, None), (0.2, None), (0.02, None), (0.1, 0.02), (None, None)]


def test_polarisation_classes(spark):
    rows = [(0, 0, 0, None, None), (5, 0, 0, None, None), (0, 5, 0, None, None), (2000, 2000, 999, 2.0, 0.9), (2000, 2000, 1000, float("nan"), 0.9), (2000, 2000, 1000, 1.25, 0.70), (2000, 2000, 1000, 0.80, 0.30), (2000, 2000, 1000, 1.25, 0.69), (2000, 2000, 1000, 1.0, 0.5)]
    t = spark.createDataFrame(rows, "a long, b long, p long, r double, g double").coalesce(1)
    got = [r[0] for r in t.select(quality.polarisation(*(F.col(c) for c in "abprg"))).collect()]
    assert got == ["both_empty", "band1_only", "band2_only", "insufficient_paired_samples", "insufficient_paired_samples", "band1_likely_vh_band2_likely_vv", "band1_likely_vv_band2_likely_vh", "ambiguous", "ambiguous"]


def test_season_pairs_stay_on_their_side_of_the_peak(spark):
    values = [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.9, 0.2, 0.2, 0.0, 0.0]  # only the peak itself is above up to it
    t = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "f long, w long, v double")
    r = timeseries.boundaries(t, "f", "w", "v").first()
    assert (r["peak_week"], r["sos"], r["eos"], r["qa_status"]) == (6, None, 8, "one_boundary")  # at the threshold counts as below


def test_phenology_curve(spark):
    ndvi = [0.10, 0.11, 0.13, 0.18, 0.30, 0.48, 0.62, 0.72, 0.78, 0.82, 0.84, 0.82, 0.79, 0.72, 0.62, 0.48, 0.34, 0.22, 0.15, 0.12, 0.10, 0.09, 0.09, 0.08, 0.08]
    rows = [(1, dt.date(2023, 3, 6) + dt.timedelta(7 * i), v) for i, v in enumerate(ndvi)] + [(2, dt.date(2023, 3, 6) + dt.timedelta(7 * i), None) for i in range(25)]
    t = timeseries.normalised(spark.createDataFrame(rows, "f long, w date, v double"), "f", "v", "n")
    got = {r["f"]: r for r in timeseries.boundaries(t, "f", "w", "n").collect()}
    assert got[1]["qa_status"] == "detected" and got[1]["sos"] < got[1]["peak_week"] < got[1]["eos"]
    assert got[2]["qa_status"] == "no_data"


@pytest.mark.parametrize("values, want", [([None, None, 1.0], [1.0, 1.0, 1.0]), ([None, None, None, 1.0], [None, None, None, 1.0]), ([1.0, None, None, 4.0], [1.0, 2.0, 3.0, 4.0]), ([1.0, None, None, None, 5.0], [1.0, None, None, None, 5.0]), ([2.0, None, None, None, None], [2.0, 2.0, 2.0, None, None])])
def test_gaps(spark, values, want):
    t = spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], "f long, w long, v double")
    assert [r["x"] for r in timeseries.filled(t, "f", "w", "v", "x").orderBy("w").collect()] == want


def test_polygon(spark):
    ring = F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 20), (20, 20), (20, 40), (0, 40))))
    r = spark.range(1).select(geometry.inside(ring, F.lit(5.0), F.lit(35.0)), geometry.boundary_distance(ring, F.lit(5.0), F.lit(35.0)), geometry.ring_area(ring), geometry.inside(ring, F.lit(25.0), F.lit(35.0))).first()
    assert tuple(r) == (True, 5.0, 400.0, False)


def test_missing_values(spark):
    t = spark.createDataFrame([(1, 1.0), (1, float("nan")), (1, None), (1, float("inf")), (1, 3.0)], "f long, b double")
    r = zonal.zonal_stats(t, ["f"], ["b"]).first()
    assert (r["b_mean"], r["b_count"]) == (2.0, 2)


def test_store(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", 2020), (2, "b", 2021)], "id long, v string, year int")
    path = f"{tmp_path}/t"
    store.append_absent(rows, path, ["id"], ["year"])
    store.append_absent(rows.union(spark.createDataFrame([(3, "c", 2021)], rows.schema)), path, ["id"], ["year"])
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    versions = store.Versions(spark, f"{tmp_path}/v", "current_rows")
    versions.swap(versions.write(rows, "First run"), 2)
    assert spark.table("current_rows").count() == 2
    with pytest.raises(ValueError):
        versions.swap(versions.write(rows, "Second run"), 3)
    store.write_csv(rows, f"{tmp_path}/csv", single=True)
    assert store.read_csv(spark, f"{tmp_path}/csv", rows.schema).count() == 2
    with pytest.raises(ValueError):
        store.schema_of([("x", "money")])
    with pytest.raises(ValueError):
        quality.unique_or_raise(rows.union(rows), ["id"])


def test_stream_is_as_the_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(f"{tmp_path}/events")
    stream = weekly(spark.readStream.schema(events.schema).parquet(f"{tmp_path}/events"), "1 day")
    q = stream.writeStream.format("memory").queryName("weekly_rows").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    key = lambda r: (r["week_start"], r["event_type"], r["n_events"])
    assert sorted(map(key, spark.table("weekly_rows").collect())) == sorted(map(key, weekly(events).collect()))


def test_plans(spark):
    folder = "/root/testdata/sf0.001"
    for name in ("weekly_grid_wide", "npp_integration", "zonal_stats_part", "phenology"):
        plan = registry.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "Python" not in plan
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)
    plan = registry.QUERIES["phenology"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lineitem") <= 1 and plan.count("Join") <= 2


def test_zonal_grid(spark):
    nodata = float("nan")
    pixels = spark.createDataFrame([("MA1", nodata), ("MA1", 1.0), ("MA1", 4.0), ("MA1", 5.0)], "field_id string, ndvi double")
    fields = spark.createDataFrame([("MA1",), ("NA1",)], "field_id string")
    stats = zonal.with_every_field(fields, zonal.zonal_stats(pixels, ["field_id"], ["ndvi"]), "field_id", ["ndvi"]).orderBy("field_id").collect()
    assert [r["ndvi_count"] for r in stats] == [3, 0]
    assert stats[0]["ndvi_mean"] == pytest.approx(10 / 3) and stats[0]["ndvi_median"] == 4 and stats[1]["ndvi_mean"] is None


def test_cached_weights(spark):
    cells = [(0, 1000, 0.25), (0, 3000, 0.75), (1, -9999, 0.5), (1, 5000, 0.5)]
    raw = spark.createDataFrame(cells, "field int, dn int, cov double").withColumn("v", expr.decoded(F.col("dn"), 0.001, nodata=-9999))
    found = zonal.weighted_stats(raw, ["field"], "v", "cov").orderBy("field").collect()
    assert [round(r["w_mean"], 9) for r in found] == [2.5, 5.0]
    assert [r["n_pixels"] for r in found] == [2, 1]
    assert (found[1]["effective_count"], found[1]["coverage_fraction"]) == (0.5, 0.5)


def test_survey_answers(spark):
    rows = [(None, None), (None, "maize + beans"), ("mono_culture", None), ("mixed_cropping", "maize beans")]
    t = spark.createDataFrame(rows, "pattern string, mixed string")
    assert [r[0] for r in t.select(yields.intercrop(F.col("pattern"), F.col("mixed"))).collect()] == ["unknown", "yes", "no", "yes"]
    t = spark.createDataFrame([("irish_potato",), ("beans",), (None,), (" ",)], "crop string")
    assert [r[0] for r in t.select(yields.survey_match(F.col("crop"), ["potato", "potatoes"])).collect()] == [True, False, None, None]


def test_scale_there_and_back(spark):
    t = spark.createDataFrame([(2.5,), (None,)], "v double")
    dn = t.select(F.round(expr.encoded(F.col("v"), 0.001)).alias("dn"))
    assert [r["dn"] for r in dn.collect()] == [2500.0, None]
    assert [r[0] for r in dn.select(F.round(expr.decoded(F.col("dn"), 0.001), 9)).collect()] == [2.5, None]


def test_first_of_each(spark):
    scenes = spark.createDataFrame([("a", 3.0), ("a", 1.0), ("b", 2.0)], "region string, score double")
    top = first_of(scenes, ["region"], F.col("score").desc()).orderBy("region").collect()
    assert [(r["region"], r["score"]) for r in top] == [("a", 3.0), ("b", 2.0)]


def _plain_cover(rects, target=995):
    """The greedy loop over all scenes, by cells of a tenth (sides in tenths)."""
    cells = {i: {(x, y) for x in range(max(r[0], 0), min(r[2], 10)) for y in range(max(r[1], 0), min(r[3], 10))} for i, r in rects.items()}
    seen, out, left = set(), [], dict(cells)
    while left and len(seen) * 10 < target:
        best = max(left, key=lambda i: (len(left[i] - seen), len(cells[i]), -i))
        gain = len(left.pop(best) - seen)
        if not gain:
            break
        seen |= cells[best]
        out.append((best, gain, len(seen)))
    return out or [(min(rects), 0, 0)]


def test_greedy_cover_is_the_plain_loop_over_all_scenes(spark):
    rng = random.Random(7)
    groups = {"few": {}, "small": {}, "whole": {900: (-2, -2, 12, 12)}, "out": {7: (11, 11, 13, 13), 5: (3, 3, 3, 9)}}
    for i in range(300):  # the best have large ids
        x, y = rng.randint(-1, 8), rng.randint(-1, 9)
        side = 1 if i < 200 else rng.randint(1, 4)
        for g in ("few", "whole"):
            groups[g][i] = (x, y, x + side, y + rng.randint(1, 3))
        groups["small"][i] = (i % 10, i // 10 % 10, i % 10 + 1, i // 10 % 10 + 1)  # 100 choices
    rows = [(g, i, *(v / 10 for v in r)) for g, found in groups.items() for i, r in found.items()] + [("out", 1, None, 0.1, 0.2, 0.3)]
    groups["out"][1] = (0, 0, 0, 0)
    table = spark.createDataFrame(rows, "region string, scene_id long, x0 double, y0 double, x1 double, y1 double").repartition(5)
    got = {g: [] for g in groups}
    for r in greedy_cover(table, ["region"]).orderBy("region", "step").collect():
        got[r["region"]].append((r["scene_id"], round(r["gain"] * 100, 6), round(r["covered"] * 100, 6)))
    assert got == {g: _plain_cover(r) for g, r in groups.items()}
    assert len(got["small"]) == 100 and got["whole"] == [(900, 100, 100)]
    assert greedy_cover(table, ["region"], limit=2).filter("region = 'few'").count() == 2


def _season_weeks(spark, curves):
    """curves: field -> (optical or None, radar or None) by week."""
    rows = [(f, dt.date(2023, 3, 6) + dt.timedelta(7 * i), o, o, o, r) for f, (optical, radar) in curves.items() for i, (o, r) in enumerate(zip(optical, radar))]
    return spark.createDataFrame(rows, "f string, w date, a double, b double, c double, r double")


def test_seasons_and_what_stands_in_for_them(spark):
    bell = [0.10, 0.11, 0.13, 0.18, 0.30, 0.48, 0.62, 0.72, 0.78, 0.82, 0.84, 0.82, 0.79, 0.72, 0.62, 0.48, 0.34, 0.22, 0.15, 0.12, 0.10, 0.09, 0.09, 0.08, 0.08]
    none, n = [None] * 25, 25
    curves = {
        "clear": (bell, none), "cloudy": ([None if 9 <= i <= 12 else v for i, v in enumerate(bell)], bell), "nothing": (none, none),
        "few": ([0.1, 0.5, 0.9, 0.2, 0.1] + [None] * 20, none), "flat": ([0.5] * n, none), "rising": ([i / 24 for i in range(n)], none),
    }
    first, last = (F.lit(d).cast("date") for d in ("2023-03-01", "2023-08-31"))
    got = {r["f"]: r for r in timeseries.seasons(_season_weeks(spark, curves), "f", "w", ["a", "b", "c"], "r", first, last).collect()}
    whole = (dt.date(2023, 3, 1), dt.date(2023, 8, 31))
    assert got["clear"]["qa_status"] == "detected" and got["clear"]["method"] == timeseries.DETECTED
    assert got["clear"]["sos"] < got["clear"]["peak_date"] < got["clear"]["eos"] and got["clear"]["optical_valid_weeks"] == n and got["clear"]["confidence"] > 0.9
    assert (got["cloudy"]["optical_valid_weeks"], got["cloudy"]["sar_supported_weeks"], got["cloudy"]["qa_status"]) == (21, 4, "detected")
    assert (got["nothing"]["qa_status"], got["nothing"]["confidence"], got["nothing"]["peak_date"]) == ("no_weekly_signal", 0.0, None)
    assert (got["few"]["qa_status"], got["few"]["confidence"]) == ("insufficient_optical_weeks", 0.15)
    assert got["flat"]["qa_status"] == "no_weekly_signal"  # no spread, so nothing to normalise
    assert (got["rising"]["qa_status"], got["rising"]["method"], got["rising"]["eos"]) == ("partial_boundary_fallback", timeseries.ONE_BOUNDARY, whole[1])
    assert all((got[f]["sos"], got[f]["eos"], got[f]["method"]) == (*whole, timeseries.FULL_SEASON) for f in ("nothing", "few", "flat"))


def test_season_yield_flags(spark):
    d = dt.date
    fields = [("ok", "yes?", None), ("mixed", "yes", "maize"), ("other", "no", "irish_potato"), ("same", "no", "sweet-corn"), ("tea", "no", None), ("draft", None, None), ("short", None, None), ("none", None, None), ("absent", None, None)]
    fields = [("ok", None, None), *fields[1:]]
    plots = spark.createDataFrame([(f, "k", 2.0, m, s) for f, m, s in fields], "field_id string, county string, area_ha double, intercrop_status string, survey_crop_text string")
    labels = spark.createDataFrame([(f, "k", "Tea" if f == "tea" else "Maize", None if f == "none" else 0.9, "draft" if f == "draft" else "final") for f, _, _ in fields if f != "absent"], "field_id string, county string, seasonal_label string, seasonal_confidence double, status string")
    found = spark.createDataFrame([(f, d(2023, 3, 10), d(2023, 6, 1), d(2023, 7, 1), "m", 0.9, "detected", 20, 0) for f, _, _ in fields], "field_id string, sos date, peak_date date, eos date, method string, confidence double, qa_status string, optical_valid_weeks long, sar_supported_weeks long")
    sums = [(f, None if f == "none" else 300.0, 250.0, 350.0, 100, 0.5 if f == "short" else 0.0 if f == "none" else 0.9, None if f == "none" else 0.7 if f == "short" else 0.9, 5) for f, _, _ in fields]
    metrics = spark.createDataFrame(sums, "field_id string, npp_central double, npp_narrow double, npp_wide double, days_central long, temporal_central double, spatial_central double, periods_central long")
    got = {r["field_id"]: r for r in yields.season_yield(plots, labels, found, metrics, yields.crop_factors(spark)).collect()}
    assert {f: r["qa_flags"] for f, r in got.items()} == {
        "ok": "intercrop_unknown", "mixed": "mixed_crop_biomass_only", "other": "survey_crop_mismatch", "same": "", "tea": "unsupported_or_unclassified_crop", "draft": "seasonal_status_not_final",
        "short": "low_npp_temporal_coverage;low_npp_spatial_coverage", "none": "crop_confidence_below_threshold;low_npp_temporal_coverage;low_npp_spatial_coverage;missing_npp",
        "absent": "unsupported_or_unclassified_crop;seasonal_status_not_final;crop_confidence_below_threshold",
    }
    assert [round(got["same"][f"yield_{x}"], 6) for x in ("low", "central", "high")] == [4.159958, 4.457098, 4.771717]
    assert got["same"]["yield_status"] == "calculated_unvalidated" and got["ok"]["yield_status"] == "calculated_unvalidated_intercrop_unknown"
    assert round(got["same"]["production_central"], 6) == 8.914197 and got["same"]["yield_narrow"] < got["same"]["yield_central"] < got["same"]["yield_wide"]
    assert got["mixed"]["yield_central"] is None and got["mixed"]["biomass"] is not None and got["absent"]["crop_label"] == "Unclassified"


def test_weighted_median_and_bounds(spark):
    rows = [(1, 5.0, 0.2), (1, 1.0, 0.5), (1, 3.0, 0.5), (1, 3.0, 0.5), (1, None, 1.0), (1, 99.0, 0.0), (2, None, 1.0)]
    got = zonal.weighted_stats(spark.createDataFrame(rows, "f long, v double, w double"), ["f"], "v", "w").orderBy("f").collect()
    assert (got[0]["w_median"], got[0]["w_min"], got[0]["w_max"], got[0]["n_pixels"]) == (3.0, 1.0, 5.0, 4)
    assert (got[1]["w_median"], got[1]["w_min"], got[1]["n_pixels"], got[1]["effective_count"]) == (None, None, 0, 0.0)


def test_buffers_need_both_sensors(spark):
    rows = [(f, True, dist, s1, True) for f, near in (("wide", 12.0), ("mid", 7.0), ("thin", 1.0)) for dist, s1 in ((near, True), (near, True), (20.0, False), (20.0, False))]
    t = spark.createDataFrame(rows + [("out", False, 9.0, True, True)], "f string, inside boolean, distance double, s1 boolean, s2 boolean")
    got = {r["f"]: tuple(r)[1:] for r in zonal.buffers(t, ["f"], ["s1", "s2"], F.lit(2)).collect()}
    assert got == {"wide": (10, 2, 2, 4, 4, False), "mid": (5, 2, 2, 4, 4, False), "thin": (0, 2, 2, 4, 4, False), "out": (0, 0, 0, 0, 0, True)}


def test_survey_answers_of_each_season(spark):
    t = spark.createDataFrame([("mixed_cropping", "maize beans", "mono_culture", "maize")], "cropping_pattern string, croptype_mixed string, cropping_pattern_2 string, croptype_mono_2 string")
    got = [t.select(*yields.survey_answers(t, s)).first() for s in ("lr", "sr")]
    assert [tuple(r) for r in got] == [("no", "maize"), ("yes", "maize beans")]
