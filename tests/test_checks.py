"""Each rule against rows that keep and break it; names, grids, samples and storage."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldloom.functions import expr, geometry
from fieldloom.operators import checks, quality, zonal
from fieldloom.sources import store


def broken(table, rules):
    """Which rules each row breaks, by the row's name."""
    return {r["name"]: {k for k in rules if r[f"_{k}"]} for r in table.select("name", *(c.alias(f"_{k}") for k, c in rules.items())).collect()}


def test_part_rules(spark):
    rows = [("good", 5, 10, 8, 8, 2.0), ("buffer", 7, 10, 8, 8, 2.0), ("nobuffer", None, 10, 8, 8, 2.0), ("more", 0, 10, 11, 8, 2.0), ("less", 0, 10, -1, None, None), ("count", 10, 10, 8, 9, 2.0), ("negative", 10, 10, 8, -1, 2.0), ("part", 10, 10, 8, 8, 2.5), ("empty", None, None, None, None, None)]
    t = spark.createDataFrame(rows, "name string, buffer_width_m int, pixel_count_before int, pixel_count_after int, a_count int, b_count double")
    assert broken(t, checks.part_rules(["a", "b"])) == {"good": set(), "buffer": {"bad_buffer"}, "nobuffer": set(), "more": {"bad_geometry_count"}, "less": {"bad_geometry_count"}, "count": {"bad_valid_count"}, "negative": {"bad_valid_count"}, "part": {"bad_valid_count"}, "empty": set()}


def test_radar_rules(spark):
    names = ["p_ratio_count", "rvi_count", "rcspr_count", "sigma_vv_linear_count", "sigma_vh_linear_count", "p_ratio_min", "rvi_min", "rvi_max", "rcspr_min", "rcspr_max", "p_ratio_mean", "rvi_mean", "rcspr_mean", "sigma_vh_linear_mean"]
    good = dict(zip(names, [5.0, 5.0, 5.0, 6.0, 5.0, 0.1, 0.5, 1.5, -0.2, 0.7, 0.2, 1.0, 0.5, 0.02]))
    cases = {"good": {}, "counts": {"rvi_count": 4.0}, "more": {"sigma_vh_linear_count": 4.0}, "ratio": {"p_ratio_min": -0.1}, "rvi": {"rvi_max": 4.1}, "edge": {"rvi_max": 4.000005}, "rcspr": {"rcspr_min": -1.1}, "identity": {"rvi_mean": 1.01}, "near": {"rvi_mean": 1.00001}, "orphan": {"sigma_vh_linear_mean": None}}
    t = spark.createDataFrame([(k, *(good | v).values()) for k, v in cases.items()], "name string, " + ", ".join(f"{n} double" for n in names))
    assert broken(t, checks.radar_rules()) == {"good": set(), "counts": {"bad_counts"}, "more": {"bad_counts"}, "ratio": {"bad_domain"}, "rvi": {"bad_domain"}, "edge": set(), "rcspr": {"bad_domain"}, "identity": {"bad_identity"}, "near": set(), "orphan": {"index_without_vh"}}


def test_model_yield_and_rate_rules(spark):
    rows = [("good", "classified", 0.5, 0.5), ("none", "below_threshold", None, None), ("reason", "guess", None, None), ("noreason", None, 1.0, None), ("sum", "classified", 0.5, 0.4), ("near", "classified", 0.5, 0.500005)]
    t = spark.createDataFrame(rows, "name string, reason string, a double, b double")
    assert broken(t, checks.model_rules(["a", "b"])) == {"good": set(), "none": set(), "reason": {"unexpected_reason"}, "noreason": set(), "sum": {"bad_probability_sum"}, "near": set()}
    rows = [("good", 2.0, 1.0, 2.0, 3.0, 4.0), ("none", 2.0, None, None, None, None), ("area", 0.0, None, None, None, None), ("noarea", None, None, None, None, None), ("order", 2.0, 2.5, 2.0, 3.0, 4.0), ("amount", 2.0, 1.0, 2.0, 3.0, 4.1), ("large", 2.0, 21.0, 22.0, 23.0, 44.0)]
    t = spark.createDataFrame(rows, "name string, area_ha double, yield_low double, yield_central double, yield_high double, production_central double")
    assert broken(t, checks.yield_rules()) == {"good": set(), "none": set(), "area": {"bad_area"}, "noarea": {"bad_area"}, "order": {"bad_order"}, "amount": {"bad_production"}, "large": {"warn_yield_over_20"}}
    t = spark.createDataFrame([("good", 1.0), ("bad", -0.1), ("high", 14.5), ("none", None)], "name string, rate double")
    assert broken(t, checks.rate_rules()) == {"good": set(), "bad": {"bad_rate"}, "high": {"warn_rate_over_14_4"}, "none": set()}


def test_histories_loads_and_batches(spark):
    t = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 1), ("x", 1), ("x", 2)], "f string, week_start int")
    expected = spark.createDataFrame([("a",), ("b",), ("c",)], "f string")
    assert {r["f"]: r["fault"] for r in checks.history(t, expected, "f", 2).collect()} == {"b": "incomplete", "c": "missing", "x": "unexpected"}
    part = lambda *rows: spark.createDataFrame(rows, "part string, rows long")
    got = checks.loads(part(("a", 2), ("b", 3), ("c", 1)), part(("a", 2), ("b", 2)), part(("a", 2), ("b", 3), ("d", 1)), "part").collect()
    assert {tuple(r) for r in got} == {("b", 3, 2, 3), ("c", 1, 0, 0), ("d", 0, 0, 1)}
    statuses = spark.createDataFrame([(1, "passed", 10), (2, "passed", None), (3, "failed", None), (4, "scoring", None)], "batch_id long, status string, rows long")
    assert tuple(checks.batch_summary(spark.range(1, 7).withColumnRenamed("id", "batch_id"), statuses).first()) == (6, 1, 1, 2, 2, 10)
    assert tuple(checks.key_counts(t, ["f", "week_start"]).first()) == (6, 5, 1)
    assert tuple(checks.key_counts(t.limit(0), ["f"]).first()) == (0, 0, 0)


def test_inventories_and_layouts(spark):
    a = spark.createDataFrame([(1, "g", 1.0), (2, "g", 1.0), (3, None, None), (4, "g", 1.0), (5, "g", None)], "k long, grid string, w double")
    b = spark.createDataFrame([(1, "g", 1.0 + 1e-13), (2, "h", 1.0), (3, None, None), (5, "g", 1.0), (6, "g", 1.0)], "k long, grid string, w double")
    assert {r["k"]: r["fault"] for r in checks.differing(a, b, "k", ["grid"], {"w": 1e-12}).collect()} == {2: "differs", 4: "only_first", 5: "differs", 6: "only_second"}
    files = spark.createDataFrame([("good", ["VV", "vh"], ["f", "f"]), ("one", ["vv"], ["f"]), ("type", ["vv", "vh"], ["f", "i"]), ("order", ["vh", "vv"], ["f", "f"])], "path string, names array<string>, kinds array<string>")
    assert {r["path"]: r["fault"] for r in checks.layout_faults(files, ["vv", "vh"], "f").collect()} == {"one": "band_count", "type": "type", "order": "names"}
    files = spark.createDataFrame([("r", 1, "g"), ("r", 2, "g"), ("r", 2, "g"), ("r", 3, "h")], "region string, week long, grid string")
    assert {(r["week"], r["fault"]) for r in store.inventory_faults(files, ["region", "week"], "grid").collect()} == {(2, "duplicate"), (3, "grid")}
    listing, scenes = spark.createDataFrame([("s1",), ("s2",)], "name string"), spark.createDataFrame([("s1", "b"), ("s1", "a")], "name string, region string")
    assert {tuple(r) for r in store.with_scenes(listing, scenes, "name", "region").collect()} == {("s1", "a"), ("s1", "b"), ("s2", None)}
    assert {tuple(r) for r in store.with_scenes(listing, scenes, "name", "region", every=False).collect()} == {("s1", "a"), ("s2", None)}


def test_seasons_fields_and_covers(spark):
    d = dt.date
    seasons = spark.createDataFrame([("2023_lr", d(2023, 3, 1), d(2023, 8, 31), True), ("2022_lr", d(2022, 3, 1), d(2022, 8, 31), True), ("2023_sr", d(2023, 10, 1), d(2024, 2, 29), False)], "season_code string, season_start date, season_end date, is_complete boolean")
    assert [r[0] for r in checks.eligible_seasons(seasons, "2023-01-01", "2024-12-31").collect()] == ["2023_lr"]
    with pytest.raises(ValueError, match="2023_sr"):
        checks.eligible_seasons(seasons, "2023-01-01", "2024-12-31", ["2023_lr", "2023_sr"])
    square = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]
    t = spark.createDataFrame([("good", square), ("none", None), ("empty", []), ("flat", [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)]), ("short", square[:2]), ("twice", square), ("twice", square)], "f string, ring array<struct<x:double,y:double>>")
    assert {r["f"]: r["fault"] for r in checks.geometry_faults(t, "f", "ring").collect()} == {"none": "null", "empty": "empty", "flat": "invalid", "short": "invalid", "twice": "duplicate"}
    weeks = spark.createDataFrame([(1, "a", 0.5), (1, "a", 0.9), (2, "a", 0.5), (2, "b", 0.9)], "week long, region string, share double")
    regions = spark.createDataFrame([("a",), ("b",)], "region string")
    assert {tuple(r) for r in checks.cover_faults(weeks, regions, 0.8).collect()} == {(1, "b", 0.0), (2, "a", 0.5)}


def test_names(spark):
    t = spark.createDataFrame([(["Sigma0_VH", "Sigma0_VV"], "x_1SDV_y"), (["vv"], "x_1SSV_y"), ([None], "x_1SSV_y"), ([None, ""], "x_1sdv_y")], "d array<string>, p string").coalesce(1)
    got = [tuple(r[0]) for r in t.select(expr.product_bands(F.col("d"), F.col("p"))).collect()]
    assert got == [(2, 1, "band-descriptions"), (1, None, "band-descriptions"), (1, None, "safe-single-vv"), (2, 1, "audited-dual-vh-vv")]
    with pytest.raises(Exception, match="unknown bands"):
        spark.createDataFrame([(["a", "b"], "x_1SSH_y")], "d array<string>, p string").select(expr.product_bands(F.col("d"), F.col("p"))).collect()
    t = spark.createDataFrame([("Mean-NDVI", 9), ("odd", 2), ("odd", 3), (None, 1)], "raw string, i int").coalesce(1)
    assert [r[0] for r in t.select(expr.band_name(F.col("raw"), F.col("i"), {"ndvi": ("mean ndvi",), "evi": ("evi",)})).collect()] == ["ndvi", "evi", "odd", "ndvi"]
    t = spark.createDataFrame([(5.0,), (125.04,), (3725.0,), (None,)], "s double").coalesce(1)
    assert [r[0] for r in t.select(expr.duration(F.col("s"))).collect()] == ["5.0s", "2m 5.0s", "1h 2m 5.0s", "0.0s"]
    with pytest.raises(ValueError):
        expr.reduced("mode", F.col("v"), F.col("i"))
    t = spark.createDataFrame([(None, 1), (2.0, 2), (4.0, 3), (float("nan"), 4)], "v double, i int")
    assert tuple(t.agg(*(expr.reduced(n, F.col("v"), F.col("i")) for n in ("nanmean", "nanmedian", "lastvalid", "firstvalid"))).first()) == (3.0, 3.0, 4.0, 2.0)


def test_grids(spark):
    box = lambda *v: dict(zip(("x0", "y0", "x1", "y1"), map(F.lit, v)))
    window = lambda b: tuple(spark.range(1).select(*geometry.pixel_window(b, 0.0, 100.0, 10.0, 10, 10).values()).first())
    assert window(box(5.0, 72.0, 21.0, 95.0)) == (0, 0, 3, 3) and window(box(-5.0, -5.0, 500.0, 8.0)) == (0, 9, 10, 1) and window(box(200.0, 0.0, 210.0, 5.0)) == (None,) * 4
    assert tuple(spark.range(1).select(*geometry.snapped(box(-1.0, 3.0, 11.0, 20.0), 10.0).values()).first()) == (-10.0, 0.0, 20.0, 20.0)
    ring = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (1.0, 0.0), (1.0, 2.5))))
    assert spark.range(1).select(geometry.ring_wkt(ring, 1)).first()[0] == "POLYGON((0.0 0.0, 1.0 0.0, 1.0 2.5, 0.0 0.0))"


def test_cells(spark):
    w = spark.createDataFrame([(1, 10, 0.5), (1, 11, 0.25), (2, 11, 1.0), (2, 12, 1.0)], "f long, cell_id long, coverage double")
    r = spark.createDataFrame([(10, 1, 100.0), (11, 1, 200.0), (12, 1, -9.0), (10, 2, None), (11, 2, -9.0)], "cell_id long, p long, raw double")
    got = {(x["f"], x["p"]): (x["rate"], x["source_pixel_count"], x["effective_pixel_count"], x["coverage_fraction"]) for x in zonal.cell_rates(w, r, "f", "p", 0.1, 0.0, -9.0).collect()}
    assert {k: (round(v[0], 9) if v[0] is not None else None, *v[1:]) for k, v in got.items()} == {(1, 1): (13.333333333, 2, 0.75, 1.0), (2, 1): (20.0, 1, 1.0, 0.5), (1, 2): (None, 0, 0.0, 0.0), (2, 2): (None, 0, 0.0, 0.0)}
    t = zonal.with_expected(spark.createDataFrame([(1, 2.0)], "f long, mean double"), {"mean": "a_mean"}, ["a_mean", "a_count", "b_mean"])
    assert t.collect()[0].asDict() == {"f": 1, "a_mean": 2.0, "a_count": 0, "b_mean": None}


def test_samples(spark):
    a, b = spark.range(0, 80).repartition(3), spark.range(40, 120)
    both = {r["id"] for r in quality.sampled(a, b, "id", 12).collect()}
    assert len(both) == 12 and both <= set(range(40, 80)) and both == {r["id"] for r in quality.sampled(a.coalesce(1), b.repartition(7), "id", 12).collect()}
    either = {r["id"] for r in quality.sampled(a, b, "id", 500, common=False).collect()}
    assert either == set(range(120)) and both != {r["id"] for r in quality.sampled(a, b, "id", 12, seed=7).collect()}
    blocks = spark.createDataFrame([(f, i, n) for f, n in (("full", 60), ("thin", 10), ("none", 0)) for i in range(9)], "f string, b long, n long")
    got = {r["f"]: r["k"] for r in quality.sampled_blocks(blocks, "f", "b", "n", 100, least=1, most=5).groupBy("f").agg(F.count("*").alias("k")).collect()}
    assert got == {"full": 2, "thin": 5, "none": 5}
    with pytest.raises(ValueError):
        quality.one_to_one(a, b.union(b), ["id"])
    assert quality.one_to_one(a, b, ["id"]).count() == 80


def test_parts_are_loaded_once(spark, tmp_path):
    rows, key = spark.range(3), {"run_id": "r", "sensor": "s1", "part": "p0"}
    path, done = f"{tmp_path}/t", f"{tmp_path}/done"
    with pytest.raises(ValueError):
        store.load_part(rows, path, done, key, expected=4)
    assert store.load_part(rows, path, done, key, expected=3) and not store.load_part(rows, path, done, key, expected=3)
    assert spark.read.parquet(path).count() == 3 and spark.read.parquet(done).first()["n_rows"] == 3
    versions = store.Versions(spark, f"{tmp_path}/v", "now")
    for n in (2, 5):
        versions.swap(versions.write(spark.range(n), f"run {n}"), n)
    assert store.Versions(spark, f"{tmp_path}/v", "again").current().count() == 5 and spark.table("again").count() == 5
    store.append_json(rows, f"{tmp_path}/j")
    store.append_json(rows, f"{tmp_path}/j")
    assert spark.read.json(f"{tmp_path}/j").count() == 6
    store.write_described(rows, f"{tmp_path}/d", {"run": "r"})
    assert store.described(spark, f"{tmp_path}/d") == {"run": "r"}
    (tmp_path / "ids.txt").write_text("MA2\n\n NA1 \nMA2\n")
    assert [r["id"] for r in store.read_ids(spark, f"{tmp_path}/ids.txt", "^(?:MA|NA)[0-9]+$").collect()] == ["MA2", "NA1"]
    with pytest.raises(ValueError):
        store.read_ids(spark, f"{tmp_path}/ids.txt", repeats=False)
