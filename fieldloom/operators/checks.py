"""Rules that loaded tables, exports, model batches and seasons have to keep, as conditions of a row or counts by key.

A condition names a fault: it is true for a row that breaks the rule, and NULL, which counts as no fault, where there
is nothing to judge.  quality.violations counts any of them in one pass.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Allowed buffers in metres, and the reasons that a model may give.
BUFFERS = (0, 5, 10)
REASONS = ("classified", "below_threshold", "inter_season", "insufficient_observations", "incomplete_history", "out_of_training_range", "out_of_range", "unknown_county")


def _any(conditions: list[Column]) -> Column:
    return reduce(or_, (F.coalesce(c, F.lit(False)) for c in conditions))


def part_rules(bands: list[str]) -> dict[str, Column]:
    """Of a table of fields and weeks: its buffer, pixel counts, and the counts of valid pixels of each band."""
    after, before = F.col("pixel_count_after"), F.col("pixel_count_before")
    counts = [F.col(f"{b}_count") for b in bands]
    bad = [x for c in counts for x in (c < 0, c > after, c != c.cast("long"))]
    return {"bad_buffer": ~F.col("buffer_width_m").isin(*BUFFERS), "bad_geometry_count": _any([after > before, after < 0]), "bad_valid_count": _any(bad)}


def radar_rules(tolerance: float = 1e-5) -> dict[str, Column]:
    """Of radar statistics: the counts of indices agree, values lie in their domain, and rvi = 2 (1 - rcspr)."""
    p = F.col("p_ratio_count")
    counts = [p != F.col("rvi_count"), p != F.col("rcspr_count"), p > F.col("sigma_vv_linear_count"), p > F.col("sigma_vh_linear_count")]
    domain = [F.col("p_ratio_min") < 0, F.col("rvi_min") < -tolerance, F.col("rvi_max") > 4 + tolerance, F.col("rcspr_min") < -1 - tolerance, F.col("rcspr_max") > 1 + tolerance]
    derived = [F.col(f"{i}_mean").isNotNull() for i in ("p_ratio", "rvi", "rcspr")]
    return {
        "bad_counts": _any(counts), "bad_domain": _any(domain),
        "bad_identity": F.abs(F.col("rvi_mean") - 2 * (1 - F.col("rcspr_mean"))) > 2 * tolerance,
        "index_without_vh": F.col("sigma_vh_linear_mean").isNull() & _any(derived),
    }


def export_rules(sensors: tuple[str, ...] = ("s1", "s2")) -> dict[str, Column]:
    """Of an export with a row for each field and week: its buffer, and each sensor's buffer, pixels and presence."""
    out = {"bad_buffer": ~F.coalesce(F.col("buffer_width_m").isin(*BUFFERS), F.lit(False))}
    for s in sensors:
        before, after = F.col(f"{s}_pixel_count_before"), F.col(f"{s}_pixel_count_after")
        out |= {f"{s}_buffer_mismatch": F.col(f"{s}_buffer_width_m") != F.col("buffer_width_m"), f"bad_{s}_pixel_count": _any([before < 0, after < 0, after > before]), f"{s}_null_rows": F.col(f"{s}_field_id").isNull()}
    return out


def row_rules() -> dict[str, Column]:
    """Of a stored field week: its week, dates, buffer and pixel counts."""
    return {
        "bad_week": ~F.col("week_no").between(1, 53), "bad_dates": F.col("end_date") < F.col("start_date"), "bad_buffer": ~F.col("buffer_width_m").isin(*BUFFERS),
        "bad_pixels": _any([F.col("pixel_count_before") < 0, F.col("pixel_count_after") < 0, F.col("pixel_count_after") > F.col("pixel_count_before")]),
    }


def model_rules(probabilities: list[str], reasons: tuple[str, ...] = REASONS, tolerance: float = 1e-5) -> dict[str, Column]:
    """Of a model's output: reasons are known ones, and probabilities, where there is one, add up to 1."""
    p = [F.col(c) for c in probabilities]
    total = reduce(lambda a, b: a + b, (F.coalesce(c, F.lit(0.0)) for c in p))
    return {"unexpected_reason": ~F.col("reason").isin(*reasons), "bad_probability_sum": _any([c.isNotNull() for c in p]) & (F.abs(total - 1) > tolerance)}


def yield_rules() -> dict[str, Column]:
    """Of season yields: area over 0, low <= central <= high, and production is yield times area (relative 1e-7)."""
    central, made = F.col("yield_central"), F.col("yield_central") * F.col("area_ha")
    return {
        "bad_area": ~F.coalesce(F.col("area_ha") > 0, F.lit(False)), "bad_order": _any([F.col("yield_low") > central, central > F.col("yield_high")]),
        "bad_production": central.isNotNull() & ~F.coalesce(F.abs(F.col("production_central") - made) <= 1e-8 + 1e-7 * F.abs(made), F.lit(False)), "warn_yield_over_20": central > 20,
    }


def rate_rules() -> dict[str, Column]:
    """Of productivity by period: rates are not negative; those over 14.4 are to be looked at."""
    return {"bad_rate": F.col("rate") < 0, "warn_rate_over_14_4": F.col("rate") > 14.4}


def key_counts(table: DataFrame, keys: list[str]) -> DataFrame:
    """One row: n_rows, n_keys and how many rows repeat a key.  Keys with NULLs are keys too."""
    counted = table.groupBy(*keys).agg(F.count("*").alias("n"))
    return counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_repeated"))


def history(table: DataFrame, expected: DataFrame, key: str, weeks: int) -> DataFrame:
    """A row for each field that is expected or there and is missing, unexpected or without one row for each week."""
    n = table.groupBy(key).agg(F.count("*").alias("n"), F.count_distinct("week_start").alias("n_weeks"))
    both = expected.select(key).distinct().withColumn("_e", F.lit(True)).join(n, key, "full")
    fault = F.when(F.col("n").isNull(), "missing").when(F.col("_e").isNull(), "unexpected").when((F.col("n") != weeks) | (F.col("n_weeks") != weeks), "incomplete")
    return both.select(key, F.coalesce("n", F.lit(0)).alias("n"), fault.alias("fault")).filter("fault is not null")


def batch_summary(batches: DataFrame, statuses: DataFrame) -> DataFrame:
    """One row: how many batches passed (with an output), failed, run and wait, and the rows of those that passed.

    batches: batch_id.  statuses: batch_id, status, rows, a row a batch at most; rows is NULL without an output."""
    t = batches.select("batch_id").join(statuses, "batch_id", "left")
    state = F.when(F.col("status").isNull(), "pending").when((F.col("status") == "passed") & F.col("rows").isNotNull(), "passed").when(F.col("status") == "failed", "failed").otherwise("running")
    t = t.select(state.alias("s"), "rows")
    return t.agg(F.count("*").alias("n_batches"), *(F.count_if(F.col("s") == s).alias(s) for s in ("passed", "failed", "running", "pending")), F.coalesce(F.sum(F.when(F.col("s") == "passed", F.col("rows"))), F.lit(0)).alias("passed_rows"))


def roll_up(batches: DataFrame, group: str, counters: list[str]) -> DataFrame:
    """Counters of batches added up by group; a NULL counter is 0."""
    return batches.groupBy(group).agg(F.count("*").alias("n_batches"), *(F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in counters))


def loads(manifest: DataFrame, stored: DataFrame, checkpoints: DataFrame, key: str) -> DataFrame:
    """Parts whose rows differ between manifest, table and checkpoints (key, rows each), with the three numbers."""
    named = [t.groupBy(key).agg(F.sum("rows").alias(n)) for t, n in ((manifest, "expected"), (stored, "stored"), (checkpoints, "recorded"))]
    t = named[0].join(named[1], key, "full").join(named[2], key, "full").na.fill(0, ["expected", "stored", "recorded"])
    return t.filter("expected <> stored or expected <> recorded")


def differing(a: DataFrame, b: DataFrame, key: str, exact: list[str], near: dict[str, float] | None = None) -> DataFrame:
    """Keys of which a or b has no row, or whose columns differ: at all (exact, NULLs are equal) or by more than a bound (near)."""
    near = near or {}
    columns = [*exact, *near]
    x = a.select(key, F.lit(True).alias("_a"), *(F.col(c).alias(f"_a_{c}") for c in columns))
    y = b.select(key, F.lit(True).alias("_b"), *(F.col(c).alias(f"_b_{c}") for c in columns))
    t = x.join(y, key, "full")
    unlike = [~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")) for c in exact]
    unlike += [F.coalesce(F.abs(F.col(f"_a_{c}") - F.col(f"_b_{c}")) > tol, F.col(f"_a_{c}").isNull() != F.col(f"_b_{c}").isNull()) for c, tol in near.items()]
    fault = F.when(F.col("_b").isNull(), "only_first").when(F.col("_a").isNull(), "only_second").when(_any(unlike), "differs")
    return t.select(key, fault.alias("fault")).filter("fault is not null")


def layout_faults(files: DataFrame, bands: list[str], kind: str) -> DataFrame:
    """Files (path, names, kinds: arrays by band) with another number, type or order of bands, each with its fault."""
    wrong = F.when(F.size("names") != len(bands), "band_count").when(F.exists("kinds", lambda k: k != kind), "type").when(F.transform("names", F.lower) != F.array(*map(F.lit, bands)), "names")
    return files.select("path", wrong.alias("fault")).filter("fault is not null")


def cover_faults(weeks: DataFrame, regions: DataFrame, least: float) -> DataFrame:
    """Regions that a week lacks or of which it covers too small a share (week, region, share; the greatest counts)."""
    best = weeks.groupBy("week", "region").agg(F.max("share").alias("share"))
    wanted = weeks.select("week").distinct().crossJoin(F.broadcast(regions.select("region").distinct()))  # a list of regions
    t = wanted.join(best, ["week", "region"], "left")
    return t.select("week", "region", F.coalesce("share", F.lit(0.0)).alias("share")).filter(F.col("share") < least)


def eligible_seasons(seasons: DataFrame, first: str, last: str, requested: list[str] | None = None) -> DataFrame:
    """Complete seasons within the model's range, and of those the requested ones; a requested one that isn't there is an error."""
    found = seasons.filter(F.col("is_complete") & (F.col("season_start") >= F.lit(first).cast("date")) & (F.col("season_end") <= F.lit(last).cast("date")))
    if requested is None:
        return found
    found = found.filter(F.col("season_code").isin(*requested))
    there = {r["season_code"] for r in found.select("season_code").distinct().collect()}  # as many as were asked for at most
    if absent := sorted(set(requested) - there):
        raise ValueError(f"seasons absent or incomplete: {absent}")
    return found


def geometry_faults(fields: DataFrame, key: str, ring: str) -> DataFrame:
    """Fields without a ring, with one of under three corners or no area, or whose id repeats."""
    from ..functions.geometry import ring_area

    n = fields.groupBy(key).agg(F.count("*").alias("_n"))
    fault = F.when(F.col(ring).isNull(), "null").when(F.size(ring) == 0, "empty").when((F.size(ring) < 3) | (ring_area(F.col(ring)) <= 0), "invalid").when(F.col("_n") > 1, "duplicate")
    return fields.join(n, key, "left").select(key, fault.alias("fault")).filter("fault is not null")
