"""Statistics of pixels by field."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import finite, ratio

STATS = ("mean", "median", "min", "max", "std", "count")


def stat_columns(bands: list[str]) -> list[Column]:
    """Six statistics of each band over its valid values, computed in doubles."""
    out = []
    for b in bands:
        v = finite(F.col(b)).cast("double")
        out += [F.avg(v).alias(f"{b}_mean"), F.median(v).alias(f"{b}_median"), F.min(v).alias(f"{b}_min"), F.max(v).alias(f"{b}_max"), F.stddev_pop(v).alias(f"{b}_std"), F.count(v).alias(f"{b}_count")]
    return out


def zonal_stats(pixels: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    return pixels.groupBy(*keys).agg(*stat_columns(bands))


def with_every_field(fields: DataFrame, stats: DataFrame, key: str, bands: list[str]) -> DataFrame:
    """A row for every field; where it has no pixel, counts are 0 and the rest NULL."""
    joined = fields.join(stats, key, "left")
    return joined.na.fill(0, [f"{b}_count" for b in bands])


def weighted_stats(pixels: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """Coverage-weighted mean, median, standard deviation and count, the least and greatest value, and how many pixels.

    The median is the first value, in ascending order, up to which there is half of the weight.  Pixels of one value
    are added up first, so that what a field's window orders are its distinct values."""
    v, w = finite(F.col(value)).cast("double"), F.col(weight).cast("double")
    valid = v.isNotNull() & (w > 0)
    by_value = pixels.groupBy(*keys, F.when(valid, v).alias("_v")).agg(F.sum(w).alias("_all"), F.sum(F.when(valid, w)).alias("_w"), F.count(F.when(valid, 1)).alias("_n"))
    field = Window.partitionBy(*keys)
    upto = F.sum("_w").over(field.orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    t = by_value.withColumn("_upto", upto).withColumn("_half", F.sum("_w").over(field) / 2)
    sums = t.groupBy(*keys).agg(
        F.sum("_w").alias("effective"), F.sum(F.col("_w") * F.col("_v")).alias("total"), F.sum(F.col("_w") * F.col("_v") * F.col("_v")).alias("squares"), F.sum("_n").alias("n_pixels"), F.sum("_all").alias("all_weight"),
        F.min(F.when(F.col("_upto") >= F.col("_half") * (1 - 1e-12), F.col("_v"))).alias("w_median"), F.min("_v").alias("w_min"), F.max("_v").alias("w_max"),
    )
    mean, effective = ratio(F.col("total"), F.col("effective")), F.coalesce("effective", F.lit(0.0))
    spread = F.sqrt(F.greatest(F.lit(0.0), ratio(F.col("squares"), F.col("effective")) - mean * mean))
    return sums.select(*keys, mean.alias("w_mean"), "w_median", "w_min", "w_max", spread.alias("w_std"), "n_pixels", effective.alias("effective_count"), ratio(effective, F.col("all_weight")).alias("coverage_fraction"))


def buffers(points: DataFrame, keys: list[str], sensors: list[str], least: Column, widths: tuple[int, ...] = (10, 5, 0)) -> DataFrame:
    """The first inward buffer (metres) that leaves every sensor `least` pixels, or else the last, with each sensor's
    pixels before and after, and whether too few are left.

    points: keys, inside, distance (to the boundary) and a boolean column of each sensor: whether the point is its
    pixel.  least is an expression of the keys."""
    within = {d: F.col("inside") if d == 0 else F.col("inside") & (F.col("distance") > d) for d in widths}
    n = points.groupBy(*keys).agg(*(F.count_if(F.col(s) & c).alias(f"_{s}_{d}") for s in sensors for d, c in within.items()))
    enough = {d: reduce(and_, (F.col(f"_{s}_{d}") >= least for s in sensors)) for d in widths}

    def chosen(of: Callable[[int], Column]) -> Column:
        out = of(widths[-1])
        for d in reversed(widths[:-1]):
            out = F.when(enough[d], of(d)).otherwise(out)
        return out

    after = {s: chosen(lambda d, s=s: F.col(f"_{s}_{d}")) for s in sensors}
    few = reduce(or_, (v < least for v in after.values()))
    pairs = [x for s in sensors for x in (F.col(f"_{s}_{widths[-1]}").alias(f"{s}_before"), after[s].alias(f"{s}_after"))]
    return n.select(*keys, chosen(lambda d: F.lit(d)).alias("buffer_width_m"), *pairs, few.alias("below_min_pixel_threshold"))


def cell_rates(weights: DataFrame, raster: DataFrame, field: str, period: str, scale: float = 1.0, offset: float = 0.0, nodata: float | None = None) -> DataFrame:
    """Each field's coverage-weighted value in each period, from weights made once (field, cell_id, coverage) and the
    raster's cells (cell_id, period, raw): rate, pixels, their coverage and its share of the field's.

    An equi-join by cell, then one aggregate; a cell without a valid value counts in the field's whole coverage only."""
    whole = weights.groupBy(field).agg(F.sum("coverage").alias("_whole"))
    v = finite(F.col("raw")).cast("double")
    valid = v.isNotNull() if nodata is None else v.isNotNull() & (v != nodata)
    w = F.when(valid, F.col("coverage"))
    sums = weights.join(raster.select("cell_id", period, "raw"), "cell_id").groupBy(field, period).agg(F.sum(w).alias("_w"), F.sum(w * (v * scale + offset)).alias("_t"), F.count(w).alias("source_pixel_count"))
    effective = F.coalesce("_w", F.lit(0.0))
    return sums.join(whole, field).select(field, period, ratio(F.col("_t"), F.col("_w")).alias("rate"), "source_pixel_count", effective.alias("effective_pixel_count"), ratio(effective, F.col("_whole")).alias("coverage_fraction"))


def with_expected(table: DataFrame, names: dict[str, str], expected: list[str]) -> DataFrame:
    """Columns renamed and, of those expected, the absent ones added: counts as 0, the rest as NULL."""
    t = table.withColumnsRenamed(names)
    return t.withColumns({c: F.lit(0).cast("long") if c.endswith("_count") else F.lit(None).cast("double") for c in expected if c not in t.columns})
