"""Signals by field over a dense axis of weeks: normalising, filling gaps, smoothing and season boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import clip, middle, nearest, ratio

#: How the bounds of a season were found.
DETECTED = "optical-rvi-relative-threshold-v1-matrix"
ONE_BOUNDARY = "optical-rvi-relative-threshold-v1-matrix-one-boundary-fallback"
FULL_SEASON = "full-season-fallback"


def dense(fields: DataFrame, axis: DataFrame, values: DataFrame, key: str, week: str) -> DataFrame:
    """Every field and week, with its values or NULLs.  The axis is a calendar, and so is broadcast."""
    return fields.crossJoin(F.broadcast(axis)).join(values, [key, week], "left")


def normalised(table: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """By the field's 10th and 90th percentile, clipped to 0..1; NULL with under 3 values or no spread.  No join: windows over the field."""
    field = Window.partitionBy(key)
    low, high = (F.percentile(value, F.lit(x)).over(field) for x in (0.1, 0.9))
    t = table.withColumn("_low", low).withColumn("_high", high).withColumn("_n", F.count(value).over(field))
    span = F.col("_high") - F.col("_low")
    scaled = F.when((F.col("_n") >= 3) & (span > 1e-8), clip(ratio(F.col(value) - F.col("_low"), span), 0.0, 1.0))
    return t.withColumn(out, scaled).drop("_low", "_high", "_n")


def filled(table: DataFrame, key: str, week: str, value: str, out: str, limit: int = 2) -> DataFrame:
    """Interior gaps of `limit` weeks at most by linear interpolation; the first weeks from the first value if there
    are `limit` of them at most; the `limit` weeks after the last value from it.  Weeks are rows of a dense axis."""
    order = Window.partitionBy(key).orderBy(week)
    before, after = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    t = table.withColumn("_i", F.row_number().over(order)).withColumn("_at", F.when(F.col(value).isNotNull(), F.col("_i")))
    t = t.withColumn("_pi", F.last("_at", True).over(before)).withColumn("_pv", F.last(value, True).over(before))
    t = t.withColumn("_ni", F.first("_at", True).over(after)).withColumn("_nv", F.first(value, True).over(after))
    i, gap = F.col("_i"), F.col("_ni") - F.col("_pi") - 1
    inner = F.when(gap <= limit, F.col("_pv") + (F.col("_nv") - F.col("_pv")) * (i - F.col("_pi")) / (F.col("_ni") - F.col("_pi")))
    lead = F.when(F.col("_ni") - 1 <= limit, F.col("_nv"))
    trail = F.when(i - F.col("_pi") <= limit, F.col("_pv"))
    both, none = F.col("_pi").isNotNull(), F.col("_ni").isNotNull()
    made = F.when(F.col(value).isNotNull(), F.col(value)).when(both & none, inner).when(none, lead).when(both, trail)
    return t.withColumn(out, made).drop("_i", "_at", "_pi", "_pv", "_ni", "_nv")


def smoothed(table: DataFrame, key: str, week: str, value: str, out: str) -> DataFrame:
    """Median of each week and its neighbours, of those that have a value."""
    frame = Window.partitionBy(key).orderBy(week).rowsBetween(-1, 1)
    return table.withColumn(out, F.percentile(value, F.lit(0.5)).over(frame))


def boundaries(table: DataFrame, key: str, week: str, value: str, share: float = 0.2, least: int = 6, amplitude: float = 0.2, also: tuple[str, ...] = ()) -> DataFrame:
    """Per field: peak (the first maximum), base (median of the first and last three values), threshold, start and end
    of season: the first of two adjacent weeks at or above the threshold, both up to the peak, and the first of two
    adjacent weeks at or below it, both from the peak on; and a status.  Windows over the field, so one shuffle in all.
    also: columns that are the same in all weeks of a field, to be kept."""
    field, order, back = Window.partitionBy(key), Window.partitionBy(key).orderBy(week), Window.partitionBy(key).orderBy(F.desc(week))
    v, w = F.col(value), F.col(week)
    t = table.withColumn("_f", F.count(value).over(order)).withColumn("_b", F.count(value).over(back))
    edge = F.when(v.isNotNull() & ((F.col("_f") <= 3) | (F.col("_b") <= 3)), v)
    t = t.withColumn("valid_weeks", F.count(value).over(field)).withColumn("peak_value", F.max(value).over(field)).withColumn("base", F.percentile(edge, F.lit(0.5)).over(field))
    t = t.withColumn("peak_week", F.min(F.when(v == F.col("peak_value"), w)).over(field))
    threshold = nearest(F.col("base") + share * (F.col("peak_value") - F.col("base")), 9)
    t = t.withColumn("_above", F.coalesce((v >= threshold) & (w <= F.col("peak_week")), F.lit(False))).withColumn("_below", F.coalesce((v <= threshold) & (w >= F.col("peak_week")), F.lit(False)))
    pair = lambda c: F.col(c) & F.coalesce(F.lead(c).over(order), F.lit(False))
    t = t.withColumn("_up", pair("_above")).withColumn("_down", pair("_below"))
    out = t.groupBy(key, *also, "valid_weeks", "peak_value", "base", "peak_week").agg(F.min(F.when(F.col("_up"), w)).alias("sos"), F.min(F.when(F.col("_down"), w)).alias("eos"))
    low = F.col("peak_value") - F.col("base") < amplitude
    status = F.when(F.col("valid_weeks") == 0, "no_data").when(F.col("valid_weeks") < least, "too_few_weeks").when(low, "low_amplitude").when(F.col("sos").isNull() & F.col("eos").isNull(), "no_boundary").when(F.col("sos").isNull() | F.col("eos").isNull(), "one_boundary").otherwise("detected")
    return out.withColumn("qa_status", status)


def combined(table: DataFrame, key: str, optical: list[str], radar: str) -> DataFrame:
    """Adds optical (the median of a week's normalised optical columns), signal (that, or the normalised radar of a
    week that has none) and by_radar (whether it is the radar's)."""
    t = table
    for c in [*optical, radar]:
        t = normalised(t, key, c, f"_n_{c}")
    t = t.withColumn("optical", middle(F.array(*(F.col(f"_n_{c}") for c in optical))))
    t = t.withColumn("by_radar", F.col("optical").isNull() & F.col(f"_n_{radar}").isNotNull()).withColumn("signal", nearest(F.coalesce("optical", f"_n_{radar}"), 9))
    return t.drop(*(f"_n_{c}" for c in [*optical, radar]))


def seasons(table: DataFrame, key: str, week: str, optical: list[str], radar: str, first: Column, last: Column, least: int = 6) -> DataFrame:
    """Start, peak and end of each field's season within first..last, with how they were found and how sure that is.

    Weeks are rows of a dense axis.  A bound that isn't found, or found on the wrong side of the peak, is the
    season's; with too few weeks or too small an amplitude both are.  All is windows over the field: one shuffle."""
    field = Window.partitionBy(key)
    t = combined(table, key, optical, radar)
    t = t.withColumn("optical_valid_weeks", F.count("optical").over(field)).withColumn("sar_supported_weeks", F.count_if("by_radar").over(field)).withColumn("_n_weeks", F.count("*").over(field))
    t = filled(t, key, week, "signal", "_filled").withColumn("_filled", nearest(F.col("_filled"), 9))
    t = smoothed(t, key, week, "_filled", "_smooth").withColumn("_smooth", nearest(F.col("_smooth"), 9))
    b = boundaries(t, key, week, "_smooth", least=least, also=("optical_valid_weeks", "sar_supported_weeks", "_n_weeks"))
    sos, eos = F.coalesce("sos", first), F.coalesce("eos", last)
    any_signal, peak = F.col("valid_weeks") > 0, F.col("peak_week")
    wrong = any_signal & ((sos > peak) | (eos < peak) | (sos >= eos))
    both = ~wrong & F.col("sos").isNotNull() & F.col("eos").isNotNull()
    few = (F.col("optical_valid_weeks") < least) | (F.col("valid_weeks") < least)
    amplitude = F.col("peak_value") - F.col("base")
    weak = ~few & F.coalesce(amplitude < 0.2, F.lit(True))
    whole = few | weak | wrong
    score = F.least(F.lit(0.95), 0.35 + 0.35 * F.least(F.lit(1.0), F.col("optical_valid_weeks") / F.greatest(F.lit(1), F.col("_n_weeks"))) + 0.25 * F.least(F.lit(1.0), amplitude))
    confidence = F.when(few & ~any_signal, 0.0).when(few, 0.15).when(weak, 0.2).when(both, score).otherwise(score * 0.65)
    return b.select(
        key, F.when(whole, first).otherwise(sos).alias("sos"), peak.alias("peak_date"), F.when(whole, last).otherwise(eos).alias("eos"),
        F.when(few | weak, FULL_SEASON).when(both, DETECTED).otherwise(ONE_BOUNDARY).alias("method"), nearest(confidence, 4).alias("confidence"),
        F.when(few & ~any_signal, "no_weekly_signal").when(few, "insufficient_optical_weeks").when(weak, "weak_seasonal_amplitude").when(both, "detected").otherwise("partial_boundary_fallback").alias("qa_status"),
        "optical_valid_weeks", "sar_supported_weeks",
    )
