"""NULL-safe arithmetic and index formulas as Column expressions.

Whatever is missing, NaN or infinite is NULL before anything is computed from it; a division by zero is NULL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(c: Column) -> Column:
    """NULL for NaN and infinities."""
    d = c.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), c)


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def nearest(c: Column, places: int) -> Column:
    """c scaled, rounded with halves away from zero, and scaled back: SQL engines that round doubles do so, where
    Spark's round takes the shortest decimal of the double, which falls on the other side of some ties."""
    scale = F.lit(10.0**places)
    return F.round(c * scale) / scale


def clip(c: Column, low: float, high: float) -> Column:
    """Between low and high; NULL stays NULL (least and greatest alone would skip it)."""
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def between_or(c: Column, mask: Column) -> Column:
    return F.when(mask, c)


def reflectance(dn: Column, scl: Column, inside: Column) -> Column:
    """Digital number as reflectance where the scene class is clear land and the pixel is inside the area."""
    return F.when(scl.isin(4, 5, 6, 7) & inside, dn / 10_000)


def offset_corrected(c: Column, offset: float = 0.1) -> Column:
    return F.when(c != 0, finite(c) - offset)


def decoded(dn: Column, scale: float, offset: float = 0.0, nodata: float | None = None) -> Column:
    value = dn * scale + offset
    return value if nodata is None else F.when(dn != nodata, value)


def encoded(value: Column, scale: float, offset: float = 0.0) -> Column:
    return (value - offset) / scale


def normalised_difference(a: Column, b: Column) -> Column:
    return clip(ratio(a - b, a + b), -1.0, 1.0)


def optical_indices(b: dict[str, Column]) -> dict[str, Column]:
    """The seven optical indices from bands B02 to B11."""
    ndvi = normalised_difference(b["b08"], b["b04"])
    return {
        "ndvi": ndvi,
        "evi": clip(ratio(2.5 * (b["b08"] - b["b04"]), b["b08"] + 6 * b["b04"] - 7.5 * b["b02"] + 1), -1.0, 1.0),
        "ndmi": normalised_difference(b["b08"], b["b11"]),
        "ndre": normalised_difference(b["b8a"], b["b05"]),
        "msi": clip(ratio(b["b11"], b["b08"]), 0.0, 10.0),
        "pvr": normalised_difference(b["b03"], b["b02"]),
        "lai": clip(3.618 * ndvi - 0.118, 0.0, 10.0),
    }


def radar_indices(vv: Column, vh: Column) -> dict[str, Column]:
    return {"p_ratio": ratio(vh, vv), "rvi": ratio(4 * vh, vv + vh), "rcspr": ratio(vv - vh, vv + vh)}


def remapped(b1: Column, b2: Column) -> tuple[Column, Column]:
    """vv and vh of an archive that stores vh first where both exist, and vv alone otherwise; only finite values over 0 count."""
    b1, b2 = (F.when(b > 0, b) for b in (finite(b1), finite(b2)))
    return F.coalesce(b2, b1), F.when(b1.isNotNull() & b2.isNotNull(), b1)


def any_outside(bounds: dict[str, tuple[float, float]]) -> Column:
    """Whether a column lies outside its bounds; a NULL never does."""
    each = [F.coalesce((F.col(c) < low) | (F.col(c) > high), F.lit(False)) for c, (low, high) in bounds.items()]
    return reduce(lambda a, b: a | b, each)


def middle(values: Column) -> Column:
    """Median of an array, NULLs left out."""
    v = F.array_sort(F.filter(values, lambda x: x.isNotNull()))
    n = F.size(v)
    low, high = F.get(v, F.floor((n - 1) / 2).cast("int")), F.get(v, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (low + high) / 2)


def band_name(raw: Column, position: Column, aliases: dict[str, tuple[str, ...]]) -> Column:
    """The name of a band by an alias of what it is called (case and punctuation don't count), else by its position
    (from 1) among the names, else as it is."""
    plain = lambda x: F.regexp_replace(F.lower(x), "[^a-z0-9]+", "")
    names = list(aliases)
    known = {"".join(ch for ch in a.lower() if ch.isascii() and ch.isalnum()): n for n in reversed(names) for a in aliases[n]}
    by_alias = F.try_element_at(F.create_map(*(F.lit(x) for pair in known.items() for x in pair)), plain(raw))
    return F.coalesce(by_alias, F.get(F.array(*map(F.lit, names)), position - 1), raw)


def product_bands(descriptions: Column, product: Column) -> Column:
    """Positions (from 1) of a radar file's vv and vh, and how they are known: by the bands' descriptions, else by the
    product's code: a single band is vv, two without descriptions are vh and vv.  Anything else is an error."""
    plain = F.transform(descriptions, lambda d: F.regexp_replace(F.upper(F.coalesce(d, F.lit(""))), "[^A-Z0-9]+", ""))
    name, n = F.upper(product), F.size(descriptions)

    def last(band: str) -> Column:
        hits = F.filter(F.transform(plain, lambda d, i: F.when(d.contains(f"SIGMA0{band}") | (d == band), i + 1)), lambda x: x.isNotNull())
        return F.array_max(hits)

    vv, vh, single = last("VV"), last("VH"), name.contains("_1SSV_")
    how = lambda v, h, text: F.struct(v.cast("int").alias("vv"), h.cast("int").alias("vh"), F.lit(text).alias("how"))
    error = F.raise_error(F.concat(F.lit("unknown bands: "), product)).cast("struct<vv:int,vh:int,how:string>")
    return (
        F.when(vv.isNotNull() & (vh.isNotNull() | single), how(vv, vh, "band-descriptions")).when((n == 1) & single, how(F.lit(1), F.lit(None), "safe-single-vv"))
        .when((n >= 2) & name.contains("_1SDV_"), how(F.lit(2), F.lit(1), "audited-dual-vh-vv")).otherwise(error)
    )


def display_name(region: Column, special: dict[str, str]) -> Column:
    """A region's name for people: a special one, or its words with capitals."""
    key = F.lower(F.trim(region))
    out = F.initcap(F.translate(key, "_", " "))
    for k, v in special.items():
        out = F.when(key == k, v).otherwise(out)
    return out


def day_bounds(day: Column) -> tuple[Column, Column]:
    """First and last instant of a day as texts in UTC, to the millisecond."""
    d = F.date_format(day, "yyyy-MM-dd")
    return F.concat(d, F.lit("T00:00:00.000Z")), F.concat(d, F.lit("T23:59:59.999Z"))


def duration(seconds: Column) -> Column:
    """Seconds as 5.0s, 2m 5.0s or 1h 2m 5.0s; NULL is 0."""
    t = F.coalesce(seconds.cast("double"), F.lit(0.0))
    hours, minutes, rest = F.floor(t / 3600).cast("int"), F.floor(t % 3600 / 60).cast("int"), t % 60
    return F.when(t < 60, F.format_string("%.1fs", t)).when(t < 3600, F.format_string("%dm %.1fs", minutes, rest)).otherwise(F.format_string("%dh %dm %.1fs", hours, minutes, rest))


#: Reducers of a pixel's values over time, by name: of a value and what orders it.
REDUCERS = {
    "nanmean": lambda v, order: F.avg(finite(v)),
    "nanmedian": lambda v, order: F.median(finite(v)),
    "lastvalid": lambda v, order: F.max_by(finite(v), F.when(finite(v).isNotNull(), order)),
    "firstvalid": lambda v, order: F.min_by(finite(v), F.when(finite(v).isNotNull(), order)),
}


def reduced(name: str, value: Column, order: Column) -> Column:
    """An aggregate by its name; an unknown one is an error."""
    if name not in REDUCERS:
        raise ValueError(f"unknown reducer: {name}")
    return REDUCERS[name](value, order)
