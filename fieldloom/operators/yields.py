"""Productivity between season boundaries, crop yield and its flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import overlap_days
from ..functions.expr import nearest, ratio

#: Carbon productivity to total biomass, and for each crop the factors low, central and high.
NPP_TO_BIOMASS = 0.022222
CROPS = {
    "maize": {"fc": (1.8, 1.8, 1.8), "aot": (0.65, 0.65, 0.65), "hi": (0.48, 0.50, 0.52), "moisture": (0.10, 0.125, 0.15)},
    "beans": {"fc": (1.0, 1.0, 1.0), "aot": (0.65, 0.65, 0.65), "hi": (0.38, 0.50, 0.85), "moisture": (0.12, 0.14, 0.15)},
    "potatoes": {"fc": (1.0, 1.0, 1.0), "aot": (1.0, 1.0, 1.0), "hi": (0.70, 0.79, 0.85), "moisture": (0.75, 0.79, 0.80)},
}
LEVELS = ("low", "central", "high")
FACTORS = ("fc", "aot", "hi", "moisture")


def crop_factors(spark: SparkSession, crops: dict = CROPS) -> DataFrame:
    """A row a crop: crop, and each factor at each level (fc_low and so on)."""
    rows = [(c, *(float(x) for f in FACTORS for x in v[f])) for c, v in crops.items()]
    return spark.createDataFrame(rows, "crop string, " + ", ".join(f"{f}_{x} double" for f in FACTORS for x in LEVELS))


def crop_yield(biomass: Column, level: str) -> Column:
    """Tonnes a hectare at a level (low, central, high); the factors are columns."""
    return ratio(biomass * F.col(f"fc_{level}") * F.col(f"aot_{level}") * F.col(f"hi_{level}"), nearest(1 - F.col(f"moisture_{level}"), 12))  # 0.2, not 1 - 0.8 in doubles


def bounds(days: int, first: Column, last: Column) -> dict[str, tuple[Column, Column]]:
    """Start and end of a season: central, narrow (both moved in; one day at least is left) and wide (both moved out, up to the season's first and last day)."""
    sos, eos = F.col("sos"), F.col("eos")
    inner = F.least(eos, F.date_add(sos, days))
    return {"central": (sos, eos), "narrow": (inner, F.greatest(inner, F.date_sub(eos, days))), "wide": (F.greatest(first, F.date_sub(sos, days)), F.least(last, F.date_add(eos, days)))}


def integrated(seasons: DataFrame, periods: DataFrame, key: str, shift: int = 10) -> DataFrame:
    """Productivity of each field between sos and eos, and between the bounds moved in and out by `shift` days, in one pass.

    seasons: key, sos, eos, season_first, season_last.  periods: key, period_start, period_end, rate (a day), coverage
    and, if it is there, effective_pixels.
    An equi-join by field with the overlap as its residual; the three variants are conditional sums of one aggregate.
    """
    variants = bounds(shift, F.col("season_first"), F.col("season_last"))
    joined = seasons.join(periods, key, "left").sortWithinPartitions(key, "period_start")  # a sum of doubles depends on the order
    shares = {"_c": "coverage"} | ({"_p": "effective_pixels"} if "effective_pixels" in periods.columns else {})
    sums = []
    for name, (start, end) in variants.items():
        d = overlap_days(start, end, F.col("period_start"), F.col("period_end"))
        valid = F.when(F.col("rate").isNotNull(), d)
        sums += [F.sum(F.col("rate") * valid).alias(f"npp_{name}"), F.sum(valid).alias(f"days_{name}"), *(F.sum(F.col(c) * valid).alias(f"{k}_{name}") for k, c in shares.items()), F.count(F.when(valid > 0, 1)).alias(f"periods_{name}")]
    out = joined.groupBy(key, "sos", "eos", "season_first", "season_last").agg(*sums)
    for name, (start, end) in variants.items():
        out = out.withColumn(f"temporal_{name}", ratio(F.coalesce(F.col(f"days_{name}"), F.lit(0)), F.datediff(end, start) + 1))
        for k, to in (("_c", f"spatial_{name}"), ("_p", f"pixels_{name}")):
            if k in shares:
                out = out.withColumn(to, ratio(F.col(f"{k}_{name}"), F.when(F.col(f"days_{name}") > 0, F.col(f"days_{name}")))).drop(f"{k}_{name}")
    return out.drop("season_first", "season_last")


def intercrop(pattern: Column, mixed: Column, mono: Column | None = None) -> Column:
    """yes, no or unknown, from what a survey says: a mixed crop or pattern, else a single crop or pattern."""
    p = F.lower(F.trim(F.coalesce(pattern, F.lit(""))))
    m, single = (F.trim(F.coalesce(x, F.lit(""))) for x in (mixed, F.lit("") if mono is None else mono))
    return F.when((m != "") | p.rlike("mix|intercrop"), "yes").when((single != "") | p.rlike("mono|single"), "no").otherwise("unknown")


def survey_answers(table: DataFrame, season: str) -> tuple[Column, Column]:
    """Intercrop class and crop text for a season of kind lr (columns that end in _2) or sr (no suffix).

    Each answer is that of the short form and that of the long one, whichever of them the table has; a NULL is no answer."""
    suffix = {"lr": "_2", "sr": ""}[season]

    def said(name: str) -> Column:
        there = [F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in (f"{name}{suffix}", f"lngsht_{name}{suffix}") if c in table.columns]
        return F.trim(F.concat_ws(" ", *there)) if there else F.lit("")

    mixed, mono = said("croptype_mixed"), said("croptype_mono")
    return intercrop(said("cropping_pattern"), mixed, mono), F.when(mixed != "", mixed).when(mono != "", mono)


def _words(text: Column) -> Column:
    return F.split(F.translate(F.lower(F.trim(text)), "_-", "  "), r"\s+")


def survey_match(text: Column, aliases: list[str]) -> Column:
    """Whether a crop is named; NULL if nothing is."""
    return F.when(F.trim(text) != "", F.arrays_overlap(_words(text), F.array(*map(F.lit, aliases))))


#: The names by which a survey may call a crop; any other crop has its own only.
ALIASES = {"maize": ("maize", "corn"), "beans": ("bean", "beans"), "potatoes": ("potato", "potatoes")}


def survey_agrees(crop: Column, text: Column) -> Column:
    """Whether the survey names the row's crop; NULL if it names nothing."""
    names = F.array(F.lower(crop))
    for c, known in ALIASES.items():
        names = F.when(F.lower(crop) == c, F.array(*map(F.lit, known))).otherwise(names)
    return F.when(F.trim(text) != "", F.arrays_overlap(_words(text), names))


def joined_reasons(reasons: dict[str, Column]) -> Column:
    """The names of the conditions that hold, in order, with ; between; NULL counts as not."""
    return F.concat_ws(";", *(F.when(c, F.lit(name)) for name, c in reasons.items()))


def season_yield(fields: DataFrame, predictions: DataFrame, phenology: DataFrame, metrics: DataFrame, factors: DataFrame, confidence: float = 0.0, temporal: float = 0.8, spatial: float = 0.8, places: int | None = 12) -> DataFrame:
    """A row for every field: its crop, season, productivity, yield and production at three levels, and all reasons
    why there is no yield.

    fields: field_id, county, area_ha, intercrop_status, survey_crop_text.  predictions: field_id, county,
    seasonal_label, seasonal_confidence, status.  phenology: as of seasons().  metrics: as of integrated().
    factors: as of crop_factors(), a row a crop, and so broadcast.  What is missing is NULL and no reason to drop a field.
    places: to which shares are rounded before they are held against their bounds, so that one on its bound is not below
    it by a sum's last bits; None: the doubles as they are.
    """
    t = fields.join(predictions, ["field_id", "county"], "left").join(phenology, "field_id", "left").join(metrics.drop("sos", "eos"), "field_id", "left")
    label = F.lower(F.coalesce("seasonal_label", F.lit("unclassified")))
    t = t.withColumn("crop_label", F.when(label == "unclassified", "Unclassified").otherwise(label)).withColumn("intercrop_status", F.coalesce("intercrop_status", F.lit("unknown")))
    t = t.withColumn("survey_crop_match", survey_agrees(F.col("crop_label"), F.col("survey_crop_text")))
    t = t.join(F.broadcast(factors.withColumnRenamed("crop", "crop_label")), "crop_label", "left")
    sure = lambda c: F.coalesce(c, F.lit(False))
    supported, final = F.col("fc_central").isNotNull(), sure(F.col("status") == "final")
    confident, mixed = sure(F.col("seasonal_confidence") >= confidence), F.col("intercrop_status") == "yes"
    mismatch = (F.col("intercrop_status") == "no") & sure(~F.col("survey_crop_match"))
    share = lambda c: F.col(c) if places is None else nearest(F.col(c), places)
    long, wide = (sure(share(c) >= least) for c, least in (("temporal_central", temporal), ("spatial_central", spatial)))
    known = F.col("npp_central").isNotNull()
    eligible = supported & final & confident & ~mixed & ~mismatch & long & wide & known
    unsure = eligible & (F.col("intercrop_status") == "unknown")
    flags = {
        "unsupported_or_unclassified_crop": ~supported, "seasonal_status_not_final": ~final, "crop_confidence_below_threshold": ~confident,
        "mixed_crop_biomass_only": mixed, "survey_crop_mismatch": mismatch, "low_npp_temporal_coverage": ~long & supported & final,
        "low_npp_spatial_coverage": ~wide & supported & final, "missing_npp": ~known & supported & final, "intercrop_unknown": unsure,
    }
    made = {x: F.when(eligible, crop_yield(F.col("npp_central") * NPP_TO_BIOMASS, x)) for x in LEVELS}
    return t.select(
        "field_id", "county", "area_ha", "crop_label", F.col("seasonal_confidence").alias("crop_confidence"), F.col("status").alias("crop_status"), "intercrop_status", "survey_crop_text", "survey_crop_match",
        "sos", "peak_date", "eos", F.col("method").alias("phenology_method"), F.col("confidence").alias("phenology_confidence"), F.col("qa_status").alias("phenology_qa_status"), "optical_valid_weeks", "sar_supported_weeks",
        F.col("npp_central").alias("seasonal_npp"), F.col("days_central").alias("npp_valid_days"), (F.datediff("eos", "sos") + 1).alias("npp_total_days"), F.col("temporal_central").alias("npp_temporal_coverage"), F.col("spatial_central").alias("npp_spatial_coverage"), F.col("periods_central").alias("npp_periods_used"),
        (F.col("npp_central") * NPP_TO_BIOMASS).alias("biomass"), *(v.alias(f"yield_{x}") for x, v in made.items()), *((v * F.col("area_ha")).alias(f"production_{x}") for x, v in made.items()),
        *(F.when(eligible, crop_yield(F.col(f"npp_{v}") * NPP_TO_BIOMASS, "central")).alias(f"yield_{v}") for v in ("narrow", "wide")),
        F.when(unsure, "calculated_unvalidated_intercrop_unknown").when(eligible, "calculated_unvalidated").otherwise("not_calculated").alias("yield_status"), joined_reasons(flags).alias("qa_flags"),
    )
