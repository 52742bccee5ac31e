"""Counts of rule violations, set comparisons and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def violations(table: DataFrame, rules: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    """How many rows break each rule, in one pass; a NULL outcome is no violation."""
    return table.groupBy(*(keys or [])).agg(F.count("*").alias("n_rows"), *(F.count_if(c).alias(name) for name, c in rules.items()))


def distinct_keys(*columns: str) -> Column:
    """Distinct tuples, those with NULLs too."""
    return F.count_distinct(F.struct(*columns))


def null_profile(table: DataFrame, columns: list[str], top: int = 30) -> DataFrame:
    counted = table.select(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counted.unpivot([], columns, "column_name", "n_null").orderBy(F.desc("n_null"), "column_name").limit(top)


def missing(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    return expected.select(*keys).distinct().join(found.select(*keys).distinct(), keys, "left_anti")


def unique_or_raise(table: DataFrame, keys: list[str]) -> DataFrame:
    """table, after its key is found to be unique."""
    twice = table.groupBy(*keys).count().filter("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"keys that repeat: {[r.asDict() for r in twice]}")
    return table


def polarisation(valid_1: Column, valid_2: Column, paired: Column, share: Column, greater: Column, least: int = 1_000) -> Column:
    """What the two bands of a radar file are likely to be.

    valid_1, valid_2: finite values over 0 of each band; paired: places where both have one; there, share: the
    second band's median by the first's, and greater: the part in which the second is greater.
    """
    return (
        F.when((valid_1 == 0) & (valid_2 == 0), "both_empty").when((valid_1 > 0) & (valid_2 == 0), "band1_only").when((valid_2 > 0) & (valid_1 == 0), "band2_only")
        .when((paired < least) | share.isNull() | F.isnan(share) | (F.abs(share) == float("inf")), "insufficient_paired_samples")
        .when((share >= 1.25) & (greater >= 0.70), "band1_likely_vh_band2_likely_vv")
        .when((share <= 0.80) & (greater <= 0.30), "band1_likely_vv_band2_likely_vh").otherwise("ambiguous")
    )


def one_to_one(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """A join, after the key is found to be unique on both sides."""
    return unique_or_raise(left, keys).join(unique_or_raise(right, keys), keys, how)


def sampled(a: DataFrame, b: DataFrame, key: str, n: int, seed: int = 42, common: bool = True) -> DataFrame:
    """n of the ids that both tables have (common) or either has, by a seeded hash: the same for the same ids, however
    they lie.  Each table's rows of the sample are its left semi-join with the result."""
    ids = a.select(key).intersect(b.select(key)) if common else a.select(key).union(b.select(key)).distinct()
    return ids.filter(F.col(key).isNotNull()).orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def sampled_blocks(blocks: DataFrame, file: str, block: str, pairs: str, target: int, least: int = 1, most: int = 1_000) -> DataFrame:
    """Of each file, blocks in the order of a hash of file and block until there are `least` blocks and target pairs,
    or `most` blocks: what a reader that stops early would read."""
    order = Window.partitionBy(file).orderBy(F.xxhash64(F.col(file), F.col(block)), block)
    t = blocks.withColumn("_i", F.row_number().over(order)).withColumn("_before", F.coalesce(F.sum(pairs).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return t.filter((F.col("_i") <= most) & ((F.col("_i") <= least) | (F.col("_before") < target))).drop("_i", "_before")
