"""Choice of scenes: the best few of each group, and greedy cover of an area."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_of(table: DataFrame, keys: list[str], *order: Column, n: int = 1) -> DataFrame:
    """The first n rows of each group in this order."""
    return table.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_rank") <= n).drop("_rank")


def greedy_cover(scenes: DataFrame, keys: list[str], target: float = 0.995, limit: int = 0) -> DataFrame:
    """Of each group, scenes (rectangles x0, y0, x1, y1 with an id) in the order in which each adds most area of the
    unit square, until the target share is covered, nothing adds more, or there are limit of them (0: no limit).

    Every scene of a group is a candidate.  Of equal gains (to 12 places) the larger rectangle within the square goes
    first, then the smaller id.  A group of which no scene meets the square keeps its smallest id, with a gain of 0.
    Scenes that are one rectangle within the square are one candidate, with the smallest id: the others could add
    nothing after it.  Each choice depends on the ones before, so that the rest is a grouped function; it keeps what
    is uncovered as rectangles, and so needs memory for the candidates and for these, but for no grid."""
    kinds = ", ".join(f"{k} {dict(scenes.dtypes)[k]}" for k in keys)
    sides = ["x0", "y0", "x1", "y1"]

    def cover(group: pd.DataFrame) -> pd.DataFrame:
        rects = group[sides].to_numpy(float)
        gains = np.nan_to_num((rects[:, 2] - rects[:, 0]).clip(0) * (rects[:, 3] - rects[:, 1]).clip(0))
        order = np.lexsort((group["scene_id"].to_numpy(), -gains.round(12)))
        rects, gains, ids = rects[order], gains[order], group["scene_id"].to_numpy()[order]
        bare, covered, out = [(0.0, 0.0, 1.0, 1.0)], 0.0, []
        while not limit or len(out) < limit:
            best = int(np.argmax(gains.round(12)))
            gain = float(gains[best])
            if gain <= 1e-12:
                break
            x0, y0, x1, y1 = rects[best].tolist()
            kept = []
            for a0, b0, a1, b1 in bare:
                c0, d0, c1, d1 = max(a0, x0), max(b0, y0), min(a1, x1), min(b1, y1)
                if c0 >= c1 or d0 >= d1:
                    kept.append((a0, b0, a1, b1))
                    continue
                gains -= (np.minimum(rects[:, 2], c1) - np.maximum(rects[:, 0], c0)).clip(0) * (np.minimum(rects[:, 3], d1) - np.maximum(rects[:, 1], d0)).clip(0)
                kept += [r for r in ((a0, b0, c0, b1), (c1, b0, a1, b1), (c0, b0, c1, d0), (c0, d1, c1, b1)) if r[0] < r[2] and r[1] < r[3]]
            bare, covered = kept, covered + gain
            gains[best] = 0.0
            out.append((*(group[k].iloc[0] for k in keys), ids[best], len(out) + 1, gain, covered))
            if covered >= target - 1e-12:
                break
        if not out:
            out = [(*(group[k].iloc[0] for k in keys), ids.min(), 1, 0.0, 0.0)]
        return pd.DataFrame(out, columns=[*keys, "scene_id", "step", "gain", "covered"])

    within = [F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(c).cast("double"))).alias(c) for c in sides]
    whole = [F.when(F.greatest(*(F.col(c).isNull() | F.isnan(c) for c in sides)), None).otherwise(x).alias(c) for c, x in zip(sides, within)]
    apart = scenes.select(*keys, "scene_id", *whole).groupBy(*keys, *sides).agg(F.min("scene_id").alias("scene_id"))
    return apart.groupBy(*keys).applyInPandas(cover, f"{kinds}, scene_id long, step long, gain double, covered double")


def scored(table: DataFrame, key: str, score, schema: str) -> DataFrame:
    """A model (a function of a group's whole history as pandas) applied to each entity."""
    return table.groupBy(key).applyInPandas(score, schema)
