"""Pixel addresses and planar polygons (rings as arrays of structs x, y) in Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def global_cell(lon: Column, lat: Column, resolution: float = 0.0009765625, columns: int = 368_640) -> Column:
    return (F.floor((60 - lat) / resolution) * columns + F.floor((lon + 180) / resolution)).cast("long")


def flat_pixel(row: Column, col: Column, width: int) -> Column:
    return row * width + col


def tile(row: Column, col: Column, size: int, width: int) -> Column:
    return (F.floor(row / size) * (-(-width // size)) + F.floor(col / size)).cast("long")


def _edges(ring: Column) -> Column:
    n = F.size(ring)
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(ring, i.cast("int")).alias("p"), F.get(ring, ((i + 1) % n).cast("int")).alias("q")))


def inside(ring: Column, x: Column, y: Column) -> Column:
    """Whether a point is in the polygon, by the parity of crossings of a ray to the right."""

    def crosses(e: Column) -> Column:
        p, q = e["p"], e["q"]
        return ((p["y"] > y) != (q["y"] > y)) & (x < (q["x"] - p["x"]) * (y - p["y"]) / F.nullif(q["y"] - p["y"], F.lit(0.0)) + p["x"])

    return F.size(F.filter(_edges(ring), lambda e: F.coalesce(crosses(e), F.lit(False)))) % 2 == 1


def boundary_distance(ring: Column, x: Column, y: Column) -> Column:
    def to_edge(e: Column) -> Column:
        dx, dy = e["q"]["x"] - e["p"]["x"], e["q"]["y"] - e["p"]["y"]
        t = F.coalesce(F.try_divide((x - e["p"]["x"]) * dx + (y - e["p"]["y"]) * dy, dx * dx + dy * dy), F.lit(0.0))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
        return F.sqrt(F.pow(x - e["p"]["x"] - t * dx, 2) + F.pow(y - e["p"]["y"] - t * dy, 2))

    return F.array_min(F.transform(_edges(ring), to_edge))


def ring_area(ring: Column) -> Column:
    each = F.transform(_edges(ring), lambda e: e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"])
    return F.abs(F.aggregate(each, F.lit(0.0), lambda a, b: a + b)) / 2


def rectangle_overlap(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Shared area of two rectangles (x0, y0, x1, y1)."""
    w = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    h = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.greatest(F.lit(0.0), w) * F.greatest(F.lit(0.0), h)


def pixel_window(bounds: dict[str, Column], x0: float, y1: float, size: float, width: int, height: int) -> dict[str, Column]:
    """Rows and columns of a grid (its upper left corner x0, y1) that bounds (x0, y0, x1, y1) touch, clipped to it; NULL if none."""
    left, right = F.greatest(F.lit(0), F.floor((bounds["x0"] - x0) / size)), F.least(F.lit(width), F.ceil((bounds["x1"] - x0) / size))
    top, bottom = F.greatest(F.lit(0), F.floor((y1 - bounds["y1"]) / size)), F.least(F.lit(height), F.ceil((y1 - bounds["y0"]) / size))
    some = (right > left) & (bottom > top)
    return {"col": F.when(some, left), "row": F.when(some, top), "n_cols": F.when(some, right - left), "n_rows": F.when(some, bottom - top)}


def snapped(bounds: dict[str, Column], size: float) -> dict[str, Column]:
    """Bounds moved outwards to multiples of size."""
    return {k: (F.floor(v / size) if k in ("x0", "y0") else F.ceil(v / size)) * size for k, v in bounds.items()}


def quarters(bounds: dict[str, Column]) -> Column:
    """The four quarters of a rectangle, as an array of structs x0, y0, x1, y1, by rows from below."""
    xs = [bounds["x0"], (bounds["x0"] + bounds["x1"]) / 2, bounds["x1"]]
    ys = [bounds["y0"], (bounds["y0"] + bounds["y1"]) / 2, bounds["y1"]]
    return F.array(*(F.struct(xs[i].alias("x0"), ys[j].alias("y0"), xs[i + 1].alias("x1"), ys[j + 1].alias("y1")) for j in (0, 1) for i in (0, 1)))


def rectangle_wkt(bounds: dict[str, Column], places: int = 6) -> Column:
    """A rectangle as closed WKT, from its lower left corner against the clock."""
    n = f"%.{places}f"
    corners = [("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")]
    return F.format_string("POLYGON((" + ", ".join(f"{n} {n}" for _ in corners) + "))", *(bounds[c] for pair in corners for c in pair))


def ring_wkt(ring: Column, places: int = 6) -> Column:
    """A ring as WKT, closed with its first point."""
    point = lambda p: F.format_string(f"%.{places}f %.{places}f", p["x"], p["y"])
    return F.concat(F.lit("POLYGON(("), F.array_join(F.transform(F.concat(ring, F.slice(ring, 1, 1)), point), ", "), F.lit("))"))
