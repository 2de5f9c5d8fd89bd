"""Heat maps: bins of positions, map pixels, hexagons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questlog.session import written

#: The world's centre and the map's size.
CENTRE = (503.245239, 748.971008)
MAP_SIZE = (512, 512)


def heatmap_bins(rows: DataFrame, level_id: str, event_type: str) -> DataFrame:
    """Events by whole-number position; null positions are a bin."""
    picked = rows.where((F.col("level_id") == F.lit(level_id)) & (F.col("event_type") == F.lit(event_type)))
    return picked.groupBy(F.floor("position_x").alias("bin_x"), F.floor("position_y").alias("bin_y")).agg(F.count("*").alias("events"))


def heatmap_to_map(bins: DataFrame, centre: tuple[float, float] = CENTRE, size: tuple[int, int] = MAP_SIZE) -> DataFrame:
    """Bins in pixels of the map, halves rounded away from zero; null bins are dropped."""
    at = lambda c, i: F.round(F.col(c) - F.lit(centre[i] - size[i] / 2)).cast("long")
    return bins.where("bin_x is not null and bin_y is not null").select(at("bin_x", 0).alias("map_x"), at("bin_y", 1).alias("map_y"), "events")


def heatmap_hexbin(points: DataFrame, grid: int = 25) -> DataFrame:
    """The largest count of a bin in each hexagon, from the nearest centres of two lattices.

    Points, one for each pixel with events, are written first, so that what they come from is worked
    out once. The extent is one row, joined to every point. A zero extent is one cell.
    """
    points = written(points)
    rows = max(1, int(grid / 3**0.5))
    extent = points.agg(F.min("map_x").alias("x0"), F.max("map_x").alias("x1"), F.min("map_y").alias("y0"), F.max("map_y").alias("y1"))
    step = lambda lo, hi, n: F.when(F.col(hi) > F.col(lo), (F.col(hi) - F.col(lo)) / n).otherwise(1.0)
    at = points.crossJoin(F.broadcast(extent)).select(
        ((F.col("map_x") - F.col("x0")) / step("x0", "x1", grid)).alias("u"), ((F.col("map_y") - F.col("y0")) / step("y0", "y1", rows)).alias("v"), "events"
    )
    square = lambda c: c * c
    far = lambda a, b: square(F.col("u") - a) + 3 * square(F.col("v") - b)
    ua, va = F.rint("u"), F.rint("v")
    ub, vb = F.floor("u") + F.lit(0.5), F.floor("v") + F.lit(0.5)
    first = far(ua, va) < far(ub, vb)
    pick = lambda a, b: F.when(first, a).otherwise(b).cast("double")
    return at.groupBy(pick(ua, ub).alias("cell_u"), pick(va, vb).alias("cell_v")).agg(F.max("events").alias("events"))

