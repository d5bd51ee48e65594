"""Joins of points with circles and polygons through a grid of cells: an equality join, then the exact test.

Circles and polygons are written with their cells before points meet them, so that Spark's size check knows how small they
are: few of them are broadcast, and points in few cells then don't meet in few tasks.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.functions import spatial
from harborline.operators.graphs import cut

CELL_DEGREES = 0.05


def _cells(x0, y0, x1, y1, size: float):
    """All cells that a box touches."""
    cell = lambda v: F.floor(v / size).cast("int")
    xs, ys = F.sequence(cell(x0), cell(x1)), F.sequence(cell(y0), cell(y1))
    return F.flatten(F.transform(xs, lambda i: F.transform(ys, lambda j: F.struct(i.alias("__cx"), j.alias("__cy")))))


def within_distance(points: DataFrame, centres: DataFrame, *, lat: str = "latitude", lon: str = "longitude", centre_lat: str = "centre_latitude", centre_lon: str = "centre_longitude", radius: str = "radius_metres", cell: float = CELL_DEGREES) -> DataFrame:
    """points with each centre within its radius: centres' columns and distance_metres."""
    high, wide = spatial.degrees_box(F.col(radius), F.col(centre_lat))
    boxed = centres.withColumn("__cell", F.explode(_cells(F.col(centre_lon) - wide, F.col(centre_lat) - high, F.col(centre_lon) + wide, F.col(centre_lat) + high, cell)))
    here = points.withColumns({"__cx": F.floor(F.col(lon) / cell).cast("int"), "__cy": F.floor(F.col(lat) / cell).cast("int")})
    near = here.join(cut(boxed.select("*", "__cell.*").drop("__cell")), ["__cx", "__cy"]).drop("__cx", "__cy")
    far = spatial.distance_m(F.col(lat), F.col(lon), F.col(centre_lat), F.col(centre_lon))
    return near.withColumn("distance_metres", far).filter(F.col("distance_metres") <= F.col(radius))


def in_polygons(points: DataFrame, zones: DataFrame, *, x: str = "longitude", y: str = "latitude", polygon: str = "polygon", cell: float = CELL_DEGREES) -> DataFrame:
    """points with each zone that covers them (boundary included); several hits stay."""
    box = zones.withColumns({"__b": spatial.bounds(F.col(polygon)), "__sides": spatial.sides(F.col(polygon))})
    boxed = box.withColumn("__cell", F.explode(_cells(F.col("__b.x0"), F.col("__b.y0"), F.col("__b.x1"), F.col("__b.y1"), cell)))
    here = points.withColumns({"__cx": F.floor(F.col(x) / cell).cast("int"), "__cy": F.floor(F.col(y) / cell).cast("int")})
    near = here.join(cut(boxed.select("*", "__cell.*").drop("__cell")), ["__cx", "__cy"]).drop("__cx", "__cy")
    inside = F.col(x).between(F.col("__b.x0"), F.col("__b.x1")) & F.col(y).between(F.col("__b.y0"), F.col("__b.y1"))
    return near.filter(inside & spatial.enclosed(F.col("__sides"), F.col(x), F.col(y))).drop("__b", "__sides")
