"""Outlines of areas that points cover: a raster of cells, widened and closed, and the polygons around it.

Points become cells of a grid at once, so all that follows is of the size of the area in cells, not of the points. Widening
and closing are joins of cells with the cells around them; parts are connected components; a part's outline is traced
along the sides of its cells that no neighbour shares. A polygon is one row, so one task traces one part.
"""

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.functions import spatial
from harborline.operators.graphs import components, cut


def cells(points: DataFrame, cell: float, x: str = "x", y: str = "y") -> DataFrame:
    """cx, cy: the cells with a point."""
    return points.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.floor(F.col(x) / cell).cast("long").alias("cx"), F.floor(F.col(y) / cell).cast("long").alias("cy")).distinct()


def _disc(radius: float, cell: float) -> Column:
    """Steps to the cells whose centres are within a radius."""
    reach = int(radius / cell)
    near = [(i, j) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1) if math.hypot(i, j) * cell <= radius]
    return F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in near])


def _votes(area: DataFrame, disc: Column) -> DataFrame:
    """Each cell that cells of the area reach, with the number of those that do."""
    reached = area.select("cx", "cy", F.explode(disc).alias("s")).select((F.col("cx") + F.col("s.i")).alias("cx"), (F.col("cy") + F.col("s.j")).alias("cy"))
    return reached.groupBy("cx", "cy").agg(F.count("*").alias("n"))


def widened(area: DataFrame, radius: float, cell: float) -> DataFrame:
    return _votes(area, _disc(radius, cell)).select("cx", "cy")


def narrowed(area: DataFrame, radius: float, cell: float) -> DataFrame:
    """The cells all of whose surroundings are in the area."""
    disc = _disc(radius, cell)
    return _votes(area, disc).filter(F.col("n") == F.size(disc)).select("cx", "cy")


def closed(area: DataFrame, radius: float, cell: float) -> DataFrame:
    """The area with gaps of up to twice the radius filled."""
    return narrowed(widened(area, radius, cell), radius, cell) if radius >= cell else area


def parts(area: DataFrame, cell: float, least_area: float = 0.0) -> DataFrame:
    """cx, cy, part: cells of one part are joined side by side; parts of less than an area go."""
    number = lambda x, y: x * F.lit(1 << 32) + y
    here = cut(area.select("cx", "cy", number(F.col("cx"), F.col("cy")).alias("node")))
    beside = here.select("node", F.explode(F.array(F.lit(0), F.lit(1 << 32), F.lit(1))).alias("step")).select(F.col("node").alias("a"), (F.col("node") + F.col("step")).alias("b"))
    links = beside.join(here.select(F.col("node").alias("b")), "b")
    named = here.join(components(links).withColumnRenamed("root", "part"), "node").select("cx", "cy", "part")
    large = named.groupBy("part").agg(F.count("*").alias("n")).filter(F.col("n") * (cell * cell) >= least_area).select("part")
    return named.join(large, "part").select("cx", "cy", "part")


def _sides(area: DataFrame) -> DataFrame:
    """part, x, y, dx, dy: the sides of cells without a neighbour of their part, from their first corner, the cell on the left."""
    around = ((0, 0, 1, 0, 0, -1), (1, 0, 0, 1, 1, 0), (1, 1, -1, 0, 0, 1), (0, 1, 0, -1, -1, 0))  # corner, direction, neighbour
    side = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("x", "y", "dx", "dy", "i", "j"), s, strict=True)]) for s in around]))
    each = area.select("part", "cx", "cy", side.alias("s"))
    each = each.select("part", (F.col("cx") + F.col("s.x")).alias("x"), (F.col("cy") + F.col("s.y")).alias("y"), "s.dx", "s.dy", (F.col("cx") + F.col("s.i")).alias("cx"), (F.col("cy") + F.col("s.j")).alias("cy"))
    return each.join(area.select("cx", "cy", "part"), ["part", "cx", "cy"], "left_anti").select("part", "x", "y", "dx", "dy")


def rings(sides: Iterator[tuple[int, int, int, int]]) -> list[list[tuple[int, int]]]:
    """Corners of the closed lines that sides (x, y, dx, dy) make. Where lines touch, each turns left, so none crosses another."""
    ahead: dict[tuple[int, int], set[tuple[int, int]]] = {}
    for x, y, dx, dy in sides:
        ahead.setdefault((x, y), set()).add((dx, dy))
    found = []
    for start in sorted(ahead):
        while ahead[start]:
            at, way, ring = start, min(ahead[start]), []
            while way in ahead[at]:
                ahead[at].remove(way)
                x, y = at[0] + way[0], at[1] + way[1]
                left, right = (-way[1], way[0]), (way[1], -way[0])
                turn = next((w for w in (left, way, right) if w in ahead[x, y]), None)
                if turn != way:
                    ring.append((x, y))
                at, way = (x, y), turn
            found.append(ring)
    return found


def _traced(cell: float, holes: bool):
    def run(sides: pd.DataFrame) -> pd.DataFrame:
        each = []
        for ring in rings(sides[["x", "y", "dx", "dy"]].itertuples(index=False, name=None)):
            area = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))
            each.append((area, [{"x": x * cell, "y": y * cell} for x, y in ring]))
        outer = max(each)
        inner = [r for r in each if r is not outer] if holes else []
        return pd.DataFrame({"part": [int(sides["part"].iloc[0])], "polygon": [[r for _, r in (outer, *sorted(inner, key=lambda r: r[0]))]]})

    return run


def polygons(area: DataFrame, cell: float, holes: bool = True) -> DataFrame:
    """part, polygon (in the units of the points), cell_count: of cx, cy, part. The outer line is anticlockwise."""
    traced = _sides(area).groupBy("part").applyInPandas(_traced(cell, holes), f"part bigint, polygon {spatial.POLYGON}")
    return traced.join(area.groupBy("part").agg(F.count("*").alias("cell_count")), "part")


def outlines(points: DataFrame, *, cell: float, buffer: float, closing: float = 0.0, least_area: float = 0.0, holes: bool = True, x: str = "x", y: str = "y") -> DataFrame:
    """part, polygon, cell_count: outlines of what lies within `buffer` of points, with gaps closed, without small parts."""
    return polygons(cut(parts(closed(widened(cells(points, cell, x, y), buffer, cell), closing, cell), cell, least_area)), cell, holes)
