"""Density clusters of points, and their profiles."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from harborline.functions import spatial
from harborline.operators.graphs import components, cut
from harborline.operators.rank import numbered

#: Pairs of boxes with at most so many pairs of points are decided point by point.
FEW_PAIRS = 256


def _around(points: DataFrame, steps: list[tuple[int, int]]) -> DataFrame:
    """points once for each step, with the cell it leads to in cx, cy and their own in ax, ay."""
    step = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps]))
    own = points.withColumnsRenamed({"cx": "ax", "cy": "ay"}).withColumn("__step", step)
    return own.withColumns({"cx": F.col("ax") + F.col("__step.i"), "cy": F.col("ay") + F.col("__step.j")}).drop("__step")


def _near(points: DataFrame, others: DataFrame, eps: float) -> DataFrame:
    """point_id of points with other (and others' further columns) for each of others within eps, by cells of eps / sqrt(2)."""
    steps = [(i, j) for i in range(-2, 3) for j in range(-2, 3)]
    left = _around(points.select(F.col("point_id"), F.col("x").alias("px"), F.col("y").alias("py"), "cx", "cy"), steps)
    pairs = left.join(others.withColumnRenamed("point_id", "other"), ["cx", "cy"])
    return pairs.filter(F.pow(F.col("px") - F.col("x"), 2) + F.pow(F.col("py") - F.col("y"), 2) <= eps * eps).drop("px", "py", "x", "y", "cx", "cy", "ax", "ay", "u", "v")


PART, BOX = ("cx", "cy", "part_x", "part_y"), ("n", "x0", "x1", "y0", "y1")


def _named(df: DataFrame, side: str, columns: tuple[str, ...]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{side}_{c}") for c in columns])


def _parts(core: DataFrame, level: int) -> DataFrame:
    """core with the part of the cell that a point lies in; a cell has 4**level parts."""
    return core.withColumns({f"part_{a}": F.floor(F.col(c) * float(1 << level)).cast("long") for a, c in (("x", "u"), ("y", "v"))})


def _boxes(core: DataFrame, level: int) -> DataFrame:
    """Boxes around the core points of each part."""
    return cut(_parts(core, level).groupBy(*PART).agg(F.count("*").alias("n"), *[f(c).alias(f"{c}{k}") for c in "xy" for k, f in enumerate((F.min, F.max))]))


def _undecided(pairs: DataFrame, eps: float) -> DataFrame:
    """Pairs of boxes a and b that have points within eps of each other, for certain (linked) or maybe (few: look at them)."""
    gap = lambda c: F.greatest(F.col(f"b_{c}0") - F.col(f"a_{c}1"), F.col(f"a_{c}0") - F.col(f"b_{c}1"), F.lit(0.0))
    span = lambda c: F.greatest(F.col(f"b_{c}1") - F.col(f"a_{c}0"), F.col(f"a_{c}1") - F.col(f"b_{c}0"))
    square = lambda f: F.pow(f("x"), 2) + F.pow(f("y"), 2)
    near = pairs.withColumns({"least": square(gap), "linked": square(span) <= eps * eps}).filter(F.col("least") <= eps * eps)
    return cut(near.select(*[f"{s}_{c}" for s in "ab" for c in PART], _cell("a_").alias("a"), _cell("b_").alias("b"), "linked", (F.col("a_n") * F.col("b_n") <= FEW_PAIRS).alias("few")))


def _cell(side: str = "") -> Column:
    """One number for a cell."""
    return F.col(f"{side}cx") * F.lit(1 << 32) + F.col(f"{side}cy")


def _links(core: DataFrame, eps: float) -> DataFrame:
    """Pairs (a, b) of cells with core points within eps of each other, or of cells that other such pairs join anyhow.

    Boxes around the cells' core points decide most pairs; those that don't are cut into four, level by level, and only the
    undecided pairs of parts go on, unless their cells are in one component by then. Pairs of few points are looked at.
    """
    whole, level = _boxes(core, 0), 0
    half = [(i, j) for i in range(3) for j in range(-2, 3) if i > 0 or j > 0]
    left = _around(whole, half).withColumnsRenamed({"ax": "own_x", "ay": "own_y"})
    left = left.select("cx", "cy", F.col("own_x").alias("a_cx"), F.col("own_y").alias("a_cy"), *[F.col(c).alias(f"a_{c}") for c in (*PART[2:], *BOX)])
    pairs = left.join(_named(whole, "b", (*PART, *BOX)), [F.col("cx") == F.col("b_cx"), F.col("cy") == F.col("b_cy")])
    links = whole.select(_cell().alias("a"), _cell().alias("b"))
    while True:
        seen = _undecided(pairs, eps)
        points = _parts(core, level)
        each = seen.filter("few and not linked")
        for s in "ab":
            each = each.join(points.select(*[F.col(c).alias(f"{s}{s}_{c}") for c in (*PART, "x", "y")]), [F.col(f"{s}_{c}") == F.col(f"{s}{s}_{c}") for c in PART])
        close = F.pow(F.col("aa_x") - F.col("bb_x"), 2) + F.pow(F.col("aa_y") - F.col("bb_y"), 2) <= eps * eps
        links = cut(links.unionByName(seen.filter("linked").select("a", "b")).unionByName(each.filter(close).select("a", "b")).distinct())
        open_ = seen.filter("not few and not linked")
        if open_.isEmpty():
            return links
        roots, level = components(links), level + 1
        for s in "ab":
            open_ = open_.join(roots.select(F.col("node").alias(s), F.col("root").alias(f"{s}_root")), s)
        pairs, boxes = open_.filter("a_root <> b_root").select([f"{s}_{c}" for s in "ab" for c in PART]), _boxes(core, level)
        for s in "ab":
            up = [F.col(f"{s}{s}_cx") == F.col(f"{s}_cx"), F.col(f"{s}{s}_cy") == F.col(f"{s}_cy")] + [F.shiftright(f"{s}{s}_{c}", 1) == F.col(f"{s}_{c}") for c in PART[2:]]
            pairs = pairs.join(_named(boxes, s + s, (*PART, *BOX)), up)
        pairs = pairs.select(*[F.col(f"{s}{s}_{c}").alias(f"{s}_{c}") for s in "ab" for c in (*PART, *BOX)])


def dbscan(points: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """points (point_id, x, y, ...) with cluster_id: from 0 in the order of the least core point, -1 for noise.

    A point is a core point if at least min_samples points, itself included, lie within eps. Core points within eps of
    each other share a cluster; another point near a core point joins the least such cluster.

    Points meet in cells whose diagonal is just under eps: all points of a cell with min_samples of them are core points, and
    core points of one cell share a cluster. So only points of other cells, fewer than min_samples in each, are compared with
    points around them, and only cells are linked and contracted to clusters, not points.
    """
    side = eps / math.sqrt(2) * (1 - 1e-12)
    placed = points.select("point_id", "x", "y", (F.col("x") / side).alias("u"), (F.col("y") / side).alias("v")).filter("u is not null and v is not null")
    placed = cut(placed.withColumns({"cx": F.floor("u").cast("long"), "cy": F.floor("v").cast("long")}))
    crowded = cut(placed.groupBy("cx", "cy").agg(F.count("*").alias("n"))).filter(F.col("n") >= min_samples).select("cx", "cy")
    loose = placed.join(crowded, ["cx", "cy"], "left_anti")
    enough = _near(loose, placed, eps).groupBy("point_id").agg(F.count("*").alias("n")).filter(F.col("n") >= min_samples).select("point_id")
    core = cut(placed.join(crowded, ["cx", "cy"], "left_semi").select(placed.columns).unionByName(loose.join(enough, "point_id", "left_semi").select(placed.columns)))
    cells = components(_links(core, eps)).select(F.col("node").alias("cell"), "root")
    rooted = core.withColumn("cell", _cell()).join(cells, "cell").drop("cell")
    least = rooted.groupBy("root").agg(F.min("point_id").alias("label"))
    labelled = cut(rooted.join(least, "root").select(*core.columns, "label"))
    border = _near(loose.join(core.select("point_id"), "point_id", "left_anti"), labelled, eps).groupBy("point_id").agg(F.min("label").alias("label"))
    named = labelled.select("point_id", "label").unionByName(border)
    cell = F.floor(F.col("label") / 65_536) if isinstance(points.schema["point_id"].dataType, NumericType) else None
    order = numbered(least.select("label"), [F.col("label")], "n", cell).select("label", (F.col("n") - 1).alias("cluster_id"))
    out = points.join(named.join(order, "label").drop("label"), "point_id", "left")
    return out.withColumn("cluster_id", F.coalesce("cluster_id", F.lit(-1)))


def summary(clustered: DataFrame, vessel: str = "mmsi", ts: str | None = None) -> DataFrame:
    """cluster_id, point_count, vessel_count, centre_x, centre_y (and first and last time); no noise; largest first."""
    times = [F.min(ts).alias("min_time"), F.max(ts).alias("max_time")] if ts else []
    rows = clustered.filter("cluster_id >= 0").groupBy("cluster_id").agg(
        F.count("*").alias("point_count"), F.countDistinct(vessel).alias("vessel_count"), F.avg("x").alias("centre_x"), F.avg("y").alias("centre_y"), *times)
    return rows.orderBy(F.desc("vessel_count"), F.desc("point_count"), "cluster_id")


def profiles(clustered: DataFrame, heading: str | None = None, *, margin: float = 30.0, least: tuple[float, float] = (80.0, 40.0)) -> DataFrame:
    """cluster_id, centre, principal axis, and length and width: the middle 96 % along and across the axis, plus a margin."""
    members = clustered.filter("cluster_id >= 0")
    heads = [c.alias(n) for c, n in zip(spatial.axis_mean(F.col(heading)), ("heading_axis_degrees", "heading_concentration"), strict=True)] if heading else []
    centre = members.groupBy("cluster_id").agg(
        F.count("*").alias("point_count"), F.avg("x").alias("centre_x"), F.avg("y").alias("centre_y"), spatial.principal_axis(F.col("x"), F.col("y")).alias("axis_degrees"), *heads)
    turn = F.radians("axis_degrees")
    dx, dy = F.col("x") - F.col("centre_x"), F.col("y") - F.col("centre_y")
    along = members.join(centre.select("cluster_id", "centre_x", "centre_y", "axis_degrees"), "cluster_id").select(
        "cluster_id", (dx * F.cos(turn) + dy * F.sin(turn)).alias("u"), (dy * F.cos(turn) - dx * F.sin(turn)).alias("v"))
    spans = along.groupBy("cluster_id").agg(
        F.greatest(F.percentile("u", 0.98) - F.percentile("u", 0.02) + margin, F.lit(least[0])).alias("length_metres"),
        F.greatest(F.percentile("v", 0.98) - F.percentile("v", 0.02) + margin, F.lit(least[1])).alias("width_metres"))
    return centre.join(spans, "cluster_id")
