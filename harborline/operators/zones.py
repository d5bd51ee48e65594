"""Zones from evidence: which points speak for an anchorage, a manoeuvring area, a channel or an approach; templates."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.functions import spatial
from harborline.operators import clusters, outlines
from harborline.operators.rank import numbered


def west_to_east(profiles: DataFrame, expected: int = 3) -> DataFrame:
    """Cluster profiles numbered from 1 by centre_x; raises unless there are as many as expected."""
    n = profiles.count()
    if n != expected:
        raise ValueError(f"{n} clusters found, {expected} expected")
    return numbered(profiles, [F.col("centre_x"), F.col("cluster_id")], "place")


def paired(templates: DataFrame, profiles: DataFrame, expected: int = 3) -> DataFrame:
    """Template zones (with polygon) and cluster profiles, the k-th from the west with the k-th."""
    named = templates.withColumn("__c", spatial.centroid(F.col("polygon")))
    left = numbered(named, [F.col("__c.x"), F.col("zone_code")], "place").drop("__c")
    return left.join(west_to_east(profiles, expected), "place")


def fitted(pairs: DataFrame) -> DataFrame:
    """Each template's polygon scaled to its cluster's length and width, turned to its axis and moved to its centre.

    The template's own length, width and direction are those of the smallest rectangle around it.
    """
    sized = pairs.withColumns({"__r": spatial.rectangle(F.col("polygon")), "__c": spatial.centroid(F.col("polygon"))})
    level = sized.withColumn("polygon", spatial.moved(F.col("polygon"), degrees=-F.col("__r.angle"), about=F.col("__c")))
    shape = spatial.moved(
        F.col("polygon"), dx=F.col("centre_x") - F.col("__c.x"), dy=F.col("centre_y") - F.col("__c.y"),
        scale_x=F.col("length_metres") / F.col("__r.length"), scale_y=F.col("width_metres") / F.col("__r.width"),
        degrees=F.col("axis_degrees"), about=F.col("__c"))
    return level.withColumn("polygon", shape).drop("__r", "__c")


def normalised(zones: DataFrame, width: float = 10_000.0) -> DataFrame:
    """Zones (polygons in metres) scaled about the middle of them all, so that together they are `width` wide."""
    box = zones.select(spatial.bounds(F.col("polygon")).alias("b")).agg(F.min("b.x0").alias("x0"), F.min("b.y0").alias("y0"), F.max("b.x1").alias("x1"), F.max("b.y1").alias("y1"))
    middle = F.struct(((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"))
    scale = F.lit(width) / (F.col("x1") - F.col("x0"))
    joined = zones.crossJoin(F.broadcast(box)).withColumns({"__m": middle, "__s": scale})
    return joined.withColumn("polygon", spatial.moved(F.col("polygon"), scale_x=F.col("__s"), scale_y=F.col("__s"), about=F.col("__m"))).select(zones.columns)


def invalid(zones: DataFrame, least_area: float = 1.0) -> DataFrame:
    """Zones whose outline crosses itself or that are too small, with the reason."""
    reason = F.when(~spatial.is_simple(F.col("polygon")), "outline crosses itself").when(spatial.area(F.col("polygon")) < least_area, "too small")
    return zones.withColumn("reason", reason).filter("reason is not null").select("zone_code", "reason")


def repaired(zones: DataFrame, least_area: float = 1.0) -> DataFrame:
    """zones with a row (part, polygon) for each polygon that is left when outlines are cut where they cross or touch themselves
    or each other. What an odd number of turns goes around is covered, and lines around less than an area are dropped. A zone
    without faults keeps its shape; one with nothing left has no row.

    Rings that meet, or one that meets itself, change there: each takes the other's way on. The closed lines that come of
    it touch, but don't cross, and one within an odd number of others is a hole in the one around it.
    """
    key = [c for c in zones.columns if c != "polygon"]
    walked = zones.withColumn("__sides", spatial.sides(F.col("polygon"))).withColumn("__walks", spatial.walks(F.col("polygon"), F.col("__sides"))).withColumn("__corners", F.flatten("__walks"))
    lines = walked.withColumn("__ahead", spatial.uncrossed(F.col("__walks"), F.col("__corners"))).withColumn("__all", spatial.loops(F.col("__ahead"), F.col("__corners")))
    found = lines.withColumn("__lines", F.filter("__all", lambda r: (F.size(r) >= 3) & (spatial.ring_area(r) >= least_area)))
    deep = found.withColumn("__deep", F.transform("__lines", lambda r: F.struct(r.alias("ring"), F.size(F.filter("__lines", lambda by: spatial.within(r, by))).alias("depth"))))
    outer = deep.select(*key, "__deep", F.posexplode(F.filter("__deep", lambda d: d["depth"] % 2 == 0)).alias("part", "__outer"))
    holes = F.filter("__deep", lambda h: (h["depth"] == F.col("__outer.depth") + 1) & spatial.within(h["ring"], F.col("__outer.ring")))
    return outer.select(*key, "part", F.concat(F.array("__outer.ring"), F.transform(holes, lambda h: h["ring"])).alias("polygon"))


def touching_boxes(zones: DataFrame) -> DataFrame:
    """Pairs (zone_code, other) whose bounding boxes overlap. Zones are few: all pairs of them are tried."""
    box = zones.select("zone_code", spatial.bounds(F.col("polygon")).alias("a"))
    other = box.select(F.col("zone_code").alias("other"), F.col("a").alias("b"))
    apart = (F.col("a.x1") <= F.col("b.x0")) | (F.col("b.x1") <= F.col("a.x0")) | (F.col("a.y1") <= F.col("b.y0")) | (F.col("b.y1") <= F.col("a.y0"))
    return box.join(other, (F.col("zone_code") < F.col("other")) & ~apart).select("zone_code", "other")


def overlaps(zones: DataFrame, least_area: float = 1.0) -> DataFrame:
    """Pairs (zone_code, other, area) that share more than an area. Zones may have holes and inward corners: both are taken
    as signed sums of triangles, and each two triangles are clipped by each other."""
    parts = zones.select("zone_code", F.inline(spatial.triangles(F.col("polygon"))))
    other = parts.select(F.col("zone_code").alias("other"), F.col("sign").alias("other_sign"), F.col("ring").alias("other_ring"))
    both = touching_boxes(zones).join(parts, "zone_code").join(other, "other")
    shared = F.sum(F.col("sign") * F.col("other_sign") * spatial.ring_area(spatial.clipped(F.col("ring"), F.col("other_ring"))))
    return both.groupBy("zone_code", "other").agg(shared.alias("area")).filter(F.col("area") > least_area)


def require_apart(zones: DataFrame, least_area: float = 1.0) -> None:
    """Raises if zones overlap by more than an area."""
    if found := [f"{r['zone_code']} and {r['other']}: {r['area']:.2f}" for r in overlaps(zones, least_area).orderBy("zone_code", "other").limit(21).collect()]:
        raise ValueError(f"zones overlap: {', '.join(found[:20])}{' and more' if len(found) > 20 else ''}")


def before_berth(points: DataFrame, still: float = 0.5, least: int = 3) -> DataFrame:
    """Still points outside berths that a call has before its first point in a berth; calls with fewer than `least` go.

    points: validated_call_id, mmsi, recorded_at, speed_knots, x, y, in_berth, near_berth.
    """
    call = Window.partitionBy("validated_call_id")
    entry = F.min(F.when(F.col("in_berth"), F.col("recorded_at"))).over(call)
    early = points.withColumn("__entry", entry).filter((F.col("recorded_at") < F.col("__entry")) & (F.col("speed_knots") < still) & ~F.col("near_berth"))
    return early.withColumn("__n", F.count("*").over(call)).filter(F.col("__n") >= least).drop("__n", "__entry")


def anchorage(points: DataFrame, eps: float = 200.0, min_samples: int = 20, vessels: int = 2) -> DataFrame:
    """The best cluster of before_berth() points (vessels, calls, points), or no row: it needs several vessels."""
    numbered_points = points.withColumn("point_id", F.xxhash64("validated_call_id", "recorded_at"))
    found = clusters.dbscan(numbered_points, eps, min_samples).filter("cluster_id >= 0")
    sizes = found.groupBy("cluster_id").agg(F.countDistinct("mmsi").alias("vessel_count"), F.countDistinct("validated_call_id").alias("call_count"), F.count("*").alias("point_count"), F.avg("x").alias("centre_x"), F.avg("y").alias("centre_y"))
    return sizes.filter(F.col("vessel_count") >= vessels).orderBy(F.desc("vessel_count"), F.desc("call_count"), F.desc("point_count"), "cluster_id").limit(1)


#: Speeds (from, below) and greatest distance to a berth in metres of what each zone type is drawn from.
EVIDENCE = {"manoeuvring_basin": (0.5, 2.0, 1500.0), "shipping_channel": (2.0, None, 3000.0), "approach": (None, None, 2500.0)}


def evidence(points: DataFrame, zone_type: str, least: int = 20) -> DataFrame:
    """points (speed_knots, berth_metres, in_berth) that speak for a zone type; none if there are fewer than `least`."""
    low, high, far = EVIDENCE[zone_type]
    chosen = points.filter((F.col("berth_metres") <= far) & ~F.col("in_berth"))
    chosen = chosen.filter(F.col("speed_knots") >= low) if low is not None else chosen
    chosen = chosen.filter(F.col("speed_knots") < high) if high is not None else chosen
    enough = chosen.agg(F.count("*").alias("__n")).filter(F.col("__n") >= least)
    return chosen.crossJoin(F.broadcast(enough)).drop("__n")


#: How zones are drawn from their evidence, in metres: buffer around points, gaps that are closed (half their width), least area of a part.
DRAWN = {"manoeuvring_basin": (60.0, 120.0, 2500.0), "shipping_channel": (60.0, 40.0, 2500.0), "approach": (100.0, 400.0, 2500.0), "anchorage": (75.0, 150.0, 2500.0)}


def drawn(points: DataFrame, zone_type: str, least: int = 20, cell: float = 20.0) -> DataFrame:
    """zone_type, part, polygon, cell_count: the outline of a zone's evidence (x, y in metres, and what `evidence` needs; an
    anchorage's points are evidence as they are). No row where evidence lacks. Holes are filled, as ships pass around what
    they don't cross by less than a zone's width."""
    buffer, closing, least_area = DRAWN[zone_type]
    chosen = points if zone_type == "anchorage" else evidence(points, zone_type, least)
    found = outlines.outlines(chosen, cell=cell, buffer=buffer, closing=closing, least_area=least_area, holes=False)
    return found.select(F.lit(zone_type).alias("zone_type"), "part", "polygon", "cell_count")
