"""Geodesy and polygons as columns: distances, projections, containment, areas. No shapes library, no UDF.

A polygon is array<array<struct<x: double, y: double>>>: rings, the first the outer one, closed or not.
"""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: WGS84.
SEMI_MAJOR, FLATTENING = 6_378_137.0, 1 / 298.257223563
ECC2 = FLATTENING * (2 - FLATTENING)
POLYGON = "array<array<struct<x:double,y:double>>>"


def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres on the spheroid by radii of curvature at the middle latitude: within millimetres up to some 20 km."""
    mid = F.radians((lat1 + lat2) / 2)
    root = F.sqrt(1 - ECC2 * F.pow(F.sin(mid), 2))
    meridian, normal = SEMI_MAJOR * (1 - ECC2) / F.pow(root, 3), SEMI_MAJOR / root
    return F.hypot(meridian * F.radians(lat2 - lat1), normal * F.cos(mid) * F.radians(lon2 - lon1))


def degrees_box(radius_m: Column, lat: Column) -> tuple[Column, Column]:
    """Half height and half width in degrees of a box that surely holds a circle (a cheap filter before distances)."""
    height = radius_m / 110_500.0
    return height, height / F.greatest(F.cos(F.radians(F.abs(lat) + height)), F.lit(0.01))


def utm(lat: Column, lon: Column, zone: int = 15) -> tuple[Column, Column]:
    """Easting and northing (northern hemisphere), by the series of the third order in the third flattening."""
    n = FLATTENING / (2 - FLATTENING)
    radius = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    e = math.sqrt(ECC2)
    phi, lam = F.radians(lat), F.radians(lon - F.lit(zone * 6.0 - 183.0))
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(alpha, 1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return 500_000.0 + 0.9996 * radius * east, 0.9996 * radius * north


def lat_lon(east: Column, north: Column, zone: int = 15) -> tuple[Column, Column]:
    """The inverse of utm()."""
    n = FLATTENING / (2 - FLATTENING)
    radius = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    xi, eta = north / (0.9996 * radius), (east - 500_000.0) / (0.9996 * radius)
    x, y = xi, eta
    for j, b in enumerate(beta, 1):
        x = x - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        y = y - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(x) / F.cosh(y))
    phi = chi
    for j, d in enumerate(delta, 1):
        phi = phi + d * F.sin(2 * j * chi)
    return F.degrees(phi), F.lit(zone * 6.0 - 183.0) + F.degrees(F.atan2(F.sinh(y), F.cos(x)))


def _edges(ring: Column) -> Column:
    """Array of struct<a, b>: the ring's sides, the closing one too."""
    turned = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.zip_with(ring, turned, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def sides(polygon: Column) -> Column:
    """The sides of all rings, as structs of two points."""
    return F.flatten(F.transform(polygon, _edges))


def covers(polygon: Column, x: Column, y: Column) -> Column:
    """The point lies in the polygon or on its boundary; holes (rings after the first) are outside. Even-odd rule."""
    return enclosed(sides(polygon), x, y)


def enclosed(sides: Column, x: Column, y: Column) -> Column:
    """`covers`, by the sides of the polygon: they can be kept where many points meet it."""

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        return F.when((a["y"] > y) != (b["y"] > y), x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"]).otherwise(False)

    def touches(e: Column) -> Column:
        a, b = e["a"], e["b"]
        cross = (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])
        return (F.abs(cross) <= 1e-14) & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))

    return F.exists(sides, touches) | (F.size(F.filter(sides, crosses)) % 2 == 1)


def bounds(polygon: Column) -> Column:
    """struct<x0, y0, x1, y1> of the outer ring."""
    xs, ys = F.transform(polygon[0], lambda p: p["x"]), F.transform(polygon[0], lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def _twice_area(ring: Column) -> Column:
    return F.aggregate(_edges(ring), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])


def area(polygon: Column) -> Column:
    """Area of the outer ring without its holes."""
    rings = F.transform(polygon, lambda r: F.abs(_twice_area(r)) / 2)
    return rings[0] - F.aggregate(F.slice(rings, 2, F.greatest(F.size(rings), F.lit(1))), F.lit(0.0), lambda s, a: s + a)


def centroid(polygon: Column) -> Column:
    """struct<x, y>: centre of mass of the outer ring."""
    sides, twice = _edges(polygon[0]), _twice_area(polygon[0])

    def moment(axis: str) -> Column:
        return F.aggregate(sides, F.lit(0.0), lambda s, e: s + (e["a"][axis] + e["b"][axis]) * (e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]))

    return F.struct((moment("x") / (3 * twice)).alias("x"), (moment("y") / (3 * twice)).alias("y"))


def triangles(polygon: Column) -> Column:
    """Array of struct<sign, ring>: anticlockwise triangles whose signed sum is the polygon without its holes."""

    def fan(ring: Column, i: Column) -> Column:
        a, first = ring[0], F.signum(_twice_area(ring)) * F.when(i == 0, 1).otherwise(-1)

        def one(b: Column, k: Column) -> Column:
            c = F.get(ring, k + 2)
            s = (b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])
            return F.struct((F.signum(s) * first).alias("sign"), F.when(s > 0, F.array(a, b, c)).otherwise(F.array(a, c, b)).alias("ring"))

        return F.transform(F.slice(ring, 2, F.greatest(F.size(ring) - 2, F.lit(0))), one)

    return F.filter(F.flatten(F.transform(polygon, fan)), lambda t: t["sign"] != 0)


def clipped(ring: Column, by: Column) -> Column:
    """The part of a ring that lies in a convex anticlockwise ring; an empty array if there is none."""
    points = "array<struct<x:double,y:double>>"

    def cut(left: Column, edge: Column) -> Column:
        def side(p: Column) -> Column:
            a, b = edge["a"], edge["b"]
            return (b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"])

        def kept(e: Column) -> Column:
            a, b, nothing = e["a"], e["b"], F.array().cast(points)
            t = side(a) / (side(a) - side(b))
            meets = F.struct((a["x"] + t * (b["x"] - a["x"])).alias("x"), (a["y"] + t * (b["y"] - a["y"])).alias("y"))
            return F.concat(F.when(side(a) >= 0, F.array(a).cast(points)).otherwise(nothing), F.when((side(a) >= 0) != (side(b) >= 0), F.array(meets).cast(points)).otherwise(nothing))

        return F.flatten(F.transform(_edges(left), kept)).cast(points)

    return F.aggregate(_edges(by), ring.cast(points), cut)


def ring_area(ring: Column) -> Column:
    return F.abs(_twice_area(ring)) / 2


def rectangle(polygon: Column) -> Column:
    """struct<area, angle, length, width> of the smallest rectangle, turned as it may be, around the outer ring.

    One of its sides runs through two corners, so the directions of all pairs of corners are tried. The angle is that of
    the longer sides, in degrees above -90 up to 90.
    """
    ring = polygon[0]
    pairs = F.flatten(F.transform(ring, lambda p: F.transform(ring, lambda q: F.when((p["x"] != q["x"]) | (p["y"] != q["y"]), F.atan2(q["y"] - p["y"], q["x"] - p["x"])))))
    turns = F.array_distinct(F.filter(pairs, lambda t: (t > -math.pi / 2) & (t <= math.pi / 2)))

    def box(t: Column) -> Column:
        along = F.transform(ring, lambda p: p["x"] * F.cos(t) + p["y"] * F.sin(t))
        across = F.transform(ring, lambda p: p["y"] * F.cos(t) - p["x"] * F.sin(t))
        u, v, angle = F.array_max(along) - F.array_min(along), F.array_max(across) - F.array_min(across), F.degrees(t)
        longer = F.when(u >= v, angle).when(angle > 0, angle - 90).otherwise(angle + 90)
        return F.struct((u * v).alias("area"), longer.alias("angle"), F.greatest(u, v).alias("length"), F.least(u, v).alias("width"))

    return F.array_min(F.transform(turns, box))


def from_wkt(wkt: Column) -> Column:
    """Array of polygons of a POLYGON or MULTIPOLYGON text, with or without an SRID; further ordinates are dropped. Other texts give null."""
    body = F.regexp_extract(wkt, r"(?is)^\s*(?:SRID=[0-9]+;)?\s*(?:MULTI)?POLYGON\s*(?:ZM?|M)?\s*(\(.*\))\s*$", 1)
    pairs = F.regexp_replace(body, r"([-+.0-9eE]+)\s+([-+.0-9eE]+)(?:\s+[-+.0-9eE]+)*", "[$1,$2]")
    brackets = F.translate(pairs, "()", "[]")
    many = F.when(wkt.rlike(r"(?i)MULTIPOLYGON"), brackets).otherwise(F.concat(F.lit("["), brackets, F.lit("]")))
    rings = F.from_json(F.when(body != "", many), "array<array<array<array<double>>>>")
    return F.transform(rings, lambda polygon: F.transform(polygon, lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))).cast(f"array<{POLYGON}>")


def to_wkt(polygon: Column) -> Column:
    """POLYGON text; rings are closed."""
    def corner(p: Column) -> Column:
        return F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))

    def closed(r: Column) -> Column:
        return F.when(F.element_at(r, -1) == r[0], r).otherwise(F.concat(r, F.slice(r, 1, 1)))

    rings = F.transform(polygon, lambda r: F.concat(F.lit("("), F.array_join(F.transform(closed(r), corner), ", "), F.lit(")")))
    return F.concat(F.lit("POLYGON ("), F.array_join(rings, ", "), F.lit(")"))


def is_simple(polygon: Column) -> Column:
    """No two sides of the outer ring cross."""
    sides = _edges(polygon[0])

    def side(p: Column, q: Column, r: Column) -> Column:
        return F.signum((q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"]))

    def cross(e: Column, f: Column) -> Column:
        return (side(e["a"], e["b"], f["a"]) * side(e["a"], e["b"], f["b"]) < 0) & (side(f["a"], f["b"], e["a"]) * side(f["a"], f["b"], e["b"]) < 0)

    return ~F.exists(sides, lambda e: F.exists(sides, lambda f: cross(e, f)))


_POINTS = "array<struct<x:double,y:double>>"


def sides(polygon: Column) -> Column:
    """Array of struct<a, b>: the sides of all rings."""
    return F.flatten(F.transform(polygon, _edges))


def walks(polygon: Column, all_sides: Column) -> Column:
    """The rings with a corner wherever one of all_sides crosses or touches them."""
    place = lambda x, y: F.struct((F.round(x, 9) + 0.0).alias("x"), (F.round(y, 9) + 0.0).alias("y"))
    cross = lambda o, a, b: (a["x"] - o["x"]) * (b["y"] - o["y"]) - (a["y"] - o["y"]) * (b["x"] - o["x"])

    def meeting(p: Column, q: Column) -> Column:
        d1, d2 = cross(q["a"], q["b"], p["a"]), cross(q["a"], q["b"], p["b"])
        t = d1 / F.nullif(d1 - d2, F.lit(0.0))
        apart = cross(p["a"], p["b"], q["a"]) * cross(p["a"], p["b"], q["b"]) > 0
        return F.when((d1 * d2 <= 0) & ~apart & t.isNotNull(), place(p["a"]["x"] + t * (p["b"]["x"] - p["a"]["x"]), p["a"]["y"] + t * (p["b"]["y"] - p["a"]["y"])))

    def met(e: Column, f: Column) -> Column:
        """The same numbers whichever of two sides asks where they meet."""
        return F.when(F.struct(e["a"], e["b"]) < F.struct(f["a"], f["b"]), meeting(e, f)).otherwise(meeting(f, e))

    def corner_on(e: Column, f: Column) -> Column:
        """A corner of f on e, for sides along each other."""
        a, b, c = e["a"], e["b"], f["a"]
        within = c["x"].between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & c["y"].between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))
        return F.when((F.abs(cross(a, b, c)) <= 1e-9) & within, place(c["x"], c["y"]))

    def stops(e: Column) -> Column:
        """The places along a side, in order, without its last corner."""
        own, last = place(e["a"]["x"], e["a"]["y"]), place(e["b"]["x"], e["b"]["y"])
        found = F.concat(F.transform(all_sides, lambda f: met(e, f)), F.transform(all_sides, lambda f: corner_on(e, f)), F.array(own))
        way = lambda p: (p["x"] - e["a"]["x"]) * (e["b"]["x"] - e["a"]["x"]) + (p["y"] - e["a"]["y"]) * (e["b"]["y"] - e["a"]["y"])
        keyed = F.transform(F.filter(F.array_distinct(found), lambda p: p.isNotNull() & (p != last)), lambda p: F.struct(way(p).alias("at"), p.alias("p")))
        return F.transform(F.array_sort(keyed), lambda k: k["p"])

    return F.transform(polygon, lambda ring: F.flatten(F.transform(_edges(ring), stops))).cast(f"array<{_POINTS}>")


def uncrossed(found: Column, corners: Column) -> Column:
    """For each corner of walks (all walks' corners one after another) the number of the corner that comes next, when walks
    that meet at a place change there, each taking the other's way on: so they touch, but don't cross."""
    before = lambda r: F.aggregate(F.slice(found, 1, r), F.lit(0), lambda n, w: n + F.size(w))
    along = F.flatten(F.transform(found, lambda w, r: F.transform(w, lambda p, k: before(r) + (k + 1) % F.size(w))))

    def change(p: Column, i: Column) -> Column:
        visits = F.filter(F.transform(corners, lambda q, j: F.when(q == p, j)), lambda j: j.isNotNull())
        return F.get(along, F.get(visits, F.array_position(visits, i).cast("int") % F.size(visits)))

    return F.transform(corners, change)


def loops(ahead: Column, corners: Column) -> Column:
    """The closed lines that corners make, each followed by the one whose number is ahead."""
    start = F.struct(F.array().cast("array<int>").alias("seen"), F.array().cast("array<array<int>>").alias("lines"))

    def follow(i: Column) -> Column:
        def step(way: Column, _: Column) -> Column:
            to = F.get(ahead, F.element_at(way, -1))
            return F.when(to == way[0], way).otherwise(F.concat(way, F.array(to)))

        return F.aggregate(ahead, F.array(i), step)

    def gather(state: Column, i: Column) -> Column:
        line = F.when(F.array_contains(state["seen"], i), F.array().cast("array<int>")).otherwise(follow(i))
        return F.transform(F.array(line), lambda w: F.struct(F.concat(state["seen"], w).alias("seen"), F.concat(state["lines"], F.filter(F.array(w), lambda x: F.size(x) > 0)).alias("lines")))[0]

    lines = F.aggregate(F.sort_array(ahead), start, gather)["lines"]
    return F.transform(lines, lambda w: F.transform(w, lambda i: F.get(corners, i)))


def within(line: Column, other: Column) -> Column:
    """A closed line, which doesn't cross another, lies within it."""
    middle = lambda e: F.struct(((e["a"]["x"] + e["b"]["x"]) / 2).alias("x"), ((e["a"]["y"] + e["b"]["y"]) / 2).alias("y"))
    return (ring_area(line) < ring_area(other)) & F.forall(F.transform(_edges(line), middle), lambda m: covers(F.array(other), m["x"], m["y"]))


def moved(polygon: Column, *, dx: Column | float = 0.0, dy: Column | float = 0.0, scale_x: Column | float = 1.0, scale_y: Column | float = 1.0, degrees: Column | float = 0.0, about: Column | None = None) -> Column:
    """The polygon scaled and turned (anticlockwise) about a point (its centroid), then moved."""
    as_column = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    about = centroid(polygon) if about is None else about
    turn = F.radians(as_column(degrees))

    def place(p: Column) -> Column:
        x, y = (p["x"] - about["x"]) * as_column(scale_x), (p["y"] - about["y"]) * as_column(scale_y)
        return F.struct(
            (about["x"] + x * F.cos(turn) - y * F.sin(turn) + as_column(dx)).alias("x"),
            (about["y"] + x * F.sin(turn) + y * F.cos(turn) + as_column(dy)).alias("y"))

    return F.transform(polygon, lambda ring: F.transform(ring, place))


def axis_mean(degrees: Column) -> tuple[Column, Column]:
    """Aggregates over undirected axes (0 and 180 are the same): mean axis in [0, 180) and concentration in [0, 1]."""
    double = F.radians(degrees) * 2
    c, s = F.avg(F.cos(double)), F.avg(F.sin(double))
    half = F.degrees(F.atan2(s, c)) / 2
    return F.when(half < 0, half + 180).otherwise(half), F.hypot(c, s)


def principal_axis(x: Column, y: Column) -> Column:
    """Aggregate: direction of greatest spread in degrees, from -90 to 90."""
    return F.degrees(0.5 * F.atan2(2 * F.covar_samp(x, y), F.var_samp(x) - F.var_samp(y)))
