"""Components and density clusters against brute force, and clusters of crowded cells."""

import time
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborline.operators import clusters, graphs


def _roots(links):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        up[find(a)] = find(b)
    groups = defaultdict(set)
    for x in list(up):
        groups[find(x)].add(x)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("kind", ["path", "random", "loops", "none"])
def test_components_are_those_of_brute_force(spark, kind):
    rng = np.random.default_rng(1)
    links = {
        "path": [(i, i + 1) for i in range(200)], "random": [tuple(map(int, x)) for x in rng.integers(0, 300, (200, 2))],
        "star": [(0, i) for i in range(1, 50)] + [(60, 61)], "loops": [(1, 1), (2, 3), (3, 2), (4, 4)], "none": []}[kind]
    found = graphs.components(spark.createDataFrame(links, "a long, b long"))
    groups = defaultdict(set)
    for r in found.collect():
        assert r["node"] not in groups[r["root"]]
        groups[r["root"]].add(r["node"])
    assert {frozenset(g) for g in groups.values()} == _roots(links) and all(root in g for root, g in groups.items())


def _clusters(xy, eps, least):
    near = ((xy[:, None] - xy[None]) ** 2).sum(2) <= eps * eps
    core = near.sum(1) >= least
    groups = _roots([(int(a), int(b)) for a, b in np.argwhere(near & core[:, None] & core[None])])
    label = {i: min(g) for g in groups for i in g}
    number = {x: k for k, x in enumerate(sorted(set(label.values())))}
    out = {}
    for i in range(len(xy)):
        seen = [label[j] for j in np.flatnonzero(near[i] & core)]
        out[i] = number[label[i] if core[i] else min(seen)] if seen else -1
    return out


@pytest.mark.parametrize(("seed", "eps", "least", "few"), [(1, 8.0, 6, 256), (3, 3.0, 3, 4), (4, 5.0, 1, 16)])
def test_clusters_are_those_of_brute_force(spark, monkeypatch, seed, eps, least, few):
    monkeypatch.setattr(clusters, "FEW_PAIRS", few)
    rng = np.random.default_rng(seed)
    parts = [rng.normal(c, s, (60, 2)) for c, s in (((0, 0), 5), ((60, 0), 3), ((0, 80), 9), ((11, 3), 0.5))] + [rng.uniform(-100, 100, (60, 2))]
    grid = np.argwhere(np.ones((8, 8))) * eps + 150.0  # neighbours at eps exactly
    xy = np.concatenate([*parts, grid, grid[:5], grid[:5], -grid[:9]])
    df = spark.createDataFrame([(i, f"v{i}", float(x), float(y)) for i, (x, y) in enumerate(xy)], "point_id int, mmsi string, x double, y double")
    found = clusters.dbscan(df, eps, least)
    assert found.columns == ["point_id", "mmsi", "x", "y", "cluster_id"]
    assert {r["point_id"]: r["cluster_id"] for r in found.collect()} == _clusters(xy, eps, least)


def test_crowded_cells_are_linked_without_their_pairs(spark):
    """10**5 points in one cell, and as many in the next but one, at just eps or just over it."""
    n = 100_000
    for gap, together in ((1.0, True), (1.0001, False)):
        one = spark.range(n).select(F.col("id").alias("point_id"), (F.rand(1) * -0.6).alias("x"), (F.rand(2) * 0.6).alias("y"))
        two = spark.range(n).select((F.col("id") + n).alias("point_id"), (F.rand(3) * 0.6 + gap).alias("x"), (F.rand(4) * 0.6).alias("y"))
        edges = spark.createDataFrame([(2 * n, 0.0, 0.3), (2 * n + 1, gap, 0.3)], "point_id long, x double, y double")
        began = time.time()
        found = clusters.dbscan(one.union(two).union(edges), 1.0, 5).groupBy("cluster_id").count().collect()
        assert sorted(r["count"] for r in found) == ([2 * n + 2] if together else [n + 1, n + 1])
        assert time.time() - began < 120


def test_no_points_and_points_without_place(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, 1.0, None)], "point_id long, x double, y double")
    assert {r["cluster_id"] for r in clusters.dbscan(df, 1, 1).collect()} == {-1} and clusters.dbscan(df.limit(0), 1, 1).isEmpty()


def test_tables_of_an_application_are_cleaned(spark):
    df = graphs.cut(spark.range(5))
    assert df.count() == 5
    graphs.clean(spark)
    with pytest.raises(Exception, match="(?i)not.*exist|not_exist"):
        spark.read.parquet(df.inputFiles()[0]).count()
