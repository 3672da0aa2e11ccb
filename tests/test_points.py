import numpy as np
import pytest
from pyspark.sql import functions as F

from stratapoint.operators import aggregates, focal, geometry, points, raster


def test_class_needed(spark):
    with pytest.raises(ValueError):
        points.cut_to_class(spark.range(3), 2)


def test_extend_needs_all_columns(spark):
    a, b = spark.createDataFrame([(1.0, 2)], "x double, c int"), spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError):
        points.extend(a, b)
    assert points.extend(a, b, least_common=True).columns == ["x"]
    assert points.empty_like(a).count() == 0


def test_radius_filters_against_all_pairs(spark):
    rng = np.random.default_rng(0)
    p = np.round(rng.random((200, 3)) * [20, 20, 5], 2)
    df = spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(p)], "k int, x double, y double, z double")
    d = np.hypot(p[:, None, 0] - p[None, :, 0], p[:, None, 1] - p[None, :, 1]) <= 2.0
    want = [p[d[k], 2] for k in range(len(p))]
    key = ["k", "x", "y", "z"]
    data = df.select("x", "y", "z")
    for f, g in ((focal.min_filter, np.min), (focal.max_filter, np.max), (focal.mean_filter, np.mean), (focal.median_filter, np.median), (focal.var_filter, lambda v: np.var(v) if len(v) > 1 else None)):
        got = {r.k: r.value for r in f(df, data, 2.0, key).collect()}
        assert len(got) == 200
        assert all(got[k] is None if g(v) is None else got[k] == pytest.approx(g(v)) for k, v in enumerate(want))
    with pytest.raises(ValueError):
        focal.mean_filter(df, data, 2.0, key, cell=1.0)


def test_queries_without_neighbours(spark):
    far = spark.createDataFrame([(1, 100.0, 100.0)], "k int, x double, y double")
    data = spark.createDataFrame([(0.0, 0.0, 1.0)], "x double, y double, z double")
    assert focal.mean_filter(far, data, 2.0, ["k", "x", "y"]).first().value is None
    assert focal.density_filter(far, data, 2.0, ["k", "x", "y"]).first().value == 0
    assert focal.distance_filter(far, data, 2.0, ["k", "x", "y"]).first().value is None


def test_polygons_reject_nothing_closed_and_see_holes(spark):
    ring = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
    hole = [(4, 4), (6, 4), (6, 6), (4, 6), (4, 4)]
    v = spark.createDataFrame([(1, r, q, float(x), float(y)) for r, vs in enumerate((ring, hole)) for q, (x, y) in enumerate(vs)], "feat_id int, ring int, seq int, x double, y double")
    p = spark.createDataFrame([(1.0, 1.0), (5.0, 5.1), (11.0, 5.0), (9.5, 9.5)], "x double, y double")
    assert sorted(r.x for r in geometry.points_in_polygons(p, v).collect()) == [1.0, 9.5]
    assert geometry.unclosed_rings(v).count() == 0
    assert geometry.unclosed_rings(v.where("seq < 4")).count() == 2
    assert geometry.polygon_area(v).first().area == 96.0


def test_buffer_is_strict(spark):
    line = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 10.0, 0.0), (1, 2, 10.0, 0.0)], "feat_id int, seq int, x double, y double")
    p = spark.createDataFrame([(5.0, 1.0), (5.0, 0.99), (11.0, 0.0), (10.5, 0.5)], "x double, y double")
    assert sorted(r.x for r in geometry.points_near_lines(p, line, 1.0).collect()) == [5.0, 10.5]


def test_trimming_stops_when_nothing_goes(spark):
    v = spark.createDataFrame([("a", float(k % 2)) for k in range(50)] + [("a", 40.0), ("b", 1.0), ("c", None)], "g string, dz double")
    got = {r.g: r for r in aggregates.dz_statistics(v, ["g"]).collect()}
    assert got["a"].n == 50 and got["a"].mean == 0.5
    assert "c" not in got


def test_mode_is_the_lowest_of_ties(spark):
    v = spark.createDataFrame([(1, 5), (1, 2), (1, 2), (1, 5), (2, 9)], "g int, c int")
    assert {r.g: r.c for r in aggregates.most_frequent(v, "c", ["g"]).collect()} == {1: 2, 2: 9}


def test_geoid_must_cover(spark):
    geoid = spark.createDataFrame([(i, j, 1.0) for i in range(2) for j in range(2)], "row int, col int, value double")
    inside = spark.createDataFrame([(0.5, -0.5, 3.0)], "x double, y double, z double")
    assert raster.to_ellipsoidal(inside, geoid, 0.0, 1.0, 0.0, 1.0).first().z == 4.0
    with pytest.raises(Exception, match="geoid"):
        raster.to_ellipsoidal(inside.withColumn("x", F.lit(9.0)), geoid, 0.0, 1.0, 0.0, 1.0).collect()


def test_extents():
    assert raster.intersect_extents((0, 0, 10, 10, 1), (5, 5, 20, 20, 1)) == (5, 5, 10, 10)
    with pytest.raises(ValueError):
        raster.intersect_extents((0, 0, 1, 1, 1), (0, 0, 1, 1, 2))
    with pytest.raises(ValueError):
        raster.intersect_extents((0, 0, 1, 1, 1), (3, 3, 4, 4, 1))
    assert raster.grid_extent(0.0, 10.0, 2.0, 3, 4) == (0.0, 4.0, 8.0, 10.0)


def test_clip_polygons(spark):
    ring = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
    v = spark.createDataFrame([(1, 0, q, float(x), float(y)) for q, (x, y) in enumerate(ring)] + [(2, 0, q, x + 50.0, float(y)) for q, (x, y) in enumerate(ring)], "feat_id int, ring int, seq int, x double, y double")
    got = geometry.clip_polygons(v, -5.0, 5.0, 4.0, 50.0)
    assert {r.feat_id: r.area for r in geometry.polygon_area(got).collect()} == {1: 20.0}
    assert geometry.unclosed_rings(got).count() == 0
