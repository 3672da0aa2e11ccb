import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratapoint.functions import fitting
from stratapoint.functions.delaunay import triangulate
from stratapoint.operators import elevation, tin


def hull_area(points):
    points = sorted(set(map(tuple, points)))

    def half(ps):
        out = []
        for p in ps:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    ring = half(points) + half(points[::-1])
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))) / 2


@pytest.mark.parametrize("lattice", [False, True])
@pytest.mark.parametrize("n", [3, 10, 200])
def test_delaunay_covers_the_hull_with_empty_circles(n, lattice):
    rng = np.random.default_rng(n)
    p = rng.integers(0, 30, (n, 2)) / 8 if lattice else np.round(rng.random((n, 2)) * 10, 4)
    t = triangulate(p[:, 0], p[:, 1])
    a, b, c = (p[t[:, k]] for k in range(3))
    area = ((b - a)[:, 0] * (c - a)[:, 1] - (b - a)[:, 1] * (c - a)[:, 0]) / 2
    assert (area > 0).all()
    assert area.sum() == pytest.approx(hull_area(p))
    for u, v, w in zip(a, b, c, strict=True):
        d = 2 * (u[0] * (v[1] - w[1]) + v[0] * (w[1] - u[1]) + w[0] * (u[1] - v[1]))
        x = (u @ u * (v[1] - w[1]) + v @ v * (w[1] - u[1]) + w @ w * (u[1] - v[1])) / d
        y = (u @ u * (w[0] - v[0]) + v @ v * (u[0] - w[0]) + w @ w * (v[0] - u[0])) / d
        r = math.hypot(u[0] - x, u[1] - y)
        assert (np.hypot(p[:, 0] - x, p[:, 1] - y) > r - 1e-6 * max(1, r)).all()


@pytest.mark.parametrize("xy", [[], [(0, 0)], [(0, 0), (1, 1)], [(0, 0), (1, 1), (2, 2), (5, 5)], [(1, 1)] * 5])
def test_delaunay_of_degenerate_points_is_empty(xy):
    p = np.array(xy, float).reshape(-1, 2)
    assert len(triangulate(p[:, 0], p[:, 1])) == 0


def test_blocks_agree_with_one_triangulation(spark):
    rng = np.random.default_rng(1)
    p = np.round(rng.random((3000, 3)) * [100, 100, 5], 3)
    df = spark.createDataFrame(p.tolist(), "x double, y double, z double")
    got = tin.triangulate(df, block=25.0, halo=15.0).toPandas()
    whole = triangulate(p[:, 0], p[:, 1])
    key = lambda t: tuple(sorted(map(tuple, t)))
    want = {key(p[t][:, :2].tolist()) for t in whole if np.ptp(p[t][:, :2], axis=0).max() < 8}
    found = {key([(r[f"x{k}"], r[f"y{k}"]) for k in range(3)]) for r in got.to_dict("records")}
    assert want <= found


def test_interpolation_of_a_plane_is_exact(spark):
    rng = np.random.default_rng(2)
    xy = np.round(rng.random((500, 2)) * 60, 3)
    df = spark.createDataFrame([(float(x), float(y), float(2 * x - y + 3)) for x, y in xy], "x double, y double, z double")
    asked = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(rng.random((200, 2)) * 40 + 10)], "id int, x double, y double")
    got = tin.interpolate(asked, tin.triangulate(df), ["id", "x", "y"])
    assert got.count() == 200
    assert got.where(F.abs(F.col("h") - (2 * F.col("x") - F.col("y") + 3)) > 1e-6).count() == 0


def test_geometry_of_a_known_triangle(spark):
    df = spark.createDataFrame([("t", 0.0, 0.0, 0.0, 2.0, 0.0, 2.0, 0.0, 3.0, 0.0)], ["tri", *tin.CORNERS])
    r = tin.geometry(df).first()
    assert (r.tan2, r.xy_size, r.z_range) == (pytest.approx(1.0), 3.0, 2.0)


def test_roof_planes_and_ridge():
    rng = np.random.default_rng(3)
    xy = rng.random((600, 2)) * [12, 8] - [6, 4]
    z = 5 - np.abs(xy[:, 1]) * 0.7 + rng.normal(0, 0.01, 600)
    pair = fitting.ridge_pair(fitting.find_planes(np.c_[xy, z]))
    line = fitting.ridge_line(pair)
    assert abs(line[0] / line[1]) < 0.02 and abs(line[2] / line[1]) < 0.1


def test_projective_map_hits_the_square():
    corners = np.array([(0.0, 0.0), (10.0, 1.0), (9.0, 8.0), (1.0, 7.0)])
    h = fitting.projective(corners)
    assert np.allclose(fitting.apply_projective(h, corners), fitting.SQUARE)
    with pytest.raises(ValueError):
        fitting.projective(np.array([(0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (3.0, 0.0)]))


def test_utm_of_known_places(spark):
    from stratapoint.operators.buildings import utm

    df = spark.createDataFrame([(9.0, 0.0), (9.0, 55.0), (10.0, 55.0)], "lon double, lat double")
    e, n = utm(F.col("lon"), F.col("lat"))
    got = df.select(e.alias("e"), n.alias("n")).collect()
    assert got[0].e == pytest.approx(500000) and got[0].n == pytest.approx(0, abs=1e-6)
    assert got[1].e == pytest.approx(500000) and 6094000 < got[1].n < 6096000
    assert got[2].e == pytest.approx(563948, abs=50)


def square_of(spark, x0, y0, x1, y1, z):
    ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return spark.createDataFrame([(1, 0, q, float(x), float(y), float(z)) for q, (x, y) in enumerate(ring)], "feat_id int, ring int, seq int, x double, y double, z double")


def test_elevation_model_takes_all_steps_of_the_kernel(spark):
    """Land at 10 m with a lake of no points (a wall of 13 m on its west bank), a sea, and a house over low points."""
    in_lake = lambda x, y: 14 < x < 26 and 14 < y < 26
    in_sea = lambda x, y: x > 33 and y < 8
    rows = []
    for x in range(41):
        for y in range(41):
            z = 13.0 if x == 14 and 14 <= y <= 26 else 0.3 if in_sea(x, y) else 10.0
            if not in_lake(x, y):
                rows.append((x + 0.0, y + 0.0, z, 2, 1))
    house = [(x + 0.5, y + 0.5, 15.0, 6, 1) for x in range(3, 9) for y in range(30, 36)]
    low = [(x + 0.25, y + 0.25, 5.0, 2, 2) for x in range(4, 8) for y in range(31, 35)]
    high = [(30.5, 30.5, 99.0, 1, 1)]  # of a class that neither model takes
    points = spark.createDataFrame(rows + house + low + high, "x double, y double, z double, c int, rn int")
    layers = {"lakes": square_of(spark, 17.2, 17.2, 22.8, 22.8, 8), "sea": square_of(spark, 34.2, 0.2, 39.8, 6.8, 0), "houses": square_of(spark, 2.1, 29.1, 9.9, 36.9, 0)}
    run = lambda first, **more: {(r.row, r.col): r.value for r in elevation.elevation_model(points, 1.0, 0.0, 40.0, 40, 40, [2, 9, 17], [2, 3, 4, 5, 6, 9, 17], first, **layers, **more).collect()}
    at = lambda cells, x, y: cells[int(40 - y), int(x)]
    dtm, dsm = run(False, sea_z=0.0), run(True, sea_z=0.0)
    for cells in (dtm, dsm):
        assert at(cells, 20.5, 20.5) == 8.0 and at(cells, 18.5, 21.5) == 8.0  # lake
        assert max(at(cells, x + 0.5, y + 0.5) for x in (15, 16) for y in range(18, 23)) <= 10.0 + 1e-9  # no steep bank
        assert at(cells, 36.5, 3.5) == 0.0 and at(cells, 31.5, 3.5) == 10.0  # sea
        assert max(cells.values()) < 16
    assert at(dtm, 5.5, 32.5) > 9.9 and at(dsm, 5.5, 32.5) > 14
    assert at(run(False), 36.5, 3.5) == pytest.approx(0.3)


def test_features_go_to_the_tile_of_their_first_vertex(spark):
    from stratapoint.plans import derived, surface_queries

    tiles = {r.feat_id: r.km_name for r in surface_queries.feature_tiles(derived.lines(spark).union(derived.polygons(spark).where("feat_id = 3").select("feat_id", "ring", "seq", "x", "y", "z"))).collect()}
    assert tiles == {1: "1km_6173_632", 2: "1km_6174_632", 3: "1km_6174_633"}
    report = spark.createDataFrame([(1, 1.0, -1.0, 2.0, 2.0), (2, -3.0, 3.0, 4.0, 4.0), (2, 5.0, 5.0, 6.0, 6.0)], "feat_id int, mean12 double, mean21 double, sigma12 double, sigma21 double")
    got = {r.tilename: (r.abs_avg12, r.abs_avg21, r.sigma12) for r in surface_queries._tile_view(report, derived.lines(spark)).collect()}
    assert got == {"1km_6173_632": (1.0, 1.0, 2.0), "1km_6174_632": (4.0, 4.0, 5.0)}


def test_wall_corners_come_from_the_upper_ends_of_walls():
    from stratapoint.operators import buildings

    rng = np.random.default_rng(5)
    xy = rng.random((6000, 2)) * [24, 20] - 2
    house = (xy > [0.2, 0.2]).all(axis=1) & (xy < [20.2, 16.2]).all(axis=1)
    xyz = np.c_[xy, np.where(house, 9.0, 1.0)]
    ring = np.array([(0.0, 0.0), (20.0, 0.0), (20.0, 16.0), (0.0, 16.0), (0.0, 0.0)])
    got = buildings.wall_corners(xyz, [ring])
    assert len(got) == 4
    off = np.array([(r["u"] - r["x"], r["v"] - r["y"]) for r in got])
    assert np.abs(off - np.where(ring[:4] == 0, 0.35, 0.05)).max() < 0.2  # just inside the walls
    assert buildings.wall_corners(np.c_[xy, np.full(len(xy), 1.0)], [ring]) == []  # flat ground has no walls
    half = xyz[~((xyz[:, 2] > 5) & (xyz[:, 0] > 4) & (xyz[:, 0] < 17) & (xyz[:, 1] < 3))]
    assert {r["vertex"] for r in buildings.wall_corners(half, [ring])} <= {2, 3}  # points on both ends of the first side only
    assert buildings.wall_corners(xyz[:300], [ring]) == []  # few points
