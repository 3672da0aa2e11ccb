import random

import pytest

from stratapoint.operators import raster, regions


def brute(cells, offsets):
    left, out = set(cells), {}
    while left:
        todo, part = [left.pop()], []
        while todo:
            c = todo.pop()
            part.append(c)
            for o in offsets:
                n = tuple(a + b for a, b in zip(c, o, strict=True))
                if n in left:
                    left.remove(n)
                    todo.append(n)
        for c in part:
            out[c] = "_".join(map(str, min(part)))
    return out


@pytest.mark.parametrize("block", [4, 256])
def test_labels_cross_blocks(spark, block):
    rng = random.Random(block)
    cells = [(i, j) for i in range(-10, 20) for j in range(25) if rng.random() < 0.6]
    df = spark.createDataFrame(cells, "row int, col int")
    got = {(r.row, r.col): r.label for r in regions.label(df, block=block).collect()}
    assert got == brute(cells, [(0, 1), (1, 0), (0, -1), (-1, 0)])


def test_voxels(spark):
    rng = random.Random(5)
    cells = [(i, j, k) for i in range(9) for j in range(9) for k in range(9) if rng.random() < 0.12]
    near = [(a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) if (a, b, c) != (0, 0, 0)]
    df = spark.createDataFrame(cells, "i int, j int, k int")
    got = {(r.i, r.j, r.k): r.label for r in regions.label(df, ["i", "j", "k"], near, block=3).collect()}
    assert got == brute(cells, near)


def test_empty_mask(spark):
    assert regions.label(spark.createDataFrame([], "row int, col int")).count() == 0


def test_polygon_with_a_hole(spark):
    cells = [(i, j) for i in range(5) for j in range(5) if (i, j) != (2, 2)]
    lab = regions.label(spark.createDataFrame(cells, "row int, col int"))
    shape = regions.region_polygons(regions.outlines(lab, 0.0, 5.0, 1.0)).first()
    assert shape.area == 24.0
    assert shape.wkt.count("(") == 3


def test_expand_water(spark):
    add = spark.createDataFrame([(0, 0), (0, 1), (0, 2), (5, 5)], "row int, col int")
    water = spark.createDataFrame([(0, 0), (9, 9)], "row int, col int")
    assert sorted(map(tuple, regions.expand_water(add, water).collect())) == [(0, 0), (0, 1), (0, 2), (9, 9)]


def test_contour_of_a_ramp(spark):
    cells = spark.createDataFrame([(i, j, float(j)) for i in range(4) for j in range(4)], "row int, col int, value double")
    got = raster.contours(cells, 1.0, 0.0, 4.0, 1.0).collect()
    assert got and all(abs(r.x1 - (r.level + 0.5)) < 1e-9 and abs(r.x2 - (r.level + 0.5)) < 1e-9 for r in got)
