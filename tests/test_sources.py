import json
import struct

import numpy as np
import pytest

from stratapoint.plans import jobs, reports
from stratapoint.sources import files, sinks, tiles

POINTS = [("1km_6173_632", 632000.25 + k, 6173000.5 + k / 4, 10.0 + k / 16, k % 7, k % 3) for k in range(40)]


@pytest.fixture
def points(spark):
    return spark.createDataFrame(POINTS, "tile string, x double, y double, z double, c int, pid int")


def las(path, rows, form=1):
    head = bytearray(227)
    head[:4] = b"LASF"
    head[24:26] = bytes((1, 2))
    size = {0: 20, 1: 28, 3: 34}[form]
    struct.pack_into("<HII", head, 94, 227, 227, 0)
    struct.pack_into("<BHI", head, 104, form, size, len(rows))
    struct.pack_into("<3d3d", head, 131, 0.01, 0.01, 0.01, 600000.0, 6000000.0, 0.0)
    body = b""
    for x, y, z, c, pid, rn, t in rows:
        rec = struct.pack("<iiiHBBbBH", round((x - 600000) * 100), round((y - 6000000) * 100), round(z * 100), 0, rn, c, 0, 0, pid)
        body += rec + (struct.pack("<d", t) if form else b"") + (struct.pack("<HHH", 1, 2, 3) if form == 3 else b"")
    path.write_bytes(bytes(head) + body)


@pytest.mark.parametrize("form", [0, 1, 3])
def test_las(spark, tmp_path, form):
    las(tmp_path / "1km_6173_632.las", [(632000.25, 6173000.5, 12.25, 2, 7, 1, 99.5), (632001.0, 6173001.0, 13.0, 5, 8, 2, 100.5)], form)
    got = files.read_points(spark, str(tmp_path / "1km_6173_632.las")).orderBy("x").collect()
    assert [(r.x, r.y, r.z, r.c, r.pid, r.rn) for r in got] == [(pytest.approx(632000.25), pytest.approx(6173000.5), 12.25, 2, 7, 1), (632001.0, 6173001.0, 13.0, 5, 8, 2)]
    assert got[0].tile == "1km_6173_632"
    assert got[0].gps_time == (99.5 if form else None)
    assert got[0].r == (1 if form == 3 else None)


def test_unsupported_kinds(spark):
    for path in ("a.laz", "a.tif"):
        with pytest.raises(ValueError):
            files.read_points(spark, path)


def test_npy_and_bin_round_trip(spark, tmp_path, points):
    assert sinks.dump_npy(points, str(tmp_path / "npy")).collect()[0].n == 40
    assert sinks.dump_bin(points, str(tmp_path / "bin")).count() == 1
    npy = files.read_points(spark, str(tmp_path / "npy" / "1km_6173_632.npy"))
    raw = files.read_points(spark, str(tmp_path / "bin"), "bin")
    assert sorted((r.x, r.y, r.z) for r in npy.collect()) == sorted(p[1:4] for p in POINTS)
    assert sorted((r.x, r.y, r.z, r.c, r.pid) for r in raw.collect()) == sorted(p[1:] for p in POINTS)


def test_patch(spark, tmp_path):
    np.array([[1.0, 2, 3, 4, 5, 6]]).tofile(tmp_path / "a.patch")
    r = files.read_points(spark, str(tmp_path / "a.patch")).first()
    assert (r.x, r.y, r.z, r.pid, r.c) == (1, 2, 3, 5, 6)


def test_text_and_csv(spark, tmp_path, points):
    sinks.dump_csv(points, str(tmp_path / "csv"))
    assert files.read_points(spark, str(tmp_path / "csv"), "csv").count() == 40
    sinks.dump_text(points, str(tmp_path / "txt"))
    assert sorted(r.x for r in files.read_points(spark, str(tmp_path / "txt"), "txt").collect()) == sorted(p[1] for p in POINTS)


def test_ascii_grid_round_trip(spark, tmp_path):
    cells = spark.createDataFrame([("1km_6173_632", i, j, i * 10.0 + j, 5.0, 7.0) for i in range(3) for j in range(4) if (i, j) != (1, 1)], "tile string, row int, col int, value double, xmin double, ymin double")
    sinks.dump_ascii_grid(cells, str(tmp_path), 3, 4, 2.0).collect()
    got = files.read_ascii_grid(spark, str(tmp_path / "1km_6173_632.asc")).collect()
    assert {(r.row, r.col): r.value for r in got} == {(i, j): i * 10.0 + j for i in range(3) for j in range(4) if (i, j) != (1, 1)}
    assert (got[0].xmin, got[0].ymax, got[0].cell) == (5.0, 13.0, 2.0)


def test_geojson_is_taken_apart(spark, tmp_path):
    ring = [[0, 0], [4, 0], [4, 4], [0, 0]]
    features = [("Point", [1, 2, 3]), ("LineString", [[0, 0, 1], [1, 1, 2]]), ("Polygon", [ring]), ("MultiPolygon", [[ring], [ring]])]
    text = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"id": k}, "geometry": {"type": t, "coordinates": c}} for k, (t, c) in enumerate(features)]}
    (tmp_path / "a.geojson").write_text(json.dumps(text))
    got = files.read_features(spark, str(tmp_path / "a.geojson")).collect()
    assert sorted((r.feat_id, r.part, r.ring, r.seq) for r in got if r.feat_id < 2) == [(0, 0, 0, 0), (1, 0, 0, 0), (1, 0, 0, 1)]
    assert sum(r.feat_id == 3 for r in got) == 8
    assert next(r.z for r in got if r.feat_id == 0) == 3


def test_layer_by_sql_binds_the_extent(spark):
    spark.createDataFrame([(1, "a")], "id int, name string").createOrReplaceTempView("features")
    r = files.layer(spark, sql="SELECT id, WKT_EXT AS ext FROM features", extent=(0, 1, 2, 3)).first()
    assert r.ext == "POLYGON((0 1,0 3,2 3,2 1,0 1))"
    assert files.layer(spark, name="features").count() == 1


def test_catalogue(spark, tmp_path):
    for name in ("a/1km_6173_632.las", "a/b/1km_6174_632.las", "skip/1km_6175_632.las", "a/readme.las"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        las(path, [])
    found = tiles.walk(spark, str(tmp_path), exclude="skip")
    assert sorted((r.tile_name, r.row, r.col) for r in found.collect()) == [("1km_6173_632", 27, 32), ("1km_6174_632", 26, 32)]
    assert tiles.walk(spark, str(tmp_path), depth=1, exclude="skip").count() == 1
    assert tiles.without(found, found.where("row = 27")).count() == 1
    assert tiles.match_reference(found, found.where("row = 27")).count() == 1
    assert tiles.upsert(found, found).count() == 2
    assert tiles.refresh(found, found).count() == 2


def test_reports_by_run(spark, tmp_path, points):
    base = str(tmp_path / "db")
    reports.create(spark, base, ["f_classes_in_tiles"])
    assert reports.exists(spark, "f_classes_in_tiles", base)
    for run in (1, 2, 2):
        log = jobs.run(spark, jobs.definition(kernel="count_classes", schema=base, run_id=run), points).collect()
        assert [(r.tile_name, r.status) for r in log] == [("1km_6173_632", jobs.STATES["finished"])]
    got = reports.read(spark, "f_classes_in_tiles", base)
    assert sorted((r.run_id, r.n_points_total) for r in got.collect()) == [(1, 40), (2, 40)]
    assert reports.reset(spark, "f_classes_in_tiles", base, 1)
    assert reports.read(spark, "f_classes_in_tiles", base).count() == 1
    got.createOrReplaceTempView("f_classes_in_tiles")
    assert "v_classes_distribution" in reports.create_views(spark)
    assert reports.drop(spark, "f_classes_in_tiles", base)


def test_job_definitions(spark, tmp_path, points):
    (tmp_path / "job.json").write_text(json.dumps({"kernel": "spike_check", "radius": 2.0}))
    assert jobs.definition(str(tmp_path / "job.json"), radius=1.0)["radius"] == 1.0
    with pytest.raises(ValueError):
        jobs.definition(kernel="none")
    with pytest.raises(ValueError):
        jobs.definition(kernel="count_classes", radius=1)
    bad = jobs.run(spark, jobs.definition(kernel="time_stats"), points).first()  # the points have no time
    assert bad.status == jobs.STATES["failed"] and bad.msg
    assert all(len(reports.schema(t)) for t in reports.TABLES) and len(reports.TABLES) == 25


def test_stream_appends_with_a_watermark(spark, tmp_path):
    from stratapoint.streaming import arrivals

    rows = spark.sql("SELECT id AS event_id, timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id as int)) AS ts, 1L AS user_id, 'a' AS event_type, 1.0D AS value, '' AS props FROM range(10)")
    rows.repartition(1).write.parquet(str(tmp_path / "in"))
    stream = arrivals.daily(arrivals.arrivals(spark, str(tmp_path / "in")), late="1 day")
    arrivals.run_to_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"), mode="append")
    assert spark.read.parquet(str(tmp_path / "out")).count() <= 10
