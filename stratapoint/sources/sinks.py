"""Writers. Tables and text go through Spark's writers; formats of one file per tile are written by the task that holds it."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_DATA = -9999.0
DONE = pa.schema([("tile", pa.string()), ("path", pa.string()), ("n", pa.int64())])


def dump_csv(points: DataFrame, path: str) -> None:
    """x, y, z with two decimals, and class and strip where there are any; with a header."""
    cols = [F.format_string("%.2f", F.col(a)).alias(a) for a in "xyz"]
    cols += [F.col(c).alias(n) for c, n in (("c", "c"), ("pid", "strip")) if c in points.columns]
    points.select(*cols).write.csv(path, header=True)


def dump_text(points: DataFrame, path: str) -> None:
    points.select(F.concat_ws(" ", *[F.format_string("%.18e", F.col(a)) for a in "xyz"])).write.text(path)


def compress(points: DataFrame, path: str) -> None:
    """The points as Parquet under a strong codec, by tile."""
    points.repartition("tile").sortWithinPartitions("tile").write.partitionBy("tile").option("compression", "zstd").parquet(path)


def _put(folder: str, name: str, data: bytes) -> str:
    """Write a file beside its place, then move it there: a task that runs twice leaves one whole file."""
    import uuid

    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    system.create_dir(base, recursive=True)
    part = f"{base}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(data)
    system.move(part, f"{base}/{name}")
    return f"{base}/{name}"


def _by_tile(df: DataFrame, columns: list[str], folder: str, ext: str, encode) -> DataFrame:
    def write(table: pa.Table) -> pa.Table:
        tile = table["tile"][0].as_py()
        path = _put(folder, f"{tile}.{ext}", encode(table))
        return pa.Table.from_pylist([{"tile": tile, "path": path, "n": table.num_rows}], schema=DONE)

    return df.select("tile", *columns).groupBy("tile").applyInArrow(write, "tile string, path string, n long")


def dump_npy(points: DataFrame, folder: str) -> DataFrame:
    """tile, path, n of one .npy file of x, y, z per tile; acting on the result writes them."""

    def encode(t: pa.Table) -> bytes:
        out = io.BytesIO()
        np.save(out, np.stack([t[a].to_numpy() for a in "xyz"], axis=1))
        return out.getvalue()

    return _by_tile(points, ["x", "y", "z"], folder, "npy", encode)


def dump_bin(points: DataFrame, folder: str) -> DataFrame:
    """The same, with x, y, z, class and strip as raw doubles."""
    names = ["x", "y", "z", "c", "pid"]
    return _by_tile(points, names, folder, "bin", lambda t: np.stack([t[a].to_numpy().astype("<f8") for a in names], axis=1).tobytes())


def dump_ascii_grid(cells: DataFrame, folder: str, rows: int, cols: int, cell: float) -> DataFrame:
    """The same, with rasters (tile, row, col, value, xmin, ymin) as ESRI ASCII grids; cells without a row are no-data."""

    def encode(t: pa.Table) -> bytes:
        grid = np.full((rows, cols), NO_DATA)
        grid[t["row"].to_numpy(), t["col"].to_numpy()] = t["value"].to_numpy(zero_copy_only=False) if isinstance(t["value"], pa.Array) else t["value"].to_numpy()
        grid[np.isnan(grid)] = NO_DATA
        head = f"ncols {cols}\nnrows {rows}\nxllcorner {t['xmin'][0].as_py()}\nyllcorner {t['ymin'][0].as_py()}\ncellsize {cell}\nNODATA_value {NO_DATA:g}\n"
        return (head + "\n".join(" ".join(f"{v:.10g}" for v in row) for row in grid) + "\n").encode()

    return _by_tile(cells, ["row", "col", "value", "xmin", "ymin"], folder, "asc", encode)
