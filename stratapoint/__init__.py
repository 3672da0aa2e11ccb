"""Point-cloud analytics on Spark: points, tiles, rasters, triangles and features as DataFrames."""
