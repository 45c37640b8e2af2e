"""Rainloom: station, raster and zonal rainfall analytics as Spark DataFrame operators."""
