"""Every sink and source over the driver's tables: what is written to the shared folder is read back, and held against SQL.

Importing this module adds its queries to those of `proxy`."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar, geometry
from ..operators import homogeneity, plots, raster, series, variogram
from ..schema import CACHE_COLUMNS
from ..sources import asciigrid, csv, fields, netcdf3, shapefile
from ..sources.shared import kept, mounted, new_folder
from ..streaming import runs
from ..streaming.store import Store
from . import proxy
from .proxy import CANDIDATE, CELL, MIN_DAYS, ORACLE, query

DATE = "1997-03-03"


def _with_header(spark: SparkSession, schema: str, path: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


# -- tables as CSV --------------------------------------------------------------------------------------------------


@query(f"WITH {proxy._OBS} SELECT date, station, value FROM (SELECT DISTINCT date FROM obs) CROSS JOIN (SELECT DISTINCT station FROM obs) LEFT JOIN obs USING (date, station)")
def file_wide_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column for each station, blanks where it doesn't report."""
    path = new_folder(spark, "wide")
    csv.write_one_csv(series.to_wide(proxy.observations(spark, sf_dir), "station", "value").orderBy("date"), path)
    return csv.read_wide(spark, path)


@query(ORACLE["utm_projection"].replace("SELECT station, round(", "SELECT station, lon, lat, z, round(").replace("AS easting", "AS x").replace("AS northing", "AS y"))
def file_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "stations")
    csv.write_one_csv(proxy.stations(spark, sf_dir).select(F.col("z").alias("Z"), F.col("station").alias("Station"), F.col("lon").alias("X"), F.col("lat").alias("Y")), path)
    return proxy._rounded(csv.read_stations(spark, path), 3, "x", "y")


@query(f"WITH {proxy._OBS}, {proxy._ANNUAL} SELECT station, CAST(year AS INTEGER) AS year, round(total, 1) AS total FROM (SELECT DISTINCT year FROM annual) CROSS JOIN (SELECT DISTINCT station FROM annual) LEFT JOIN annual USING (station, year)")
def file_annual_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "annual")
    csv.write_annual(homogeneity.annual_totals(proxy.observations(spark, sf_dir), MIN_DAYS), path)
    return csv.read_wide(spark, path, date="Year").select("station", F.year("date").alias("year"), F.col("value").alias("total"))


@query(ORACLE["snht_statistic"])
def file_snht_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests, path = proxy.snht_statistic(spark, sf_dir), new_folder(spark, "snht")
    csv.write_one_csv(tests.orderBy("station"), path)
    return spark.read.schema(tests.schema).option("header", True).csv(path)


@query(f"""WITH {proxy._OBS}, {proxy._ANNUAL}, {proxy._NORM}, {proxy._CORR}, {proxy._RELATIVE}
SELECT CAST(year AS INTEGER) AS year, round(candidate_norm, 3) AS candidate_norm, round(reference, 3) AS reference, round(ratio, 3) AS ratio FROM relative""")
def file_relative_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "relative")
    csv.write_relative(homogeneity.relative_series(homogeneity.annual_totals(proxy.observations(spark, sf_dir), MIN_DAYS), CANDIDATE), CANDIDATE, path)
    return _with_header(spark, "year int, candidate_norm double, reference double, ratio double", path)


@query(ORACLE["homogeneity_report"])
def file_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "report")
    proxy.homogeneity_report(spark, sf_dir).select("report").coalesce(1).write.mode("overwrite").text(path)
    return spark.read.text(path, wholetext=True).select(F.lit(CANDIDATE).alias("station"), F.rtrim("value", F.lit("\n")).alias("report"))


@query(ORACLE["variogram_table_fits"])
def file_variogram_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table made by a run in batches of ten days, as the command line makes it, written as CSV in order of day, and read again."""
    path = new_folder(spark, "variograms")
    runs.build_variogram_table(proxy.observations(spark, sf_dir), proxy.stations(spark, sf_dir), f"{path}/parquet", batch=10)
    csv.write_variogram_table(spark.read.parquet(f"{path}/parquet"), f"{path}/csv")
    columns = [c for c in CACHE_COLUMNS if c == "doy" or c.endswith(("_model", "_rmse", "_n_days"))]
    return proxy._rounded(csv.read_variogram_table(spark, f"{path}/csv"), 3, "ked_rmse", "ok_rmse").select(*columns)


# -- grids, fields and polygons -------------------------------------------------------------------------------------


@query(ORACLE["grid_coords"])
def file_ascii_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing elevations go out as the file's own sign for them and come back as nulls."""
    spark.dataSource.register(asciigrid.AsciiGrid)
    folder = mounted(new_folder(spark, "grid"))
    asciigrid.write(proxy.cells(spark), f"{folder}/dem.asc", CELL)
    return spark.read.format("asciigrid").load(csv.first_existing(f"{folder}/other.asc", f"{folder}/dem.asc"))


def _year_files(spark: SparkSession, sf_dir: str, kind: str = "classic") -> str:
    """A NetCDF file for each year, all years by one job."""
    folder = new_folder(spark, "years")
    place = mounted(folder)
    cells = kept(proxy.field(spark, sf_dir).join(proxy.cells(spark), ["row", "col"]).withColumn("variance", F.abs("rainfall")), "cells")
    days = cells.select("date").distinct().select("date", F.lit(0).alias("method_flag"), F.lit(25).alias("n_reporting"), F.lit(0.5).alias("r"))
    years = [r.year for r in days.select(F.year("date").alias("year")).distinct().orderBy("year").collect()]
    fields.write_years({y: f"{place}/rainfall_{y}.nc" for y in years}, cells, days, proxy.cells(spark), kind)
    return place


@query(f"WITH {proxy._CELLS}, {proxy._FIELD} SELECT date, \"row\", col, x, y, CAST(rainfall AS DOUBLE) AS value, CAST(abs(rainfall) AS DOUBLE) AS variance FROM field JOIN cells USING (\"row\", col)")
def file_netcdf_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each year, all of them read as one field, the first variable by default and the other by name."""
    spark.dataSource.register(netcdf3.NetCdf3)
    place = _year_files(spark, sf_dir)
    variance = spark.read.format("netcdf3").option("variable", "kriging_variance").load(f"{place}/*.nc")
    return spark.read.format("netcdf3").load(place).join(variance.select("date", "row", "col", F.col("value").alias("variance")), ["date", "row", "col"])


@query(ORACLE["file_netcdf_years"])
def file_netcdf4_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same years as NetCDF-4 files, with deflated chunks and an unlimited time."""
    place = _year_files(spark, sf_dir, "netcdf4")
    variance = fields.load(spark, f"{place}/*.nc", variable="kriging_variance")
    return fields.load(spark, place).join(variance.select("date", "row", "col", F.col("value").alias("variance")), ["date", "row", "col"])


@query("SELECT DISTINCT CAST(l_shipdate AS DATE) AS date, 0.0::DOUBLE AS method_flag, 25.0::DOUBLE AS n_stations_reporting, 0.5::DOUBLE AS elevation_rainfall_r FROM lineitem")
def file_netcdf_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the files of all years say about each day."""
    return fields.load_days(spark, _year_files(spark, sf_dir, "netcdf4"))


#: A grid that a table gives: a part is a cell, as many to a row; its size is the elevation, some are missing.
WIDE = 40
_PARTS = f"""dem AS (SELECT CAST(k // {WIDE} AS INTEGER) AS "row", CAST(k % {WIDE} AS INTEGER) AS col, (k % {WIDE} + 0.5::DOUBLE) * {CELL}::DOUBLE AS x, ((SELECT max(p_partkey) // {WIDE} + 1 FROM part) - k // {WIDE} - 0.5::DOUBLE) * {CELL}::DOUBLE AS y,
  CASE WHEN p_size % 7 <> 0 THEN p_size * 31 + k % 50 + 0.125::DOUBLE END AS z FROM (SELECT p_partkey AS k, p_size FROM part))"""


def part_grid(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    parts = proxy._table(spark, sf_dir, "part")
    rows = parts.agg(F.max("p_partkey")).first()[0] // WIDE + 1
    k = F.col("p_partkey")
    cells = parts.select((k / WIDE).cast("int").alias("row"), (k % WIDE).cast("int").alias("col"), F.when(F.col("p_size") % 7 != 0, F.col("p_size") * 31 + k % 50 + 0.125).cast("double").alias("z"))
    return raster.grid_coordinates(cells, rows, 0.0, 0.0, CELL).select("row", "col", "x", "y", "z"), rows


@query(f"WITH {_PARTS} SELECT * FROM dem")
def file_part_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid of all parts, written as an ASCII grid by tasks and read again in byte ranges."""
    path = f"{mounted(new_folder(spark, 'grid'))}/parts.asc"
    asciigrid.write(part_grid(spark, sf_dir)[0], path, CELL)
    return asciigrid.load(spark, path)


@query(f"""WITH {_PARTS} SELECT CAST("row" // 3 AS INTEGER) AS "row", CAST(col // 3 AS INTEGER) AS col, round(avg(x), 4) AS x, round(avg(y), 4) AS y, round(avg(z), 6) AS z FROM dem
WHERE "row" < (SELECT (max("row") + 1) // 3 * 3 FROM dem) AND col < {WIDE // 3 * 3} GROUP BY "row" // 3, col // 3""")
def part_grid_coarsened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid of all parts in cells three times as wide; what is beyond whole ones goes."""
    cells, rows = part_grid(spark, sf_dir)
    found = raster.coarsen(cells, raster.coarsening_factor(CELL, 3 * CELL), rows, WIDE)
    return proxy._rounded(proxy._rounded(found, 4, "x", "y"), 6, "z")


#: A polygon for each supplier: a kite about a place that its key gives, with a hole in every third one.
_KITES = f"""kite AS (SELECT 's' || k AS basin, k, k * 7919 % 200000 AS cx, k * 104729 % 200000 AS cy, 4000 + k * 31 % 21000 AS r FROM (SELECT CAST(s_suppkey AS BIGINT) AS k FROM supplier)),
ring AS (SELECT basin, 0 AS ring, unnest([[cx - r, cy], [cx, cy - 0.5::DOUBLE * r], [cx + r, cy], [cx, cy + 2.0::DOUBLE * r]]) AS p, unnest([0, 1, 2, 3]) AS i FROM kite
  UNION ALL SELECT basin, 1, unnest([[cx - 0.25::DOUBLE * r, cy], [cx, cy - 0.25::DOUBLE * r], [cx + 0.25::DOUBLE * r, cy]]), unnest([0, 1, 2]) FROM kite WHERE k % 3 = 0),
side AS (SELECT basin, p[1] AS ax, p[2] AS ay, coalesce(lead(p[1]) OVER o, first_value(p[1]) OVER o) AS bx, coalesce(lead(p[2]) OVER o, first_value(p[2]) OVER o) AS by_ FROM ring WINDOW o AS (PARTITION BY basin, ring ORDER BY i))"""


@query(f"""WITH {_PARTS}, {_KITES} SELECT basin, "row", col FROM dem, side WHERE (ay > y) <> (by_ > y) AND x < ax + (y - ay) * ((bx - ax) / (by_ - ay)) GROUP BY ALL HAVING count(*) % 2 = 1""")
def file_supplier_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A polygon of each supplier, written as a shapefile, read again, and laid over the grid of all parts."""
    spark.dataSource.register(shapefile.Shapefile)
    folder, rings = mounted(new_folder(spark, "kites")), {}
    for r in proxy._table(spark, sf_dir, "supplier").select("s_suppkey").toLocalIterator():
        k = r.s_suppkey
        cx, cy, size = float(k * 7919 % 200000), float(k * 104729 % 200000), float(4000 + k * 31 % 21000)
        rings[f"s{k}"] = [[(cx - size, cy), (cx, cy - 0.5 * size), (cx + size, cy), (cx, cy + 2.0 * size)]]
        if k % 3 == 0:
            rings[f"s{k}"].append([(cx - 0.25 * size, cy), (cx, cy - 0.25 * size), (cx + 0.25 * size, cy)])
    shapefile.write(f"{folder}/kites.shp", rings)
    return raster.polygon_mask(part_grid(spark, sf_dir)[0], spark.read.format("shapefile").load(f"{folder}/kites.shp"))


@query(f"""WITH {proxy._STATIONS}, {proxy._PAIRS} SELECT s1, s2, model, round(2 + 8 * CASE model WHEN 'spherical' THEN CASE WHEN distance >= r THEN 1 ELSE 1.5 * (distance / r) - 0.5 * (distance / r) ** 3 END
  WHEN 'exponential' THEN 1 - exp(-3 * (distance / r)) ELSE 1 - exp(-3 * (distance / r) ** 2) END, 6) AS gamma FROM (SELECT *, 50000.0::DOUBLE AS r FROM pairs), (VALUES ('spherical'), ('exponential'), ('gaussian')) m(model)""")
def gamma_of_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The semivariance of each pair of stations by each model."""
    pairs = variogram.station_pairs(proxy.stations(spark, sf_dir)).select("s1", "s2", "distance", F.explode(F.array(*[F.lit(m) for m in geometry.MODELS])).alias("model"))
    return pairs.select("s1", "s2", "model", F.round(geometry.gamma(F.col("model"), F.col("distance"), F.lit(2.0), F.lit(10.0), F.lit(50000.0)), 6).alias("gamma"))


@query(f"WITH {proxy._OBS} SELECT date, station, value FROM (SELECT DISTINCT date FROM obs WHERE dayofmonth(date) <> 13) CROSS JOIN (SELECT DISTINCT station FROM obs) LEFT JOIN obs USING (date, station)")
def file_lines_without_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose first column is no date are passed over: here those of every 13th, blank or words by turns."""
    path = new_folder(spark, "dateless")
    wide = series.to_wide(proxy.observations(spark, sf_dir), "station", "value")
    text = F.when(F.dayofmonth("date") != 13, F.col("date").cast("string")).when(F.month("date") % 2 == 0, F.lit("no date"))
    csv.write_one_csv(wide.orderBy("date").withColumn("date", text), path)
    return csv.read_wide(spark, path)


@query(f"""WITH {proxy._CELLS}, {proxy._FIELD} SELECT date, "row", col, x, y, CAST(rainfall AS DOUBLE) AS value FROM field JOIN cells USING ("row", col)
WHERE (date BETWEEN DATE '1996-11-03' AND DATE '1998-02-10') AND "row" IN (3, 4, 9) AND col >= 5 AND x < 80000 AND y > 20000""")
def field_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filters are the feature: dates, rows and columns of a field in files, pushed into the source, which reads no other records and lines."""
    cells = fields.load(spark, _year_files(spark, sf_dir))
    return cells.where("date BETWEEN DATE'1996-11-03' AND DATE'1998-02-10' AND row IN (3, 4, 9) AND col >= 5 AND x < 80000.0 AND y > 20000.0")


@query(ORACLE["zonal_mean"])
def stream_zonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field files arrive in two lots; a stream sums what is new in each by basin, however often it runs, and all sums give the means."""
    folder, years = new_folder(spark, "arrivals"), _year_files(spark, sf_dir)
    place, mask = mounted(folder), kept(raster.polygon_mask(proxy.cells(spark), proxy.polygons(spark)), "mask")
    os.mkdir(f"{place}/in")
    lots = sorted(os.listdir(years))
    for lot in (lots[:3], lots[3:]):
        for name in lot:
            os.rename(f"{years}/{name}", f"{place}/in/{name}")
        for _ in range(2):
            runs.stream_zonal_sums(spark, f"{place}/in", mask, f"{folder}/out", f"{folder}/taken", variable="rainfall")
    return proxy._rounded(runs.zonal_means(spark, f"{folder}/out", proxy.polygons(spark)), 6, "mean")


@query(ORACLE["polygon_mask"])
def file_shapefile_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.dataSource.register(shapefile.Shapefile)
    folder = mounted(new_folder(spark, "shapes"))
    shapefile.write(f"{folder}/basins.shp", proxy.RINGS)
    return raster.polygon_mask(proxy.cells(spark), spark.read.format("shapefile").load(f"{folder}/basins.shp"))


@query(ORACLE["zonal_flush_round"])
def file_zonal_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "zonal")
    csv.write_zonal(raster.tidy(proxy._zonal(spark, sf_dir)), path)
    return csv.read_wide(spark, path, date="Date", name="basin").withColumnRenamed("value", "mean")


@query(ORACLE["typed_series"])
def file_typed_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files for each basin, with type and unit in every row."""
    path = new_folder(spark, "series")
    csv.write_series(raster.tidy(proxy._zonal(spark, sf_dir)).select("date", "basin", F.col("mean").alias("value")), "rainfall", path)
    return _with_header(spark, "date date, value double, variable string, item_type string, unit string, value_type string, basin string", path)


# -- runs and streams -----------------------------------------------------------------------------------------------


@query(ORACLE["doy_window_counts"])
def run_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that stops after some days, is given no time, and is then resumed in batches."""
    path, days = f"{new_folder(spark, 'resumed')}/days", calendar.reference_calendar(spark).select("doy")
    counts = kept(proxy.doy_window_counts(spark, sf_dir), "counts")
    make = lambda keys: counts.where(F.col("doy").isin(keys)).coalesce(1)
    runs.resume(spark, days.where("doy <= 98"), "doy", path, make, 49)
    runs.resume(spark, days, "doy", path, make, 100, budget_s=-1.0)
    runs.resume(spark, days, "doy", path, make, 100)
    return spark.read.parquet(path)


def _lose(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@query(f"WITH {proxy._OBS} SELECT date, station, value, CAST(year(date) AS INTEGER) AS year FROM obs")
def store_of_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store of years that loses one year's files and another one's manifest, and holds stray files, as killed runs leave them, and is resumed: both years are made again, and no row is there twice."""
    path, obs = f"{new_folder(spark, 'store')}/obs", kept(proxy.observations(spark, sf_dir).withColumn("year", F.year("date")), "obs")
    years, made = [r.year for r in obs.select("year").distinct().orderBy("year").collect()], []

    def make(own: list) -> list[DataFrame]:
        made.extend(own)
        return [obs.where(F.col("year").isin(own)).repartition(2)]

    store = Store(spark, path, "year", True)
    runs.fill([store], years, make, 1)
    first, last = years[0], years[-1]
    of = lambda year: next(f for f in store.read().inputFiles() if f"/year={year}/" in f)
    _lose(spark, of(first))
    spark.read.parquet(of(last)).write.mode("append").parquet(f"{path}/year={last}")  # files that no manifest names
    _lose(spark, f"{path}/_manifest/{next(name for name, m in store._manifests().items() if m['keys'] == [last])}")
    if runs.fill([store], years, make, 1) != len(years) or made != [*years, *sorted({first, last})]:
        raise AssertionError(f"years made: {made}")
    return store.read().select("date", "station", "value", "year")


@query("SELECT CAST(l_shipdate AS DATE) AS date, CAST(s_nationkey AS VARCHAR) AS station, sum(l_quantity) AS value, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2")
def stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines arrive in two sets of files; each file is taken once, however often the stream runs."""
    folder = new_folder(spark, "stream")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").join(spark.read.parquet(f"{sf_dir}/supplier.parquet"), F.col("l_suppkey") == F.col("s_suppkey"))
    lines = lines.select(F.col("l_shipdate").cast("date").alias("date"), F.col("s_nationkey").cast("string").alias("station"), F.col("l_quantity").cast("double").alias("value"))
    early = F.year("date") <= 1997
    for arrived in (lines.where(early), lines.where(~F.coalesce(early, F.lit(False)))):
        arrived.write.mode("append").parquet(f"{folder}/in")
        for _ in range(2):
            runs.stream_daily_totals(spark, f"{folder}/in", lines.schema, f"{folder}/out", f"{folder}/taken")
    return runs.daily_totals(spark, f"{folder}/out")


# -- clipping, and the surface of a day -----------------------------------------------------------------------------


@query(f"WITH {proxy._CELLS}, {proxy._FIELD} SELECT date, \"row\", col, CASE WHEN rainfall < 0 THEN 0 ELSE CAST(rainfall AS DOUBLE) END AS rainfall FROM field")
def clipped_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proxy.field(spark, sf_dir).withColumn("rainfall", geometry.clip_zero(F.col("rainfall").cast("double")))


@query(f"""WITH {proxy._CELLS}, {proxy._FIELD}, {proxy._OBS}, {proxy._STATIONS}, {proxy._PRESENT}
SELECT date, "row", col, CAST(rainfall AS DOUBLE) AS value, NULL AS station FROM field WHERE date = DATE '{DATE}' AND rainfall IS NOT NULL
UNION ALL SELECT date, NULL, NULL, value, station FROM present WHERE date = DATE '{DATE}'""")
def plot_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One date is the feature: its cells with values, and the stations laid over them."""
    cells, over = plots.surface(proxy.field(spark, sf_dir), proxy.observations(spark, sf_dir), proxy.stations(spark, sf_dir), DATE)
    return series.combine(cells.select("date", "row", "col", F.col("rainfall").cast("double").alias("value")), over.select("date", "value", "station"))
