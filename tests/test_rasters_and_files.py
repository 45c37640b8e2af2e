import datetime as dt
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainloom.operators import raster, series
from rainloom.sources import asciigrid, csv, netcdf3, shapefile
from rainloom.streaming import runs


def test_coarsen_drops_the_rest_and_skips_missing(spark):
    grid = spark.createDataFrame([(r, c, float(c), float(-r), None if (r, c) == (0, 0) or (r > 1 and c < 2) else float(r * 5 + c)) for r in range(5) for c in range(5)], "row int, col int, x double, y double, z double")
    found = {(r.row, r.col): (r.x, r.y, r.z) for r in raster.coarsen(grid, 2, 5, 5).collect()}
    assert found == {(0, 0): (0.5, -0.5, 4.0), (0, 1): (2.5, -0.5, 5.0), (1, 0): (0.5, -2.5, None), (1, 1): (2.5, -2.5, 15.0)}
    with pytest.raises(ValueError):
        raster.coarsening_factor(30, 100)


def test_masks_holes_overlaps_and_specks(spark):
    ids = spark.range(100).select((F.col("id") / 10).cast("int").alias("row"), (F.col("id") % 10).cast("int").alias("col"))
    grid = raster.grid_coordinates(ids, 10, 0.0, 0.0, 1.0)
    square = lambda a, b: [(a, a), (b, a), (b, b), (a, b)]
    polygons = raster.polygons_of(spark, {"ring": [square(1.0, 9.0), square(3.0, 7.0)], "part": [square(0.0, 2.0)], "speck": [square(0.1, 0.2)], "dry": [square(9.0, 10.0)]})
    mask = raster.polygon_mask(grid, polygons)
    sizes = {r.basin: r["count"] for r in mask.groupBy("basin").count().collect()}
    assert sizes == {"ring": 48, "part": 4, "dry": 1}
    day = dt.date(2001, 1, 1)
    values = grid.select(F.lit(day).alias("date"), "row", "col", F.when(~((F.col("col") == 9) & (F.col("row") == 0)), F.col("col").cast("float")).alias("rainfall"))
    found = {r.basin: (r["mean"], r.n_valid) for r in raster.zonal_mean(values, mask, polygons).collect()}
    assert found == {"ring": (4.5, 48), "part": (0.5, 4), "speck": (None, 0), "dry": (None, 0)}
    zonal = raster.zonal_mean(values, mask, polygons)
    assert raster.warnings(zonal).count() == 2
    assert {r.basin: r.total for r in raster.annual_sums(raster.tidy(zonal)).collect()} == {"ring": 5.0, "part": 1.0, "speck": 0.0, "dry": 0.0}


def test_ascii_grid_round_trip(spark, tmp_path):
    path = tmp_path / "dem.asc"
    path.write_text("NCOLS 3\nNROWS 2\nXLLCENTER 100.5\nYLLCENTER 200.5\nCELLSIZE 1\nNODATA_value -9999\n1 2 3\n4 -9999 6.25\n")
    spark.dataSource.register(asciigrid.AsciiGrid)
    grid = spark.read.format("asciigrid").load(str(path))
    rows = {(r.row, r.col): (r.x, r.y, r.z) for r in grid.collect()}
    assert rows[0, 0] == (100.5, 201.5, 1.0) and rows[1, 1] == (101.5, 200.5, None) and rows[1, 2][2] == 6.25
    asciigrid.write(grid, str(tmp_path / "out.asc"), 1.0)
    assert {(r.row, r.col): (r.x, r.y, r.z) for r in spark.read.format("asciigrid").load(str(tmp_path / "out.asc")).collect()} == rows
    (tmp_path / "bad.asc").write_text("ncols 3\n1 2 3\n")
    with pytest.raises(ValueError):
        asciigrid.GridHeader.read(str(tmp_path / "bad.asc"))


def test_netcdf_round_trip(spark, tmp_path):
    days, ys, xs = np.arange(6210, 6250, dtype="i4"), np.array([300.0, 200.0, 100.0]), np.array([10.0, 20.0])
    cube = np.arange(240, dtype="f4").reshape(40, 3, 2)
    cube[5, 1, 1] = np.nan
    flag = np.array([-1.0, 0.0] * 20, "f4")
    f4 = lambda v: {"_FillValue": np.array([v], "f4")}
    path = str(tmp_path / "rain_1997.nc")
    netcdf3.write(path, {"time": None, "y": 3, "x": 2}, [
        netcdf3.Var("time", ("time",), days, {"units": "days since 1980-01-01"}), netcdf3.Var("y", ("y",), ys), netcdf3.Var("x", ("x",), xs),
        netcdf3.Var("rainfall", ("time", "y", "x"), cube, f4(np.nan)), netcdf3.Var("method_flag", ("time",), flag, f4(-1)), netcdf3.Var("odd", ("time", "x"), (cube[:, 0] % 7).astype("i2")),
    ], {"title": "test", "n": 3})
    back = netcdf3.to_dict(path)
    assert back["attributes"]["title"] == "test" and back["dimensions"] == {"time": 40, "y": 3, "x": 2}
    v = back["variables"]
    assert np.array_equal(v["rainfall"].data, cube, equal_nan=True) and np.array_equal(v["odd"].data, cube[:, 0] % 7) and np.isnan(v["method_flag"].data[0])
    assert struct.unpack(">i", open(path, "rb").read()[4:8])[0] == 40
    spark.dataSource.register(netcdf3.NetCdf3)
    rows = {(r.date, r.row, r.col): r for r in spark.read.format("netcdf3").load(str(tmp_path)).collect()}
    assert len(rows) == 240 and rows[dt.date(1997, 1, 6), 1, 1].value is None
    r = rows[dt.date(1997, 1, 1), 0, 1]
    assert (r.x, r.y, r.value) == (20.0, 300.0, 1.0)
    (tmp_path / "h.nc").write_bytes(b"\x89HDF\r\n\x1a\n")
    with pytest.raises(ValueError, match="HDF5"):
        netcdf3.Classic(str(tmp_path / "h.nc"))
    with pytest.raises(ValueError):
        netcdf3.write(str(tmp_path / "w.nc"), {"x": 3}, [netcdf3.Var("x", ("x",), xs)])
    assert not (tmp_path / "w.nc").exists() and not (tmp_path / "w.nc.part").exists()


def test_year_file(spark, tmp_path):
    day = dt.date(1999, 5, 4)
    cells = spark.createDataFrame([(day, 0, 0, 1.0, 9.0, 2.5, 0.5), (day, 0, 1, 2.0, 9.0, None, None)], "date date, row int, col int, x double, y double, rainfall float, variance float")
    days = spark.createDataFrame([(day, 1, 9, 0.5), (dt.date(1999, 5, 5), -1, 2, None)], "date date, method_flag int, n_reporting int, r float")
    netcdf3.write_year(str(tmp_path / "y.nc"), cells, days, 1999)
    v = netcdf3.to_dict(str(tmp_path / "y.nc"))["variables"]
    assert v["rainfall"].data.shape == (2, 1, 2) and v["rainfall"].data[0, 0, 0] == 2.5 and np.isnan(v["rainfall"].data[1]).all()
    assert v["time"].data.tolist() == [7063, 7064]


def test_shapefile(spark, tmp_path):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 0.0)]
    body = struct.pack("<i4dii", 5, 0, 0, 4, 4, 1, len(ring)) + struct.pack("<i", 0) + b"".join(struct.pack("<2d", *p) for p in ring)
    record = struct.pack(">ii", 1, len(body) // 2) + body
    empty = struct.pack(">ii", 2, 2) + struct.pack("<i", 0)
    head = struct.pack(">i", 9994) + bytes(20) + struct.pack(">i", (100 + len(record) + len(empty)) // 2) + struct.pack("<ii", 1000, 5) + bytes(64)
    (tmp_path / "a.shp").write_bytes(head + record + empty)
    field = b"Cat_Name".ljust(11, b"\0") + b"C" + bytes(4) + bytes([6]) + bytes(15)
    (tmp_path / "a.dbf").write_bytes(struct.pack("<B3BIHH", 3, 99, 1, 1, 2, 65, 7) + bytes(20) + field + b"\r" + b" Upper " + b" Lower ")
    spark.dataSource.register(shapefile.Shapefile)
    rows = spark.read.format("shapefile").load(str(tmp_path / "a.shp")).collect()
    assert [(r.basin, [[tuple(p) for p in ring] for ring in r.rings]) for r in rows] == [("Upper", [ring[:-1]])]
    with pytest.raises(ValueError, match="no field"):
        shapefile.read_names(str(tmp_path / "a.dbf"), "Name")


def test_csv_sources_and_sinks(spark, tmp_path):
    (tmp_path / "rain.csv").write_text("Station_ID,909,1030\n2001-01-02,1.5,\n2001-01-01,,2\nbad,3,4\n,5,6\n")
    obs = csv.read_meteo(spark, str(tmp_path / "rain.csv"))
    assert [tuple(r) for r in obs.orderBy("date", "station").collect()] == [(dt.date(2001, 1, 1), "1030", 2.0), (dt.date(2001, 1, 1), "909", None), (dt.date(2001, 1, 2), "1030", None), (dt.date(2001, 1, 2), "909", 1.5)]
    with pytest.raises(ValueError):
        csv.read_meteo(spark, "rain.txt")
    with pytest.raises(ValueError):
        csv.read_wide(spark, str(tmp_path / "rain.csv"), date="Date")
    (tmp_path / "st.csv").write_text("Station,Y,X,Z\n909,27.16416667,84.98,137\n1030,27.7,85.35,\n")
    st = {r.station: r for r in csv.read_stations(spark, str(tmp_path / "st.csv")).collect()}
    assert st["909"].lon == 84.98 and st["909"].z == 137 and st["1030"].z is None and 200000 < st["909"].x < 400000
    with pytest.raises(ValueError, match="lacks"):
        csv.read_stations(spark, str(tmp_path / "rain.csv"))
    zonal = spark.createDataFrame([(dt.date(2001, 1, 1), "a", 1.25), (dt.date(2001, 1, 1), "b", None)], "date date, basin string, mean double")
    csv.write_zonal(zonal, str(tmp_path / "zonal"))
    back = csv.read_wide(spark, str(tmp_path / "zonal"), date="Date", name="basin")
    assert {(r.basin, r.value) for r in back.collect()} == {("a", 1.25), ("b", None)}
    csv.write_series(zonal.withColumnRenamed("mean", "value"), "Discharge", str(tmp_path / "series"))
    assert (tmp_path / "series" / "basin=a").exists()
    with pytest.raises(ValueError, match="no unit"):
        series.typed(zonal, "snow")


def test_set_checks(spark):
    obs = spark.createDataFrame([("2001-01-01", "a", 1.0), ("2001-01-03", "b", 2.0)], "date string, station string, value double").withColumn("date", F.col("date").cast("date"))
    known = spark.createDataFrame([("a",)], "station string")
    assert [r.station for r in series.missing_stations(obs, known).collect()] == ["b"]
    with pytest.raises(ValueError, match="b"):
        series.check_stations(obs, known)
    with pytest.raises(ValueError, match="2001-01-01 to 2001-01-03"):
        series.one_date(obs, "2001-01-02")
    assert series.year_range(obs, 2002, None).count() == 2 and series.year_range(obs, 2002, 2003).count() == 0


def test_resumed_runs_equal_one(spark, tmp_path):
    keys = spark.range(7).withColumnRenamed("id", "k")
    made = []

    def make(own):
        made.append(own)
        return spark.createDataFrame([(k, k * k) for k in own], "k long, v long")

    path = str(tmp_path / "t")
    assert runs.resume(spark, keys, "k", path, make, batch=3, budget_s=-1) == 0
    make([0, 1]).write.parquet(path)
    made.clear()
    assert runs.resume(spark, keys, "k", path, make, batch=3) == 7
    assert made == [[2, 3, 4], [5, 6]] and spark.read.parquet(path).count() == 7
    assert runs.resume(spark, keys, "k", path, make) == 7 and len(made) == 2


def test_stream_takes_each_file_once(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    rows = lambda v: spark.createDataFrame([(dt.date(2001, 1, 1), "a", v)], "date date, station string, value double")
    for v in (1.0, 2.0):
        rows(v).write.mode("append").parquet(src)
        for _ in range(2):
            runs.stream_daily_totals(spark, src, rows(v).schema, out, check)
    assert [tuple(r) for r in runs.daily_totals(spark, out).collect()] == [(dt.date(2001, 1, 1), "a", 3.0, 2)]
