"""Stores that were killed half way, fields written by tasks, filters that reach the files, streams of files, masks and zonal sums by blocks."""

import datetime as dt
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainloom.functions import geometry
from rainloom.operators import kriging, raster, variogram
from rainloom.schema import Variogram
from rainloom.sources import fields, netcdf3
from rainloom.streaming import runs
from rainloom.streaming.store import Store

DAY = dt.date(2001, 12, 30)


def numbers(spark, keys):
    return spark.createDataFrame([(k, 10 * k + j) for k in keys for j in range(10)], "k int, v int").repartition(2)


@pytest.mark.parametrize("partitioned", [False, True])
def test_a_store_makes_what_a_killed_run_left(spark, tmp_path, partitioned):
    path, made = str(tmp_path / "s"), []

    def make(own):
        made.extend(own)
        return [numbers(spark, own)]

    store = Store(spark, path, "k", partitioned)
    assert runs.fill([store], [1, 2, 3, 4], make, 1) == 4
    files = sorted(f.removeprefix("file:").removeprefix("//") for f in store.read().inputFiles())
    whole = sorted(map(tuple, store.read().select("k", "v").collect()))
    # a file of one key is lost, the manifest of another one, and a batch had been moved without a manifest
    holding = {k: [f for f in files if k in {r.k if not partitioned else int(f.split("k=")[1].split("/")[0]) for r in (spark.read.parquet(f).select("k").collect() if not partitioned else [None])} or partitioned and f"/k={k}/" in f] for k in (1, 2)}
    os.remove(holding[1][0])
    gone = next(n for n, m in store._manifests().items() if m["keys"] == [2])
    os.remove(f"{path}/_manifest/{gone}")
    made.clear()
    assert runs.fill([store], [1, 2, 3, 4], make, 1, budget_s=-1) == 2 and not made
    assert runs.fill([Store(spark, path, "k", partitioned)], [1, 2, 3, 4], make, 1) == 4 and made == [1, 2]
    assert sorted(map(tuple, store.read().select("k", "v").collect())) == whole
    assert runs.fill([store], [1, 2, 3, 4], make, 1) == 4 and len(made) == 2


def test_a_failing_batch_leaves_others_and_keys_without_rows_are_done(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), "k")

    def make(own):
        if 5 in own:
            raise ArithmeticError("no key 5")
        return [numbers(spark, [k for k in own if k != 2])]

    with pytest.raises(ArithmeticError):
        runs.fill([store], [1, 2, 5, 6], make, 1, at_once=2)
    assert {"1", "2"} <= store.open() and store.read().select("k").distinct().count() == len(store.open()) - 1
    assert runs.fill([store], [1, 2, 6], make, 1) == 3


def test_batches_grow(spark, tmp_path):
    sizes = []
    store = Store(spark, str(tmp_path / "s"), "k")
    runs.fill([store], list(range(20)), lambda own: [sizes.append(len(own)) or numbers(spark, own)][-1:], 3, growth=2)
    assert sizes == [3, 6, 11] and store.read().count() == 200


@pytest.fixture(scope="module")
def small(spark):
    rng = random.Random(4)
    names = [str(k) for k in range(9)]
    stations = spark.createDataFrame([(s, 85.0, 27.0, rng.random() * 900, rng.random() * 9e4, rng.random() * 9e4) for s in names], "station string, lon double, lat double, z double, x double, y double").cache()
    rows = [(DAY + dt.timedelta(days=k), s, rng.random() * 20) for k in range(-40, 40) for s in names]
    return spark.createDataFrame(rows, "date date, station string, value double").repartition(3).cache(), stations


def test_variogram_table_in_batches_equals_one_job(spark, small, tmp_path):
    obs, stations = small
    path = str(tmp_path / "t")
    assert runs.build_variogram_table(obs, stations, path, batch=50, budget_s=-1.0) == 0
    assert runs.build_variogram_table(obs, stations, path, batch=50) == 365
    # the second run starts from the stored sums, whatever the observations are by now
    first = Store(spark, path, "doy")
    gone = first.read().inputFiles()[0].removeprefix("file:").removeprefix("//")
    os.remove(gone)
    assert runs.build_variogram_table(obs.limit(0), stations, path, batch=7) == 365
    rounded = lambda df: sorted(str([round(x, 7) if isinstance(x, float) else x for x in r]) for r in df.collect())
    want = variogram.variogram_table(obs, stations)
    assert rounded(spark.read.parquet(path).select(want.columns)) == rounded(want)
    one = variogram.variogram_table(obs, stations, Variogram(), [3])
    assert rounded(one) == rounded(want.where("doy = 3"))


def test_kriged_years_are_cells_and_days_and_whole(spark, small, tmp_path):
    obs, stations = small
    grid = raster.grid_coordinates(spark.range(12).select((F.col("id") / 4).cast("int").alias("row"), (F.col("id") % 4).cast("int").alias("col")), 3, 0.0, 0.0, 2e4).withColumn("z", F.lit(100.0))
    table, path = variogram.variogram_table(obs, stations).cache(), str(tmp_path / "k")
    assert runs.krige_years(obs, stations, grid, table, path) == 2
    cells, days = (spark.read.parquet(p) for p in (path, f"{path}/{runs.DAYS}"))
    assert days.count() == 80 and cells.count() == 80 * 12 and {f for f in cells.columns} >= {"year", "rainfall", "variance"}
    lost = next(f for f in cells.inputFiles() if "year=2002" in f).removeprefix("file:").removeprefix("//")
    os.remove(lost)
    assert runs.krige_years(obs, stations, grid, table, path) == 2
    again = spark.read.parquet(path)
    assert again.count() == 80 * 12 and again.groupBy("date", "row", "col").count().where("count > 1").isEmpty()
    pruned = again.where("year = 2001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in pruned and "(year#" in pruned
    whole = kriging.krige(obs, stations, grid, table)[0]
    assert whole.exceptAll(again.select(whole.columns)).where("rainfall IS NULL").isEmpty()


# -- fields in files ------------------------------------------------------------------------------------------------


def made_field(spark, days=5, rows=7, cols=4):
    ids = spark.range(days * rows * cols)
    k = F.col("id").cast("int")
    own = ids.select(F.date_add(F.lit(DAY), (k / (rows * cols)).cast("int")).alias("date"), (k / cols).cast("int").alias("r"), (k % cols).alias("col")).withColumn("row", F.col("r") % rows).drop("r")
    value = F.when((F.col("row") + F.col("col")) % 5 != 0, F.col("row") * 10.5 + F.col("col") + F.dayofmonth("date") / 100)
    return own.select("date", "row", "col", (F.col("col") * 10.0 + 5).alias("x"), (100.0 - F.col("row") * 10).alias("y"), value.cast("float").alias("rainfall"), (value * 2).cast("float").alias("variance"))


def day_rows(cells):
    return cells.select("date").distinct().select("date", F.lit(1).alias("method_flag"), F.lit(9).alias("n_reporting"), F.lit(0.25).alias("r"))


def written(spark, tmp_path, cells, **more):
    paths = {y: str(tmp_path / f"f_{y}.nc") for y in (2001, 2002)}
    fields.write_years(paths, cells, day_rows(cells), **more)
    return paths


def test_tasks_write_what_the_plain_writer_writes(spark, tmp_path, monkeypatch):
    cells = made_field(spark)
    monkeypatch.setattr(fields, "PIECE", 8)  # pieces of two lines
    paths = written(spark, tmp_path, cells.repartition(6))
    assert sorted(os.listdir(tmp_path)) == ["f_2001.nc", "f_2002.nc"]
    for year, path in paths.items():
        own = [r for r in cells.collect() if r.date.year == year]
        days = sorted({r.date for r in own})
        cubes = {"rainfall": np.full((len(days), 7, 4), np.nan, "f4"), "kriging_variance": np.full((len(days), 7, 4), np.nan, "f4")}
        for r in own:
            for name, c in fields.CUBES.items():
                cubes[name][days.index(r.date), r.row, r.col] = np.nan if r[c] is None else r[c]
        sorted_days = sorted(day_rows(cells.where(F.year("date") == year)).collect(), key=lambda r: r.date)
        variables = fields.year_variables(sorted_days, 100.0 - 10.0 * np.arange(7), 10.0 * np.arange(4) + 5, "EPSG:32645", "1980-01-01", cubes.get)
        plain = str(tmp_path / "plain.nc")
        netcdf3.write(plain, {"time": None, "y": 7, "x": 4}, variables, fields.year_attributes(year, "EPSG:32645", 0.3, 8))
        assert open(path, "rb").read() == open(plain, "rb").read()
    back = fields.load(spark, str(tmp_path / "f_*.nc"))
    assert back.count() == 5 * 28 and back.where("value IS NOT NULL").join(cells, ["date", "row", "col", "x", "y"]).where("value <> rainfall").isEmpty()


def test_days_without_cells_are_missing_not_zero(spark, tmp_path):
    cells = made_field(spark)
    days = day_rows(cells)
    path = str(tmp_path / "y.nc")
    netcdf3.write_year(path, cells.where("date <> DATE'2001-12-31' AND row > 1"), days, 2001)
    v = netcdf3.to_dict(path)["variables"]["rainfall"].data
    assert v.shape == (2, 5, 4) and np.isnan(v[1]).all() and not np.isnan(v[0]).all()
    with pytest.raises(ValueError, match="no field"):
        netcdf3.write_year(str(tmp_path / "none.nc"), cells.limit(0), days, 2001)
    fields.write_years({2001: str(tmp_path / "none.nc")}, cells.limit(0), days, cells)
    assert np.isnan(netcdf3.to_dict(str(tmp_path / "none.nc"))["variables"]["rainfall"].data).all()


def test_a_job_that_fails_leaves_no_file(spark, tmp_path):
    broken = made_field(spark).withColumn("rainfall", F.when(F.col("date") == "2002-01-01", F.raise_error(F.lit("lost")).cast("float")).otherwise(F.col("rainfall")))
    with pytest.raises(Exception, match="lost"):
        fields.write_years({2001: str(tmp_path / "a.nc"), 2002: str(tmp_path / "b.nc")}, broken, day_rows(made_field(spark)), made_field(spark))
    assert os.listdir(tmp_path) == []


def test_pieces_that_nobody_wrote_are_found(tmp_path):
    import json

    part = tmp_path / "a.nc.part"
    part.write_bytes(b"")
    (tmp_path / "plan").write_text(json.dumps({"pieces": 3, "files": [{"part": str(part), "path": str(tmp_path / "a.nc")}]}))
    writer = fields.YearWriter({"path": str(tmp_path / "plan")})
    with pytest.raises(RuntimeError, match="1 pieces"):
        writer.commit([fields.Written([0, 1]), None, fields.Written([1])])
    writer.abort([])
    assert not part.exists()


def test_a_task_that_runs_again_writes_the_same_bytes(spark, tmp_path):
    import json
    import shutil

    import pyarrow as pa

    cells = made_field(spark)
    paths = written(spark, tmp_path, cells)
    whole = open(paths[2001], "rb").read()
    layout = {"path": paths[2001], "part": paths[2001], "first": 0}
    c = netcdf3.Classic(paths[2001])
    plan = {"rows": list(range(7)), "cols": list(range(4)), "height": 7, "bands": 1, "variables": list(fields.CUBES), "pieces": 2, "files": [layout | {"begin": {n: c.place(n).begin for n in fields.CUBES}, "step": c.stride}]}
    (tmp_path / "plan").write_text(json.dumps(plan))
    own = [r for r in cells.collect() if r.date == DAY]
    column = lambda name, kind: pa.array([None, *(r[name] for r in own)], kind)
    batch = pa.RecordBatch.from_arrays([pa.array([0] * (len(own) + 1), pa.int64()), column("row", pa.int32()), column("col", pa.int32()), column("rainfall", pa.float32()), column("variance", pa.float32())], ["piece", "row", "col", "rainfall", "kriging_variance"])
    for _ in range(2):
        writer = fields.YearWriter({"path": str(tmp_path / "plan")})
        assert writer.write(iter([batch.slice(0, 9), batch.slice(9)])).pieces == [0]
        assert open(paths[2001], "rb").read() == whole
    shutil.rmtree(tmp_path, ignore_errors=True)


def test_filters_reach_the_files(spark, tmp_path):
    cells = made_field(spark, 8, 6, 4)
    written(spark, tmp_path, cells)
    found = fields.load(spark, str(tmp_path)).where("date = DATE'2002-01-02' AND row IN (1, 3) AND x BETWEEN 10.0 AND 30.0 AND value > 12")
    want = cells.where("date = DATE'2002-01-02' AND row IN (1, 3) AND x BETWEEN 10.0 AND 30.0 AND rainfall > 12")
    assert {(r.row, r.col, r.value) for r in found.collect()} == {(r.row, r.col, r.rainfall) for r in want.collect()} and want.count()
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThan, Not

    reader = fields.FilteredReader({"path": str(tmp_path)})
    odd = [GreaterThan(("value",), 1.0), Not(EqualTo(("row",), 1)), EqualTo(("row",), None)]
    kept = list(reader.pushFilters([EqualTo(("date",), dt.date(2002, 1, 2)), In(("row",), (1, 3)), LessThan(("col",), 2), *odd]))
    assert kept == odd
    parts = reader.partitions()
    assert [(os.path.basename(p.path), p.first, p.last) for p in parts] == [("f_2002.nc", 1, 2)]
    before = netcdf3.Classic.taken
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == 4
    axes = 6 * 4 + (6 + 4) * 8  # days as int32, two axes as doubles
    assert netcdf3.Classic.taken - before == axes + 3 * 4 * 4  # lines 1 to 3 of one record
    none = fields.FilteredReader({"path": str(tmp_path)})
    assert not list(none.pushFilters([GreaterThan(("row",), 99)])) and [b for p in none.partitions() for b in none.read(p)] == []
    assert fields.load(spark, str(tmp_path)).where("row > 99").count() == 0


def test_a_stream_takes_each_record_once(spark, tmp_path):
    cells = made_field(spark, 6)
    (tmp_path / "all").mkdir()
    (tmp_path / "in").mkdir()
    written(spark, tmp_path / "all", cells)
    mask = spark.createDataFrame([("a", r, c) for r in range(3) for c in range(4)] + [("b", 6, 1)], "basin string, row int, col int").cache()
    go = lambda: runs.stream_zonal_sums(spark, str(tmp_path / "in"), mask, str(tmp_path / "out"), str(tmp_path / "check"))
    for name in ("f_2001.nc", "f_2002.nc"):
        os.rename(tmp_path / "all" / name, tmp_path / "in" / name)
        go()
        go()
    exact = lambda df: sorted((r.date, r.basin, r.n_valid, None if r.mean is None else round(r.mean, 6)) for r in df.collect())
    basins = mask.select("basin").distinct()
    assert exact(runs.zonal_means(spark, str(tmp_path / "out"), basins)) == exact(raster.zonal_mean(cells, mask, basins))
    assert len(os.listdir(tmp_path / "out")) == 2
    # a batch that had not been acknowledged when the run was killed runs again, and replaces itself
    for f in (tmp_path / "check" / "commits").iterdir():
        if f.name in ("1", ".1.crc"):
            f.unlink()
    go()
    assert exact(runs.zonal_means(spark, str(tmp_path / "out"), basins)) == exact(raster.zonal_mean(cells, mask, basins))


# -- masks and zonal sums -------------------------------------------------------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def made_polygons(rng, n):
    out = []
    for k in range(n):
        x, y = rng.uniform(0, 900), rng.uniform(0, 900)
        ring = [(x + rng.uniform(-150, 150), y + rng.uniform(-150, 150)) for _ in range(rng.randint(3, 9))]
        rings = [ring + ring[:1] if k % 2 else ring]
        if k % 3 == 0:
            rings.append([(x + rng.uniform(-40, 40), y + rng.uniform(-40, 40)) for _ in range(4)])
        out.append((f"b{k % 7}", rings))
    # corners and edges that lie on cells' centres, rings that touch, and an empty one
    out += [("on", [[(5.0, 5.0), (105.0, 5.0), (105.0, 105.0), (5.0, 105.0)], [(105.0, 105.0), (205.0, 105.0), (205.0, 205.0)]]), ("none", []), ("point", [[(5.0, 5.0)]])]
    return out


@pytest.mark.parametrize("tile", [None, 13.0, 100_000.0])
def test_masks_equal_the_even_odd_rule(spark, tile):
    polygons = made_polygons(random.Random(8), 30)
    frame = spark.createDataFrame(polygons, "basin string, rings array<array<struct<x:double,y:double>>>").repartition(3)
    grid = raster.grid_coordinates(spark.range(90 * 90).select((F.col("id") / 90).cast("int").alias("row"), (F.col("id") % 90).cast("int").alias("col")), 90, 0.0, 0.0, 10.0)
    found = raster.polygon_mask(grid, frame, tile)
    brute = grid.crossJoin(F.broadcast(frame)).where(geometry.inside(F.col("x"), F.col("y"), F.col("rings"))).select("basin", "row", "col").distinct()
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, brute.collect())) and found.count() > 1000
    assert not any(x in plan_of(found) for x in ("NestedLoop", "Cartesian"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert not any(x in plan_of(raster.polygon_mask(grid, frame, tile)) for x in ("NestedLoop", "Cartesian"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_zonal_sums_by_both_ways(spark):
    rng = random.Random(2)
    cells = [(r, c) for r in range(-3, 140, 2) for c in range(0, 150, 3)]
    values = spark.createDataFrame([(DAY + dt.timedelta(days=k), r, c, None if rng.random() < 0.1 else float("nan") if rng.random() < 0.1 else rng.random()) for k in range(3) for r, c in cells] + [(DAY + dt.timedelta(days=9), 1000, 1000, 1.0)], "date date, row int, col int, rainfall double").repartition(5).cache()
    mask = spark.createDataFrame([(b, r, c) for r, c in cells for b in "abc" if rng.random() < 0.4] + [("d", 500, 500)], "basin string, row int, col int").cache()
    expected = {(r.date, r.basin): (r.n, r.total) for r in values.join(mask, ["row", "col"]).groupBy("date", "basin").agg(F.count(F.nanvl("rainfall", F.lit(None))).alias("n"), F.sum(F.nanvl("rainfall", F.lit(None))).alias("total")).collect()}
    for broadcast in (raster.BROADCAST, 0):
        sums = raster.zonal_sums(values, mask, broadcast=broadcast)
        found = {(r.date, r.basin): (r.n, pytest.approx(r.total)) for r in sums.where("basin IS NOT NULL").collect() if r.n}
        assert found == {k: v for k, v in expected.items() if v[0]}
        mean = raster.zonal_of_sums(sums, mask)
        assert mean.count() == 4 * 4 and mean.where("date > '2002-01-05' AND mean IS NULL AND n_valid = 0").count() == 4
        assert not any(x in plan_of(mean) for x in ("NestedLoop", "Cartesian"))


def shuffled_rows(df):
    """Rows that each exchange of a query wrote, by what the plan counted."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    out, stack = [], [plan]
    while stack:
        p = stack.pop()
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            p = p.executedPlan()
        if p.getClass().getSimpleName() == "ShuffleQueryStageExec":
            p = p.plan()
        if p.getClass().getSimpleName() == "ShuffleExchangeExec":
            out.append(p.metrics().apply("shuffleRecordsWritten").value())
        children = p.children()
        stack += [children.apply(k) for k in range(children.size())]
    return sum(out)


def test_sums_are_what_is_shuffled(spark):
    """Cells stay where they are: with 4 tasks, 6 dates and 2 basins, at most 4 x 6 x (2 + 1) rows move, the one without basin counted."""
    side, dates = 150, 6
    k = F.col("id")
    values = spark.range(0, side * side * dates, 1, 4).select(F.date_add(F.lit(DAY), (k % dates).cast("int")).alias("date"), (k / dates / side).cast("int").alias("row"), ((k / dates) % side).cast("int").alias("col"), (k % 97).cast("double").alias("rainfall"))
    mask = spark.createDataFrame([(b, r, c) for b in "ab" for r in range(0, side, 2) for c in range(0, side, 3)], "basin string, row int, col int").cache()
    mask.count()
    assert shuffled_rows(raster.zonal_sums(values, mask)) <= 4 * dates * 3 + raster.mask_blocks(mask).count() * 70
    # without a broadcast: rows of blocks and dates, and sums
    blocks = 9
    assert shuffled_rows(raster.zonal_sums(values.coalesce(1), mask, broadcast=0)) < side * side * dates / 10 + blocks * 200
