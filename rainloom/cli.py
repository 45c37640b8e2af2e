"""Command line: `python -m rainloom.cli STEP ...`, a step at a time over files."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions import calendar
from .operators import homogeneity, kriging, raster, series, variogram
from .schema import Homogeneity, Variogram
from .sources import asciigrid, csv, fields, netcdf3, shapefile
from .streaming import runs


#: Rows of a table that are shown.
PREVIEW = 5


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="rainloom")
    steps = top.add_subparsers(dest="step", required=True)

    def step(name: str, *files: str) -> argparse.ArgumentParser:
        own = steps.add_parser(name)
        for f in files:
            own.add_argument(f)
        return own

    p = step("homogeneity", "rain", "out")
    p.add_argument("--candidate", default="1030")
    for name, kind in (("alpha", float), ("min_days", int), ("simulations", int), ("seed", int)):
        p.add_argument(f"--{name}", type=kind, default=getattr(Homogeneity, name))
    places = lambda p: [p.add_argument(f"--{name}", default=default) for name, default in (("source", "EPSG:4326"), ("target", None))]
    p = step("variograms", "rain", "stations", "out")
    places(p)
    p.add_argument("--window", type=int, default=Variogram.window)
    p.add_argument("--lags", type=int, default=Variogram.lags)
    p.add_argument("--estimator", default=Variogram.estimator, choices=("matheron", "cressie"))
    p.add_argument("--batch", type=int, default=10)
    p.add_argument("--budget", type=float, default=35.0)
    p = step("krige", "rain", "stations", "grid", "table", "out")
    places(p)
    p.add_argument("--first", type=int)
    p.add_argument("--last", type=int)
    p.add_argument("--budget", type=float, default=38.0)
    p = step("krige-day", "rain", "stations", "grid", "out")
    places(p)
    p.add_argument("--date", default="2009-07-20")
    p = step("netcdf", "kriged", "grid", "out")
    p.add_argument("--kind", default="netcdf4", choices=("netcdf4", "classic"))
    p = step("zonal", "kriged", "polygons", "out")
    p.add_argument("--field", default=shapefile.FIELD)
    p = step("series", "zonal", "out")
    p.add_argument("--variable", default="rainfall", choices=[u[0] for u in series.UNITS])
    return top


def _stations(spark: SparkSession, args: argparse.Namespace):
    found = csv.read_stations(spark, args.stations, source=args.source, target=args.target)
    found.orderBy("station").show(PREVIEW)
    return found


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    for source in (asciigrid.AsciiGrid, netcdf3.NetCdf3, shapefile.Shapefile):
        spark.dataSource.register(source)
    grid = lambda: asciigrid.load(spark, args.grid)
    if args.step == "homogeneity":
        p = Homogeneity(args.alpha, args.min_days, args.simulations, args.seed)
        annual = homogeneity.annual_totals(csv.read_wide(spark, args.rain), p.min_days).cache()
        if annual.where(F.col("station") == args.candidate).isEmpty():
            raise ValueError(f"no station {args.candidate!r} in {args.rain}")
        # the tables that don't depend on neighbours are written first
        csv.write_annual(annual, f"{args.out}/annual_totals")
        tests = homogeneity.with_p_values(homogeneity.snht(annual.withColumnRenamed("total", "value"), ["station"], p.least_years), p)
        csv.write_one_csv(tests.orderBy("station"), f"{args.out}/snht_results")
        csv.write_relative(homogeneity.relative_series(annual, args.candidate), args.candidate, f"{args.out}/relative_series_{args.candidate}")
        report = homogeneity.report(homogeneity.relative_test(annual, args.candidate, p), homogeneity.neighbour_correlations(annual, args.candidate))
        report.select("report").coalesce(1).write.mode("overwrite").text(f"{args.out}/relative_result_{args.candidate}")
    elif args.step == "variograms":
        obs, stations = csv.read_wide(spark, args.rain).cache(), _stations(spark, args).cache()
        p = Variogram(args.window, args.lags, args.estimator)
        done = runs.build_variogram_table(obs, stations, f"{args.out}/parquet", p, args.batch, args.budget)
        csv.write_variogram_table(spark.read.parquet(f"{args.out}/parquet"), f"{args.out}/csv")
        print(f"{done} of 365 days done")
    elif args.step == "krige":
        obs, stations = csv.read_wide(spark, args.rain).cache(), _stations(spark, args).cache()
        series.check_stations(obs, stations)
        print(runs.krige_years(obs, stations, grid(), csv.read_variogram_table(spark, args.table), args.out, args.first, args.last, budget_s=args.budget), "years done")
    elif args.step == "krige-day":
        obs, stations = csv.read_wide(spark, args.rain).cache(), _stations(spark, args).cache()
        # the window of one day of the year is pooled, not all of them
        doy = obs.sparkSession.range(1).select(calendar.calendar_doy(F.lit(args.date).cast("date")).alias("d")).first().d
        table = variogram.variogram_table(obs, stations, doys=[doy]).cache()
        cells, days = kriging.krige(series.one_date(obs, args.date), stations, grid(), table)
        cells.write.mode("overwrite").parquet(f"{args.out}/cells")
        days.write.mode("overwrite").parquet(f"{args.out}/day")
        plan = kriging.plan_days(series.one_date(obs, args.date), stations, table)
        cv = kriging.leave_one_out(kriging.day_systems(series.one_date(obs, args.date), stations, plan))
        csv.write_one_csv(cv.orderBy("station"), f"{args.out}/leave_one_out")
        csv.write_one_csv(kriging.scores(cv, ["date"]), f"{args.out}/scores")
        kriging.scores(cv, ["date"]).show()
    elif args.step == "netcdf":
        kriged = spark.read.parquet(args.kriged)
        os.makedirs(args.out, exist_ok=True)
        places = grid().select("row", "col", "x", "y").cache()
        cells = kriged.join(places, ["row", "col"])
        days = spark.read.parquet(f"{args.kriged}/{runs.DAYS}")
        years = [r.y for r in days.select(F.year("date").alias("y")).distinct().orderBy("y").collect()]
        fields.write_years({y: f"{args.out}/rainfall_kriged_{y}.nc" for y in years}, cells, days, places, args.kind)
    elif args.step == "zonal":
        field = fields.load(spark, args.kriged).withColumnRenamed("value", "rainfall")
        polygons = spark.read.format("shapefile").option("field", args.field).load(args.polygons)
        mask = raster.polygon_mask(field.select("row", "col", "x", "y").distinct(), polygons).cache()
        zonal = raster.zonal_mean(field, mask, polygons).cache()
        for row in raster.warnings(zonal).toLocalIterator():
            print("WARNING:", row.warning)
        tidy = raster.tidy(zonal)
        csv.write_zonal(tidy, f"{args.out}/daily")
        series.to_wide(tidy, "basin", "mean").orderBy("date").show(PREVIEW)
        csv.write_one_csv(raster.annual_sums(tidy).orderBy("basin", "year"), f"{args.out}/annual")
        csv.write_one_csv(raster.monthly_climatology(tidy).orderBy("basin", "month"), f"{args.out}/monthly")
    else:
        csv.write_series(csv.read_wide(spark, args.zonal, date="Date", name="basin"), args.variable, args.out)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    run(SparkSession.builder.appName("rainloom").config("spark.sql.session.timeZone", "UTC").getOrCreate(), args)


if __name__ == "__main__":
    main()
