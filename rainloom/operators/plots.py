"""The data behind the diagnostic figures; drawing is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry
from . import drift, raster


def drift_lines(obs: DataFrame, stations: DataFrame) -> DataFrame:
    """date, station, z, value, fitted, rank: each value with its point on the day's line; rank orders a day by elevation."""
    rows = drift.present(obs, stations).join(drift.daily_drift(obs, stations).select("date", "a", "b"), "date").where("z IS NOT NULL")
    rank = F.row_number().over(Window.partitionBy("date").orderBy("z", "station"))
    return rows.select("date", "station", "z", "value", (F.col("a") + F.col("b") * F.col("z")).alias("fitted"), rank.alias("rank"))


def variogram_points(bins: DataFrame, keys: list[str]) -> DataFrame:
    """keys, lag_center, gamma, n and marker size: 20 for no pairs up to 200 for the fullest bin."""
    most = F.max("n").over(Window.partitionBy(*keys))
    return bins.select(*keys, "lag_center", "gamma", "n", (20 + 180 * F.col("n") / most).alias("size"))


def variogram_curve(bins: DataFrame, fits: DataFrame, keys: list[str], points: int = 300) -> DataFrame:
    """keys, h, gamma: the fitted model at `points` distances from 0 to 1.05 of the greatest lag."""
    reach = bins.groupBy(*keys).agg((F.max("lag_center") * 1.05).alias("reach"))
    steps = fits.join(reach, keys).select(*keys, "model", "nugget", "sill", "range", "reach", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("k"))
    steps = steps.withColumn("h", F.col("reach") * F.col("k") / (points - 1))
    return steps.select(*keys, "h", geometry.gamma(F.col("model"), F.col("h"), F.col("nugget"), F.col("sill"), F.col("range")).alias("gamma"))


def surface(values: DataFrame, obs: DataFrame, stations: DataFrame, date: str) -> tuple[DataFrame, DataFrame]:
    """One date's cells with a value, and the stations to lay over them."""
    on = F.col("date") == F.lit(date).cast("date")
    return values.where(on & F.col("rainfall").isNotNull()), drift.present(obs.where(on), stations)


def cv_scatter(cv: DataFrame, keys: list[str]) -> DataFrame:
    """keys, observed, predicted and the limits low, high that hold both, for a 1:1 line."""
    w = Window.partitionBy(*keys)
    return cv.select(*keys, "station", "observed", "predicted", F.min(F.least("observed", "predicted")).over(w).alias("low"), F.max(F.greatest("observed", "predicted")).over(w).alias("high"))


def snht_panel(series: DataFrame, tests: DataFrame, keys: list[str]) -> DataFrame:
    """keys, year, value, level and break_at: each year with the mean of its side of the break, drawn half a year before it.

    With tests that have p values, the status tells which stations are inhomogeneous."""
    joined = series.where(F.col("value").isNotNull()).join(tests, keys)
    level = F.when(F.col("year") < F.col("break_year"), F.col("mean_before")).otherwise(F.col("mean_after"))
    status = [F.when(F.col("inhomogeneous"), "inhomogeneous").otherwise("homogeneous").alias("status")] if "inhomogeneous" in tests.columns else []
    return joined.select(*keys, "year", "value", level.alias("level"), (F.col("break_year") - 0.5).alias("break_at"), *status)


def ratio_bars(relative: DataFrame) -> DataFrame:
    """year, ratio, height: bars from 1 to each year's ratio."""
    return relative.where(F.col("ratio").isNotNull()).select("year", "ratio", (F.col("ratio") - 1).alias("height"))


def basin_summaries(zonal: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Annual totals and the monthly climatology by basin."""
    return raster.annual_sums(zonal), raster.monthly_climatology(zonal)
