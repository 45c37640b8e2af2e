"""Daily regression of observations on elevation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import Kriging

DEFAULT = Kriging()


def present(obs: DataFrame, stations: DataFrame) -> DataFrame:
    """Values that are there, with their station's x, y and z. The station table is the small side; Spark checks its size."""
    return obs.where(F.col("value").isNotNull() & ~F.isnan("value")).join(stations.select("station", "x", "y", "z"), "station")


def daily_drift(obs: DataFrame, stations: DataFrame, min_stations: int = DEFAULT.min_stations) -> DataFrame:
    """date, a, b, r, n: value = a + b * z by least squares, for days with min_stations values at known elevations.

    r is the correlation with the fitted values, so it is never negative; 0 where values or elevations don't vary.
    Equal elevations give the fit of least norm."""
    z, v = F.col("z"), F.col("value")
    day = present(obs, stations).where(z.isNotNull()).groupBy("date")
    s = day.agg(F.count("value").alias("n"), F.avg(z).alias("mz"), F.avg(v).alias("mv"), F.var_pop(z).alias("vz"), F.var_pop(v).alias("vv"), F.covar_pop(v, z).alias("c"))
    s = s.where(F.col("n") >= min_stations)
    flat = F.col("vz") <= 0
    slope = F.when(flat, F.col("mv") * F.col("mz") / (1 + F.col("mz") * F.col("mz"))).otherwise(F.try_divide("c", "vz"))
    s = s.withColumn("b", slope).withColumn("a", F.when(flat, F.col("mv") / (1 + F.col("mz") * F.col("mz"))).otherwise(F.col("mv") - F.col("b") * F.col("mz")))
    r = F.coalesce(F.abs(F.try_divide(F.col("c"), F.sqrt(F.col("vz")) * F.sqrt(F.col("vv")))), F.lit(0.0))
    return s.select("date", "a", "b", r.alias("r"), F.col("n").cast("int").alias("n"))


def significant(n: Column, r: Column, p: Kriging = DEFAULT) -> Column:
    return F.coalesce((n >= p.min_stations_drift) & (F.abs(r) >= p.r_threshold), F.lit(False))


def residuals(obs: DataFrame, stations: DataFrame, min_stations: int = DEFAULT.min_stations) -> DataFrame:
    """date, station, x, y, value: what the day's regression leaves."""
    rows = present(obs, stations).where(F.col("z").isNotNull())
    fit = daily_drift(obs, stations, min_stations)
    return rows.join(fit.select("date", "a", "b"), "date").select("date", "station", "x", "y", (F.col("value") - F.col("a") - F.col("b") * F.col("z")).alias("value"))


def day_method(obs: DataFrame, stations: DataFrame, p: Kriging = DEFAULT) -> DataFrame:
    """date, n_reporting, r, preferred: ked where the drift is significant, ok else, null with too few stations.

    Days without any value are kept."""
    days = obs.select("date").distinct()
    reporting = present(obs, stations).groupBy("date").agg(F.count("value").cast("int").alias("n_reporting"))
    out = days.join(reporting, "date", "left").join(daily_drift(obs, stations).select("date", "r", "n"), "date", "left").withColumn("n_reporting", F.coalesce("n_reporting", F.lit(0)))
    enough = F.col("n_reporting") >= p.min_stations
    preferred = F.when(enough, F.when(significant(F.col("n"), F.col("r"), p), "ked").otherwise("ok"))
    return out.select("date", "n_reporting", F.when(enough, F.col("r")).alias("r"), preferred.alias("preferred"))
