"""Wide and long series, set checks, resuming, and series with units."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: type, unit and value type of each variable that series are written for
UNITS = [
    ("rainfall", "Rainfall", "millimeter", "StepAccumulated"),
    ("temperature", "Temperature", "degree_Celsius", "Instantaneous"),
    ("Evapotranspiration", "Evaporation", "millimeter", "StepAccumulated"),
    ("Discharge", "Discharge", "meter_pow_3_per_sec", "Instantaneous"),
]


def units(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(UNITS, "variable string, item_type string, unit string, value_type string")


def typed(series: DataFrame, variable: str = "rainfall") -> DataFrame:
    """series with the variable's type, unit and value type; ValueError for an unknown variable."""
    found = next((u for u in UNITS if u[0] == variable), None)
    if found is None:
        raise ValueError(f"no unit is known for {variable!r}; known: {', '.join(u[0] for u in UNITS)}")
    return series.withColumns({"variable": F.lit(variable), **{c: F.lit(v) for c, v in zip(("item_type", "unit", "value_type"), found[1:], strict=True)}})


def to_long(wide: DataFrame, date: str, name: str = "station", value: str = "value") -> DataFrame:
    """date, name, value from one column for each name; NaN becomes null."""
    others = [c for c in wide.columns if c != date]
    long = wide.select(F.col(date).cast("date").alias("date"), *[F.col(f"`{c}`").cast("double").alias(c) for c in others]).unpivot(["date"], others, name, value)
    return long.withColumn(value, F.when(~F.isnan(value), F.col(value)))


def to_wide(long: DataFrame, name: str, value: str, names: list[str] | None = None, key: str = "date") -> DataFrame:
    """One row for each key and one column for each name. Give the names to spare a pass that finds them."""
    return long.groupBy(key).pivot(name, names).agg(F.first(value, ignorenulls=True))


def year_range(obs: DataFrame, first: int | None, last: int | None) -> DataFrame:
    """Years first to last, if both are given; everything else stays as it is."""
    return obs if first is None or last is None else obs.where(F.year("date").between(first, last))


def one_date(obs: DataFrame, date: str) -> DataFrame:
    """That date's rows; ValueError with the range of dates if there are none."""
    found = obs.where(F.col("date") == F.lit(date).cast("date"))
    if found.isEmpty():
        low, high = obs.agg(F.min("date"), F.max("date")).first()
        raise ValueError(f"no data on {date}: the dates run from {low} to {high}")
    return found


def missing_stations(obs: DataFrame, stations: DataFrame) -> DataFrame:
    """Stations with values that the station table lacks."""
    return obs.select("station").distinct().join(stations.select("station"), "station", "left_anti")


def check_stations(obs: DataFrame, stations: DataFrame, show: int = 20) -> None:
    lacking = [str(r.station) for r in missing_stations(obs, stations).orderBy("station").limit(show + 1).collect()]
    if lacking:
        raise ValueError(f"no metadata for stations: {', '.join(lacking[:show])}{' and more' if len(lacking) > show else ''}")


def pending(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What isn't done yet."""
    return wanted.join(done.select(*keys).distinct(), keys, "left_anti")


def combine(*frames: DataFrame) -> DataFrame:
    """All rows, columns matched by name, missing ones null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
