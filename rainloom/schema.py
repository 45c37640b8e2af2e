"""Schemas and default parameters that the operators share."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

OBS = T.StructType([T.StructField("date", T.DateType()), T.StructField("station", T.StringType()), T.StructField("value", T.DoubleType())])
STATIONS = T.StructType([T.StructField("station", T.StringType()), *(T.StructField(c, T.DoubleType()) for c in ("lon", "lat", "z", "x", "y"))])
GRID = T.StructType([T.StructField("row", T.IntegerType()), T.StructField("col", T.IntegerType()), *(T.StructField(c, T.DoubleType()) for c in ("x", "y", "z"))])
#: Columns of the variogram table, one row for each day of the year.
CACHE_COLUMNS = ["doy", "month", "day"] + [f"{m}_{c}" for m in ("ked", "ok") for c in ("model", "nugget", "sill", "range", "rmse", "n_days")]


@dataclass(frozen=True)
class Homogeneity:
    alpha: float = 0.05
    min_days: int = 330
    simulations: int = 20_000
    seed: int = 42
    least_years: int = 5
    year_tolerance: int = 3


@dataclass(frozen=True)
class Variogram:
    window: int = 7
    lags: int = 12
    estimator: str = "matheron"
    min_stations: int = 4
    models: tuple[str, ...] = ("spherical", "exponential")
    spherical_bias: float = 0.05
    ranges: int = 60


@dataclass(frozen=True)
class Kriging:
    r_threshold: float = 0.3
    min_stations_drift: int = 8
    min_stations: int = 4
    epoch: str = "1980-01-01"
