"""Station tables, wide daily series and variogram tables as files."""

from __future__ import annotations

import os
import shutil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import crs, geometry
from ..operators import series
from ..schema import CACHE_COLUMNS
from . import xlsx


def header(spark: SparkSession, path: str) -> list[str]:
    """The first line's names; of a folder, the first file's."""
    row = spark.read.option("header", False).csv(path).limit(1).first()
    if row is None:
        raise ValueError(f"{path} is empty")
    return [("" if x is None else str(x)).strip() for x in row]


def read_wide(spark: SparkSession, path: str, date: str | None = None, name: str = "station") -> DataFrame:
    """date, name, value of a CSV with a date column and one column of numbers for each name; blanks are null.

    The date column is the first, or the named one, which has to exist. Types come from the header, never from the data."""
    names = header(spark, path)
    if date is not None and date not in names:
        raise ValueError(f"{path} has no column {date!r}")
    at = names.index(date) if date else 0
    fields = [T.StructField(f"c{k}", T.StringType() if k == at else T.DoubleType()) for k in range(len(names))]
    raw = spark.read.schema(T.StructType(fields)).option("header", True).option("enforceSchema", True).option("nanValue", "NaN").csv(path)
    wide = raw.withColumn(f"c{at}", F.expr(f"try_to_timestamp(c{at})").cast("date")).withColumnsRenamed({f"c{k}": n for k, n in enumerate(names) if k != at}).withColumnRenamed(f"c{at}", "__date")
    return series.to_long(wide, "__date", name).where("date IS NOT NULL")


def _driver_frame(path: str, index: int | None = None):
    """A table of one of the kinds that pandas reads, by the file's ending; ValueError for any other."""
    import pandas as pd

    ending = os.path.splitext(path)[1].lower()
    if ending not in (".xls", ".xlsx", ".pkl"):
        raise ValueError(f"no reader for {ending or 'files without an ending'}: csv, xls, xlsx or pkl")
    return pd.read_pickle(path) if ending == ".pkl" else pd.read_excel(path, index_col=index)


def read_meteo(spark: SparkSession, path: str, name: str = "station") -> DataFrame:
    """Wide daily data from csv, xls, xlsx or pkl by the file's ending, in order of date; ValueError for any other.

    Workbooks (xlsx) are read by Spark, a file a task; xls and pickle files on the driver by pandas, pickles only from trusted places."""
    ending = os.path.splitext(path)[1].lower()
    if ending == ".csv":
        return read_wide(spark, path, name=name).orderBy("date")
    if ending == ".xlsx":
        names, text = xlsx.table(spark, path)
        number = [F.col(f"c{k}").try_cast("double").alias(n) for k, n in enumerate(names) if k and n]
        wide = text.select(F.expr("try_to_timestamp(c0)").cast("date").alias("__date"), *number)
        return series.to_long(wide, "__date", name).where("date IS NOT NULL").orderBy("date")
    import pandas as pd

    frame = _driver_frame(path, 0)
    frame.index = pd.to_datetime(frame.index)
    frame.columns = frame.columns.astype(str)
    wide = spark.createDataFrame(frame.rename_axis("__date").reset_index())
    return series.to_long(wide, "__date", name).orderBy("date")


def read_stations(spark: SparkSession, path: str, zone: int = 45, source: str = "EPSG:4326", target: str | None = None) -> DataFrame:
    """station, lon, lat, z and the projected x, y of a table with columns Station, X, Y and Z, in any order.

    X and Y are degrees, or metres of the UTM system that `source` names; x and y are metres of the northern zone given, or of the
    system that `target` names. CSV files and folders of them, and xlsx, are read by Spark; xls and pkl on the driver, pickles
    only from trusted places."""
    came, to, ending = crs.parse(source), crs.parse(target) if target else None, os.path.splitext(path)[1].lower()
    frame = _driver_frame(path) if ending in (".xls", ".pkl") else None
    if frame is not None and "Station" not in frame.columns:
        frame = frame.reset_index()  # the stations are the table's index
    names, sheet = xlsx.table(spark, path) if ending == ".xlsx" else (header(spark, path) if frame is None else [str(c) for c in frame.columns], None)
    lacking = [c for c in ("Station", "X", "Y", "Z") if c not in names]
    if lacking:
        raise ValueError(f"{path} lacks the columns {', '.join(lacking)}")
    fields = [T.StructField(f"c{k}", T.StringType()) for k in range(len(names))]
    text = T.StructType(fields)
    raw = sheet if sheet is not None else spark.read.schema(text).option("header", True).csv(path) if frame is None else spark.createDataFrame([[str(x) for x in row] for row in frame.itertuples(index=False)], text)
    col = lambda n: F.trim(f"c{names.index(n)}")
    number = lambda n: geometry.missing(col(n).try_cast("double"))
    lon, lat = crs.to_degrees(number("X"), number("Y"), came)
    rows = raw.select(col("Station").alias("station"), lon.alias("lon"), lat.alias("lat"), number("Z").alias("z"))
    x, y = crs.from_degrees(F.col("lon"), F.col("lat"), to) if to else geometry.utm(F.col("lat"), F.col("lon"), zone)
    return rows.withColumns({"x": x, "y": y})


def read_variogram_table(spark: SparkSession, path: str) -> DataFrame:
    """The table of fits by day of the year, from CSV."""
    kind = lambda c: T.StringType() if c.endswith("model") else T.IntegerType() if c in ("doy", "month", "day") or c.endswith("n_days") else T.DoubleType()
    names = header(spark, path)
    lacking = [c for c in CACHE_COLUMNS if c not in names]
    if lacking:
        raise ValueError(f"{path} lacks the columns {', '.join(lacking)}")
    table = spark.read.schema(T.StructType([T.StructField(c, kind(c)) for c in names])).option("header", True).csv(path)
    return table.select(*CACHE_COLUMNS)


def write_one_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header in the folder `path`, for tables that a person opens: some thousands of rows."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_annual(annual: DataFrame, path: str) -> None:
    wide = series.to_wide(annual.withColumn("total", F.round("total", 1)), "station", "total", key="year")
    write_one_csv(wide.withColumnRenamed("year", "Year").orderBy("Year"), path)


def write_relative(relative: DataFrame, candidate: str, path: str) -> None:
    named = {"candidate_norm": f"station_{candidate}_normalised", "reference": "neighbour_reference", "ratio": "ratio"}
    write_one_csv(relative.select(F.col("year").alias("Year"), *[F.round(c, 3).alias(n) for c, n in named.items()]).orderBy("Year"), path)


def write_variogram_table(table: DataFrame, path: str) -> None:
    write_one_csv(table.select(*CACHE_COLUMNS).orderBy("doy"), path)


def write_zonal(zonal: DataFrame, path: str) -> None:
    wide = series.to_wide(zonal, "basin", "mean")
    write_one_csv(wide.withColumnRenamed("date", "Date").orderBy("Date"), path)


def write_series(zonal: DataFrame, variable: str, path: str) -> None:
    """A folder of files for each basin, with type, unit and value type in every row."""
    typed = series.typed(zonal, variable).repartition("basin").sortWithinPartitions("basin", "date")
    typed.write.mode("overwrite").partitionBy("basin").option("header", True).csv(path)


def first_existing(*candidates: str) -> str:
    """The first of some places where an input may lie; FileNotFoundError names them all."""
    for path in candidates:
        if os.path.exists(path):
            return path
    raise FileNotFoundError(" or ".join(candidates))


def hand_off(copies: dict[str, tuple[str, ...]]) -> list[str]:
    """Copies each target from the first of its places that exists, and returns a warning for every target that has none."""
    lacking = []
    for target, places in copies.items():
        try:
            found = first_existing(*places)
        except FileNotFoundError as error:
            lacking.append(f"{target}: no {error}")
            continue
        os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
        shutil.copyfile(found, target)
    return lacking
