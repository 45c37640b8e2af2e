"""Runs that can be stopped and resumed, and daily series as streams."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar
from ..operators import kriging, raster, series, variogram
from ..schema import Kriging, Variogram
from ..sources import fields
from .store import Store

#: Batches of a run that are under way at a time, where each is small.
AT_ONCE = 3
#: Where the days of a store of kriged years lie, beside its cells: readers of the store pass it over.
DAYS = "_days"


def fill(stores: list[Store], keys: list, make: Callable[[list], list[DataFrame]], batch: int = 10, budget_s: float | None = None, at_once: int = 1, growth: int = 1) -> int:
    """Makes the keys that any of the stores lacks and returns how many are done.

    make(keys) gives a table for each store. Batches of keys are made one after the other, or at_once together, and stored one by
    one, so a stop loses those under way at most; no new one begins after budget_s seconds. Each batch is `growth` times as
    large as the one before it: 2 for keys that cost less than a job does, so that jobs are few."""
    began = time.monotonic()
    whole = set.intersection(*(s.open() for s in stores))
    left = [k for k in keys if str(k) not in whole]
    batches, at = [], 0
    while at < len(left):
        batches.append(left[at : at + batch])
        at, batch = at + batch, batch * growth

    def run(own: list) -> int:
        for store, rows in zip(stores, make(own), strict=True):
            store.write(rows, own)
        return len(own)

    made, under_way = 0, set()
    with ThreadPoolExecutor(at_once) as pool:
        while under_way or batches and (budget_s is None or time.monotonic() - began <= budget_s):
            while batches and len(under_way) < at_once and (budget_s is None or time.monotonic() - began <= budget_s):
                under_way.add(pool.submit(run, batches.pop(0)))
            done, under_way = wait(under_way, return_when=FIRST_COMPLETED)
            made += sum(f.result() for f in done)
    return len(keys) - len(left) + made


def resume(spark: SparkSession, keys: DataFrame, key: str, path: str, make: Callable[[list], DataFrame], batch: int = 10, budget_s: float | None = None) -> int:
    """Makes what is missing at `path` and returns how many keys are done.

    keys (key) is the whole work, some hundreds of days or years. The table is a `Store`; one that is there without a manifest
    counts as made whole by something else."""
    return fill([Store(spark, path, key)], [r[0] for r in keys.select(key).distinct().orderBy(key).collect()], lambda own: [make(own)], batch, budget_s)


def build_variogram_table(obs: DataFrame, stations: DataFrame, path: str, p: Variogram = Variogram(), batch: int = 365, budget_s: float | None = None) -> int:
    """The variogram table, stored at a path day by day of the year; done days are left as they are.

    What days share, the sums over pairs for each day of the source, is stored first, a variant at a time, and kept: batches
    and later runs start from there, and read observations for no day again. The first batch has `batch` days, each next
    one twice as many, for what is left to do for a day is less than a job costs."""
    spark, began = obs.sparkSession, time.monotonic()
    shared = f"{path}/_sums-{p.estimator}-{p.lags}-{p.min_stations}"
    sums, counts = Store(spark, f"{shared}/pairs", "variant"), Store(spark, f"{shared}/days", "variant")
    both = fill([sums, counts], list(variogram.VARIANTS), lambda v: [variogram.source_sums(obs, stations, v[0], p), variogram.source_days(obs, stations, v[0], p)], 1, budget_s, 2)
    if both < len(variogram.VARIANTS):
        return 0
    pairs, days = sums.read().cache(), counts.read().cache()
    rest = None if budget_s is None else max(0.0, budget_s - (time.monotonic() - began))
    done = fill([Store(spark, path, "doy")], list(range(1, calendar.DAYS + 1)), lambda doys: [variogram.table_of(pairs, days, p, doys)], batch, rest, AT_ONCE, 2)
    pairs.unpersist(), days.unpersist()
    return done


def krige_years(obs: DataFrame, stations: DataFrame, grid: DataFrame, table: DataFrame, path: str, first: int | None = None, last: int | None = None, p: Kriging = Kriging(), budget_s: float | None = None) -> int:
    """Kriged fields of all years, stored by year, with a table of their days beside them; years that are whole are skipped."""
    spark, chosen = obs.sparkSession, series.year_range(obs, first, last).withColumn("year", F.year("date"))

    def make(years: list) -> list[DataFrame]:
        both = kriging.krige(chosen.where(F.col("year").isin(years)).drop("year"), stations, grid, table, p)
        return [df.withColumn("year", F.year("date")) for df in both]

    years = [r.year for r in chosen.select("year").distinct().orderBy("year").collect()]
    return fill([Store(spark, path, "year", True), Store(spark, f"{path}/{DAYS}", "year", True)], years, make, 1, budget_s)


def stream_daily_totals(spark: SparkSession, source: str, schema, out: str, checkpoint: str) -> None:
    """Sums of new files' values by day and station, appended to `out`; each file is taken once, however often this runs.

    What one call finds is summed by itself; readers sum over calls."""

    def store(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy("date", "station").agg(F.sum("value").alias("value"), F.count("value").alias("n"))
        sums.write.mode("overwrite").parquet(f"{out}/batch={number}")  # the same batch again replaces itself

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def daily_totals(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).groupBy("date", "station").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))


def stream_zonal_sums(spark: SparkSession, source: str, mask: DataFrame, out: str, checkpoint: str, **options: str) -> None:
    """Zonal sums of the records of field files that have come since the last call, stored in `out`; each record is taken once.

    A call that is stopped between its batches goes on from the checkpoint; a batch that runs again replaces itself."""

    def store(batch: DataFrame, number: int) -> None:
        raster.zonal_sums(batch, mask, "value").write.mode("overwrite").parquet(f"{out}/batch={number}")

    new = fields.stream(spark, source, **options)
    new.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def zonal_means(spark: SparkSession, out: str, basins: DataFrame) -> DataFrame:
    """date, basin, mean, n_valid of all that stream_zonal_sums has stored."""
    return raster.zonal_of_sums(spark.read.parquet(out).drop("batch"), basins)
