"""Experimental variograms pooled by day of the year, and the models fitted to them.

Pair sums are made once for each day of the year and pooled over the window afterwards, so a day's pairs are never
formed again for the 15 windows that they belong to."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar, geometry
from ..schema import CACHE_COLUMNS, Variogram
from . import drift

DEFAULT = Variogram()
#: Residuals of the drift, for kriging with external drift, and the values, for ordinary kriging.
VARIANTS = ("ked", "ok")
#: The part by which errors of fits may differ and still count as equal.
TIE = 1e-9


def hull(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Corners of the convex hull, counterclockwise from the least point."""
    points = sorted(set(points))
    if len(points) < 3:
        return points
    sides = []
    for run in (points, points[::-1]):
        side: list[tuple[float, float]] = []
        for p in run:
            while len(side) > 1 and (side[-1][0] - side[-2][0]) * (p[1] - side[-2][1]) <= (side[-1][1] - side[-2][1]) * (p[0] - side[-2][0]):
                side.pop()
            side.append(p)
        sides.append(side[:-1])
    return sides[0] + sides[1]


def widest(corners: list[tuple[float, float]]) -> float:
    """The greatest distance between corners of a hull, among the pairs that parallel lines can touch."""
    n, most = len(corners), 0.0
    k = 1 % max(n, 1)
    apart = lambda a, b: math.sqrt((a[0] - b[0]) * (a[0] - b[0]) + (a[1] - b[1]) * (a[1] - b[1]))
    area = lambda a, b, c: abs((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]))
    for i in range(n):
        a, b = corners[i], corners[(i + 1) % n]
        steps = 0
        while steps < n and area(a, b, corners[(k + 1) % n]) >= area(a, b, corners[k]):
            most = max(most, apart(a, corners[k]), apart(b, corners[k]))
            k, steps = (k + 1) % n, steps + 1
        most = max(most, apart(a, corners[k]), apart(b, corners[k]))
    return most


def greatest_distance(stations: DataFrame) -> float:
    """Between any two stations; 0 with fewer than two. Tasks keep the corners of their own hulls; only hulls meet."""

    def corners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[float, float]] = []
        for batch in batches:
            kept = hull(kept + list(zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in kept], pa.float64()) for k in (0, 1)], ["x", "y"])

    def width(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in corners(batches):
            yield pa.RecordBatch.from_arrays([pa.array([widest(list(zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)))])], ["d"])

    known = stations.select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).where("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    hulls = known.mapInArrow(corners, "x double, y double").repartition(1).mapInArrow(width, "d double")
    return hulls.agg(F.max("d")).first()[0] or 0.0


def station_pairs(stations: DataFrame, max_lag: float | None = None, lags: int = DEFAULT.lags) -> DataFrame:
    """s1, s2, distance, bin (0 to lags - 1) for pairs of stations, s1 < s2, with distance below max_lag.

    max_lag is two thirds of the greatest distance between any two stations, unless given. Stations lie in cells as wide as
    max_lag; those of neighbouring cells meet by an equality join, so a short max_lag doesn't form all pairs."""
    reach = float(greatest_distance(stations) * (2.0 / 3.0) if max_lag is None else max_lag)
    side = reach or 1.0
    cell = lambda c: F.floor(F.col(c) / side)
    near = F.array(F.lit(-1), F.lit(0), F.lit(1))
    a = stations.select(F.col("station").alias("s1"), F.col("x").alias("x1"), F.col("y").alias("y1"), cell("x").alias("i"), cell("y").alias("j"))
    a = a.withColumn("di", F.explode(near)).withColumn("dj", F.explode(near)).select("s1", "x1", "y1", (F.col("i") + F.col("di")).alias("i"), (F.col("j") + F.col("dj")).alias("j"))
    b = stations.select(F.col("station").alias("s2"), F.col("x").alias("x2"), F.col("y").alias("y2"), cell("x").alias("i"), cell("y").alias("j"))
    pairs = a.join(b, ["i", "j"]).where("s1 < s2").select("s1", "s2", geometry.distance(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")).alias("distance"))
    return pairs.where(F.col("distance") < reach).select("s1", "s2", "distance", F.floor(F.col("distance") * lags / F.lit(reach)).cast("int").alias("bin"))


def pair_statistic(difference: Column, estimator: str) -> Column:
    if estimator == "matheron":
        return difference * difference
    if estimator == "cressie":
        return F.sqrt(F.abs(difference))
    raise ValueError("the estimator is matheron or cressie")


def semivariance(total: Column, count: Column, estimator: str) -> Column:
    mean = total / count
    return mean / 2 if estimator == "matheron" else 0.5 * mean * mean * mean * mean / (0.457 + 0.494 / count)


def pair_sums(values: DataFrame, pairs: DataFrame, keys: list[str], estimator: str = DEFAULT.estimator) -> DataFrame:
    """keys, bin, n, sum_distance, sum_stat over the pairs of values (date, station, value, keys) of one date."""
    left = values.select("date", *[k for k in keys if k != "date"], F.col("station").alias("s1"), F.col("value").alias("v1"))
    right = values.select("date", F.col("station").alias("s2"), F.col("value").alias("v2"))
    both = left.join(right, "date").where("s1 < s2").join(pairs, ["s1", "s2"])
    return both.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("distance").alias("sum_distance"), F.sum(pair_statistic(F.col("v1") - F.col("v2"), estimator)).alias("sum_stat"))


def experimental(values: DataFrame, pairs: DataFrame, keys: list[str], estimator: str = DEFAULT.estimator) -> DataFrame:
    """keys, bin, lag_center, gamma, n: the variogram of each key's own pairs."""
    s = pair_sums(values, pairs, keys, estimator)
    return s.select(*keys, "bin", (F.col("sum_distance") / F.col("n")).alias("lag_center"), semivariance(F.col("sum_stat"), F.col("n"), estimator).alias("gamma"), "n")


def usable_days(obs: DataFrame, stations: DataFrame, variant: str, p: Variogram = DEFAULT) -> DataFrame:
    """date, station, value of the days that a variant pools: residuals of the drift (ked) or the values (ok).

    The values' days are those with enough values, at known stations or not."""
    if variant == "ked":
        return drift.residuals(obs, stations, p.min_stations).select("date", "station", "value")
    if variant != "ok":
        raise ValueError("the variant is ked or ok")
    enough = obs.where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("date").agg(F.count("value").alias("c")).where(F.col("c") >= p.min_stations)
    return drift.present(obs, stations).join(enough.select("date"), "date", "left_semi").select("date", "station", "value")


def source_sums(obs: DataFrame, stations: DataFrame, variant: str, p: Variogram = DEFAULT) -> DataFrame:
    """variant, source_doy, bin, n, sum_distance, sum_stat: the pairs of each day of the year, over all years; 365 x lags rows at most."""
    values = usable_days(obs, stations, variant, p).withColumn("source_doy", calendar.calendar_doy(F.col("date")))
    return pair_sums(values, station_pairs(stations, None, p.lags), ["source_doy"], p.estimator).withColumn("variant", F.lit(variant))


def source_days(obs: DataFrame, stations: DataFrame, variant: str, p: Variogram = DEFAULT) -> DataFrame:
    """variant, source_doy, k: the days that each day of the year has."""
    days = usable_days(obs, stations, variant, p).groupBy("date").agg(F.lit(1).alias("one"))
    return days.groupBy(calendar.calendar_doy(F.col("date")).alias("source_doy")).agg(F.sum("one").alias("k")).withColumn("variant", F.lit(variant))


def _targets(sums: DataFrame, p: Variogram, doys: list[int] | None = None) -> DataFrame:
    """Sums by day of the source, for each day of the year (or those named) that pools them."""
    bridge = calendar.window_bridge(sums.sparkSession, p.window)
    return sums.join(F.broadcast(bridge if doys is None else bridge.where(F.col("doy").isin(doys))), "source_doy")


def pool(sums: DataFrame, p: Variogram = DEFAULT, doys: list[int] | None = None) -> DataFrame:
    """variant, doy, bin, lag_center, gamma, n of source_sums pooled over each day's window."""
    s = _targets(sums, p, doys).groupBy("variant", "doy", "bin").agg(F.sum("n").alias("n"), F.sum("sum_distance").alias("d"), F.sum("sum_stat").alias("s"))
    return s.select("variant", "doy", "bin", (F.col("d") / F.col("n")).alias("lag_center"), semivariance(F.col("s"), F.col("n"), p.estimator).alias("gamma"), "n")


def pooled(obs: DataFrame, stations: DataFrame, variant: str, p: Variogram = DEFAULT) -> DataFrame:
    """doy, bin, lag_center, gamma, n for every day of the year."""
    return pool(source_sums(obs, stations, variant, p), p).drop("variant")


def pool_days(days: DataFrame, p: Variogram = DEFAULT, doys: list[int] | None = None) -> DataFrame:
    """variant, doy, n_days of source_days pooled over each day's window."""
    return _targets(days, p, doys).groupBy("variant", "doy").agg(F.sum("k").cast("int").alias("n_days"))


def pooled_days(obs: DataFrame, stations: DataFrame, variant: str, p: Variogram = DEFAULT) -> DataFrame:
    """doy, n_days: the days that each day of the year pools."""
    return pool_days(source_days(obs, stations, variant, p), p).drop("variant")


def fit_models(bins: DataFrame, keys: list[str], p: Variogram = DEFAULT) -> DataFrame:
    """keys, model, nugget, sill, range, rmse: each model's best fit to bins (keys, lag_center, gamma, n).

    For ranges from 0.1 to 1.5 of the greatest lag, nugget and partial sill are solved by least squares weighted by
    pairs, held to at least 0 and 1e-9 afterwards, and scored as held. The first range with the least error wins. Fewer
    than three bins, or no range that can be solved, give no row."""
    solid = bins.where(F.col("lag_center").isNotNull() & F.col("gamma").isNotNull() & (F.col("n") > 0)).select(*keys, F.col("lag_center").alias("h"), F.col("gamma").alias("g"), F.col("n").cast("double").alias("w"))
    packed = solid.groupBy(*keys).agg(F.max("h").alias("reach"), F.count("h").alias("bins"), F.collect_list(F.struct("h", "g", "w")).alias("points")).where("bins >= 3")
    # few bytes, much work: dealt out to all tasks, where adaptive planning would leave them in one
    packed = packed.repartition(int(bins.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    tried = packed.select(*keys, "points", "reach", F.explode(F.sequence(F.lit(0), F.lit(p.ranges - 1))).alias("__k"))
    # the last candidate is the end itself, as evenly spaced numbers go
    low, high = F.col("reach") * 0.1, F.col("reach") * 1.5
    tried = tried.withColumn("range", F.when(F.col("__k") == p.ranges - 1, high).otherwise(low + F.col("__k") * ((high - low) / (p.ranges - 1))))
    tried = tried.withColumn("model", F.explode(F.array(*[F.lit(m) for m in p.models])))
    point = tried.select(*keys, "model", "__k", "range", F.explode("points").alias("p")).select(*keys, "model", "__k", "range", "p.*")
    point = point.withColumn("s", F.coalesce(*[F.when(F.col("model") == m, geometry.shape(m, F.col("h"), F.col("range"))) for m in p.models]))
    # the error of any nugget and partial sill follows from sums, so points are gone over once; a key's lie in one partition already
    w, s, g = F.col("w"), F.col("s"), F.col("g")
    sums = {"sw": w, "sws": w * s, "swss": w * s * s, "swg": w * g, "swsg": w * s * g, "swgg": w * g * g}
    point = point.groupBy(*keys, "model", "__k").agg(F.first("range").alias("range"), *[F.sum(x).alias(name) for name, x in sums.items()])
    det = F.col("sw") * F.col("swss") - F.col("sws") * F.col("sws")
    point = point.withColumn("nugget", F.try_divide(F.col("swss") * F.col("swg") - F.col("sws") * F.col("swsg"), det)).withColumn("partial", F.try_divide(F.col("sw") * F.col("swsg") - F.col("sws") * F.col("swg"), det)).where("partial IS NOT NULL")
    point = point.withColumn("nugget", F.greatest("nugget", F.lit(0.0))).withColumn("partial", F.greatest("partial", F.lit(1e-9)))
    a, b = F.col("nugget"), F.col("partial")
    square = F.col("swgg") - 2 * a * F.col("swg") - 2 * b * F.col("swsg") + a * a * F.col("sw") + 2 * a * b * F.col("sws") + b * b * F.col("swss")
    scored = point.withColumn("sse", F.greatest(square, F.lit(0.0)))
    # ranges below which no bin lies but the first fit alike; rounding mustn't choose among them, so the first within TIE wins
    of = F.struct("__k", "nugget", "partial", "range", "sse", "sw")
    tries = scored.groupBy(*keys, "model").agg(F.min("sse").alias("least"), F.collect_list(of).alias("tries"))
    best = tries.withColumn("b", F.array_min(F.filter("tries", lambda t: t["sse"] <= F.col("least") * (1 + TIE))))
    return best.select(*keys, "model", "b.nugget", (F.col("b.nugget") + F.col("b.partial")).alias("sill"), "b.range", F.sqrt(F.col("b.sse") / F.col("b.sw")).alias("rmse"))


def best_model(fits: DataFrame, keys: list[str], p: Variogram = DEFAULT) -> DataFrame:
    """The chosen fit: spherical, unless another's error is below 0.95 of the best so far; the least error without spherical.

    Models are held against each other in the order they are named."""
    by = fits.groupBy(*keys).agg(*[F.max(F.when(F.col("model") == m, F.struct("model", "nugget", "sill", "range", "rmse"))).alias(m) for m in p.models])
    if "spherical" in p.models:
        best = F.col("spherical")
        for m in p.models:
            if m != "spherical":
                best = F.when(F.col(m)["rmse"] < best["rmse"] * (1 - p.spherical_bias), F.col(m)).otherwise(best)
        rest = [m for m in p.models if m != "spherical"]
    else:
        best, rest = F.lit(None), list(p.models)
    if rest:
        every = F.filter(F.array(*[F.col(m) for m in rest]), lambda f: f.isNotNull())
        least = F.aggregate(every, F.get(every, F.lit(0)), lambda a, b: F.when(b["rmse"] < a["rmse"], b).otherwise(a))
        best = F.coalesce(best, least)
    return by.withColumn("b", best).where("b IS NOT NULL").select(*keys, "b.*")


def table_of(sums: DataFrame, days: DataFrame, p: Variogram = DEFAULT, doys: list[int] | None = None) -> DataFrame:
    """The table of all days of the year, or of those named, from source_sums and source_days of both variants."""
    every = calendar.reference_calendar(sums.sparkSession)
    out = every if doys is None else every.where(F.col("doy").isin(doys))
    best = best_model(fit_models(pool(sums, p, doys), ["variant", "doy"], p), ["variant", "doy"], p)
    # 365 rows of each variant at most, side by side
    fit = best.join(pool_days(days, p, doys), ["variant", "doy"], "left").select("variant", "doy", F.struct("model", "nugget", "sill", "range", "rmse", F.coalesce("n_days", F.lit(0)).alias("n_days")).alias("f"))
    wide = fit.groupBy("doy").agg(*[F.max(F.when(F.col("variant") == v, F.col("f"))).alias(v) for v in VARIANTS])
    found = out.join(wide, "doy", "left")
    columns = [F.col(f"{v}.{c}").alias(f"{v}_{c}") if c != "n_days" else F.coalesce(f"{v}.n_days", F.lit(0)).alias(f"{v}_n_days") for v in VARIANTS for c in ("model", "nugget", "sill", "range", "rmse", "n_days")]
    return found.select("doy", "month", "day", *columns).select(*CACHE_COLUMNS)


def variogram_table(obs: DataFrame, stations: DataFrame, p: Variogram = DEFAULT, doys: list[int] | None = None) -> DataFrame:
    """The table of all 365 days, or of those named: each with the fit for residuals (ked_*) and for values (ok_*), null where none was possible."""
    if doys is not None:  # only the days of the source that they pool
        sources = calendar.window_bridge(obs.sparkSession, p.window).where(F.col("doy").isin(doys)).select("source_doy").distinct()
        obs = obs.join(F.broadcast(sources), calendar.calendar_doy(F.col("date")) == F.col("source_doy"), "left_semi")
    each = [(source_sums(obs, stations, v, p), source_days(obs, stations, v, p)) for v in VARIANTS]
    return table_of(each[0][0].unionByName(each[1][0]), each[0][1].unionByName(each[1][1]), p, doys)


def look_up(days: DataFrame, table: DataFrame) -> DataFrame:
    """days (date, preferred) with used, model, nugget, sill, range: the preferred fit, or else the other, or else none.

    The table has 365 rows at most."""
    fit = lambda v: F.when(F.col(f"{v}_model").isNotNull(), F.struct(F.lit(v).alias("used"), *[F.col(f"{v}_{c}").alias(c) for c in ("model", "nugget", "sill", "range")]))
    fits = table.select("doy", fit("ked").alias("ked"), fit("ok").alias("ok"))
    joined = days.withColumn("doy", calendar.calendar_doy(F.col("date"))).join(F.broadcast(fits), "doy", "left")
    chosen = F.when(F.col("preferred") == "ked", F.coalesce("ked", "ok")).when(F.col("preferred") == "ok", F.coalesce("ok", "ked"))
    return joined.withColumn("f", chosen).select(*days.columns, "f.*")


def cached(table: DataFrame, date: str, method: str) -> dict:
    """One date's fit by method; KeyError without that day, ValueError without that fit."""
    doy = calendar.calendar_doy(F.lit(date).cast("date"))
    row = table.where(F.col("doy") == doy).select(*[F.col(f"{method}_{c}").alias(c) for c in ("model", "nugget", "sill", "range", "rmse", "n_days")]).first()
    if row is None:
        raise KeyError(f"{date} is not in the table")
    if row["model"] is None:
        raise ValueError(f"no {method} variogram for {date}")
    return row.asDict()
