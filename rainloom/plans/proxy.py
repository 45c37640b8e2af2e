"""The engine's operators over the driver's tables, each with its SQL where SQL can express it.

Stations are nations, a day's value is the quantity shipped from a nation's suppliers on that day, and the places of
stations, the elevation grid and the fields on it follow from whole numbers by fixed arithmetic in both languages."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar, crs, geometry
from ..operators import drift, homogeneity, kriging, plots, raster, series, variogram
from ..schema import CACHE_COLUMNS, Variogram

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: The candidate station of relative tests, and the days that a year of the smaller tables needs.
CANDIDATE, MIN_DAYS = "7", 200
#: Added before rounding where values often lie halfway between two decimals, so that both engines go the same way.
TIE = 1e-7
GRID_SIZE, CELL = 20, 5000.0


def query(sql: str | None = None, snap: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[Query], Query]:
    """Registers a query, with its SQL; snap rounds what is registered, where engines differ in the last digits."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = (lambda spark, sf_dir: snap(f(spark, sf_dir))) if snap else f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# -- proxy tables ---------------------------------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_shipdate").cast("date").alias("date"), "l_quantity")
    places = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("string").alias("station"))
    # sums by supplier and day first: what is shuffled and joined is days, not lines
    daily = lines.groupBy("date", "l_suppkey").agg(F.sum("l_quantity").alias("value"))
    return daily.join(places, "l_suppkey").groupBy("date", "station").agg(F.sum("value").alias("value"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey").cast("long")
    x, y, z = k * 7919 % 1000, k * 104729 % 1000, k * 15485863 % 2300
    return _table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("station"), (83 + x / 200).alias("lon"), (26 + y / 500).alias("lat"),
        (z + 50).cast("double").alias("z"), (x * 100).cast("double").alias("x"), (y * 140).cast("double").alias("y"),
    )


def cells(spark: SparkSession, size: int = GRID_SIZE) -> DataFrame:
    ids = spark.range(size * size).select((F.col("id") / size).cast("int").alias("row"), (F.col("id") % size).cast("int").alias("col"))
    grid = raster.grid_coordinates(ids, size, 0.0, 0.0, CELL)
    height = F.col("row") * 31 + F.col("col") * 17
    return grid.withColumn("z", F.when(height % 13 != 0, (height * 7 % 900 + 60).cast("double")))


def field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value for every cell and every date, null on some cells."""
    days = _table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("date")).distinct()
    d = F.datediff("date", F.lit("1980-01-01").cast("date"))
    v = ((F.col("row") * 37 + F.col("col") * 11 + d * 7) % 101) / 8 - 1
    return cells(spark).crossJoin(days).select("date", "row", "col", F.when((F.col("row") + F.col("col") + d) % 9 != 0, v).cast("float").alias("rainfall"))


RINGS = {
    "hollow": [[(10000.0, 10000.0), (70000.0, 12000.0), (66000.0, 71000.0), (9000.0, 60000.0)], [(30000.0, 30000.0), (50000.0, 30000.0), (40000.0, 52000.0)]],
    "east": [[(50000.0, 20000.0), (96000.0, 20000.0), (96000.0, 80000.0), (50000.0, 80000.0)]],
    "speck": [[(100.0, 100.0), (900.0, 100.0), (500.0, 900.0)]],
}


def polygons(spark: SparkSession) -> DataFrame:
    return raster.polygons_of(spark, RINGS)


_OBS = "obs AS (SELECT CAST(l_shipdate AS DATE) AS date, CAST(s_nationkey AS VARCHAR) AS station, sum(l_quantity) AS value FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)"
_STATIONS = """stations AS (SELECT CAST(n_nationkey AS VARCHAR) AS station, 83 + (k * 7919 % 1000) / 200 AS lon, 26 + (k * 104729 % 1000) / 500 AS lat,
  CAST(k * 15485863 % 2300 + 50 AS DOUBLE) AS z, CAST(k * 7919 % 1000 * 100 AS DOUBLE) AS x, CAST(k * 104729 % 1000 * 140 AS DOUBLE) AS y
  FROM (SELECT n_nationkey, CAST(n_nationkey AS BIGINT) AS k FROM nation))"""
_ANNUAL = f"""annual AS (SELECT station, year(date) AS year, CASE WHEN count(value) >= {MIN_DAYS} THEN sum(value) END AS total, count(value) AS n_days FROM obs GROUP BY 1, 2)"""
_DOY = "CASE WHEN dayofyear(make_date(year(date), 12, 31)) = 366 AND dayofyear(date) >= 60 THEN dayofyear(date) - 1 ELSE dayofyear(date) END"
_BRIDGE = "bridge AS (SELECT CAST(a.range AS INTEGER) AS doy, CAST(b.range AS INTEGER) AS source_doy FROM range(1, 366) a, range(1, 366) b WHERE least(abs(a.range - b.range), 366 - abs(a.range - b.range)) <= 7)"
_PRESENT = "present AS (SELECT o.date, o.station, o.value, s.x, s.y, s.z FROM obs o JOIN stations s USING (station))"
_DRIFT = """drift AS (SELECT date, avg(value) - covar_pop(value, z) / var_pop(z) * avg(z) AS a, covar_pop(value, z) / var_pop(z) AS b,
  CASE WHEN var_pop(value) > 0 THEN abs(covar_pop(value, z)) / (sqrt(var_pop(z)) * sqrt(var_pop(value))) ELSE 0 END AS r, CAST(count(*) AS INTEGER) AS n FROM present GROUP BY date HAVING count(*) >= 4)"""
_RESIDUALS = "residuals AS (SELECT p.date, p.station, p.x, p.y, p.value - a - b * z AS value FROM present p JOIN drift USING (date))"
_PAIRS = """allpairs AS (SELECT a.station AS s1, b.station AS s2, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS distance FROM stations a JOIN stations b ON a.station < b.station),
pairs AS (SELECT s1, s2, distance, CAST(floor(distance * 12 / max_lag) AS INTEGER) AS bin FROM (SELECT *, max(distance) OVER () * (2.0::DOUBLE / 3.0::DOUBLE) AS max_lag FROM allpairs) WHERE distance < max_lag)"""


def _splits(source: str, keys: str) -> str:
    """SQL that tests each series (keys, year, value) of source."""
    return f"""moments AS (SELECT *, count(*) OVER w AS n, avg(value) OVER w AS mean, stddev_samp(value) OVER w AS sd, sum(value) OVER w AS total,
    row_number() OVER o AS k, sum(value) OVER (o ROWS UNBOUNDED PRECEDING) AS before, lead(year) OVER o AS break_year
  FROM {source} WHERE value IS NOT NULL WINDOW w AS (PARTITION BY {keys}), o AS (PARTITION BY {keys} ORDER BY year)),
splits AS (SELECT *, before / k AS m1, (total - before) / (n - k) AS m2, k * ((before / k - mean) / sd) * ((before / k - mean) / sd) + (n - k) * (((total - before) / (n - k) - mean) / sd) * (((total - before) / (n - k) - mean) / sd) AS t FROM moments WHERE k < n AND n >= 5),
snht AS (SELECT {keys}, CAST(max(n) AS INTEGER) AS n_years, round(max(t), 4) AS t_stat, arg_max(year, t) AS last_year_before_break, arg_max(break_year, t) AS break_year, round(arg_max(m1, t), 4) AS mean_before, round(arg_max(m2, t), 4) AS mean_after FROM splits GROUP BY {keys})"""


def _p_values(keys: str, seed: int = 42, runs: int = 20_000) -> str:
    """SQL that adds the simulated p values of snht (keys, n_years, t_stat): the simulation's series are split like any others."""
    u = lambda salt: f"(CAST(('0x' || substr(md5('{seed}:{salt}:' || n_years || ':' || run || ':' || year), 1, 12)) AS BIGINT) + 0.5::DOUBLE) / 281474976710656::DOUBLE"
    made = f"""made AS (SELECT n_years, run, year, sqrt(-2 * ln({u(1)})) * cos(2 * pi() * {u(2)}) AS value
      FROM (SELECT DISTINCT n_years FROM snht) l, range({runs}) r(run), LATERAL (SELECT unnest(range(1, n_years + 1)) AS year) y)"""
    splits = _splits("made", "n_years, run").replace("moments", "moments_0").replace("splits", "splits_0").replace("snht AS", "null_0 AS")
    best = f"exact AS (SELECT {keys}, max(t) AS t FROM splits GROUP BY {keys})"
    larger = f"larger AS (SELECT {keys}, count(*) FILTER (WHERE z.t > e.t) / {runs}.0::DOUBLE AS p_value FROM exact e JOIN snht USING ({keys}) JOIN (SELECT n_years, run, max(t) AS t FROM splits_0 GROUP BY n_years, run) z USING (n_years) GROUP BY {keys})"
    return f"{made}, {splits}, {best}, {larger}, tested AS (SELECT snht.*, p_value, p_value < 0.05 AS inhomogeneous FROM snht LEFT JOIN larger USING ({keys}))"


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in names})


def _zero(*names: str) -> Callable[[DataFrame], DataFrame]:
    """Three decimals; adding 0 makes -0 a plain 0."""
    return lambda df: df.withColumns({c: F.round(c, 3) + 0 for c in names})


# -- homogeneity ----------------------------------------------------------------------------------------------------


def _annual(spark: SparkSession, sf_dir: str, min_days: int = MIN_DAYS) -> DataFrame:
    return homogeneity.annual_totals(observations(spark, sf_dir), min_days)


def _value(annual: DataFrame) -> DataFrame:
    return annual.select("station", "year", F.col("total").alias("value"))


@query(f"WITH {_OBS}, {_ANNUAL} SELECT station, CAST(year AS INTEGER) AS year, total, n_days FROM annual")
def annual_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annual(spark, sf_dir)


@query(f"WITH {_OBS}, {_ANNUAL}, v AS (SELECT station, CAST(year AS INTEGER) AS year, total AS value FROM annual), {_splits('v', 'station')} SELECT * FROM snht")
def snht_statistic(spark: SparkSession, sf_dir: str, min_days: int = MIN_DAYS) -> DataFrame:
    return _rounded(homogeneity.snht(_value(_annual(spark, sf_dir, min_days)), ["station"]), 4, "t_stat", "mean_before", "mean_after")


@query(f"WITH {_OBS}, {_ANNUAL}, v AS (SELECT station, CAST(year AS INTEGER) AS year, total AS value FROM annual), {_splits('v', 'station')}, {_p_values('station')} SELECT * FROM tested")
def snht_p_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simulated from numbers that any engine draws alike."""
    return _rounded(homogeneity.with_p_values(homogeneity.snht(_value(_annual(spark, sf_dir)), ["station"])), 4, "t_stat", "mean_before", "mean_after")


_NORM = "norm AS (SELECT *, total / avg(total) OVER (PARTITION BY station) AS norm FROM annual)"
_CORR = f"""corr AS (SELECT n.station, CASE WHEN stddev_pop(n.total) > 0 AND stddev_pop(c.total) > 0 THEN covar_pop(n.total, c.total) / (stddev_pop(n.total) * stddev_pop(c.total)) END AS r
  FROM annual n JOIN annual c ON n.year = c.year AND c.station = '{CANDIDATE}' WHERE n.station <> '{CANDIDATE}' AND n.total IS NOT NULL AND c.total IS NOT NULL GROUP BY n.station)"""
_RELATIVE = f"""reference AS (SELECT year, CASE WHEN count(norm) >= 2 THEN sum(greatest(r, 0) * norm) / nullif(sum(greatest(r, 0)), 0) END AS reference
  FROM norm JOIN corr USING (station) WHERE norm IS NOT NULL GROUP BY year),
relative AS (SELECT coalesce(o.year, f.year) AS year, o.norm AS candidate_norm, reference, o.norm / nullif(reference, 0) AS ratio
  FROM (SELECT year, norm FROM norm WHERE station = '{CANDIDATE}') o FULL JOIN reference f ON o.year = f.year)"""


@query(f"WITH {_OBS}, {_ANNUAL}, {_CORR} SELECT station, round(r, 6) AS r FROM corr WHERE r IS NOT NULL")
def neighbour_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(homogeneity.neighbour_correlations(_annual(spark, sf_dir), CANDIDATE), 6, "r").where("r IS NOT NULL")


@query(f"WITH {_OBS}, {_ANNUAL}, {_NORM}, {_CORR}, {_RELATIVE} SELECT CAST(year AS INTEGER) AS year, round(candidate_norm, 6) AS candidate_norm, round(reference, 6) AS reference, round(ratio, 6) AS ratio FROM relative")
def relative_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(homogeneity.relative_series(_annual(spark, sf_dir), CANDIDATE), 6, "candidate_norm", "reference", "ratio")


@query(f"WITH {_OBS}, {_ANNUAL}, {_NORM}, {_CORR}, {_RELATIVE}, v AS (SELECT 'ratio' AS kind, CAST(year AS INTEGER) AS year, ratio AS value FROM relative), {_splits('v', 'kind')} SELECT * FROM snht")
def relative_snht(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = homogeneity.relative_series(_annual(spark, sf_dir), CANDIDATE).select(F.lit("ratio").alias("kind"), "year", F.col("ratio").alias("value"))
    return _rounded(homogeneity.snht(ratio, ["kind"]), 4, "t_stat", "mean_before", "mean_after")


_TESTED = ["n_years", "t_stat", "last_year_before_break", "break_year", "mean_before", "mean_after", "p_value", "inhomogeneous"]
_BOTH = f"""v AS (SELECT 'absolute' AS kind, CAST(year AS INTEGER) AS year, total AS value FROM annual WHERE station = '{CANDIDATE}' UNION ALL SELECT 'relative', CAST(year AS INTEGER), ratio FROM relative),
  {_splits("v", "kind")}, {_p_values("kind")}, a AS (SELECT * FROM tested WHERE kind = 'absolute'), b AS (SELECT * FROM tested WHERE kind = 'relative'),
  test AS (SELECT '{CANDIDATE}' AS station, {", ".join(f"{t}.{c} AS {k}_{c}" for t, k in (("a", "absolute"), ("b", "relative")) for c in _TESTED)},
    CASE WHEN b.inhomogeneous IS NULL THEN '{homogeneity.NO_RELATIVE_TEST}' WHEN NOT b.inhomogeneous THEN '{homogeneity.REGIONAL}' WHEN abs(b.break_year - a.break_year) <= 3 THEN '{homogeneity.STATION_PROBLEM}'
      ELSE '{homogeneity.OTHER_YEAR}' END AS verdict FROM (SELECT 1) LEFT JOIN a ON true LEFT JOIN b ON true)"""


@query(f"WITH {_OBS}, {_ANNUAL}, {_NORM}, {_CORR}, {_RELATIVE}, {_BOTH} SELECT * FROM test")
def relative_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simulated p values decide."""
    return _rounded(homogeneity.relative_test(_annual(spark, sf_dir), CANDIDATE), 4, *[f"{k}_{c}" for k in ("absolute", "relative") for c in ("t_stat", "mean_before", "mean_after")])


_LINE = lambda kind: f"'{kind.title()} SNHT: break ' || {kind}_break_year || ', p = ' || printf('%.4f', round_even({kind}_p_value * 10000, 0) / 10000)"


@query(f"""WITH {_OBS}, {_ANNUAL}, {_NORM}, {_CORR}, {_RELATIVE}, {_BOTH},
near AS (SELECT string_agg(station, ', ' ORDER BY station) AS names, string_agg(station || '=' || CASE WHEN r IS NULL THEN 'nan' ELSE printf('%.2f', r) END, ', ' ORDER BY station) AS rs
  FROM (SELECT DISTINCT n.station FROM annual n JOIN annual c ON n.year = c.year AND c.station = '{CANDIDATE}' WHERE n.station <> '{CANDIDATE}') LEFT JOIN corr USING (station))
SELECT station, concat_ws(chr(10), 'Relative homogeneity test for station ' || station, 'Neighbours: ' || names, 'Correlations: ' || rs, '', {_LINE("absolute")}, {_LINE("relative")}, 'Verdict: ' || verdict) AS report FROM test, near""")
def homogeneity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    annual = _annual(spark, sf_dir)
    return homogeneity.report(homogeneity.relative_test(annual, CANDIDATE), homogeneity.neighbour_correlations(annual, CANDIDATE))


@query(f"""SELECT CAST(a AS BOOLEAN) AS inhomogeneous, CAST(b AS INTEGER) AS relative_break, CAST(c AS INTEGER) AS absolute_break,
  CASE WHEN a = 0 THEN '{homogeneity.REGIONAL}' WHEN abs(b - c) <= 3 THEN '{homogeneity.STATION_PROBLEM}' ELSE '{homogeneity.OTHER_YEAR}' END AS verdict
  FROM (SELECT r % 2 AS a, 1990 + r AS b, 1994 AS c FROM range(12) t(r))""")  # fmt: skip
def verdict_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = spark.range(12).select((F.col("id") % 2 == 1).alias("inhomogeneous"), (F.col("id") + 1990).cast("int").alias("relative_break"), F.lit(1994).alias("absolute_break"))
    return cases.withColumn("verdict", homogeneity.verdict(F.col("inhomogeneous"), F.col("relative_break"), F.col("absolute_break")))


# -- calendar and projection ----------------------------------------------------------------------------------------


@query(f"SELECT DISTINCT date, CAST({_DOY} AS INTEGER) AS doy, CAST(date_diff('day', DATE '1980-01-01', date) AS INTEGER) AS days FROM (SELECT CAST(l_shipdate AS DATE) AS date FROM lineitem)")
def calendar_doy(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = _table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("date")).distinct()
    return dates.select("date", calendar.calendar_doy(F.col("date")).alias("doy"), calendar.days_since(F.col("date")).alias("days"))


@query(f"WITH {_BRIDGE}, dates AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem) SELECT doy, count(*) AS n_dates FROM (SELECT {_DOY} AS source_doy FROM dates) JOIN bridge USING (source_doy) GROUP BY doy")
def doy_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = _table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("date")).distinct()
    days = dates.groupBy(calendar.calendar_doy(F.col("date")).alias("source_doy")).count()
    return days.join(F.broadcast(calendar.window_bridge(spark)), "source_doy").groupBy("doy").agg(F.sum("count").alias("n_dates"))


@query("SELECT CAST(r AS INTEGER) AS doy, CAST(month(DATE '2000-12-31' + CAST(r AS INTEGER)) AS INTEGER) AS month, CAST(day(DATE '2000-12-31' + CAST(r AS INTEGER)) AS INTEGER) AS day FROM range(1, 366) t(r)")
def reference_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.reference_calendar(spark)


@query(f"""WITH {_STATIONS}, c AS (SELECT *, 0.0033528106647474805::DOUBLE * (2 - 0.0033528106647474805::DOUBLE) AS e2 FROM stations),
r AS (SELECT *, e2 / (1 - e2) AS ep2, radians(lat) AS p FROM c),
t AS (SELECT *, 6378137.0::DOUBLE / sqrt(1 - e2 * sin(p) * sin(p)) AS n, tan(p) * tan(p) AS t, ep2 * cos(p) * cos(p) AS c, cos(p) * (radians(lon) - radians(87::DOUBLE)) AS a,
  6378137.0::DOUBLE * ((1 - e2 / 4 - 3 * e2 * e2 / 64 - 5 * e2 * e2 * e2 / 256) * p - (3 * e2 / 8 + 3 * e2 * e2 / 32 + 45 * e2 * e2 * e2 / 1024) * sin(2 * p)
    + (15 * e2 * e2 / 256 + 45 * e2 * e2 * e2 / 1024) * sin(4 * p) - (35 * e2 * e2 * e2 / 3072) * sin(6 * p)) AS m FROM r)
SELECT station, round(0.9996::DOUBLE * n * (a + (1 - t + c) * a * a * a / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * a * a * a * a * a / 120) + 500000, 3) AS easting,
  round(0.9996::DOUBLE * (m + n * tan(p) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * a * a * a * a / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * a * a * a * a * a * a / 720)), 3) AS northing FROM t""")
def utm_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = geometry.utm(F.col("lat"), F.col("lon"))
    return stations(spark, sf_dir).select("station", F.round(x, 3).alias("easting"), F.round(y, 3).alias("northing"))


def _krueger() -> str:
    """SQL of Krueger's series, forward."""
    n = "0.0016792203863837047::DOUBLE"
    a = [" + ".join(f"({c!r}::DOUBLE) * {' * '.join([n] * (k + 1))}" for k, c in enumerate(row) if c) for row in crs.FORWARD]
    terms = lambda f, g: " + ".join(f"({x}) * {f}({2 * j} * xi) * {g}({2 * j} * eta)" for j, x in enumerate(a, 1))
    scale = f"0.9996::DOUBLE * 6378137.0::DOUBLE / (1 + {n}) * (1 + {n} * {n} / 4 + {n} * {n} * {n} * {n} / 64)"
    return f"""places AS (SELECT station, zone, south, zone * 6 - 183 + (lon - 85.5::DOUBLE) AS lon, CASE WHEN south THEN -lat ELSE lat END AS lat FROM stations, (SELECT CAST(r AS INTEGER) AS zone FROM range(1, 61) t(r)), (VALUES (false), (true)) h(south)),
tau AS (SELECT *, sinh(atanh(sin(radians(lat))) - e * atanh(e * sin(radians(lat)))) AS t, radians(lon) - radians(zone * 6 - 183::DOUBLE) AS away FROM (SELECT *, 2 * sqrt({n}) / (1 + {n}) AS e FROM places)),
plane AS (SELECT *, atan2(t, cos(away)) AS xi, atanh(sin(away) / sqrt(1 + t * t)) AS eta FROM tau)
SELECT station, zone, south, round(500000 + {scale} * (eta + {terms("cos", "sinh")}), 4) AS easting, round(CASE WHEN south THEN 10000000 ELSE 0 END + {scale} * (xi + {terms("sin", "cosh")}), 4) AS northing, round(lon, 9) AS lon, round(lat, 9) AS lat FROM plane"""


@query(f"WITH {_STATIONS}, {_krueger()}")
def utm_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stations moved to every zone and both hemispheres, projected there and back."""
    zones = F.explode(F.sequence(F.lit(1), F.lit(60))).alias("zone")
    moved = stations(spark, sf_dir).select("station", "lon", "lat", zones).select("station", "zone", "lon", "lat", F.explode(F.array(F.lit(False), F.lit(True))).alias("south"))
    moved = moved.withColumn("lon", F.col("zone") * 6 - 183 + (F.col("lon") - 85.5)).withColumn("lat", F.when(F.col("south"), -F.col("lat")).otherwise(F.col("lat")))
    x, y = crs.project(F.col("lon"), F.col("lat"), F.col("zone"), F.col("south"))
    there = moved.select("station", "zone", "south", x.alias("easting"), y.alias("northing"))
    lon, lat = crs.unproject(F.col("easting"), F.col("northing"), F.col("zone"), F.col("south"))
    return there.select("station", "zone", "south", F.round("easting", 4).alias("easting"), F.round("northing", 4).alias("northing"), F.round(lon, 9).alias("lon"), F.round(lat, 9).alias("lat"))


@query(f"WITH {_STATIONS} SELECT min(lon) AS lon_low, max(lon) AS lon_high, min(lat) AS lat_low, max(lat) AS lat_high, count(*) AS n FROM stations")
def station_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations(spark, sf_dir).agg(F.min("lon").alias("lon_low"), F.max("lon").alias("lon_high"), F.min("lat").alias("lat_low"), F.max("lat").alias("lat_high"), F.count(F.lit(1)).alias("n"))


# -- drift ----------------------------------------------------------------------------------------------------------


@query(f"WITH {_OBS}, {_STATIONS}, {_PRESENT}, {_DRIFT} SELECT date, round(a, 4) AS a, round(b, 6) AS b, round(r, 6) AS r, n FROM drift")
def daily_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_rounded(drift.daily_drift(observations(spark, sf_dir), stations(spark, sf_dir)), 4, "a"), 6, "b", "r")


@query(f"WITH {_OBS}, {_STATIONS}, {_PRESENT}, {_DRIFT}, {_RESIDUALS} SELECT date, station, round(value + 1e-7, 4) AS residual FROM residuals")
def drift_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drift.residuals(observations(spark, sf_dir), stations(spark, sf_dir))
    return found.select("date", "station", F.round(F.col("value") + TIE, 4).alias("residual"))


_METHOD = """method AS (SELECT d.date, CAST(coalesce(c, 0) AS INTEGER) AS n_reporting, CASE WHEN c >= 4 THEN r END AS r, CASE WHEN c >= 4 THEN CASE WHEN coalesce(n >= 8 AND r >= 0.3, false) THEN 'ked' ELSE 'ok' END END AS preferred
  FROM (SELECT DISTINCT date FROM obs) d LEFT JOIN (SELECT date, count(*) AS c FROM present GROUP BY date) p USING (date) LEFT JOIN drift USING (date))"""


@query(f"WITH {_OBS}, {_STATIONS}, {_PRESENT}, {_DRIFT}, {_METHOD} SELECT date, n_reporting, round(r, 6) AS r, preferred FROM method")
def method_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(drift.day_method(observations(spark, sf_dir), stations(spark, sf_dir)), 6, "r")


# -- variograms -----------------------------------------------------------------------------------------------------


@query(f"WITH {_STATIONS}, {_PAIRS} SELECT s1, s2, round(distance, 4) AS distance, bin FROM pairs")
def pairwise_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(variogram.station_pairs(stations(spark, sf_dir)), 4, "distance")


def _experimental(values: str, gamma: str, keys: str = "date") -> str:
    return f"""SELECT {keys}, bin, round(avg(distance), 3) AS lag_center, round({gamma}, 3) AS gamma, count(*) AS n
  FROM {values} a JOIN {values} b ON a.date = b.date AND a.station < b.station JOIN pairs ON s1 = a.station AND s2 = b.station GROUP BY ALL"""


_MATHERON = "avg((a.value - b.value) * (a.value - b.value)) / 2"


@query(f"WITH {_OBS}, {_STATIONS}, {_PAIRS} {_experimental('obs', _MATHERON, 'a.date')}")
def experimental_variogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = variogram.experimental(observations(spark, sf_dir), variogram.station_pairs(stations(spark, sf_dir)), ["date"])
    return _rounded(found, 3, "lag_center", "gamma")


def _pooled(values: str, stat: str, final: str) -> str:
    return f"""partial AS (SELECT {_DOY.replace("(date", "(a.date")} AS source_doy, bin, count(*) AS n, sum(distance) AS d, sum({stat}) AS s
  FROM {values} a JOIN {values} b ON a.date = b.date AND a.station < b.station JOIN pairs ON s1 = a.station AND s2 = b.station GROUP BY ALL),
pooled AS (SELECT doy, bin, sum(d) / sum(n) AS lag_center, {final} AS gamma, CAST(sum(n) AS BIGINT) AS n FROM partial JOIN bridge USING (source_doy) GROUP BY ALL)"""


_ENOUGH = "enough AS (SELECT o.* FROM obs o JOIN (SELECT date FROM obs GROUP BY date HAVING count(value) >= 4) USING (date))"
_POOL_RAW = _pooled("enough", "(a.value - b.value) * (a.value - b.value)", "sum(s) / sum(n) / 2")
_POOL_RESIDUAL = _pooled("residuals", "(a.value - b.value) * (a.value - b.value)", "sum(s) / sum(n) / 2")
_POOL_CRESSIE = _pooled("enough", "sqrt(abs(a.value - b.value))", "0.5 * (sum(s) / sum(n)) ** 4 / (0.457::DOUBLE + 0.494::DOUBLE / sum(n))")
_POOLED = "SELECT doy, bin, round(lag_center, 3) AS lag_center, round(gamma, 3) AS gamma, n FROM pooled"


def _pooled_query(spark: SparkSession, sf_dir: str, variant: str, p: Variogram = Variogram()) -> DataFrame:
    return _rounded(variogram.pooled(observations(spark, sf_dir), stations(spark, sf_dir), variant, p), 3, "lag_center", "gamma")


@query(f"WITH {_OBS}, {_STATIONS}, {_PAIRS}, {_BRIDGE}, {_ENOUGH}, {_POOL_RAW} {_POOLED}")
def pooled_variogram_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pooled_query(spark, sf_dir, "ok")


@query(f"WITH {_OBS}, {_STATIONS}, {_PRESENT}, {_DRIFT}, {_RESIDUALS}, {_PAIRS}, {_BRIDGE}, {_POOL_RESIDUAL} {_POOLED}")
def pooled_variogram_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pooled_query(spark, sf_dir, "ked")


@query(f"WITH {_OBS}, {_STATIONS}, {_PAIRS}, {_BRIDGE}, {_ENOUGH}, {_POOL_CRESSIE} {_POOLED}")
def pooled_variogram_cressie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pooled_query(spark, sf_dir, "ok", Variogram(estimator="cressie"))


@query(f"WITH {_OBS}, {_STATIONS}, {_PRESENT}, {_DRIFT}, {_BRIDGE} SELECT doy, CAST(count(*) AS INTEGER) AS n_days FROM (SELECT {_DOY} AS source_doy FROM drift) JOIN bridge USING (source_doy) GROUP BY doy")
def pooled_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variogram.pooled_days(observations(spark, sf_dir), stations(spark, sf_dir), "ked")


_FIT = """tried AS (SELECT doy, k, model, CASE WHEN k = 59 THEN h * 1.5 ELSE h * 0.1 + k * ((h * 1.5 - h * 0.1) / 59) END AS r
  FROM (SELECT doy, max(lag_center) AS h FROM pooled GROUP BY doy HAVING count(*) >= 3), range(60) t(k), (VALUES ('spherical'), ('exponential')) m(model)),
shaped AS (SELECT doy, model, k, r, gamma AS g, CAST(n AS DOUBLE) AS w, CASE WHEN model = 'exponential' THEN 1 - exp(-3 * (lag_center / r)) WHEN lag_center >= r THEN 1 ELSE 1.5 * (lag_center / r) - 0.5 * (lag_center / r) ** 3 END AS s FROM tried JOIN pooled USING (doy)),
solved AS (SELECT *, (swss * swg - sws * swsg) / (sw * swss - sws * sws) AS n0, (sw * swsg - sws * swg) / (sw * swss - sws * sws) AS p0 FROM
  (SELECT *, sum(w) OVER o AS sw, sum(w * s) OVER o AS sws, sum(w * s * s) OVER o AS swss, sum(w * g) OVER o AS swg, sum(w * s * g) OVER o AS swsg FROM shaped WINDOW o AS (PARTITION BY doy, model, k))),
scored AS (SELECT doy, model, k, sum(w * (g - greatest(n0, 0) - greatest(p0, 1e-9) * s) ** 2) AS sse, any_value(sw) AS sw FROM solved GROUP BY ALL),
fits AS (SELECT doy, model, sqrt(min(sse) / any_value(sw)) AS rmse FROM scored GROUP BY ALL)"""


@query(f"WITH {_OBS}, {_STATIONS}, {_PAIRS}, {_BRIDGE}, {_ENOUGH}, {_POOL_RAW}, {_FIT} SELECT doy, model, round(rmse, 3) AS rmse FROM fits")
def variogram_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = variogram.pooled(observations(spark, sf_dir), stations(spark, sf_dir), "ok")
    return _rounded(variogram.fit_models(bins, ["doy"]), 3, "rmse").select("doy", "model", "rmse")


@query(f"""WITH {_OBS}, {_STATIONS}, {_PAIRS}, {_BRIDGE}, {_ENOUGH}, {_POOL_RAW}, {_FIT}
SELECT doy, CASE WHEN e.rmse < s.rmse * 0.95::DOUBLE THEN 'exponential' ELSE 'spherical' END AS model, round(CASE WHEN e.rmse < s.rmse * 0.95::DOUBLE THEN e.rmse ELSE s.rmse END, 3) AS rmse
FROM (SELECT * FROM fits WHERE model = 'spherical') s JOIN (SELECT * FROM fits WHERE model = 'exponential') e USING (doy)""")
def variogram_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = variogram.pooled(observations(spark, sf_dir), stations(spark, sf_dir), "ok")
    return _rounded(variogram.best_model(variogram.fit_models(bins, ["doy"]), ["doy"]), 3, "rmse").select("doy", "model", "rmse")


_WINNERS = """winner AS (SELECT s.doy, s.model, greatest(any_value(n0), 0) AS nugget, greatest(any_value(n0), 0) + greatest(any_value(p0), 1e-9) AS sill, any_value(v.r) AS reach
  FROM (SELECT doy, model, min(k) AS k FROM scored JOIN (SELECT doy, model, min(sse) AS least FROM scored GROUP BY ALL) USING (doy, model) WHERE sse <= least * (1 + 1e-9::DOUBLE) GROUP BY ALL) s
  JOIN solved v USING (doy, model, k) GROUP BY ALL)"""


@query(f"WITH {_OBS}, {_STATIONS}, {_PAIRS}, {_BRIDGE}, {_ENOUGH}, {_POOL_RAW}, {_FIT}, {_WINNERS} SELECT doy, model, round(nugget, 3) + 0 AS nugget, round(sill, 3) AS sill, round(reach, 2) AS \"range\" FROM winner")
def variogram_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winning range of each model on each day of the year, with its nugget and sill."""
    bins = variogram.pooled(observations(spark, sf_dir), stations(spark, sf_dir), "ok")
    found = variogram.fit_models(bins, ["doy"]).select("doy", "model", "nugget", "sill", "range")
    return _rounded(found, 3, "nugget", "sill").withColumn("range", F.round("range", 2)).withColumn("nugget", F.col("nugget") + 0)


def _variant_fits(variant: str, pool: str) -> str:
    """SQL of one variant's chosen fit for each day of the year, its CTEs named apart."""
    own = pool + ", " + _FIT
    for name in ("partial", "pooled", "tried", "shaped", "solved", "scored", "fits"):
        own = re.sub(rf"\b{name}\b", f"{name}_{variant}", own)
    return own + f""", best_{variant} AS (SELECT doy, CASE WHEN e.rmse < s.rmse * 0.95::DOUBLE THEN 'exponential' ELSE 'spherical' END AS model, CASE WHEN e.rmse < s.rmse * 0.95::DOUBLE THEN e.rmse ELSE s.rmse END AS rmse
  FROM (SELECT * FROM fits_{variant} WHERE model = 'spherical') s JOIN (SELECT * FROM fits_{variant} WHERE model = 'exponential') e USING (doy))"""


_SOURCES = {"ked": "drift", "ok": "(SELECT DISTINCT date FROM enough JOIN stations USING (station))"}
_N_DAYS = ", ".join(f"days_{v} AS (SELECT doy, count(*) AS n FROM (SELECT {_DOY} AS source_doy FROM {t}) JOIN bridge USING (source_doy) GROUP BY doy)" for v, t in _SOURCES.items())


@query(f"""WITH {_OBS}, {_STATIONS}, {_PRESENT}, {_DRIFT}, {_RESIDUALS}, {_PAIRS}, {_BRIDGE}, {_ENOUGH}, {_variant_fits("ked", _POOL_RESIDUAL)}, {_variant_fits("ok", _POOL_RAW)}, {_N_DAYS}
SELECT CAST(c.range AS INTEGER) AS doy, {", ".join(f"b_{v}.model AS {v}_model, round(b_{v}.rmse, 3) AS {v}_rmse, CAST(CASE WHEN b_{v}.model IS NULL THEN 0 ELSE coalesce(d_{v}.n, 0) END AS INTEGER) AS {v}_n_days" for v in _SOURCES)}
FROM range(1, 366) c {" ".join(f"LEFT JOIN best_{v} b_{v} ON b_{v}.doy = c.range LEFT JOIN days_{v} d_{v} ON d_{v}.doy = c.range" for v in _SOURCES)}""")
def variogram_table_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's models, errors and days of both variants on all 365 days: what doesn't turn on ties between ranges."""
    columns = [c for c in CACHE_COLUMNS if c == "doy" or c.endswith(("_model", "_rmse", "_n_days"))]
    return _rounded(variogram.variogram_table(observations(spark, sf_dir), stations(spark, sf_dir)), 3, "ked_rmse", "ok_rmse").select(*columns)


def _variant_winner(variant: str) -> str:
    """SQL of the parameters of one variant's chosen fit, beside best_<variant>."""
    own = _WINNERS.replace("winner AS", f"winner_{variant} AS")
    for name in ("scored", "solved"):
        own = re.sub(rf"\b{name}\b", f"{name}_{variant}", own)
    return own


@query(f"""WITH {_OBS}, {_STATIONS}, {_PRESENT}, {_DRIFT}, {_RESIDUALS}, {_PAIRS}, {_BRIDGE}, {_ENOUGH}, {_variant_fits("ked", _POOL_RESIDUAL)}, {_variant_fits("ok", _POOL_RAW)}, {_variant_winner("ked")}, {_variant_winner("ok")}, {_N_DAYS}
SELECT CAST(c.range AS INTEGER) AS doy, CAST(month(DATE '2000-12-31' + CAST(c.range AS INTEGER)) AS INTEGER) AS month, CAST(day(DATE '2000-12-31' + CAST(c.range AS INTEGER)) AS INTEGER) AS day,
  {", ".join(f"b_{v}.model AS {v}_model, round(w_{v}.nugget, 3) + 0 AS {v}_nugget, round(w_{v}.sill, 3) AS {v}_sill, round(w_{v}.reach, 2) AS {v}_range, round(b_{v}.rmse, 3) AS {v}_rmse, CAST(CASE WHEN b_{v}.model IS NULL THEN 0 ELSE coalesce(d_{v}.n, 0) END AS INTEGER) AS {v}_n_days" for v in _SOURCES)}
FROM range(1, 366) c {" ".join(f"LEFT JOIN best_{v} b_{v} ON b_{v}.doy = c.range LEFT JOIN winner_{v} w_{v} ON w_{v}.doy = c.range AND w_{v}.model = b_{v}.model LEFT JOIN days_{v} d_{v} ON d_{v}.doy = c.range" for v in _SOURCES)}""")
def variogram_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 365 days with both fits and their parameters."""
    found = variogram.variogram_table(observations(spark, sf_dir), stations(spark, sf_dir))
    found = _rounded(found, 3, *[f"{v}_{c}" for v in variogram.VARIANTS for c in ("nugget", "sill", "rmse")])
    return _rounded(found, 2, "ked_range", "ok_range").withColumns({f"{v}_nugget": F.col(f"{v}_nugget") + 0 for v in variogram.VARIANTS})


def _made_table(spark: SparkSession) -> DataFrame:
    """A table with gaps: no fit for residuals on every third day, none for values on every fifth, and no day 100."""
    d = F.col("doy")
    fit = lambda v, gap: [F.when(d % gap != 0, F.lit(m)).alias(f"{v}_{c}") for c, m in (("model", "exponential" if v == "ked" else "spherical"),)] + [F.when(d % gap != 0, x).alias(f"{v}_{c}") for c, x in (("nugget", d * 0.5), ("sill", d * 2 + 100.0), ("range", d * 10 + 50000.0))]
    return calendar.reference_calendar(spark).where("doy <> 100").select("doy", "month", "day", *fit("ked", 3), *fit("ok", 5))


@query(f"""WITH {_OBS}, {_STATIONS}, {_PRESENT}, {_DRIFT}, {_METHOD}, t AS (SELECT r AS doy FROM range(1, 366) t(r) WHERE r <> 100),
j AS (SELECT m.date, m.preferred, t.doy, CASE WHEN preferred = 'ked' THEN CASE WHEN doy % 3 <> 0 THEN 'ked' WHEN doy % 5 <> 0 THEN 'ok' END
   WHEN preferred = 'ok' THEN CASE WHEN doy % 5 <> 0 THEN 'ok' WHEN doy % 3 <> 0 THEN 'ked' END END AS used FROM (SELECT *, {_DOY} AS d FROM method) m LEFT JOIN t ON t.doy = m.d)
SELECT date, preferred, used, CASE used WHEN 'ked' THEN 'exponential' WHEN 'ok' THEN 'spherical' END AS model, CASE WHEN used IS NOT NULL THEN doy * 0.5::DOUBLE END AS nugget,
  CASE WHEN used IS NOT NULL THEN doy * 2 + 100.0::DOUBLE END AS sill, CASE WHEN used IS NOT NULL THEN doy * 10 + 50000.0::DOUBLE END AS "range" FROM j""")
def cache_lookup_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = drift.day_method(observations(spark, sf_dir), stations(spark, sf_dir)).select("date", "preferred")
    return variogram.look_up(days, _made_table(spark))


# -- kriging --------------------------------------------------------------------------------------------------------


def _systems(spark: SparkSession, sf_dir: str, used: str | None = None) -> DataFrame:
    obs = observations(spark, sf_dir)
    days = kriging.plan_days(obs, stations(spark, sf_dir), _made_table(spark))
    if used:
        days = days.withColumn("used", F.when(F.col("model").isNotNull(), used))
    return kriging.day_systems(obs, stations(spark, sf_dir), days)


_USED = """t AS (SELECT r AS doy FROM range(1, 366) t(r) WHERE r <> 100),
used AS (SELECT m.date, CASE WHEN preferred = 'ked' THEN CASE WHEN doy % 3 <> 0 THEN 'ked' WHEN doy % 5 <> 0 THEN 'ok' END
   WHEN preferred = 'ok' THEN CASE WHEN doy % 5 <> 0 THEN 'ok' WHEN doy % 3 <> 0 THEN 'ked' END END AS used FROM (SELECT *, """ + _DOY + """ AS d FROM method) m LEFT JOIN t ON t.doy = m.d)"""


def _solved(drift: str) -> str:
    """SQL that solves every day's kriging system by Gauss-Jordan elimination with pivots, a recursion over unknowns for all days at once.

    drift: the condition on which a day has elevation as drift. Gives point (a day's stations, numbered), fit, and solved
    (date, var, m, c, inv): an unknown's value, and its row of the inverse."""
    shape = "CASE WHEN {h} <= 0 THEN 0 ELSE nugget + (sill - nugget) * CASE WHEN model = 'exponential' THEN 1 - exp(-3 * ({h} / reach)) WHEN {h} >= reach THEN 1 ELSE 1.5 * ({h} / reach) - 0.5 * ({h} / reach) * ({h} / reach) * ({h} / reach) END END"
    gamma = lambda ax, ay, bx, by: shape.format(h=f"sqrt(({ax} - {bx}) * ({ax} - {bx}) + ({ay} - {by}) * ({ay} - {by}))")
    _solved.gamma = gamma
    return f"""fit AS (SELECT date, used, {drift} AS drift, CASE used WHEN 'ked' THEN 'exponential' ELSE 'spherical' END AS model, doy * 0.5::DOUBLE AS nugget, doy * 2 + 100.0::DOUBLE AS sill, doy * 10 + 50000.0::DOUBLE AS reach
  FROM (SELECT *, {_DOY} AS doy FROM used) WHERE used IS NOT NULL),
point AS (SELECT p.date, station, x, y, z, value, row_number() OVER (PARTITION BY p.date ORDER BY station) AS i, count(*) OVER (PARTITION BY p.date) AS n, fit.* EXCLUDE (date) FROM present p JOIN fit USING (date)),
wide AS (SELECT a.date, a.i, any_value(a.n) AS n, any_value(a.drift) AS drift, any_value(a.value) AS v, list({gamma("a.x", "a.y", "b.x", "b.y").replace("nugget", "a.nugget").replace("sill", "a.sill").replace("reach", "a.reach").replace("model", "a.model")} ORDER BY b.i) || [1.0::DOUBLE] || CASE WHEN any_value(a.drift) THEN [any_value(a.z)] ELSE [] END AS a
    FROM point a JOIN point b ON a.date = b.date GROUP BY a.date, a.i
  UNION ALL SELECT date, any_value(n) + 1, any_value(n), any_value(drift), 0, list(1.0::DOUBLE ORDER BY i) || [0.0::DOUBLE] || CASE WHEN any_value(drift) THEN [0.0::DOUBLE] ELSE [] END FROM point GROUP BY date
  UNION ALL SELECT date, any_value(n) + 2, any_value(n), any_value(drift), 0, list(z ORDER BY i) || [0.0::DOUBLE, 0.0::DOUBLE] FROM point WHERE drift GROUP BY date),
turned(date, i, m, k, var, a) AS (SELECT date, i, n + 1 + CAST(drift AS INTEGER), 0, 0, a || [v] || [CASE WHEN j = i THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FOR j IN range(1, n + 2 + CAST(drift AS INTEGER))] FROM wide
  UNION ALL SELECT date, i, m, k + 1, CASE WHEN i = p THEN k + 1 ELSE var END, CASE WHEN i = p THEN [x / best[k + 1] FOR x IN best] ELSE [e[1] - e[2] * (a[k + 1] / best[k + 1]) FOR e IN list_zip(a, best)] END
    FROM (SELECT *, arg_max(i, CASE WHEN var = 0 THEN abs(a[k + 1]) ELSE -1 END) OVER w AS p, arg_max(a, CASE WHEN var = 0 THEN abs(a[k + 1]) ELSE -1 END) OVER w AS best FROM turned WHERE k < m WINDOW w AS (PARTITION BY date))),
solved AS (SELECT date, var, m, a[m + 1] AS c, a[m + 2:] AS inv FROM turned WHERE k = m)"""


def _kriged(drift: str, variance: bool = False, select: str | None = None) -> str:
    """SQL of every cell's estimate on every day, or of what is selected from side (date, row, col, z, drift, coef, inv, b)."""
    own = _solved(drift)
    b = _solved.gamma("c.x", "c.y", "p[1]", "p[2]")
    known = "CASE WHEN z IS NOT NULL OR NOT drift THEN round({}, 3) + 0 END"
    quadratic = f", {known.format('list_inner_product(b, [list_inner_product(r, b) FOR r IN inv])')} AS variance" if variance else ""
    return f"""WITH RECURSIVE {_OBS}, {_STATIONS}, {_PRESENT}, {_DRIFT}, {_METHOD}, {_USED}, {own}, {{cells}},
day AS (SELECT date, any_value(fit.drift) AS drift, any_value(model) AS model, any_value(nugget) AS nugget, any_value(sill) AS sill, any_value(reach) AS reach, list(c ORDER BY var) AS coef, list(inv ORDER BY var) AS inv FROM solved JOIN fit USING (date) GROUP BY date),
spot AS (SELECT date, list([x, y] ORDER BY i) AS ps FROM point GROUP BY date),
side AS (SELECT date, "row", col, z, drift, coef, inv, [{b} FOR p IN ps] || [1.0::DOUBLE] || CASE WHEN drift THEN [coalesce(z, 0)] ELSE [] END AS b FROM day JOIN spot USING (date), cells c)
{select or f'SELECT date, "row", col, {known.format("list_inner_product(coef, b)")} AS value{quadratic}, z IS NOT NULL AS solid FROM side'}"""


@query()
def kriging_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kriging.predict(_systems(spark, sf_dir, "ok"), cells(spark))


@query()
def kriging_ked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kriging.predict(_systems(spark, sf_dir, "ked"), cells(spark))


@query(_kriged("false"), _zero("value"))
def kriging_ok_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kriging_ok to three decimals, held to SQL that solves every day's system itself."""
    return kriging_ok(spark, sf_dir)


@query(_kriged("true"), _zero("value"))
def kriging_ked_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kriging_ked to three decimals, held to SQL."""
    return kriging_ked(spark, sf_dir)


@query(_kriged("used = 'ked'", True), _zero("value", "variance"))
def kriging_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kriging.predict_with_variance(_systems(spark, sf_dir), cells(spark))


@query(f"WITH {_OBS}, {_STATIONS}, {_PRESENT}, {_DRIFT}, {_METHOD}, {_USED} SELECT date, station, used, round(value, 2) AS value, 0.0::DOUBLE AS variance FROM present JOIN used USING (date) WHERE used IS NOT NULL")
def kriging_at_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kriging is exact: at a station that reports, the estimate is its value and the variance 0, by both methods, on all days."""
    obs, places = observations(spark, sf_dir), stations(spark, sf_dir).withColumn("row", F.col("station").cast("int")).withColumn("col", F.lit(0))
    systems = _systems(spark, sf_dir)
    found = kriging.predict_with_variance(systems, places.select("row", "col", "x", "y", "z")).withColumn("station", F.col("row").cast("string"))
    known = found.join(obs.select("date", "station"), ["date", "station"]).join(systems.where("status = 'ok'").select("date", "used"), "date")
    return known.select("date", "station", "used", F.round("value", 2).alias("value"), F.abs(F.round("variance", 2)).alias("variance"))


@query(f"WITH {_OBS}, {_STATIONS}, {_PRESENT}, {_DRIFT}, {_METHOD}, {_USED}, {{cells}} SELECT date, CAST(count(*) AS BIGINT) AS n_cells, CAST(count(z) AS BIGINT) AS n_values, CAST(CASE used WHEN 'ked' THEN 1 WHEN 'ok' THEN 0 ELSE -1 END AS INTEGER) AS method_flag, max(n_reporting) AS n_reporting FROM method JOIN used USING (date), cells WHERE used IS NOT NULL GROUP BY date, used")
def krige_days_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch plan's grid and days, counted: every day with a fit has every cell, and values where there is an elevation."""
    obs = observations(spark, sf_dir)
    grid, days = kriging.krige(obs, stations(spark, sf_dir), cells(spark), _made_table(spark))
    counted = grid.groupBy("date").agg(F.count(F.lit(1)).alias("n_cells"), F.count(F.when(F.col("rainfall") >= 0, F.col("variance"))).alias("n_values"))
    return counted.join(days, "date").select("date", "n_cells", "n_values", F.col("method_flag").cast("int").alias("method_flag"), "n_reporting")


# With a range of one metre no two places are alike: ordinary kriging then gives the day's mean, and with drift the day's
# regression on elevation, whose errors and left-out estimates are known in closed form. So whole grids can be held to SQL.
_FLAT = "spherical", 0.0, 100.0, 1.0
_FLAT_DAYS = """flat AS (SELECT date, count(*) AS n, avg(value) AS mv, avg(z) AS mz, var_pop(z) AS vz, covar_pop(value, z) / var_pop(z) AS b FROM present GROUP BY date HAVING count(*) >= 4)"""
#: Values become floats first, so that ties are met alike; adding 0 makes -0 a plain 0.
_SNAP = "round(CAST(CAST({} AS FLOAT) AS DOUBLE), 3) + 0"


def _snapped(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("float").cast("double"), 3) + 0 for c in names})


def _flat_cells(spark: SparkSession) -> DataFrame:
    """The cells, one metre aside, so that none lies on a station."""
    return cells(spark).withColumn("x", F.col("x") + 1)


def _flat_systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs, places = observations(spark, sf_dir), stations(spark, sf_dir)
    used = F.when(F.dayofmonth("date") % 2 == 1, "ked").otherwise("ok").alias("used")
    days = drift.daily_drift(obs, places).select("date", used, *[F.lit(v).alias(c) for c, v in zip(("model", "nugget", "sill", "range"), _FLAT, strict=True)])
    return kriging.day_systems(obs, places, days)


@query(f"""WITH {_OBS}, {_STATIONS}, {_PRESENT}, {_FLAT_DAYS}, {{cells}}
SELECT date, "row", col, {_SNAP.format("CASE WHEN day(date) % 2 = 1 THEN mv + b * (z - mz) ELSE mv END")} AS value FROM flat, cells""")
def kriging_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both methods by turns over every day and cell, without structure."""
    return _snapped(kriging.predict(_flat_systems(spark, sf_dir), _flat_cells(spark)).select("date", "row", "col", "value"), "value")


@query(f"""WITH {_OBS}, {_STATIONS}, {_PRESENT}, {_FLAT_DAYS}, {_DRIFT}, {_METHOD}, {{cells}}
SELECT date, "row", col, {_SNAP.format("CASE WHEN z IS NOT NULL THEN greatest(CASE preferred WHEN 'ked' THEN mv + b * (z - mz) ELSE mv END, 0) END")} AS rainfall,
  {_SNAP.format("CASE WHEN z IS NOT NULL THEN 100 * (1 + 1.0::DOUBLE / n + CASE preferred WHEN 'ked' THEN (z - mz) * (z - mz) / (n * vz) ELSE 0 END) END")} AS variance
FROM flat JOIN (SELECT date, preferred FROM method WHERE preferred IS NOT NULL) USING (date), cells""")
def krige_flat_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch plan without structure: choice of method, table, solve, variance, mask and clip."""
    fit = [F.lit(v).alias(f"{m}_{c}") for m in ("ked", "ok") for c, v in zip(("model", "nugget", "sill", "range"), _FLAT, strict=True)]
    table = calendar.reference_calendar(spark).select("doy", *fit)
    return _snapped(kriging.krige(observations(spark, sf_dir), stations(spark, sf_dir), _flat_cells(spark), table)[0], "rainfall", "variance")


@query(f"""WITH {_OBS}, {_STATIONS}, {_PRESENT}, {_FLAT_DAYS},
left_out AS (SELECT date, station, value AS observed, value - (value - CASE WHEN ked THEN mv + b * (z - mz) ELSE mv END) / (1 - 1.0::DOUBLE / n - CASE WHEN ked THEN (z - mz) * (z - mz) / (n * vz) ELSE 0 END) AS predicted
  FROM (SELECT *, day(date) % 2 = 1 AS ked FROM present JOIN flat USING (date)))
SELECT date, station, {_SNAP.format("observed")} AS observed, {_SNAP.format("predicted")} AS predicted,
  {_SNAP.format("min(least(observed, predicted)) OVER (PARTITION BY date)")} AS low, {_SNAP.format("max(greatest(observed, predicted)) OVER (PARTITION BY date)")} AS high FROM left_out""")
def loo_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every station of every day estimated from the others, without structure, with the limits of its plot."""
    found = plots.cv_scatter(kriging.leave_one_out(_flat_systems(spark, sf_dir)), ["date"])
    return _snapped(found, "observed", "predicted", "low", "high")


_LEFT_OUT = f"""WITH RECURSIVE {_OBS}, {_STATIONS}, {_PRESENT}, {_DRIFT}, {_METHOD}, {_USED}, {_solved("used = 'ked'")},
cv AS (SELECT date, station, value AS observed, value - c / inv[i] AS predicted FROM point JOIN solved USING (date) WHERE var = i)"""


@query(f"{_LEFT_OUT} SELECT date, station, observed, round(predicted, 3) + 0 AS predicted FROM cv", _zero("predicted"))
def loo_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kriging.leave_one_out(_systems(spark, sf_dir))


@query(f"{_LEFT_OUT} SELECT date, round(sqrt(avg((predicted - observed) * (predicted - observed))), 3) + 0 AS rmse, round(avg(abs(predicted - observed)), 3) + 0 AS mae, round(avg(predicted - observed), 3) + 0 AS bias FROM cv GROUP BY date", _zero("rmse", "mae", "bias"))
def loo_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kriging.scores(kriging.leave_one_out(_systems(spark, sf_dir)), ["date"])


@query(_kriged("used = 'ked'", select=f"""SELECT date, "row", col, {_SNAP.format("CASE WHEN z IS NOT NULL THEN greatest(list_inner_product(coef, b), 0) END")} AS rainfall,
  {_SNAP.format("CASE WHEN z IS NOT NULL THEN list_inner_product(b, [list_inner_product(r, b) FOR r IN inv]) END")} AS variance FROM side"""), lambda df: _snapped(df, "rainfall", "variance"))
def krige_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days through method, table, solve, mask and clip: the batch plan's grid."""
    obs = observations(spark, sf_dir)
    return kriging.krige(obs, stations(spark, sf_dir), cells(spark), _made_table(spark))[0]


@query("""SELECT date, count(*) AS n, round(sqrt(avg((p - o) * (p - o))) + 1e-7, 4) AS rmse, round(avg(abs(p - o)) + 1e-7, 4) AS mae, round(avg(p - o) + 1e-7, 4) AS bias
FROM (SELECT CAST(l_shipdate AS DATE) AS date, l_quantity AS o, l_extendedprice / 1000 AS p FROM lineitem) GROUP BY date""")
def cv_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("date"), F.col("l_quantity").alias("observed"), (F.col("l_extendedprice") / 1000).alias("predicted"))
    found = kriging.scores(made, ["date"]).join(made.groupBy("date").agg(F.count(F.lit(1)).alias("n")), "date")
    return found.withColumns({c: F.round(F.col(c) + TIE, 4) for c in ("rmse", "mae", "bias")})


@query("""SELECT model, CAST(h AS DOUBLE) AS h, round(CASE WHEN h <= 0 THEN 0 ELSE 2 + 8 * CASE model WHEN 'spherical' THEN CASE WHEN h >= 50 THEN 1 ELSE 1.5 * (h / 50) - 0.5 * (h / 50) ** 3 END
  WHEN 'exponential' THEN 1 - exp(-3 * (h / 50)) ELSE 1 - exp(-3 * (h / 50) ** 2) END END, 6) AS gamma FROM range(80) t(h), (VALUES ('spherical'), ('exponential'), ('gaussian')) m(model)""")
def gamma_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.range(80).select(F.col("id").cast("double").alias("h"), F.explode(F.array(*[F.lit(m) for m in geometry.MODELS])).alias("model"))
    return rows.select("model", "h", F.round(geometry.gamma(F.col("model"), F.col("h"), F.lit(2.0), F.lit(10.0), F.lit(50.0)), 6).alias("gamma"))


# -- rasters --------------------------------------------------------------------------------------------------------

_CELLS = f"""cells AS (SELECT CAST(r // {GRID_SIZE} AS INTEGER) AS "row", CAST(r % {GRID_SIZE} AS INTEGER) AS col, (r % {GRID_SIZE} + 0.5::DOUBLE) * {CELL}::DOUBLE AS x, ({GRID_SIZE} - r // {GRID_SIZE} - 0.5::DOUBLE) * {CELL}::DOUBLE AS y,
  CASE WHEN (r // {GRID_SIZE} * 31 + r % {GRID_SIZE} * 17) % 13 <> 0 THEN CAST((r // {GRID_SIZE} * 31 + r % {GRID_SIZE} * 17) * 7 % 900 + 60 AS DOUBLE) END AS z FROM range({GRID_SIZE * GRID_SIZE}) t(r))"""
_FIELD = """field AS (SELECT date, "row", col, CASE WHEN ("row" + col + d) % 9 <> 0 THEN CAST((("row" * 37 + col * 11 + d * 7) % 101) / 8 - 1 AS FLOAT) END AS rainfall
  FROM cells, (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date, date_diff('day', DATE '1980-01-01', CAST(l_shipdate AS DATE)) AS d FROM lineitem))"""
_CORNERS = ", ".join(f"('{name}', {r}, {i}, {x}::DOUBLE, {y}::DOUBLE)" for name, rings in RINGS.items() for r, ring in enumerate(rings) for i, (x, y) in enumerate(ring))
_MASK = f"""corners(basin, ring, i, px, py) AS (VALUES {_CORNERS}),
edges AS (SELECT basin, px AS ax, py AS ay, coalesce(lead(px) OVER o, first_value(px) OVER o) AS bx, coalesce(lead(py) OVER o, first_value(py) OVER o) AS by_ FROM corners WINDOW o AS (PARTITION BY basin, ring ORDER BY i)),
mask AS (SELECT basin, "row", col FROM cells, edges WHERE (ay > y) <> (by_ > y) AND x < ax + (y - ay) * ((bx - ax) / (by_ - ay)) GROUP BY ALL HAVING count(*) % 2 = 1)"""
_ZONAL = "zonal AS (SELECT d.date, b.basin, avg(CAST(rainfall AS DOUBLE)) AS mean, count(rainfall) AS n_valid FROM (SELECT DISTINCT date FROM field) d CROSS JOIN (SELECT DISTINCT basin FROM corners) b LEFT JOIN mask m ON m.basin = b.basin LEFT JOIN field f ON f.date = d.date AND f.\"row\" = m.\"row\" AND f.col = m.col GROUP BY ALL)"
_TIDY = "tidy AS (SELECT date, basin, CASE WHEN mean <= 0.1 THEN 0 ELSE round_even(mean * 100, 0) / 100 END AS mean FROM zonal)"
_ALL_ZONAL = f"{_CELLS}, {_FIELD}, {_MASK}, {_ZONAL}"


def _zonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = raster.polygon_mask(cells(spark), polygons(spark))
    return raster.zonal_mean(field(spark, sf_dir), mask, polygons(spark))


for _name in ("krige_days_summary", "kriging_flat", "krige_flat_days", "kriging_ok_cells", "kriging_ked_cells", "kriging_variance", "krige_days"):
    ORACLE[_name] = ORACLE[_name].format(cells=_CELLS)


@query(f"WITH {_CELLS} SELECT * FROM cells")
def grid_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(spark)


@query(f"WITH {_CELLS} SELECT CAST(\"row\" // 3 AS INTEGER) AS \"row\", CAST(col // 3 AS INTEGER) AS col, round(avg(x), 4) AS x, round(avg(y), 4) AS y, round(avg(z), 6) AS z FROM cells WHERE \"row\" < 18 AND col < 18 GROUP BY \"row\" // 3, col // 3")
def dem_coarsen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_rounded(raster.coarsen(cells(spark), raster.coarsening_factor(CELL, 3 * CELL), GRID_SIZE, GRID_SIZE), 4, "x", "y"), 6, "z")


@query(f"WITH {_CELLS}, {_MASK} SELECT * FROM mask")
def polygon_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.polygon_mask(cells(spark), polygons(spark))


@query(f"WITH {_ALL_ZONAL} SELECT date, basin, round(mean, 6) AS mean, n_valid FROM zonal")
def zonal_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_zonal(spark, sf_dir), 6, "mean")


@query(f"WITH {_ALL_ZONAL} SELECT printf('{raster.NO_DATA}', CAST(date AS VARCHAR), basin) AS warning FROM zonal WHERE n_valid = 0")
def zonal_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.warnings(_zonal(spark, sf_dir))


@query(f"WITH {_ALL_ZONAL}, {_TIDY} SELECT * FROM tidy")
def zonal_flush_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.tidy(_zonal(spark, sf_dir)).select("date", "basin", "mean")


@query(f"WITH {_ALL_ZONAL}, {_TIDY} SELECT basin, CAST(year(date) AS INTEGER) AS year, CAST(ceil(round(coalesce(sum(mean), 0), 6)) AS DOUBLE) AS total FROM tidy GROUP BY ALL")
def annual_ceil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.annual_sums(raster.tidy(_zonal(spark, sf_dir)))


@query(f"WITH {_ALL_ZONAL}, {_TIDY} SELECT basin, CAST(m AS INTEGER) AS month, round(avg(s), 6) AS mean FROM (SELECT basin, year(date) AS y, month(date) AS m, coalesce(sum(mean), 0) AS s FROM tidy GROUP BY ALL) GROUP BY ALL")
def monthly_climatology(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(raster.monthly_climatology(raster.tidy(_zonal(spark, sf_dir))), 6, "mean")


@query(f"WITH {_ALL_ZONAL}, {_TIDY} SELECT date, any_value(mean) FILTER (WHERE basin = 'hollow') AS hollow, any_value(mean) FILTER (WHERE basin = 'east') AS east, any_value(mean) FILTER (WHERE basin = 'speck') AS speck FROM tidy GROUP BY date")
def wide_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.to_wide(raster.tidy(_zonal(spark, sf_dir)), "basin", "mean", list(RINGS))


@query(f"WITH {_ALL_ZONAL}, {_TIDY} SELECT date, basin, mean AS value, 'rainfall' AS variable, 'Rainfall' AS item_type, 'millimeter' AS unit, 'StepAccumulated' AS value_type FROM tidy")
def typed_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = series.to_wide(raster.tidy(_zonal(spark, sf_dir)), "basin", "mean", list(RINGS))
    return series.typed(series.to_long(wide, "date", "basin"), "rainfall")


@query(f"SELECT * FROM (VALUES {', '.join(map(str, series.UNITS))}) t(variable, item_type, unit, value_type)")
def eum_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.units(spark)


# -- sets, filters and resuming -------------------------------------------------------------------------------------


@query(f"WITH {_OBS} SELECT DISTINCT station FROM obs WHERE CAST(station AS INTEGER) % 5 = 0")
def missing_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.missing_stations(observations(spark, sf_dir), stations(spark, sf_dir).where("cast(station as int) % 5 <> 0"))


@query("SELECT CAST(r AS INTEGER) AS doy FROM range(1, 366) t(r) WHERE r > 98")
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = calendar.reference_calendar(spark).select("doy")
    return series.pending(days, days.where("doy <= 98"), ["doy"])


@query(f"WITH {_OBS} SELECT * FROM obs WHERE year(date) BETWEEN 1996 AND 1997")
def year_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.year_range(observations(spark, sf_dir), 1996, 1997)


@query(f"WITH {_OBS} SELECT DISTINCT CAST(year(date) AS INTEGER) AS year FROM obs")
def distinct_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).select(F.year("date").alias("year")).distinct()


@query(f"WITH {_OBS} SELECT * FROM obs WHERE date = DATE '1997-03-03'")
def exact_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.one_date(observations(spark, sf_dir), "1997-03-03")


@query(f"WITH {_OBS} SELECT date, station, value FROM obs WHERE year(date) = 1996 UNION ALL SELECT date, station, NULL FROM obs WHERE year(date) = 1999")
def combine_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    return series.combine(obs.where(F.year("date") == 1996), obs.where(F.year("date") == 1999).drop("value"))


# -- plot data ------------------------------------------------------------------------------------------------------


@query(f"WITH {_OBS}, {_STATIONS}, {_PRESENT}, {_DRIFT} SELECT date, station, z, value, round(a + b * z + 1e-7, 4) AS fitted, CAST(row_number() OVER (PARTITION BY date ORDER BY z, station) AS INTEGER) AS rank FROM present JOIN drift USING (date)")
def plot_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plots.drift_lines(observations(spark, sf_dir), stations(spark, sf_dir)).withColumn("fitted", F.round(F.col("fitted") + TIE, 4))


@query(f"WITH {_OBS}, {_STATIONS}, {_PAIRS}, {_BRIDGE}, {_ENOUGH}, {_POOL_RAW} SELECT doy, round(lag_center, 3) AS lag_center, round(gamma, 3) AS gamma, n, round(20 + 180 * n / max(n) OVER (PARTITION BY doy), 4) AS size FROM pooled")
def plot_variogram_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = variogram.pooled(observations(spark, sf_dir), stations(spark, sf_dir), "ok")
    return _rounded(_rounded(plots.variogram_points(bins, ["doy"]), 3, "lag_center", "gamma"), 4, "size")


@query(f"""WITH {_OBS}, {_STATIONS}, {_PAIRS}, {_BRIDGE}, {_ENOUGH}, {_POOL_RAW}, {_FIT}, {_WINNERS},
best AS (SELECT s.doy, CASE WHEN e.rmse < s.rmse * 0.95::DOUBLE THEN 'exponential' ELSE 'spherical' END AS model FROM (SELECT * FROM fits WHERE model = 'spherical') s JOIN (SELECT * FROM fits WHERE model = 'exponential') e USING (doy)),
steps AS (SELECT doy, model, nugget, sill, w.reach AS r, h.top * 1.05::DOUBLE * k / 299 AS h FROM best JOIN winner w USING (doy, model) JOIN (SELECT doy, max(lag_center) AS top FROM pooled GROUP BY doy) h USING (doy), range(300) t(k))
SELECT doy, round(h, 2) AS h, round(CASE WHEN h <= 0 THEN 0 ELSE nugget + (sill - nugget) * CASE WHEN model = 'exponential' THEN 1 - exp(-3 * (h / r)) WHEN h >= r THEN 1 ELSE 1.5 * (h / r) - 0.5 * (h / r) ** 3 END END, 2) AS gamma FROM steps""", lambda df: _rounded(df, 2, "h", "gamma"))
def plot_variogram_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = variogram.pooled(observations(spark, sf_dir), stations(spark, sf_dir), "ok")
    return plots.variogram_curve(bins, variogram.best_model(variogram.fit_models(bins, ["doy"]), ["doy"]), ["doy"])


@query(f"""WITH {_OBS}, {_ANNUAL}, v AS (SELECT station, CAST(year AS INTEGER) AS year, total AS value FROM annual), {_splits("v", "station")}
SELECT station, v.year, v.value, CASE WHEN v.year < break_year THEN mean_before ELSE mean_after END AS level, break_year - 0.5::DOUBLE AS break_at FROM v JOIN snht USING (station) WHERE v.value IS NOT NULL""")
def plot_snht(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = _value(_annual(spark, sf_dir))
    return _rounded(plots.snht_panel(value, homogeneity.snht(value, ["station"]), ["station"]), 4, "level")


@query(f"WITH {_OBS}, {_ANNUAL}, {_NORM}, {_CORR}, {_RELATIVE} SELECT CAST(year AS INTEGER) AS year, round(ratio, 6) AS ratio, round(ratio - 1, 6) AS height FROM relative WHERE ratio IS NOT NULL")
def plot_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(plots.ratio_bars(homogeneity.relative_series(_annual(spark, sf_dir), CANDIDATE)), 6, "ratio", "height")


@query(f"""{_LEFT_OUT} SELECT date, station, observed, round(predicted, 3) + 0 AS predicted, round(min(least(observed, predicted)) OVER (PARTITION BY date), 3) + 0 AS low,
  round(max(greatest(observed, predicted)) OVER (PARTITION BY date), 3) + 0 AS high FROM cv""", _zero("predicted", "low", "high"))
def plot_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plots.cv_scatter(kriging.leave_one_out(_systems(spark, sf_dir)), ["date"])
