"""Ordinary kriging and kriging with external drift.

Kriging is solved once for each day in its dual form: with A the system's matrix and v the values, a cell's estimate is
b . c for c = A^-1 [v; 0], and its variance b . A^-1 b, b being the cell's right-hand side. The dense solve of a few dozen
stations is the one step that runs in Python; the cells, which are the many, meet the systems of DAYS days at a time by an
equality join on that run of days, and are summed by Spark or, where the variance is wanted, handled by blocks of 64 x 64 cells
with one matrix product a day."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry
from ..schema import Kriging
from ..sources.shared import kept
from . import drift, variogram

DEFAULT = Kriging()

_SYSTEM = "date date, used string, model string, nugget double, sill double, reach double, station array<string>, x array<double>, y array<double>, z array<double>, value array<double>, coef array<double>, inverse array<double>, status string"


def gamma(model: str, h: np.ndarray, nugget: float, sill: float, reach: float) -> np.ndarray:
    """The semivariance of a model; 0 at distance 0."""
    s = h / reach
    if model == "spherical":
        rise = np.where(s >= 1, 1.0, 1.5 * s - 0.5 * s**3)
    elif model == "exponential":
        rise = -np.expm1(-3 * s)
    elif model == "gaussian":
        rise = -np.expm1(-3 * s * s)
    else:
        raise ValueError(f"unknown variogram model {model!r}")
    return np.where(h <= 0, 0.0, nugget + (sill - nugget) * rise)


def system(x: np.ndarray, y: np.ndarray, z: np.ndarray | None, fit: tuple[str, float, float, float]) -> np.ndarray:
    """The kriging matrix: semivariances, bordered by ones and, with z, by elevations."""
    n, border = len(x), 1 if z is None else 2
    a = np.zeros((n + border, n + border))
    a[:n, :n] = gamma(fit[0], np.hypot(x[:, None] - x, y[:, None] - y), *fit[1:])
    a[:n, n] = a[n, :n] = 1
    if z is not None:
        a[:n, n + 1] = a[n + 1, :n] = z
    return a


def right_side(x: np.ndarray, y: np.ndarray, xp: np.ndarray, yp: np.ndarray, zp: np.ndarray | None, fit: tuple[str, float, float, float]) -> np.ndarray:
    rows = [gamma(fit[0], np.hypot(x[:, None] - xp, y[:, None] - yp), *fit[1:]), np.ones((1, len(xp)))]
    return np.concatenate(rows if zp is None else [*rows, zp[None, :]])


def solve(x: np.ndarray, y: np.ndarray, z: np.ndarray | None, v: np.ndarray, fit: tuple[str, float, float, float]) -> tuple[np.ndarray, np.ndarray] | None:
    """The dual coefficients and the inverse; None for a singular system."""
    a = system(x, y, z, fit)
    try:
        inverse = np.linalg.inv(a)
    except np.linalg.LinAlgError:
        return None
    coef = inverse @ np.concatenate([v, np.zeros(len(a) - len(v))])
    return (coef, inverse) if np.isfinite(coef).all() else None


def day_systems(obs: DataFrame, stations: DataFrame, days: DataFrame) -> DataFrame:
    """One solved system for each day of days (date, used, model, nugget, sill, range); without a fit, or singular, a status says so.

    Stations without elevation are left out of days with drift. A day holds its stations alone, some dozens."""
    rows = drift.present(obs, stations).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    points = rows.groupBy("date").agg(F.array_sort(F.collect_list(F.struct("station", "x", "y", "z", "value"))).alias("p"))
    joined = days.select("date", "used", "model", "nugget", "sill", F.col("range").alias("reach")).join(points, "date", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                p = [q for q in r.pop("p") or [] if r["used"] != "ked" or q["z"] is not None]
                found = None
                if r["model"] is not None and p:
                    x, y, v = (np.array([q[c] for q in p]) for c in ("x", "y", "value"))
                    z = np.array([q["z"] for q in p]) if r["used"] == "ked" else None
                    found = solve(x, y, z, v, (r["model"], r["nugget"], r["sill"], r["reach"]))
                status = "ok" if found else "no variogram" if r["model"] is None else "no stations" if not p else "singular"
                out.append(r | {c: [q[c] for q in p] for c in ("station", "x", "y", "z", "value")} | {"coef": found[0] if found else None, "inverse": found[1].ravel() if found else None, "status": status})
            yield pa.RecordBatch.from_pylist(out, schema)

    doubles = pa.list_(pa.float64())
    schema = pa.schema([("date", pa.date32()), ("used", pa.string()), ("model", pa.string()), *((c, pa.float64()) for c in ("nugget", "sill", "reach")), ("station", pa.list_(pa.string())), *((c, doubles) for c in ("x", "y", "z", "value", "coef", "inverse")), ("status", pa.string())])
    return joined.mapInArrow(run, _SYSTEM)


#: Days whose systems travel together, and the side of a block of cells.
DAYS, SIDE = 32, 64


def _run() -> F.Column:
    return F.floor(F.datediff("date", F.lit(DEFAULT.epoch).cast("date")) / DAYS).alias("__run")


def _by_run(places: DataFrame, runs: DataFrame) -> DataFrame:
    """places, dealt out, once for each run of days. What is broadcast is the runs' numbers, some twelve for each year of the record."""
    n = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return places.repartition(n).join(F.broadcast(runs.select("__run").distinct()))


def predict(systems: DataFrame, grid: DataFrame) -> DataFrame:
    """date, row, col, value, solid: estimates at every cell of the grid, in Spark's own expressions; solid: whether it has an elevation.

    The sum over a day's stations is a fold over its arrays."""
    cells = grid.select("row", "col", F.col("x").alias("cx"), F.col("y").alias("cy"), F.col("z").alias("cz"))
    solved = systems.where("status = 'ok'").select(_run(), "date", "used", "model", "nugget", "sill", "reach", F.arrays_zip("x", "y").alias("p"), "coef")
    every = _by_run(cells, solved).join(solved, "__run")
    n = F.size("p")
    terms = F.zip_with("p", F.slice("coef", F.lit(1), n), lambda p, c: c * geometry.gamma(F.col("model"), geometry.distance(F.col("cx"), F.col("cy"), p["x"], p["y"]), F.col("nugget"), F.col("sill"), F.col("reach")))
    total = F.aggregate(terms, F.lit(0.0), lambda a, b: a + b) + F.element_at("coef", n + 1)
    value = F.when(F.col("used") == "ked", total + F.element_at("coef", n + 2) * F.col("cz")).otherwise(total)
    return every.select("date", "row", "col", value.alias("value"), F.col("cz").isNotNull().alias("solid"))


def predict_with_variance(systems: DataFrame, grid: DataFrame) -> DataFrame:
    """date, row, col, value, variance, solid at every cell; runs of days are held against blocks of cells."""
    block = [F.floor(F.col(c) / SIDE).alias(f"__{c}") for c in ("row", "col")]
    blocks = grid.groupBy(*block).agg(F.collect_list(F.struct("row", "col", "x", "y", "z")).alias("cells"))
    runs = systems.where("status = 'ok'").groupBy(_run()).agg(F.collect_list(F.struct("date", "used", "model", "nugget", "sill", "reach", "x", "y", "coef", "inverse")).alias("days"))
    # pairs of a block and a run are few and small beside what they become, so their number of tasks is set, not left to their size
    n = int(grid.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = _by_run(blocks, runs).join(runs, "__run").repartition(n, "__run", "__row", "__col")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                # children of nested arrays, without an object for each cell
                cells, days = batch.column("cells")[k].values, batch.column("days")[k].values
                cx, cy, cz = (cells.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y", "z"))
                solid = cells.field("z").is_valid()
                for j in range(len(days)):
                    own = lambda c, j=j: days.field(c)[j]
                    vector = lambda c: own(c).values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
                    fit = tuple(own(c).as_py() for c in ("model", "nugget", "sill", "reach"))
                    b = right_side(vector("x"), vector("y"), cx, cy, cz if own("used").as_py() == "ked" else None, fit)
                    coef = vector("coef")
                    value, variance = coef @ b, (b * (vector("inverse").reshape(len(coef), -1) @ b)).sum(axis=0)
                    cols = [pa.repeat(own("date"), len(cx)), cells.field("row"), cells.field("col"), *(pa.array(v, from_pandas=True) for v in (value, variance)), solid]
                    yield pa.RecordBatch.from_arrays(cols, ["date", "row", "col", "value", "variance", "solid"])

    return every.select("cells", "days").mapInArrow(run, "date date, row int, col int, value double, variance double, solid boolean")


def leave_one_out(systems: DataFrame) -> DataFrame:
    """date, station, observed, predicted: each station estimated from the others, by the closed form v - c / diag(A^-1)."""
    n = F.size("station")
    diagonal = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(F.col("inverse"), i * F.size("coef") + i))
    rows = systems.where("status = 'ok'").withColumn("d", diagonal).select("date", F.explode(F.arrays_zip("station", "value", F.slice("coef", F.lit(1), n).alias("c"), "d")).alias("r"))
    return rows.select("date", "r.station", F.col("r.value").alias("observed"), (F.col("r.value") - F.try_divide(F.col("r.c"), F.col("r.d"))).alias("predicted"))


def scores(cv: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rmse, mae, bias of observed and predicted values, missing ones left out."""
    e = geometry.missing(F.col("predicted") - F.col("observed"))
    return cv.groupBy(*keys).agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.avg(e).alias("bias"))


def plan_days(obs: DataFrame, stations: DataFrame, table: DataFrame, p: Kriging = DEFAULT) -> DataFrame:
    """date, n_reporting, r, preferred and the fit that is used."""
    return variogram.look_up(drift.day_method(obs, stations, p), table)


def method_flag(status, used) -> F.Column:
    """-1 no interpolation, 0 ordinary kriging, 1 with external drift."""
    return F.when(F.coalesce(status, F.lit("")) != "ok", -1).when(used == "ked", 1).otherwise(0)


def krige(obs: DataFrame, stations: DataFrame, grid: DataFrame, table: DataFrame, p: Kriging = DEFAULT, with_variance: bool = True) -> tuple[DataFrame, DataFrame]:
    """(grid values, days) for all days of obs.

    Grid values: date, row, col, rainfall (not below 0), variance, as floats, null where the elevation is missing.
    Days: date, method_flag, n_reporting, r, status. The plan and the solved systems, a row for each day, are stored in the
    shared folder, for both results start from them."""
    days = kept(plan_days(obs, stations, table, p), "plan")
    systems = kept(day_systems(obs, stations, days), "systems")
    cells = (predict_with_variance if with_variance else predict)(systems, grid)
    keep = lambda c: F.when(F.col("solid"), c).cast("float")
    values = [keep(geometry.clip_zero(F.col("value"))).alias("rainfall")] + ([keep(F.col("variance")).alias("variance")] if with_variance else [])
    day = days.join(systems.select("date", "status"), "date", "left").select("date", method_flag(F.col("status"), F.col("used")).alias("method_flag"), "n_reporting", F.col("r").cast("float").alias("r"), "status")
    return cells.select("date", "row", "col", *values), day
