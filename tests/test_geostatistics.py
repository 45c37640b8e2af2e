import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainloom.functions import calendar, geometry
from rainloom.operators import drift, kriging, variogram
from rainloom.schema import Variogram


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    xy = rng.uniform(0, 1e5, (14, 2))
    z = rng.uniform(50, 2300, 14)
    days = [dt.date(2004, 2, 25) + dt.timedelta(days=k) for k in range(9)]
    values = rng.gamma(2, 8, (9, 14)) + z / 100
    values[rng.random((9, 14)) < 0.15] = np.nan
    values[3] = 0.0
    values[4, 3:] = np.nan
    return xy, z, days, values


@pytest.fixture(scope="module")
def frames(spark, data):
    xy, z, days, values = data
    stations = spark.createDataFrame([(str(k), 0.0, 0.0, float(z[k]), *map(float, xy[k])) for k in range(14)], "station string, lon double, lat double, z double, x double, y double")
    rows = [(d, str(k), None if np.isnan(v) else float(v)) for d, row in zip(days, values, strict=True) for k, v in enumerate(row)]
    return spark.createDataFrame(rows, "date date, station string, value double"), stations


def gamma(model, h, nugget, sill, reach):
    s = h / reach
    rise = {"spherical": np.where(s < 1, 1.5 * s - s**3 / 2, 1), "exponential": 1 - np.exp(-3 * s)}[model]
    return np.where(h > 0, nugget + (sill - nugget) * rise, 0)


def primal(x, y, z, v, xp, yp, zp, fit):
    """Weights by a solve for each point: estimates and variances."""
    n = len(x)
    k = n + (1 if z is None else 2)
    a, b = np.zeros((k, k)), np.ones((k, len(xp)))
    a[:n, :n] = gamma(fit[0], np.hypot(x[:, None] - x, y[:, None] - y), *fit[1:])
    a[n, :n] = a[:n, n] = 1
    b[:n] = gamma(fit[0], np.hypot(x[:, None] - xp, y[:, None] - yp), *fit[1:])
    if z is not None:
        a[n + 1, :n] = a[:n, n + 1] = z
        b[n + 1] = zp
    w = np.linalg.solve(a, b)
    return w[:n].T @ v, (w * b).sum(axis=0)


def test_calendar_and_window(spark):
    dates = [dt.date(2004, 2, 28), dt.date(2004, 2, 29), dt.date(2004, 3, 1), dt.date(2003, 3, 1), dt.date(2004, 12, 31), dt.date(2003, 1, 1)]
    df = spark.createDataFrame([(d,) for d in dates], "d date").select(calendar.calendar_doy(F.col("d")).alias("k"))
    assert [r.k for r in df.collect()] == [59, 59, 60, 60, 365, 1]
    bridge = calendar.window_bridge(spark)
    assert bridge.count() == 5461
    sizes = {r.doy: r["count"] for r in bridge.groupBy("doy").count().collect()}
    assert {d for d, n in sizes.items() if n == 14} == {*range(1, 8), *range(359, 366)}
    # days that a record of 2005 to 2012 pools: 112, 120 and, around the leap days, 122
    record = spark.sql("SELECT explode(sequence(DATE '2005-01-01', DATE '2012-12-31')) AS date").groupBy(calendar.calendar_doy(F.col("date")).alias("source_doy")).count()
    pooled = {r.doy: r.n for r in record.join(bridge, "source_doy").groupBy("doy").agg(F.sum("count").alias("n")).collect()}
    assert [pooled[d] for d in (1, 7, 8, 51, 52, 66, 67, 98)] == [112, 112, 120, 120, 122, 122, 120, 120]


def test_projection_of_known_stations(spark):
    # fixed values: longitude and latitude of the two stations farthest apart, and their distance in metres
    rows = spark.createDataFrame([(85.16463889, 27.914975), (85.807275, 26.65224722)], "lon double, lat double")
    x, y = geometry.utm(F.col("lat"), F.col("lon"))
    (x1, y1), (x2, y2) = [tuple(r) for r in rows.select(x, y).collect()]
    assert np.hypot(x1 - x2, y1 - y2) == pytest.approx(153687, abs=30)


def test_drift_against_numpy(frames, data):
    _, z, days, values = data
    found = {r.date: r for r in drift.daily_drift(*frames).collect()}
    for day, row in zip(days, values, strict=True):
        ok = ~np.isnan(row)
        if ok.sum() < 4:
            assert day not in found
            continue
        b, a = np.polyfit(z[ok], row[ok], 1)
        r = abs(np.corrcoef(row[ok], z[ok])[0, 1]) if row[ok].std() else 0.0
        f = found[day]
        assert (f.n, f.a, f.b, f.r) == (ok.sum(), pytest.approx(a, abs=1e-8), pytest.approx(b, abs=1e-10), pytest.approx(r, abs=1e-9))
    methods = {r.date: r for r in drift.day_method(*frames).collect()}
    assert methods[days[4]].preferred is None and methods[days[4]].n_reporting < 4
    assert methods[days[3]].preferred == "ok" and methods[days[3]].r == 0


def test_equal_elevations_give_the_least_norm(spark, frames):
    obs, stations = frames
    flat = stations.withColumn("z", F.lit(3.0))
    day = obs.where("date = '2004-02-25'")
    f = drift.daily_drift(day, flat).first()
    mean = day.agg(F.avg("value")).first()[0]
    assert (f.a, f.b, f.r) == (pytest.approx(mean / 10), pytest.approx(3 * mean / 10), 0.0)


@pytest.mark.parametrize("estimator", ["matheron", "cressie"])
def test_pooled_variogram_against_numpy(frames, data, estimator):
    xy, _, days, values = data
    d = np.hypot(*(xy[:, None] - xy[None]).transpose(2, 0, 1))
    max_lag = d.max() * 2 / 3
    edges = np.linspace(0, max_lag, 13)
    n, sd, ss = np.zeros(12), np.zeros(12), np.zeros(12)
    for row in values:
        ok = np.flatnonzero(~np.isnan(row))
        if len(ok) < 4:
            continue
        i, j = np.triu_indices(len(ok), 1)
        i, j = ok[i], ok[j]
        at = np.digitize(d[i, j], edges) - 1
        keep = at < 12
        dv = row[i] - row[j]
        s = dv**2 if estimator == "matheron" else np.sqrt(abs(dv))
        for array, v in ((n, np.ones_like(s)), (sd, d[i, j]), (ss, s)):
            np.add.at(array, at[keep], v[keep])
    g = ss / 2 / n if estimator == "matheron" else 0.5 * (ss / n) ** 4 / (0.457 + 0.494 / n)
    found = {r.bin: r for r in variogram.pooled(*frames, "ok", Variogram(estimator=estimator)).where("doy = 59").collect()}
    assert set(found) == set(np.flatnonzero(n).tolist())
    for b, r in found.items():
        assert (r.n, r.lag_center, r.gamma) == (n[b], pytest.approx(sd[b] / n[b]), pytest.approx(g[b]))


def fit_plain(h, g, w, model):
    best = None
    for reach in np.linspace(h.max() * 0.1, h.max() * 1.5, 60):
        s = np.where(h < reach, 1.5 * h / reach - 0.5 * (h / reach) ** 3, 1) if model == "spherical" else 1 - np.exp(-3 * h / reach)
        x = np.stack([np.ones_like(s), s], 1)
        try:
            nugget, part = np.linalg.solve(x.T * w @ x, x.T * w @ g)
        except np.linalg.LinAlgError:
            continue
        nugget, part = max(nugget, 0), max(part, 1e-9)
        sse = (w * (g - nugget - part * s) ** 2).sum()
        if best is None or sse < best[0]:
            best = (sse, nugget, nugget + part, reach)
    return best[1:], np.sqrt(best[0] / w.sum())


def test_fits_against_numpy(spark):
    rng = np.random.default_rng(5)
    rows, truth = [], {}
    for key in range(12):
        n = 2 if key == 11 else 10
        h = np.sort(rng.uniform(3e3, 1e5, n))
        g = rng.uniform(0, 3) + 9 * (1 - np.exp(-h / rng.uniform(1e4, 9e4))) + rng.normal(0, 0.6, n)
        w = rng.integers(5, 80, n).astype(float)
        rows += [(key, float(a), float(b), int(c)) for a, b, c in zip(h, g, w, strict=True)]
        if n > 2:
            truth[key] = {m: fit_plain(h, g, w, m) for m in ("spherical", "exponential")}
    fits = variogram.fit_models(spark.createDataFrame(rows, "k int, lag_center double, gamma double, n int"), ["k"])
    found = fits.collect()
    assert {r.k for r in found} == set(truth)
    for r in found:
        (nugget, sill, reach), rmse = truth[r.k][r.model]
        assert r.rmse == pytest.approx(rmse, rel=1e-8) and (r.nugget, r.sill, r.range) == (pytest.approx(nugget, abs=1e-6), pytest.approx(sill, rel=1e-6), pytest.approx(reach))
    for r in variogram.best_model(fits, ["k"]).collect():
        s, e = truth[r.k]["spherical"][1], truth[r.k]["exponential"][1]
        assert r.model == ("exponential" if e < s * 0.95 else "spherical")


def test_kriging_dual_form_variance_and_leave_one_out(spark, frames, data):
    xy, z, days, values = data
    obs, stations = frames
    fit = ("spherical", 2.0, 30.0, 60000.0)
    plan = spark.createDataFrame([(days[0], "ok", *fit), (days[1], "ked", *fit)], "date date, used string, model string, nugget double, sill double, range double")
    grid = spark.createDataFrame([(k, 0, float(1000 + 7000 * k), float(90000 - 5000 * k), None if k == 4 else float(100 * k)) for k in range(8)] + [(99, 0, *map(float, xy[0]), float(z[0]))], "row int, col int, x double, y double, z double")
    systems = kriging.day_systems(obs, stations, plan).cache()
    by_spark = {(r.date, r.row): r.value for r in kriging.predict(systems, grid).collect()}
    by_block = {(r.date, r.row): (r.value, r.variance) for r in kriging.predict_with_variance(systems, grid).collect()}
    cells = grid.collect()
    cx, cy, cz = (np.array([np.nan if c[k] is None else c[k] for c in cells], float) for k in ("x", "y", "z"))
    cv = {(r.date, r.station): r for r in kriging.leave_one_out(systems).collect()}
    for day, row, used in ((days[0], values[0], "ok"), (days[1], values[1], "ked")):
        ok = np.flatnonzero(~np.isnan(row))
        x, y, v, zz = xy[ok, 0], xy[ok, 1], row[ok], z[ok] if used == "ked" else None
        e, var = primal(x, y, zz, v, cx, cy, cz, fit)
        for c, a, s in zip(cells, e, var, strict=True):
            if np.isnan(a):
                assert by_spark[day, c.row] is None and by_block[day, c.row] == (None, None)
                continue
            assert by_spark[day, c.row] == pytest.approx(a, abs=1e-8) and by_block[day, c.row] == (pytest.approx(a, abs=1e-8), pytest.approx(s, abs=1e-7))
            assert c.row == 99 or s > 0
        if 0 in ok:  # exact at a station
            assert by_spark[day, 99] == pytest.approx(row[0], abs=1e-7)
        for i, k in enumerate(ok):
            rest = np.arange(len(ok)) != i
            p, _ = primal(x[rest], y[rest], None if zz is None else zz[rest], v[rest], x[[i]], y[[i]], None if zz is None else zz[[i]], fit)
            assert cv[day, str(k)].predicted == pytest.approx(p[0], abs=1e-7)


def test_singular_and_missing_fits_have_a_status(spark, frames, data):
    obs, stations = frames
    days = data[2]
    twins = stations.withColumns({"x": F.lit(1.0), "y": F.lit(2.0)})
    plan = spark.createDataFrame([(days[0], "ok", "spherical", 0.0, 5.0, 1000.0), (days[1], None, None, None, None, None)], "date date, used string, model string, nugget double, sill double, range double")
    assert {r.date: r.status for r in kriging.day_systems(obs, twins, plan).collect()} == {days[0]: "singular", days[1]: "no variogram"}


def test_whole_plan(spark, frames, data):
    obs, stations = frames
    table = variogram.variogram_table(obs, stations).cache()
    assert table.count() == 365 and table.where("ok_model IS NOT NULL").count() == 22
    assert variogram.cached(table, "2010-02-28", "ok")["n_days"] > 0
    with pytest.raises(ValueError):
        variogram.cached(table, "2010-07-01", "ok")
    grid = spark.createDataFrame([(0, 0, 5e4, 5e4, 100.0), (0, 1, 6e4, 5e4, None)], "row int, col int, x double, y double, z double")
    cells, days = kriging.krige(obs, stations, grid, table)
    flags = {r.date: r.method_flag for r in days.collect()}
    assert flags[data[2][4]] == -1 and set(flags.values()) <= {-1, 0, 1} and len(flags) == 9
    found = cells.collect()
    assert all(r.rainfall is None and r.variance is None for r in found if r.col == 1)
    assert all(r.rainfall >= 0 for r in found if r.col == 0)


def test_missing_values_survive_clip_and_rounding(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.1,), (0.1000001,), (0.125,), (2.675,)], "v double")
    got = [tuple(r) for r in df.select(geometry.clip_zero(F.col("v")), geometry.flush_round(F.col("v"))).collect()]
    assert got == [(None, None), (0.0, 0.0), (0.1, 0.0), (0.1000001, 0.1), (0.125, 0.12), (2.675, 2.68)]
