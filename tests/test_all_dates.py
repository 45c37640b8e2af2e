"""Registered queries over small tables whose dates lie far apart: no date may be left out."""

import datetime as dt

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from rainloom.operators import variogram
from rainloom.plans import proxy

from .test_geostatistics import fit_plain, gamma, primal

#: Days of the year 2 (both fits), 6 (drift lacks a fit), 10 (values lack one), 15 (none), 100 (not in the table), 60 after a leap day.
DATES = [dt.date(1995, 1, 2), dt.date(1996, 1, 6), dt.date(1998, 1, 10), dt.date(1999, 1, 15), dt.date(2001, 4, 10), dt.date(1996, 3, 2), dt.date(1997, 3, 3), dt.date(2001, 11, 4), dt.date(2000, 7, 1)]
FEW = DATES[-1]


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """A folder of tables, and each day's values by station."""
    folder = tmp_path_factory.mktemp("tables")
    rng = np.random.default_rng(11)
    values = {d: {int(k): float(rng.integers(1, 60)) for k in sorted(rng.choice(25, 3 if d == FEW else 12, replace=False))} for d in DATES}
    # every second day rises with the elevation, so that both methods are chosen
    for d in DATES[::2]:
        values[d] = {k: float(round(place(k)[2] / 40 + v / 20)) for k, v in values[d].items()}
    rows = [(k, d, v) for d, own in values.items() for k, v in own.items()]
    pq.write_table(pa.table({"l_suppkey": pa.array([r[0] for r in rows], pa.int64()), "l_shipdate": pa.array([r[1] for r in rows], pa.date32()), "l_quantity": [r[2] for r in rows]}), folder / "lineitem.parquet")
    pq.write_table(pa.table({"s_suppkey": pa.array(range(25), pa.int64()), "s_nationkey": pa.array(range(25), pa.int64())}), folder / "supplier.parquet")
    pq.write_table(pa.table({"n_nationkey": pa.array(range(25), pa.int64())}), folder / "nation.parquet")
    return str(folder), values


def place(k):
    return k * 7919 % 1000 * 100.0, k * 104729 % 1000 * 140.0, k * 15485863 % 2300 + 50.0


def day_of_year(d):
    k = d.timetuple().tm_yday
    return k - 1 if d.year % 4 == 0 and k >= 60 else k


def chosen(d, own):
    """The fit's kind by the rules of method and table, or None."""
    z, v = np.array([place(k)[2] for k in own]), np.array(list(own.values()))
    k = day_of_year(d)
    if len(own) < 4 or k == 100:
        return None
    drifts = len(own) >= 8 and abs(np.corrcoef(z, v)[0, 1]) >= 0.3
    gaps = {"ked": 3, "ok": 5}
    return next((m for m in (("ked", "ok") if drifts else ("ok", "ked")) if k % gaps[m]), None)


def solved(values, force=None):
    """date -> (used, model's fit, stations, x, y, z, v) for each day that has a system."""
    out = {}
    for d, own in values.items():
        if used := chosen(d, own):
            k = day_of_year(d)
            x, y, z = np.array([place(s) for s in own]).T
            fit = ("exponential" if used == "ked" else "spherical", k * 0.5, k * 2 + 100.0, k * 10 + 50000.0)
            out[d] = (force or used, fit, list(own), x, y, z, np.array(list(own.values())))
    return out


def grid():
    row, col = np.divmod(np.arange(400), 20)
    height = row * 31 + col * 17
    return (col + 0.5) * 5000.0, (20 - row - 0.5) * 5000.0, np.where(height % 13 != 0, height * 7 % 900 + 60.0, np.nan)


def fields(values, force=None):
    cx, cy, cz = grid()
    return {d: primal(x, y, z if used == "ked" else None, v, cx, cy, cz, fit) for d, (used, fit, _, x, y, z, v) in solved(values, force).items()}


def by_cell(df, *columns):
    """date -> an array (column, cell), NaN for null."""
    out = {}
    for r in df.collect():
        day = out.setdefault(r.date, np.full((len(columns), 400), np.inf))
        day[:, r.row * 20 + r.col] = [np.nan if r[c] is None else r[c] for c in columns]
    return out


def test_days_of_the_fixture(tables):
    used = {d: chosen(d, own) for d, own in tables[1].items()}
    assert set(used.values()) == {None, "ok", "ked"} and sum(m is not None for m in used.values()) == 6


@pytest.mark.parametrize("method", ["ok", "ked"])
def test_kriged_fields(spark, tables, method):
    found, want = by_cell(proxy.QUERIES[f"kriging_{method}"](spark, tables[0]), "value"), fields(tables[1], method)
    assert set(found) == set(want)
    for d, (value, _) in want.items():
        np.testing.assert_allclose(found[d][0], value, atol=1e-6)


def test_variances_and_the_batch_grid(spark, tables):
    want = fields(tables[1])
    found, batch = by_cell(proxy.kriging_variance(spark, tables[0]), "value", "variance"), by_cell(proxy.krige_days(spark, tables[0]), "rainfall", "variance")
    assert set(found) == set(batch) == set(want)
    void = np.isnan(grid()[2])
    for d, (value, variance) in want.items():
        np.testing.assert_allclose(found[d], [value, variance], atol=1e-6)
        np.testing.assert_allclose(batch[d], np.where(void, np.nan, [np.maximum(value, 0), variance]), rtol=1e-5, atol=1e-4)


def test_leave_one_out(spark, tables):
    want = {}
    for d, (used, fit, names, x, y, z, v) in solved(tables[1]).items():
        for i, k in enumerate(names):
            rest = np.arange(len(names)) != i
            p, _ = primal(x[rest], y[rest], z[rest] if used == "ked" else None, v[rest], x[[i]], y[[i]], z[[i]], fit)
            want[d, str(k)] = (v[i], pytest.approx(p[0], abs=1e-6))
    days = {d for d, _ in want}
    assert {(r.date, r.station): (r.observed, r.predicted) for r in proxy.loo_cv(spark, tables[0]).collect()} == want
    assert {(r.date, r.station): (r.observed, r.predicted) for r in proxy.plot_cv(spark, tables[0]).collect()} == want
    scores = {r.date: (r.rmse, r.mae, r.bias) for r in proxy.loo_scores(spark, tables[0]).collect()}
    assert set(scores) == days
    for d in days:
        e = np.array([p.expected - o for (day, _), (o, p) in want.items() if day == d])
        assert scores[d] == (pytest.approx(np.sqrt((e * e).mean())), pytest.approx(abs(e).mean()), pytest.approx(e.mean(), abs=1e-6))


def test_fits_of_all_days_of_the_year(spark, tables):
    bins = {}
    for r in variogram.pooled(proxy.observations(spark, tables[0]), proxy.stations(spark, tables[0]), "ok").collect():
        bins.setdefault(r.doy, []).append((r.lag_center, r.gamma, float(r.n)))
    bins = {k: np.array(b).T for k, b in bins.items() if len(b) >= 3}
    near = lambda k, d: min(abs(k - d), 366 - abs(k - d)) <= 7
    assert set(bins) == {k for k in range(1, 366) if any(near(k, day_of_year(d)) for d in DATES if d != FEW)}
    plain = {k: {m: fit_plain(*b, m) for m in ("spherical", "exponential")} for k, b in bins.items()}
    fits = {(r.doy, r.model): r.rmse for r in proxy.QUERIES["variogram_fit"](spark, tables[0]).collect()}
    assert fits == {(k, m): pytest.approx(own[m][1], abs=1e-3) for k, own in plain.items() for m in own}
    best = {k: "exponential" if own["exponential"][1] < own["spherical"][1] * 0.95 else "spherical" for k, own in plain.items()}
    assert {r.doy: (r.model, r.rmse) for r in proxy.QUERIES["variogram_best"](spark, tables[0]).collect()} == {k: (m, pytest.approx(plain[k][m][1], abs=1e-3)) for k, m in best.items()}
    curves = {}
    for r in proxy.plot_variogram_curve(spark, tables[0]).collect():
        curves.setdefault(r.doy, []).append((r.h, r.gamma))
    assert set(curves) == set(best)
    for k, points in curves.items():
        h, g = np.array(sorted(points)).T
        np.testing.assert_allclose(h, np.linspace(0, bins[k][0].max() * 1.05, 300))
        np.testing.assert_allclose(g, gamma(best[k], h, *plain[k][best[k]][0]), rtol=1e-5, atol=1e-5)


def inside(x, y, rings):
    odd = np.zeros(len(x), bool)
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            if ay != by:
                odd ^= ((ay > y) != (by > y)) & (x < ax + (y - ay) * (bx - ax) / (by - ay))
    return odd


def test_zonal_series_of_all_dates(spark, tables):
    cx, cy, _ = grid()
    row, col = np.divmod(np.arange(400), 20)
    run = lambda name: proxy.QUERIES[name](spark, tables[0]).collect()
    mean, valid, tidy = {}, {}, {}
    for d in DATES:
        k = (d - dt.date(1980, 1, 1)).days
        v = np.where((row + col + k) % 9 != 0, ((row * 37 + col * 11 + k * 7) % 101) / 8 - 1, np.nan)
        for basin, rings in proxy.RINGS.items():
            own = v[inside(cx, cy, rings)]
            own = own[~np.isnan(own)]
            valid[d, basin], mean[d, basin] = len(own), own.mean() if len(own) else None
            tidy[d, basin] = None if not len(own) else 0.0 if own.mean() <= 0.1 else round(own.mean(), 2)
    assert {(r.date, r.basin): (r["mean"], r.n_valid) for r in run("zonal_mean")} == {k: (None if v is None else pytest.approx(v, abs=1e-6), valid[k]) for k, v in mean.items()}
    assert {(r.date, r.basin): r["mean"] for r in run("zonal_flush_round")} == {k: None if v is None else pytest.approx(v, abs=1e-9) for k, v in tidy.items()}
    assert sorted(r.warning for r in run("zonal_warnings")) == sorted(f"No valid data | Date: {d} | Basin: {b}" for (d, b), n in valid.items() if not n)
    tidy = {k: None if v is None else pytest.approx(v, abs=1e-9) for k, v in tidy.items()}
    assert {(r.date, b): r[b] for r in run("wide_pivot") for b in proxy.RINGS} == tidy
    assert {(r.date, r.basin): r.value for r in run("typed_series")} == tidy
    total = lambda basin, keep: sum(v.expected for (d, b), v in tidy.items() if b == basin and v is not None and keep(d))
    years = {d.year for d in DATES}
    assert {(r.basin, r.year): r.total for r in run("annual_ceil")} == {(b, y): float(np.ceil(round(total(b, lambda d: d.year == y), 6))) for b in proxy.RINGS for y in years}
    months = {m: {d.year for d in DATES if d.month == m} for m in {d.month for d in DATES}}
    want = {(b, m): np.mean([total(b, lambda d: (d.year, d.month) == (y, m)) for y in own]) for b in proxy.RINGS for m, own in months.items()}
    assert {(r.basin, r.month): r["mean"] for r in run("monthly_climatology")} == {k: pytest.approx(v, abs=1e-6) for k, v in want.items()}
