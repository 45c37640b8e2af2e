import pytest
from golden import ANNUAL, RELATIVE, SNHT
from pyspark.sql import functions as F

from rainloom.operators import homogeneity as h


@pytest.fixture(scope="module")
def annual(spark):
    rows = [(s, y, v) for y, *values in ANNUAL for s, v in zip(("1030", "1038", "1029"), values, strict=True)]
    return spark.createDataFrame(rows, "station string, year int, total double")


def test_snht_matches_known_results(annual):
    tests = h.with_p_values(h.snht(annual.withColumnRenamed("total", "value"), ["station"]))
    found = {r.station: r for r in tests.collect()}
    assert set(found) == set(SNHT)
    for station, (t, last, first, before, after, p) in SNHT.items():
        r = found[station]
        assert r.n_years == 38 and (r.last_year_before_break, r.break_year) == (last, first)
        assert r.t_stat == pytest.approx(t, rel=1e-9) and r.mean_before == pytest.approx(before, rel=1e-9) and r.mean_after == pytest.approx(after, rel=1e-9)
        assert r.p_value == pytest.approx(p, abs=0.015) and not r.inhomogeneous


def test_relative_series_correlations_and_verdict(annual):
    r = {x.station: round(x.r, 2) for x in h.neighbour_correlations(annual, "1030").collect()}
    assert r == {"1038": 0.63, "1029": 0.53}
    series = {x.year: x for x in h.relative_series(annual, "1030").collect()}
    for year, norm, reference, ratio in RELATIVE:
        x = series[year]
        assert (x.candidate_norm, x.reference, x.ratio) == (pytest.approx(norm, abs=5.1e-4), pytest.approx(reference, abs=5.1e-4), pytest.approx(ratio, abs=5.1e-4))
    test = h.relative_test(annual, "1030")
    row = test.first()
    assert row.relative_break_year == 2013 and row.relative_inhomogeneous and row.relative_p_value < 0.01
    assert row.verdict.startswith("Relative break found in a different year")
    text = h.report(test, h.neighbour_correlations(annual, "1030")).first().report
    assert "Correlations: 1029=0.53, 1038=0.63" in text and "Absolute SNHT: break 1994" in text


def test_completeness_and_missing_years(spark):
    obs = spark.createDataFrame([("2001-01-01", "a", 1.0), ("2001-01-02", "a", 2.0), ("2001-01-01", "b", None), ("2002-01-01", "a", 5.0)], "date string, station string, value double").withColumn("date", F.col("date").cast("date"))
    found = {(r.station, r.year): (r.total, r.n_days) for r in h.annual_totals(obs, 2).collect()}
    assert found == {("a", 2001): (3.0, 2), ("a", 2002): (None, 1), ("b", 2001): (None, 0)}


def test_short_constant_and_lonely_series(spark):
    rows = [("flat", y, 3.0) for y in range(2000, 2008)] + [("short", y, float(y)) for y in range(2000, 2004)]
    found = h.snht(spark.createDataFrame(rows, "station string, year int, value double"), ["station"]).collect()
    assert [(r.station, r.t_stat, r.break_year) for r in found] == [("flat", None, None)]
    lonely = spark.createDataFrame([("a", y, float(y % 3)) for y in range(2000, 2008)], "station string, year int, total double")
    test = h.relative_test(lonely, "a")
    row = test.first()
    assert row.relative_break_year is None and row.verdict.startswith("No relative test") and row.absolute_t_stat is not None
    lines = h.report(test, h.neighbour_correlations(lonely, "a")).first().report.splitlines()
    assert len(lines) == 4 and lines[1] == "" and lines[2].startswith("Absolute SNHT: break 200") and lines[3] == f"Verdict: {row.verdict}"


def test_constant_column_has_no_correlation(spark):
    rows = [("a", y, 1.0) for y in range(5)] + [("b", y, float(y)) for y in range(5)]
    annual = spark.createDataFrame(rows, "station string, year int, total double")
    assert h.neighbour_correlations(annual, "b").first().r is None
