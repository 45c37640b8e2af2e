"""Annual totals and the standard normal homogeneity test, absolute and relative."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schema import Homogeneity
from ..sources.shared import application_folder, kept
from ..streaming.store import Store

DEFAULT = Homogeneity()
# fixed values: the sentences of the verdict
NO_RELATIVE_TEST = "No relative test: too few neighbours or years"
REGIONAL = "Homogeneous relative to neighbours -> absolute break is likely regional/climatic"
STATION_PROBLEM = "Break also found relative to neighbours -> likely a station-specific problem"
OTHER_YEAR = "Relative break found in a different year -> inspect station history"


def annual_totals(obs: DataFrame, min_days: int = DEFAULT.min_days) -> DataFrame:
    """station, year, total, n_days: the total is null with fewer than min_days values, or none at all."""
    each = obs.groupBy("station", F.year("date").alias("year")).agg(F.sum("value").alias("total"), F.count("value").alias("n_days"))
    return each.withColumn("total", F.when(F.col("n_days") >= min_days, F.col("total")))


def _splits(series: DataFrame, keys: list[str]) -> DataFrame:
    """Every split of each series (keys, year, value) in two, with its test statistic t."""
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy("year").rowsBetween(Window.unboundedPreceding, 0)
    s = series.where(F.col("value").isNotNull() & ~F.isnan("value"))
    s = s.withColumns({"n": F.count("value").over(whole), "mean": F.avg("value").over(whole), "sd": F.stddev_samp("value").over(whole), "total": F.sum("value").over(whole)})
    s = s.withColumns({"k": F.row_number().over(whole.orderBy("year")), "sum_before": F.sum("value").over(upto), "break_year": F.lead("year").over(whole.orderBy("year"))})
    before, after = F.col("sum_before") / F.col("k"), F.try_divide(F.col("total") - F.col("sum_before"), F.col("n") - F.col("k"))
    z = lambda mean: F.try_divide(mean - F.col("mean"), F.col("sd"))
    t = F.col("k") * z(before) * z(before) + (F.col("n") - F.col("k")) * z(after) * z(after)
    return s.where("k < n").select(*keys, "n", "k", F.col("year").alias("last_year"), "break_year", before.alias("mean_before"), after.alias("mean_after"), t.alias("t"))


def snht(series: DataFrame, keys: list[str], least_years: int = DEFAULT.least_years) -> DataFrame:
    """keys, n_years, t_stat, last_year_before_break, break_year, mean_before, mean_after of each series (keys, year, value).

    Series with fewer than least_years values are left out; one without variation has no statistic."""
    best = F.max_by(F.struct("last_year", "break_year", "mean_before", "mean_after"), F.struct("t", (-F.col("k")).alias("k"))).alias("best")
    found = _splits(series, keys).where(F.col("n") >= least_years).groupBy(*keys).agg(F.first("n").cast("int").alias("n_years"), F.max("t").alias("t_stat"), best)
    known = lambda c: F.when(F.col("t_stat").isNotNull(), F.col(f"best.{c}"))
    return found.select(*keys, "n_years", "t_stat", known("last_year").alias("last_year_before_break"), known("break_year").alias("break_year"), known("mean_before").alias("mean_before"), known("mean_after").alias("mean_after"))


def null_statistics(spark: SparkSession, lengths: DataFrame, simulations: int = DEFAULT.simulations, seed: int = DEFAULT.seed) -> DataFrame:
    """(n_years, t_null): the statistic of `simulations` standard normal series for each length in lengths (n_years).

    Normal numbers come from the MD5 of their place, so a lost task makes the same ones again, and so does any engine."""
    runs = spark.range(simulations).withColumnRenamed("id", "run")
    points = lengths.select("n_years").distinct().crossJoin(F.broadcast(runs)).select("n_years", "run", F.explode(F.sequence(F.lit(1), F.col("n_years"))).alias("year"))

    def uniform(salt: int) -> Column:
        digits = F.substring(F.md5(F.concat_ws(":", F.lit(f"{seed}:{salt}"), "n_years", "run", "year").cast("binary")), 1, 12)
        return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)

    normal = F.sqrt(-2 * F.ln(uniform(1))) * F.cos(2 * F.pi() * uniform(2))
    return _splits(points.withColumn("value", normal), ["n_years", "run"]).groupBy("n_years", "run").agg(F.max("t").alias("t_null")).drop("run")


def stored_null(spark: SparkSession, lengths: list[int], simulations: int = DEFAULT.simulations, seed: int = DEFAULT.seed) -> DataFrame:
    """(n_years, null_t): the statistics of null_statistics for each length as one sorted array, bounded by the number of simulations, not by the data.

    They follow from length, number and seed alone, so an application makes each length's once and reads them afterwards."""
    store = Store(spark, application_folder(spark, f"null-{simulations}-{seed}"), "n_years")
    done = store.open()
    if lacking := [n for n in lengths if str(n) not in done]:
        null = null_statistics(spark, spark.createDataFrame([(n,) for n in lacking], "n_years int"), simulations, seed)
        store.write(null.groupBy("n_years").agg(F.array_sort(F.collect_list("t_null")).alias("null_t")), lacking)
    return spark.read.schema("n_years int, null_t array<double>").parquet(store.path).where(F.col("n_years").isin(lengths))


def with_p_values(tests: DataFrame, p: Homogeneity = DEFAULT) -> DataFrame:
    """Adds p_value, the part of simulated series of that length with a larger statistic, and inhomogeneous.

    tests, a row for each series, is stored first: its lengths, some tens, say what has to be simulated."""
    tests = kept(tests, "tests")
    lengths = sorted(r.n_years for r in tests.select("n_years").distinct().collect())
    ranked = stored_null(tests.sparkSession, lengths, p.simulations, p.seed)
    out = tests.join(F.broadcast(ranked), "n_years", "left").withColumn("p_value", F.when(F.col("t_stat").isNotNull(), _part_above("null_t", "t_stat", p.simulations)))
    return out.withColumn("inhomogeneous", F.col("p_value") < p.alpha).drop("null_t")


def _part_above(ascending: str, value: str, most: int) -> Column:
    """The part of a sorted array of up to `most` numbers that is above a value, by bisection."""
    low, size = F.lit(0), F.size(ascending)

    def halve(x: Column, _: Column) -> Column:
        mid = F.floor((x["low"] + x["high"]) / 2).cast("int")
        right = F.get(F.col(ascending), mid) <= F.col(value)
        open_ = x["low"] < x["high"]
        return F.struct(F.when(open_ & right, mid + 1).otherwise(x["low"]).alias("low"), F.when(open_ & ~right, mid).otherwise(x["high"]).alias("high"))

    steps = F.sequence(F.lit(1), F.lit(most.bit_length() + 1))
    return F.aggregate(steps, F.struct(low.alias("low"), size.alias("high")), halve, lambda x: (size - x["low"]) / size)


def guarded_corr(x: Column, y: Column) -> Column:
    """The correlation over rows where both are present; null where either doesn't vary."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def normalised(annual: DataFrame) -> DataFrame:
    """station, year, total, norm: totals over the station's long-term mean."""
    return annual.withColumn("norm", F.try_divide(F.col("total"), F.avg("total").over(Window.partitionBy("station"))))


def neighbour_correlations(annual: DataFrame, candidate: str) -> DataFrame:
    """station, r: correlation of every other station's totals with the candidate's, over years that both have."""
    own = annual.where(F.col("station") == candidate).select("year", F.col("total").alias("own"))
    # the candidate has one row for each year, so this side is bounded by the length of the record
    pairs = annual.where(F.col("station") != candidate).join(F.broadcast(own), "year")
    return pairs.groupBy("station").agg(guarded_corr(F.col("total"), F.col("own")).alias("r"))


def relative_series(annual: DataFrame, candidate: str) -> DataFrame:
    """year, candidate_norm, reference, ratio: the candidate against its neighbours, weighted by positive correlation.

    The reference is null in years with fewer than two neighbours."""
    norm = normalised(annual)
    weights = neighbour_correlations(annual, candidate).select("station", F.greatest(F.col("r"), F.lit(0.0)).alias("w"))
    near = norm.where((F.col("station") != candidate) & F.col("norm").isNotNull()).join(weights, "station")
    reference = near.groupBy("year").agg(F.count("norm").alias("present"), F.sum(F.col("w") * F.col("norm")).alias("wv"), F.sum("w").alias("w"))
    reference = reference.select("year", F.when(F.col("present") >= 2, F.try_divide("wv", "w")).alias("reference"))
    own = norm.where(F.col("station") == candidate).select("year", F.col("norm").alias("candidate_norm"))
    return own.join(reference, "year", "full").withColumn("ratio", F.try_divide("candidate_norm", "reference"))


def verdict(relative_inhomogeneous: Column, relative_break: Column, absolute_break: Column, tolerance: int = DEFAULT.year_tolerance) -> Column:
    near = F.abs(relative_break - absolute_break) <= tolerance
    return (
        F.when(relative_inhomogeneous.isNull(), NO_RELATIVE_TEST)
        .when(~relative_inhomogeneous, REGIONAL)
        .when(near, STATION_PROBLEM)
        .otherwise(OTHER_YEAR)
    )


def relative_test(annual: DataFrame, candidate: str, p: Homogeneity = DEFAULT) -> DataFrame:
    """One row: the candidate's absolute and relative tests and the verdict, also where a test wasn't possible."""
    absolute = annual.where(F.col("station") == candidate).select(F.lit("absolute").alias("kind"), "year", F.col("total").alias("value"))
    relative = relative_series(annual, candidate).select(F.lit("relative").alias("kind"), "year", F.col("ratio").alias("value"))
    tests = with_p_values(snht(absolute.unionByName(relative), ["kind"], p.least_years), p)
    names = [c for c in tests.columns if c != "kind"]
    # both tests in one row, which is there even if neither was possible
    side = lambda kind: F.max(F.when(F.col("kind") == kind, F.struct(*names))).alias(kind)
    both = tests.agg(side("absolute"), side("relative"))
    row = both.select(F.lit(candidate).alias("station"), *[F.col(f"{k}.{c}").alias(f"{k}_{c}") for k in ("absolute", "relative") for c in names])
    return row.withColumn("verdict", verdict(F.col("relative_inhomogeneous"), F.col("relative_break_year"), F.col("absolute_break_year"), p.year_tolerance))


def report(test: DataFrame, correlations: DataFrame) -> DataFrame:
    """The verdict's text in one column, `report`. Lines of neighbours that don't exist and of tests that weren't possible are left out."""
    near = correlations.orderBy("station").agg(F.array_sort(F.collect_list(F.struct("station", "r"))).alias("near"))
    # halves to even before the text is made: engines differ in how they print them
    text_of = lambda kind: F.format_string(f"{kind.title()} SNHT: break %d, p = %.4f", f"{kind}_break_year", F.rint(F.col(f"{kind}_p_value") * 10_000) / 10_000)
    line = lambda kind: F.when(F.col(f"{kind}_break_year").isNotNull() & F.col(f"{kind}_p_value").isNotNull(), text_of(kind))
    with_any = lambda line: F.when(F.size("near") > 0, line)
    text = F.concat_ws(
        "\n",
        F.format_string("Relative homogeneity test for station %s", "station"),
        with_any(F.concat(F.lit("Neighbours: "), F.array_join("near.station", ", "))),
        with_any(F.concat(F.lit("Correlations: "), F.array_join(F.transform("near", lambda x: F.concat(x["station"], F.lit("="), F.when(x["r"].isNull(), "nan").otherwise(F.format_string("%.2f", x["r"])))), ", "))),
        F.lit(""),
        line("absolute"),
        line("relative"),
        F.concat(F.lit("Verdict: "), F.col("verdict")),
    )
    return test.crossJoin(F.broadcast(near)).select("station", text.alias("report"))
