import datetime as dt
import random

from rainloom import cli
from rainloom.sources import csv


def test_whole_chain(spark, tmp_path):
    """From daily values to series with units, every step over the files of the one before."""
    rng = random.Random(1)
    names = [str(k) for k in range(100, 110)]
    place = {s: (85 + rng.random() * 0.5, 27 + rng.random() * 0.5, rng.randint(100, 2000)) for s in names}
    lines = [",".join(["date", *names])]
    for k in range(365 * 6):
        day = dt.date(2001, 1, 1) + dt.timedelta(days=k)
        lines.append(",".join([str(day), *("" if rng.random() < 0.02 else f"{rng.random() * 9 + place[s][2] / 400:.1f}" for s in names)]))
    (tmp_path / "rain.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "st.csv").write_text("Station,Y,X,Z\n" + "".join(f"{s},{y},{x},{z}\n" for s, (x, y, z) in place.items()))
    (tmp_path / "dem.asc").write_text("ncols 3\nnrows 2\nxllcorner 300000\nyllcorner 2990000\ncellsize 20000\nNODATA_value -9999\n100 200 300\n400 -9999 600\n")
    at = lambda name: str(tmp_path / name)
    run = lambda *a: cli.run(spark, cli._parser().parse_args(list(a)))
    run("homogeneity", at("rain.csv"), at("homogeneity"), "--candidate", "103", "--simulations", "300")
    assert "Verdict:" in "".join(r.value for r in spark.read.text(at("homogeneity/relative_result_103")).collect())
    run("variograms", at("rain.csv"), at("st.csv"), at("table"), "--batch", "365")
    assert csv.read_variogram_table(spark, at("table/csv")).where("ok_model IS NOT NULL").count() == 365
    short = "\n".join(lines[:1] + [x for x in lines if x.startswith("2003-07-0")]) + "\n"
    (tmp_path / "july.csv").write_text(short)
    run("krige", at("july.csv"), at("st.csv"), at("dem.asc"), at("table/csv"), at("kriged"))
    kriged = spark.read.parquet(at("kriged"))
    assert kriged.count() == 9 * 6 and kriged.where("rainfall IS NULL").count() == 9
    run("netcdf", at("kriged"), at("dem.asc"), at("nc"))
    assert spark.read.format("netcdf3").load(at("nc")).where("value IS NOT NULL").count() == 45
    run("krige-day", at("rain.csv"), at("st.csv"), at("dem.asc"), at("day"), "--date", "2003-07-04")
    assert spark.read.parquet(at("day/cells")).count() == 6
