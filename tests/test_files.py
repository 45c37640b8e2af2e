import duckdb
import pandas as pd
import pytest

from rainloom.plans import files, proxy
from rainloom.sources import csv, shapefile
from rainloom.sources.shared import mounted, new_folder

SQUARE = [(0.0, 0.0), (8.0, 0.0), (8.0, 8.0), (0.0, 8.0)]


def test_what_files_give_back_equals_the_sql(spark, sf_dir):
    """Every sink and source at the smallest size but the slow ones, which the driver compares."""
    con = duckdb.connect()
    for t in ("lineitem", "supplier", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    plain = lambda v: round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    for name in ("file_wide_csv", "file_stations", "file_annual_totals", "file_relative_series", "file_ascii_grid", "file_shapefile_mask", "file_zonal_csv", "file_typed_series", "run_resumed", "stream_daily", "plot_surface"):
        found = getattr(files, name)(spark, sf_dir)
        columns = sorted(found.columns)
        own = sorted(str([plain(r[c]) for c in columns]) for r in found.collect())
        rows = con.execute(proxy.ORACLE[name])
        names = [d[0] for d in rows.description]
        assert sorted(names) == columns, name
        assert own == sorted(str([plain(dict(zip(names, r, strict=True))[c]) for c in columns]) for r in rows.fetchall()), name


def test_shapefiles_come_back_as_written(spark, tmp_path):
    spark.dataSource.register(shapefile.Shapefile)
    rings = {"hollow": [SQUARE, [(2.0, 2.0), (4.0, 2.0), (3.0, 4.0)]], "a longer name": [SQUARE]}
    shapefile.write(str(tmp_path / "a.shp"), rings)
    found = spark.read.format("shapefile").load(str(tmp_path / "a.shp")).collect()
    assert {r.basin: [[tuple(c) for c in ring] for ring in r.rings] for r in found} == rings
    assert (tmp_path / "a.shp").stat().st_size == 2 * int.from_bytes((tmp_path / "a.shp").read_bytes()[24:28], "big")
    shapefile.write(str(tmp_path / "none.shp"), {})
    assert spark.read.format("shapefile").load(str(tmp_path / "none.shp")).count() == 0


def test_stations_from_a_pickle_equal_those_from_csv(spark, tmp_path):
    frame = pd.DataFrame({"Station": [909, 1030], "Z": [137.0, None], "X": [84.98, 85.35], "Y": [27.16, 27.7]})
    frame.to_csv(tmp_path / "s.csv", index=False)
    frame.to_pickle(tmp_path / "s.pkl")
    frame.set_index("Station").to_pickle(tmp_path / "i.pkl")
    rows = [sorted(map(tuple, csv.read_stations(spark, str(tmp_path / n)).collect())) for n in ("s.csv", "s.pkl", "i.pkl")]
    assert rows[0] == rows[1] == rows[2] and rows[0][0][0] == "1030" and rows[0][0][3] is None
    frame.drop(columns="Z").to_pickle(tmp_path / "z.pkl")
    with pytest.raises(ValueError, match="lacks the columns Z"):
        csv.read_stations(spark, str(tmp_path / "z.pkl"))


def test_hand_off_takes_the_first_place_and_names_what_is_lacking(tmp_path):
    (tmp_path / "second.csv").write_text("x")
    new, none = str(tmp_path / "in" / "a.csv"), str(tmp_path / "in" / "b.csv")
    lacking = csv.hand_off({new: (str(tmp_path / "first.csv"), str(tmp_path / "second.csv")), none: (str(tmp_path / "third.csv"),)})
    assert open(new).read() == "x" and len(lacking) == 1 and "third.csv" in lacking[0]


def test_shared_folders(spark):
    a, b = new_folder(spark, "t"), new_folder(spark, "t")
    assert a != b and mounted(a) != mounted(b)
    with pytest.raises(ValueError, match="mounted"):
        mounted("hdfs://none/here")
