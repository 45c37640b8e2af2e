"""NetCDF-4 files: what tasks write comes back, chunk by chunk; damage is found; older forms of the format are read."""

import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from rainloom.sources import fields, hdf5, netcdf3

from .test_stores_and_fields import DAY, day_rows, made_field


def plain(path, cube, chunk=(1, 2, 4), records=None):
    v = hdf5.Variable
    n = len(cube)
    own = [
        v("time", ("time",), np.dtype("<i4"), {"units": "days since 1980-01-01"}, np.arange(n) + 9000, (512,)), v("y", ("y",), np.dtype("<f8"), {"units": "m"}, 50.0 - np.arange(cube.shape[1])),
        v("x", ("x",), np.dtype("<f8"), {}, np.arange(cube.shape[2]) * 2.0), v("rain", ("time", "y", "x"), np.dtype("<f4"), {"_FillValue": np.array([np.nan], "f4"), "units": "mm"}, cube, chunk),
    ]
    data, open_chunks, end = hdf5.layout({"time": None, "y": cube.shape[1], "x": cube.shape[2]}, n, own, {"title": "made"})
    assert not open_chunks and end == len(data)
    with open(path, "wb") as f:
        f.write(data)
    return str(path)


def test_checksums_are_the_published_ones():
    assert hdf5.lookup3(b"Four score and seven years ago") == 0x17770551 and hdf5.lookup3(b"") == 0xDEADBEEF
    assert [hdf5.fletcher(x) for x in (b"abcd", b"abcde", b"")] == [(0x6162 * 2 + 0x6364) % 65535 << 16 | (0x6162 + 0x6364) % 65535, ((0x6162 * 3 + 0x6364 * 2 + 0x6500) % 65535) << 16 | (0x6162 + 0x6364 + 0x6500) % 65535, 0]


@pytest.mark.parametrize("chunk", [(1, 2, 4), (1, 5, 4), (2, 3, 3), (3, 7, 9)])
@pytest.mark.parametrize("shape", [(1, 5, 4), (7, 5, 4), (150, 5, 4)])
def test_round_trip_by_chunks(tmp_path, shape, chunk):
    rng = np.random.default_rng(3)
    cube = rng.random(shape).astype("f4")
    cube[rng.random(shape) < 0.2] = np.nan
    h = hdf5.Hdf5(plain(tmp_path / "a.nc", cube, chunk))
    assert np.array_equal(h.read("rain"), cube, equal_nan=True) and h.field_name() == "rain" and h.dim_names(h.place("rain")) == ["time", "y", "x"]
    k = shape[0] // 2
    assert np.array_equal(h.lines("rain", k, 1, 4), cube[k, 1:4], equal_nan=True) and np.array_equal(h.read("rain", k, k + 1), cube[k : k + 1], equal_nan=True)
    found = fields.to_dict(h.path)
    assert found["attributes"] == {"title": "made"} and found["dimensions"] == {"time": shape[0], "y": 5, "x": 4}
    assert found["variables"]["rain"].attributes["units"] == "mm" and np.isnan(found["variables"]["rain"].attributes["_FillValue"][0])


def test_only_the_chunks_of_the_lines_are_read(tmp_path):
    h = hdf5.Hdf5(plain(tmp_path / "a.nc", np.random.default_rng(1).random((9, 8, 4)).astype("f4"), (1, 2, 4)))
    before = hdf5.Hdf5.taken
    h.lines("rain", 5, 3, 5)  # lines 3 and 4 lie in two chunks
    sizes = {first: size for first, (_, size, _) in h._chunks(h.place("rain")).items()}
    assert hdf5.Hdf5.taken - before == sizes[5, 2, 0] + sizes[5, 4, 0]


def test_chunks_that_are_not_there_are_missing(tmp_path):
    path = plain(tmp_path / "a.nc", np.ones((2, 4, 4), "f4"))
    h = hdf5.Hdf5(path)
    del h._chunks(h.place("rain"))[1, 2, 0]
    found = h.read("rain")
    assert np.isnan(found[1, 2:]).all() and (found[1, :2] == 1).all() and (found[0] == 1).all()


def test_damaged_files_are_refused_or_read_right(tmp_path):
    """Every byte in turn: it is noticed, or it was one that nothing depends on."""
    cube = np.random.default_rng(2).random((2, 3, 4)).astype("f4")
    path = plain(tmp_path / "a.nc", cube, (1, 3, 4))
    whole = open(path, "rb").read()
    noticed = 0
    for k in range(0, len(whole), 3):
        with open(path, "wb") as f:
            f.write(whole[:k] + bytes([whole[k] ^ 0x55]) + whole[k + 1 :])
        try:
            h = hdf5.Hdf5(path)
            assert np.array_equal(h.read("rain"), cube) and h.read("time").tolist() == [9000, 9001], k
        except (ValueError, KeyError, StopIteration, struct.error, OverflowError, MemoryError):
            noticed += 1
    assert noticed > 300
    for n in (10, 60, len(whole) - 1):
        with open(path, "wb") as f:
            f.write(whole[:n])
        with pytest.raises(ValueError):
            hdf5.Hdf5(path)
    with open(path, "wb") as f:
        f.write(b"CDF\x01 and more")
    with pytest.raises(ValueError, match="no HDF5"):
        hdf5.Hdf5(path)


def test_older_forms_are_read(tmp_path):
    """Superblock 0, a group as a symbol table, headers of version 1, filters of version 1 with a Fletcher checksum."""
    values = np.arange(6, dtype="<f4").reshape(1, 2, 3)
    out = bytearray(4096)

    def put(at, data):
        out[at : at + len(data)] = data
        return at

    def header(at, messages):
        body = b"".join(struct.pack("<2HB3x", kind, len(d) + -len(d) % 8, 0) + d + bytes(-len(d) % 8) for kind, d in messages)
        return put(at, struct.pack("<BBHII4x", 1, 0, len(messages), 1, len(body)) + body)

    put(0, hdf5.SIGNATURE + struct.pack("<4B4B2HI4Q", 0, 0, 0, 0, 0, 8, 8, 0, 4, 16, 0, 0, hdf5.NONE, 4096, hdf5.NONE) + struct.pack("<2Q2I16x", 0, 96, 0, 0))
    header(96, [(17, struct.pack("<2Q", 200, 300))])
    put(200, b"TREE" + struct.pack("<2BH2Q3Q", 0, 0, 1, hdf5.NONE, hdf5.NONE, 0, 400, 8))
    put(300, b"HEAP" + struct.pack("<4x3Q", 32, hdf5.NONE, 340))
    put(340, b"\0" * 8 + b"rain\0\0\0\0")
    put(400, b"SNOD" + struct.pack("<2BH", 1, 0, 1) + struct.pack("<2Q2I16x", 8, 600, 0, 0))
    name, kind, space = b"units\0\0\0", struct.pack("<B3BI", 0x13, 0, 0, 0, 3), struct.pack("<4B4x", 1, 0, 0, 0)
    attribute = struct.pack("<2B3H", 1, 0, 6, 8, 8) + name + kind + space + b"mm\0"
    chunk = zlib_fletcher(values)
    put(1500, b"TREE" + struct.pack("<2BH2Q", 1, 0, 1, hdf5.NONE, hdf5.NONE) + struct.pack("<2I4QQ", len(chunk), 0, 0, 0, 0, 0, 3000) + struct.pack("<2I4Q", 0, 0, 1, 2, 3, 0))
    put(3000, chunk)
    filters = struct.pack("<2B6x", 1, 3) + struct.pack("<4HII", 2, 0, 0, 1, 4, 0) + struct.pack("<4HII", 1, 0, 0, 1, 4, 0) + struct.pack("<4H", 3, 0, 0, 0)
    f4 = struct.pack("<B3BI2H4BI", 0x11, 0x20, 31, 0, 4, 0, 32, 23, 8, 0, 23, 127)
    header(600, [(1, struct.pack("<4B4x3Q", 1, 3, 0, 0, 1, 2, 3)), (3, f4), (5, struct.pack("<4BIf", 2, 3, 2, 1, 4, -1.0)), (8, struct.pack("<3BQ4I", 3, 2, 4, 1500, 1, 2, 3, 4)), (11, filters), (12, attribute), (16, struct.pack("<2Q", 1400, 24))])
    put(1400, struct.pack("<2HB3x", 0, 16, 0) + bytes(16))
    (tmp_path / "old.nc").write_bytes(bytes(out))
    h = hdf5.Hdf5(str(tmp_path / "old.nc"))
    assert h.place("rain").attributes == {"units": "mm"} and h.place("rain").missing == struct.pack("<f", -1.0) and h.place("rain").shape == (1, 2, 3)
    assert np.array_equal(h.read("rain"), values)
    out[3000 + len(chunk) - 1] ^= 1
    (tmp_path / "old.nc").write_bytes(bytes(out))
    with pytest.raises(ValueError, match="damaged: a chunk"):
        hdf5.Hdf5(str(tmp_path / "old.nc")).read("rain")


def zlib_fletcher(values):
    data = hdf5.packed(values)
    return data + struct.pack("<I", hdf5.fletcher(data))


def test_what_cannot_be_read_is_named(tmp_path):
    info = hdf5._message(hdf5.LINK_INFO, struct.pack("<2B2Q", 0, 0, 4000, 4000))
    root = hdf5._header([info])
    head = hdf5.SIGNATURE + struct.pack("<4B4Q", 2, 8, 8, 0, 0, hdf5.NONE, 48 + len(root), 48)
    (tmp_path / "dense.nc").write_bytes(head + struct.pack("<I", hdf5.lookup3(head)) + root)
    with pytest.raises(ValueError, match="links in a fractal heap"):
        hdf5.Hdf5(str(tmp_path / "dense.nc"))


@pytest.mark.parametrize("piece", [4, 8, 1 << 20])
def test_tasks_write_netcdf4(spark, tmp_path, monkeypatch, piece):
    monkeypatch.setattr(fields, "PIECE", piece)
    cells = made_field(spark)
    paths = {y: str(tmp_path / f"f_{y}.nc") for y in (2001, 2002)}
    fields.write_years(paths, cells.repartition(5), day_rows(cells), kind="netcdf4")
    assert sorted(os.listdir(tmp_path)) == ["f_2001.nc", "f_2002.nc"]
    want = {(r.date, r.row, r.col, r.x, r.y): r.rainfall for r in cells.collect()}
    for reader in (fields.load(spark, str(tmp_path)), spark.read.format("netcdf").load(str(tmp_path))):
        assert {(r.date, r.row, r.col, r.x, r.y): r.value for r in reader.collect()} == want
    days = fields.load_days(spark, str(tmp_path))
    assert sorted(map(tuple, days.collect())) == sorted((r.date, 1.0, 9.0, 0.25) for r in day_rows(cells).collect()) and days.columns == ["date", "method_flag", "n_stations_reporting", "elevation_rainfall_r"]
    one = fields.load(spark, str(tmp_path), variable="kriging_variance").where(F.col("date") == DAY).where("row = 3")
    assert {(r.col, r.value) for r in one.collect()} == {(r.col, r.variance) for r in cells.where(F.col("date") == DAY).where("row = 3").collect()}
    whole, classic = fields.to_dict(paths[2001]), tmp_path / "classic.nc"
    netcdf3.write_year(str(classic), cells, day_rows(cells), 2001)
    old = netcdf3.to_dict(str(classic))
    assert list(whole["variables"]) == list(old["variables"]) and whole["dimensions"] == old["dimensions"] and whole["attributes"] == old["attributes"]
    for name, v in old["variables"].items():
        other = whole["variables"][name]
        assert np.array_equal(other.data.astype(float), v.data.astype(float), equal_nan=True) and other.dims == v.dims and set(other.attributes) == set(v.attributes)


def test_lines_that_are_lacking_and_failing_jobs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fields, "PIECE", 4)
    cells = made_field(spark).where("row NOT IN (2, 3)")
    fields.write_years({2001: str(tmp_path / "a.nc")}, cells, day_rows(cells), kind="netcdf4")
    back = {(r.date, r.y, r.x): r.value for r in fields.load(spark, str(tmp_path / "a.nc")).collect()}
    assert back == {(r.date, r.y, r.x): r.rainfall for r in cells.where("date < '2002-01-01'").collect()}
    broken = cells.withColumn("variance", F.when(F.col("row") == 5, F.raise_error(F.lit("lost")).cast("float")).otherwise(F.col("variance")))
    with pytest.raises(Exception, match="lost"):
        fields.write_years({2001: str(tmp_path / "b.nc")}, broken, day_rows(cells), kind="netcdf4")
    assert os.listdir(tmp_path) == ["a.nc"]
    with pytest.raises(ValueError, match="classic or netcdf4"):
        fields.write_years({2001: str(tmp_path / "b.nc")}, cells, day_rows(cells), kind="other")
