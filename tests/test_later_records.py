"""Records that a NetCDF file is given after the others."""

import numpy as np

from rainloom.sources import netcdf3


def test_later_records_replace_the_first(tmp_path):
    empty = np.broadcast_to(np.float32(np.nan), (3, 2, 3))
    days = [netcdf3.Var("time", ("time",), np.arange(3, dtype="i4"), {}), netcdf3.Var("x", ("x",), np.array([4, 5, 6], "i2"), {})]
    given = [(2, {"a": np.full((2, 3), 2.5), "b": np.ones((2, 3))}), (0, {"b": np.arange(6).reshape(2, 3)})]
    path = str(tmp_path / "f.nc")
    netcdf3.write(path, {"time": None, "y": 2, "x": 3}, [*days, netcdf3.Var("a", ("time", "y", "x"), empty, {}), netcdf3.Var("b", ("time", "y", "x"), empty, {})], later=given)
    c = netcdf3.Classic(path)
    a, b = c.read("a"), c.read("b")
    assert np.isnan(a[:2]).all() and (a[2] == 2.5).all()
    assert b[0].ravel().tolist() == [0, 1, 2, 3, 4, 5] and np.isnan(b[1]).all() and (b[2] == 1).all()
    assert c.read("time").tolist() == [0, 1, 2] and c.read("x").tolist() == [4, 5, 6]


def test_one_record_variable_alone_is_not_padded(tmp_path):
    path = str(tmp_path / "f.nc")
    netcdf3.write(path, {"time": None, "x": 3}, [netcdf3.Var("v", ("time", "x"), np.zeros((2, 3), "i1"), {})], later=[(1, {"v": np.array([7, 8, 9])})])
    assert netcdf3.Classic(path).read("v").tolist() == [[0, 0, 0], [7, 8, 9]]
