"""NetCDF classic files (CDF-1 and CDF-2): a parser, a writer and a Spark data source.

    spark.dataSource.register(NetCdf3)
    spark.read.format("netcdf3").option("variable", "rainfall").load(path or glob)

gives date, row, col, x, y, value for a variable over (time, y, x), a partition for each file and run of dates; the
variable is the first one with three dimensions unless it is named. Fill values are null, but for whole-number codes
read with option fill=keep. `fields` reads NetCDF-4 as well, with filters pushed into the files."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql.datasource import DataSource, DataSourceReader

# fixed values of the format: tags, and types by code
DIMENSION, VARIABLE, ATTRIBUTE = 10, 11, 12
TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8"}
CODES = {"i1": 1, "S1": 2, "i2": 3, "i4": 4, "f4": 5, "f8": 6}


@dataclass
class Var:
    name: str
    dims: tuple[str, ...]
    data: np.ndarray
    attributes: dict = field(default_factory=dict)


@dataclass
class _Place:
    name: str
    dims: list[int]
    attributes: dict
    kind: np.dtype
    size: int
    begin: int
    record: bool


class Classic:
    """The header of a file, and access to its variables' records."""

    #: Bytes of values that this process has read.
    taken = 0

    def __init__(self, path: str):
        self.path = path
        with open(path, "rb") as f:
            magic = f.read(4)
            if magic[:3] != b"CDF" or magic[3:] not in (b"\x01", b"\x02"):
                why = "it is NetCDF-4 (HDF5), which format netcdf reads" if magic == b"\x89HDF" else "no NetCDF classic file"
                raise ValueError(f"can't read {path}: {why}")
            self._f, self._offset = f, ">q" if magic[3] == 2 else ">i"
            self.records = self._int()
            self.dims: list[tuple[str, int]] = [(self._name(), self._int()) for _ in range(self._list(DIMENSION))]
            self.attributes = self._attributes()
            self.places = [self._place() for _ in range(self._list(VARIABLE))]
            del self._f
        own = [p for p in self.places if p.record]
        # one record variable alone isn't padded
        self.stride = sum(p.size for p in own) if len(own) != 1 else own[0].kind.itemsize * int(np.prod([self.dims[d][1] for d in own[0].dims[1:]], initial=1))
        if self.records < 0:  # a file still being written when it was closed
            start = min(p.begin for p in own)
            self.records = (os.path.getsize(path) - start) // self.stride if own else 0

    def _int(self) -> int:
        return struct.unpack(">i", self._f.read(4))[0]

    def _name(self) -> str:
        n = self._int()
        return self._f.read(n + -n % 4)[:n].decode()

    def _list(self, tag: int) -> int:
        found, n = self._int(), self._int()
        if found not in (0, tag) or (found == 0 and n):
            raise ValueError(f"{self.path} has a broken header")
        return n

    def _attributes(self) -> dict:
        out = {}
        for _ in range(self._list(ATTRIBUTE)):
            name, kind, n = self._name(), np.dtype(TYPES[self._int()]), self._int()
            size = n * kind.itemsize
            raw = self._f.read(size + -size % 4)[:size]
            out[name] = raw.decode(errors="replace") if kind.kind == "S" else np.frombuffer(raw, kind).tolist()
        return out

    def _place(self) -> _Place:
        name = self._name()
        dims = [self._int() for _ in range(self._int())]
        attributes, kind, size = self._attributes(), np.dtype(TYPES[self._int()]), self._int()
        begin = struct.unpack(self._offset, self._f.read(struct.calcsize(self._offset)))[0]
        return _Place(name, dims, attributes, kind, size, begin, bool(dims) and self.dims[dims[0]][1] == 0)

    def place(self, name: str) -> _Place:
        return next(p for p in self.places if p.name == name)

    def shape(self, p: _Place) -> tuple[int, ...]:
        return tuple(self.records if self.dims[d][1] == 0 else self.dims[d][1] for d in p.dims)

    def read(self, name: str, first: int = 0, last: int | None = None) -> np.ndarray:
        """The variable's data, or its first dimension's positions first to last alone."""
        p = self.place(name)
        shape = self.shape(p)
        if not shape:
            return self._values(p, p.begin, 1).reshape(())
        last = shape[0] if last is None else min(last, shape[0])
        each = int(np.prod(shape[1:], initial=1))
        if not p.record:
            return self._values(p, p.begin + first * each * p.kind.itemsize, (last - first) * each).reshape((last - first, *shape[1:]))
        rows = [self._values(p, p.begin + k * self.stride, each) for k in range(first, last)]
        return np.array(rows, p.kind).reshape((last - first, *shape[1:]))

    def _values(self, p: _Place, at: int, n: int) -> np.ndarray:
        found = np.fromfile(self.path, p.kind, n, offset=at)
        if len(found) < n:
            raise ValueError(f"{self.path} ends inside {p.name}")
        Classic.taken += found.nbytes
        return found

    def lines(self, name: str, record: int, first: int, last: int) -> np.ndarray:
        """Lines first to last of one record of a variable over (time, y, x), and no other bytes."""
        p = self.place(name)
        _, _, width = self.shape(p)
        step = self.stride if p.record else self.shape(p)[1] * width * p.kind.itemsize
        return self._values(p, p.begin + record * step + first * width * p.kind.itemsize, (last - first) * width).reshape(last - first, width)

    def dim_names(self, p: _Place) -> list[str]:
        return [self.dims[d][0] for d in p.dims]

    def field_name(self) -> str:
        """The first variable over three dimensions."""
        found = next((p.name for p in self.places if len(p.dims) == 3), None)
        if found is None:
            raise ValueError(f"{self.path} has no variable over time, y and x")
        return found

    def fill(self, p: _Place) -> float | None:
        found = p.attributes.get("_FillValue", p.attributes.get("missing_value"))
        return found[0] if isinstance(found, list) and found else None


def to_dict(path: str) -> dict:
    """All variables, fill values as NaN, with dimensions and attributes."""
    return contents(Classic(path))


def contents(c) -> dict:
    """All variables of an open file of any kind."""
    out = {}
    for p in c.places:
        data, fill = c.read(p.name), c.fill(p)
        if p.kind.kind == "f" and fill is not None:
            data = np.where(data == fill, np.nan, data)
        out[p.name] = Var(p.name, tuple(c.dim_names(p)), data, p.attributes)
    return {"variables": out, "dimensions": {n: s or c.records for n, s in c.dims}, "attributes": c.attributes}


# -- writer ---------------------------------------------------------------------------------------------------------


def _packed_name(name: str) -> bytes:
    raw = name.encode()
    return struct.pack(">i", len(raw)) + raw + bytes(-len(raw) % 4)


def _packed_attributes(attributes: dict) -> bytes:
    out = [struct.pack(">ii", ATTRIBUTE if attributes else 0, len(attributes))]
    for name, value in attributes.items():
        if isinstance(value, str):
            code, n, raw = 2, len(value.encode()), value.encode()
        else:
            array = np.atleast_1d(np.asarray(value))
            kind = "i4" if array.dtype.kind in "iub" and array.dtype.itemsize >= 4 else array.dtype.str[1:]
            array = array.astype(f">{kind}")
            code, n, raw = CODES[kind], len(array), array.tobytes()
        out.append(_packed_name(name) + struct.pack(">ii", code, n) + raw + bytes(-len(raw) % 4))
    return b"".join(out)


@dataclass
class Spot:
    """Where a variable's values lie: of a record variable those of record 0; `size` bytes each time, filled up to four."""

    kind: str
    record: bool
    begin: int
    size: int


class Layout:
    """Where everything of a CDF-2 file lies, which its header alone says: values may be put in place in any order."""

    def __init__(self, dims: dict[str, int | None], variables: list[Var], attributes: dict | None = None):
        names = list(dims)
        record_dim = next((n for n, s in dims.items() if s is None), None)
        self.records = max([len(v.data) for v in variables if v.dims and v.dims[0] == record_dim], default=0)
        self.spots: dict[str, Spot] = {}
        for v in variables:
            data = np.asarray(v.data)
            wanted = tuple(self.records if d == record_dim else dims[d] for d in v.dims)
            if data.shape != wanted:
                raise ValueError(f"{v.name} has the shape {data.shape}, its dimensions say {wanted}")
            kind, record = TYPES[CODES[data.dtype.str[1:]]], bool(v.dims) and v.dims[0] == record_dim
            self.spots[v.name] = Spot(kind, record, 0, np.dtype(kind).itemsize * int(np.prod(data.shape[1 if record else 0 :], initial=1)))
        # one record variable alone isn't padded
        self.alone = sum(p.record for p in self.spots.values()) == 1
        self.step = sum(self.taken(p) for p in self.spots.values() if p.record)

        def head() -> bytes:
            out = [b"CDF\x02", struct.pack(">i", self.records), struct.pack(">ii", DIMENSION if dims else 0, len(dims))]
            out += [_packed_name(n) + struct.pack(">i", s or 0) for n, s in dims.items()]
            out += [_packed_attributes(attributes or {}), struct.pack(">ii", VARIABLE if variables else 0, len(variables))]
            for v in variables:
                p = self.spots[v.name]
                out.append(_packed_name(v.name) + struct.pack(f">i{len(v.dims)}i", len(v.dims), *(names.index(d) for d in v.dims)))
                out.append(_packed_attributes(v.attributes) + struct.pack(">iiq", CODES[p.kind[1:] if p.kind != "S1" else "S1"], min(p.size + -p.size % 4, 2**31 - 4), p.begin))
            return b"".join(out)

        at = len(head())
        for p in [p for p in self.spots.values() if not p.record] + [p for p in self.spots.values() if p.record]:
            p.begin = at
            at += self.taken(p)
        self.head = head()
        self.end = at + self.step * (self.records - 1) if self.step and self.records else at - self.step

    def taken(self, p: Spot) -> int:
        return p.size if p.record and self.alone else p.size + -p.size % 4

    def put(self, f, name: str, values: np.ndarray, record: int = 0, after: int = 0) -> None:
        """Writes values of a variable, of a record, `after` so many bytes of it."""
        p = self.spots[name]
        f.seek(p.begin + (record * self.step if p.record else 0) + after)
        f.write(np.asarray(values).astype(p.kind).tobytes())


def begin(f, layout: Layout, variables: list[Var], later: frozenset[str] = frozenset()) -> None:
    """Writes the header and the values of all variables but those named, whose places stay open."""
    f.write(layout.head)
    f.truncate(layout.end)
    for v in variables:
        if v.name not in later:
            data = np.asarray(v.data)
            for k in range(layout.records if layout.spots[v.name].record else 1):
                layout.put(f, v.name, data[k] if layout.spots[v.name].record else data, k)


def write(path: str, dims: dict[str, int | None], variables: list[Var], attributes: dict | None = None, later: Iterable[tuple[int, dict[str, np.ndarray]]] = ()) -> None:
    """A CDF-2 file. A dimension of None is the record dimension. The file appears when it is whole, or not at all.

    later: records whose values come one by one, each with the values by variable; they replace those given at first."""
    layout, part = Layout(dims, variables, attributes), f"{path}.part"
    try:
        with open(part, "wb") as f:
            begin(f, layout, variables)
            for k, values in later:
                for name, value in values.items():
                    layout.put(f, name, value, k)
            f.flush()
            os.fsync(f.fileno())
        os.replace(part, path)
    finally:
        if os.path.exists(part):
            os.remove(part)


def write_year(path: str, cells, days, year: int, **options) -> None:
    """One year of kriged fields as a file, by the tasks that hold them: cells (date, row, col, x, y, rainfall, variance), days (date, method_flag, n_reporting, r)."""
    from .fields import write_years

    write_years({year: path}, cells, days, **options)


# -- data source ----------------------------------------------------------------------------------------------------


class NetCdf3(DataSource):
    @classmethod
    def name(cls) -> str:
        return "netcdf3"

    def schema(self) -> str:
        return "date date, row int, col int, x double, y double, value double"

    def reader(self, schema) -> DataSourceReader:
        from .fields import FieldReader

        return FieldReader(dict(self.options))
