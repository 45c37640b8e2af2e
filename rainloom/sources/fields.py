"""Gridded fields over days in NetCDF files, classic ones and NetCDF-4: read with pushed filters, streamed as files arrive, written by the tasks that hold them.

    fields.load(spark, path or glob, variable="rainfall").where("date = '2001-07-03' and row between 10 and 20")
    fields.stream(spark, folder)
    fields.write_years({2001: path, ...}, cells, days)

Reading gives date, row, col, x, y, value; the variable is the first one over (time, y, x) unless it is named. `load`
pushes comparisons of date, row, col, x and y with constants into the source, where they become records and lines of the
files: files without such a record are skipped by their time axis, and no byte of other lines is read. A partition is a
run of records of one file. Fill values are null, but for whole-number codes read with option fill=keep."""

from __future__ import annotations

import glob
import json
import operator
import os
import shutil
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, WriterCommitMessage,
)

from ..schema import Kriging
from . import hdf5, netcdf3
from .netcdf3 import Var
from .shared import move

#: Records that one partition reads at least, cells up to which it reads more, and cells of a piece of a record being written, about.
RECORDS, CELLS, PIECE = 31, 1 << 20, 1 << 20
EPOCH = "1980-01-01"
SCHEMA = "date date, row int, col int, x double, y double, value double"
_COMPARE: dict[type, Callable] = {EqualTo: operator.eq, EqualNullSafe: operator.eq, GreaterThan: operator.gt, GreaterThanOrEqual: operator.ge, LessThan: operator.lt, LessThanOrEqual: operator.le}


def open_field(path: str):
    """A field file, NetCDF classic or NetCDF-4, by what its first bytes say it is."""
    with open(path, "rb") as f:
        return (hdf5.Hdf5 if f.read(8) == hdf5.SIGNATURE else netcdf3.Classic)(path)


def to_dict(path: str) -> dict:
    """All variables of a file of either kind, fill values as NaN, with dimensions and attributes."""
    return netcdf3.contents(open_field(path))


def matching(path: str) -> list[str]:
    return sorted(glob.glob(f"{path}/*.nc") if os.path.isdir(path) else glob.glob(path))


# -- reading --------------------------------------------------------------------------------------------------------


class Axes:
    """Dates, rows and columns of a file's variable. Row 0 is the northern one, whichever way the axis runs in the file."""

    def __init__(self, c, name: str):
        self.name = name
        t, y, x = c.dim_names(c.place(name))
        words = str(c.place(t).attributes.get("units", f"days since {EPOCH}")).split()
        start = np.datetime64(date.fromisoformat(words[2][:10]))
        self.dates = start + c.read(t).astype("timedelta64[D]")
        ys, self.x = c.read(y).astype(float), c.read(x).astype(float)
        self.line = np.argsort(-ys, kind="stable")
        self.y = ys[self.line]

    def most(self) -> int:
        """Records of a partition: more of small grids."""
        return max(RECORDS, CELLS // max(1, len(self.x) * len(self.y)))

    def kept(self, filters: list[tuple[str, str, object]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Records, rows and columns that the filters leave."""
        values = {"date": self.dates, "row": np.arange(len(self.y)), "y": self.y, "col": np.arange(len(self.x)), "x": self.x}
        keep = {c: np.ones(len(v), bool) for c, v in values.items()}
        for column, name, constant in filters:
            own = values[column]
            plain = lambda v: np.datetime64(v) if isinstance(v, date) else v
            keep[column] &= np.isin(own, [plain(v) for v in constant]) if name == "In" else next(f for k, f in _COMPARE.items() if k.__name__ == name)(own, plain(constant))
        return np.flatnonzero(keep["date"]), np.flatnonzero(keep["row"] & keep["y"]), np.flatnonzero(keep["col"] & keep["x"])


@dataclass
class Part(InputPartition):
    path: str
    first: int
    last: int


def runs(records: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Records as runs of neighbours (first, behind the last), of `most` at most."""
    for own in np.split(records, np.flatnonzero(np.diff(records) != 1) + 1):
        for a in range(0, len(own), most):
            few = own[a : a + most]
            yield int(few[0]), int(few[-1]) + 1


def read_part(part: Part, variable: str | None, keep_fill: bool, filters: list) -> Iterator[pa.RecordBatch]:
    c = open_field(part.path)
    name = variable or c.field_name()
    axes, fill = Axes(c, name), c.fill(c.place(name))
    _, rows, cols = axes.kept(filters)
    if not len(rows) or not len(cols):
        return
    # lines of the file that the rows lie on: one read from the first to the last
    lines = axes.line[rows]
    low, high = int(lines.min()), int(lines.max()) + 1
    row, col = np.repeat(rows, len(cols)).astype(np.int32), np.tile(cols, len(rows)).astype(np.int32)
    for k in range(part.first, part.last):
        v = c.lines(name, k, low, high)[lines - low][:, cols].astype(float).ravel()
        if fill is not None and not keep_fill:
            v = np.where(v == fill, np.nan, v)
        when = pa.repeat(pa.scalar(axes.dates[k].astype(object), pa.date32()), len(v))
        yield pa.RecordBatch.from_arrays([when, *(pa.array(a, from_pandas=True) for a in (row, col, axes.x[col], axes.y[row], v))], ["date", "row", "col", "x", "y", "value"])


class FieldReader(DataSourceReader):
    """All records of all files at a path."""

    def __init__(self, options: dict):
        self.variable, self.keep, self.filters = options.get("variable"), options.get("fill") == "keep", []
        self.paths = matching(options["path"])
        if not self.paths:
            raise FileNotFoundError(f"no NetCDF file at {options['path']}")

    def partitions(self) -> list[Part]:
        out = []
        for path in self.paths:
            c = open_field(path)
            axes = Axes(c, self.variable or c.field_name())
            records, rows, cols = axes.kept(self.filters)
            if len(records) and len(rows) and len(cols):
                out += [Part(path, a, b) for a, b in runs(records, axes.most())]
        return out or [Part("", 0, 0)]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        if part.path:
            yield from read_part(part, self.variable, self.keep, self.filters)


class FilteredReader(FieldReader):
    """Takes comparisons of an axis with a constant over from Spark, which needn't evaluate them again."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column in ("date", "row", "col", "x", "y") and isinstance(f, IsNotNull):
                continue  # axes have no nulls
            if column in ("date", "row", "col", "x", "y") and type(f) in (*_COMPARE, In) and getattr(f, "value", 0) is not None:
                self.filters.append((column, type(f).__name__, f.value))
            else:
                yield f


class FieldStream(DataSourceStreamReader):
    """Files as they arrive. An offset is the number of records of each file seen, so a file that grows gives its new records."""

    def __init__(self, options: dict):
        self.path, self.variable, self.keep = options["path"], options.get("variable"), options.get("fill") == "keep"

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        out = {}
        for path in matching(self.path):
            c = open_field(path)
            out[path] = int(c.shape(c.place(self.variable or c.field_name()))[0])
        return out

    def partitions(self, start: dict, end: dict) -> list[Part]:
        out = []
        for path, n in sorted(end.items()):
            if n > start.get(path, 0):
                c = open_field(path)
                out += [Part(path, a, b) for a, b in runs(np.arange(start.get(path, 0), n), Axes(c, self.variable or c.field_name()).most())]
        return out

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        return read_part(part, self.variable, self.keep, [])


# -- writing --------------------------------------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    #: Pieces in their places, or (piece, variable, file, offset, size) of chunks that wait in files of their own.
    pieces: list


class YearWriter(DataSourceArrowWriter):
    """Tasks put pieces of records, which are runs of lines, in their places in files that are there already, but for their values.

    Rows (piece, row, col, and a column for each variable) come with all of a piece together; a piece has a row without cell, too,
    so one without cells is written as missing. A task that runs again writes the same bytes again. commit() asks for every
    piece, and gives the files their names; abort() deletes them."""

    def __init__(self, options: dict):
        with open(options["path"]) as f:
            self.plan = json.load(f)

    def _whole(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
        """piece, its first line, and its values by variable."""
        plan, piece, first, held = self.plan, -1, 0, {}
        rows, cols, names = np.array(plan["rows"]), np.array(plan["cols"]), plan["variables"]
        for batch in batches:
            ids = batch.column("piece").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if ids[a] != piece:
                    if piece >= 0:
                        yield piece, first, held
                    piece = int(ids[a])
                    low = rows[0] + piece % plan["bands"] * plan["height"]
                    first, last = np.searchsorted(rows, [low, low + plan["height"]]).tolist()
                    held = {name: np.full((last - first, len(cols)), np.nan, "f4") for name in names}
                own = batch.slice(a, b - a)
                solid = own.column("row").is_valid().to_numpy(zero_copy_only=False)
                at = [np.searchsorted(axis, own.column(c).to_numpy(zero_copy_only=False)[solid]) for c, axis in (("row", rows), ("col", cols))]
                for name in names:
                    held[name][at[0] - first, at[1]] = own.column(name).to_numpy(zero_copy_only=False)[solid]
        if piece >= 0:
            yield piece, first, held

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        done, files = [], {}
        try:
            for piece, first, held in self._whole(batches):
                record = piece // self.plan["bands"]
                own = max(k for k, f in enumerate(self.plan["files"]) if f["first"] <= record)
                to = self.plan["files"][own]
                if own not in files:
                    files[own] = open(to["part"], "r+b")
                for name, values in held.items():
                    files[own].seek(to["begin"][name] + (record - to["first"]) * to["step"] + first * values.shape[1] * 4)
                    files[own].write(values.astype(">f4").tobytes())
                done.append(piece)
            for f in files.values():
                f.flush()
                os.fsync(f.fileno())
        finally:
            for f in files.values():
                f.close()
        return Written(done)

    def _complete(self, found: set) -> None:
        if lacking := self.plan["pieces"] - len(found):
            raise RuntimeError(f"{lacking} pieces of records are lacking")

    def commit(self, messages: list[Written | None]) -> None:
        self._complete({p for m in messages if m for p in m.pieces})
        for f in self.plan["files"]:
            os.replace(f["part"], f["path"])

    def abort(self, messages: list[Written | None]) -> None:
        for f in self.plan["files"]:
            if os.path.exists(f["part"]):
                os.remove(f["part"])


class ChunkWriter(YearWriter):
    """Tasks deflate pieces as chunks, whose places depend on the sizes of all, and keep them in files of their own in a folder.

    commit() asks for every piece and stores where each chunk waits; those of tasks that ran twice count once."""

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        done, side = [], os.path.join(self.plan["folder"], uuid.uuid4().hex)
        with open(side, "wb") as f:
            for piece, _, held in self._whole(batches):
                for name, values in held.items():
                    whole = np.full((min(self.plan["height"], len(self.plan["rows"])), values.shape[1]), np.nan, "<f4")
                    whole[: len(values)] = values
                    data = hdf5.packed(whole)
                    done.append((piece, name, side, f.tell(), len(data)))
                    f.write(data)
            f.flush()
            os.fsync(f.fileno())
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        found = {(piece, name): (side, at, size) for m in messages if m for piece, name, side, at, size in m.pieces}
        self._complete({piece for piece, _ in found})
        with open(os.path.join(self.plan["folder"], "index"), "w") as f:
            json.dump([[*k, *v] for k, v in sorted(found.items())], f)

    def abort(self, messages: list[Written | None]) -> None:
        shutil.rmtree(self.plan["folder"], ignore_errors=True)


class NetCdf(DataSource):
    """Format "netcdf". Option filters=push needs spark.sql.python.filterPushdown.enabled, as `load` sets it."""

    @classmethod
    def name(cls) -> str:
        return "netcdf"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return (FilteredReader if self.options.get("filters") == "push" else FieldReader)(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return FieldStream(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return (ChunkWriter if self.options.get("kind") == "netcdf4" else YearWriter)(dict(self.options))


def load(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The field at a path, with filters pushed into its files. Allows the session to push filters into Python sources."""
    spark.dataSource.register(NetCdf)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("netcdf").option("filters", "push").options(**options).load(path)


def stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The field's files at a path as a stream, a file's records once each."""
    spark.dataSource.register(NetCdf)
    return spark.readStream.format("netcdf").options(**options).load(path)


def load_days(spark: SparkSession, path: str, keep_fill: bool = False) -> DataFrame:
    """date, and every variable over time alone, of the files at a path, a task for each file.

    Fill values are null, or kept as the codes that they also are (no method, no station)."""
    paths = matching(path)
    if not paths:
        raise FileNotFoundError(f"no NetCDF file at {path}")
    c = open_field(paths[0])
    names = [p.name for p in c.places if len(c.shape(p)) == 1 and c.dim_names(p) == [_time(c)] and p.name != _time(c)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in batch.column("path").to_pylist():
                c = open_field(own)
                dates = Axes(c, c.field_name()).dates
                columns = []
                for name in names:
                    p = c.place(name)
                    v, fill = c.read(name).astype(float), c.fill(p)
                    columns.append(pa.array(v, mask=np.isnan(v) if fill is None or keep_fill else np.isnan(v) | (v == fill)))
                yield pa.RecordBatch.from_arrays([pa.array(dates.astype(object), pa.date32()), *columns], ["date", *names])

    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(len(paths)).mapInArrow(run, ", ".join(["date date", *(f"`{n}` double" for n in names)]))


def _time(c) -> str:
    return c.dim_names(c.place(c.field_name()))[0]


def _axis(cells: DataFrame, index: str, place: str) -> tuple[list[int], np.ndarray]:
    found = cells.groupBy(index).agg(F.min(place).alias("v")).where(F.col(index).isNotNull()).orderBy(index).collect()
    return [r[index] for r in found], np.array([r.v for r in found], "f8")


def year_variables(days: list, ys: np.ndarray, xs: np.ndarray, crs: str, epoch: str, cube: Callable[[str], np.ndarray]) -> list[Var]:
    """A year's variables; days (date, method_flag, n_reporting, r) in order. cube gives the values of a variable over (time, y, x)."""
    start = date.fromisoformat(epoch)
    one = lambda name, values, fill, text: Var(name, ("time",), np.array(values, "f4"), {"long_name": text, "_FillValue": np.array([fill], "f4")})
    whole = lambda name, text, unit: Var(name, ("time", "y", "x"), cube(name), {"long_name": text, "units": unit, "_FillValue": np.array([np.nan], "f4"), "grid_mapping": crs})
    return [
        Var("time", ("time",), np.array([(r.date - start).days for r in days], "i4"), {"units": f"days since {epoch}"}),
        Var("y", ("y",), ys, {"units": "m"}), Var("x", ("x",), xs, {"units": "m"}),
        whole("rainfall", "Kriged daily rainfall", "mm"), whole("kriging_variance", "Kriging estimation variance", "mm^2"),
        one("method_flag", [r.method_flag for r in days], -1, "-1 none, 0 ordinary kriging, 1 with external drift"),
        one("n_stations_reporting", [r.n_reporting for r in days], 0, "stations reporting"),
        one("elevation_rainfall_r", [np.nan if r.r is None else r.r for r in days], np.nan, "correlation used for the choice of method"),
    ]


#: Variables over (time, y, x), and the columns that hold them.
CUBES = {"rainfall": "rainfall", "kriging_variance": "variance"}


def year_attributes(year: int, crs: str, r_threshold: float, min_stations: int) -> dict:
    return {
        "title": f"Daily kriged rainfall, {year}", "summary": "Ordinary kriging, or kriging with elevation as external drift where it explains the day's rainfall", "crs": crs,
        "r_threshold_for_ked": np.array([r_threshold]), "min_stations_for_ked": np.array([min_stations], "i4"),
    }


def pieces(cells: DataFrame, first: dict[date, int], rows: list[int], height: int, bands: int, values: list[Column]) -> DataFrame:
    """piece, row, col and values: cells by the piece of the record that they belong to, and a row for each piece without a cell.

    first (date -> record) has some thousands of days at most."""
    spark = cells.sparkSession
    days = spark.createDataFrame([(d, k) for d, k in first.items()], "date date, record long")
    piece = (F.col("record") * bands + F.floor((F.col("row") - rows[0]) / height)).cast("long").alias("piece")
    own = cells.where("row IS NOT NULL").join(F.broadcast(days), "date").select(piece, F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), *values)
    marks = spark.range(len(first) * bands).select(F.col("id").alias("piece"))
    return own.unionByName(marks, allowMissingColumns=True).repartition("piece").sortWithinPartitions("piece")


def _chunked(variables: list[Var], height: int, width: int) -> list[hdf5.Variable]:
    """Variables as NetCDF-4 has them: those over time in chunks, the cubes' of whole lines, to be given later."""
    out = []
    for v in variables:
        kind = np.dtype(np.asarray(v.data).dtype.newbyteorder("<"))
        cube = len(v.dims) == 3
        attributes = {k: x if isinstance(x, str) else np.asarray(x) for k, x in v.attributes.items()}
        out.append(hdf5.Variable(v.name, v.dims, kind, attributes, None if cube else np.asarray(v.data), (1, height, width) if cube else (512,) if v.dims == ("time",) else None))
    return out


def write_years(
    paths: dict[int, str], cells: DataFrame, days: DataFrame, grid: DataFrame | None = None, kind: str = "classic", crs: str = "EPSG:32645", epoch: str = EPOCH,
    r_threshold: float = Kriging.r_threshold, min_stations: int = Kriging.min_stations_drift,
) -> None:
    """A NetCDF file for each year: cells (date, row, col, x, y, rainfall, variance), days (date, method_flag, n_reporting, r). kind: classic or netcdf4.

    The driver lays the files out and writes their headers, axes and days, which follow from days and the grid (row, col, x, y; taken
    from the cells unless given). Cells go from the tasks that hold them to their places in the files; none passes through
    the driver. Chunks of NetCDF-4 are deflated by these tasks, and put in their places by a second job, when their sizes
    are known. The files appear when all of them are whole, or not at all; their folder has to be mounted everywhere. Without
    any cell or grid ValueError is raised."""
    if kind not in ("classic", "netcdf4"):
        raise ValueError("the kind is classic or netcdf4")
    spark = cells.sparkSession
    spark.dataSource.register(NetCdf)
    found = sorted(days.where(F.year("date").isin(list(paths))).select("date", "method_flag", "n_reporting", "r").collect(), key=lambda r: r.date)
    own = cells.where(F.year("date").isin(list(paths)))
    cols, xs = _axis(grid or own, "col", "x")
    rows, ys = _axis(grid or own, "row", "y")
    if not rows:
        raise ValueError("without cells or a grid there is no field to write")
    # pieces are runs of lines; where lines are lacking, one piece has all, so that chunks hold equal numbers of lines
    span = rows[-1] - rows[0] + 1
    height = min(span, max(1, PIECE // len(cols))) if span == len(rows) else span
    bands = -(-span // height)
    base = next(iter(paths.values()))
    plan: dict = {"rows": rows, "cols": cols, "height": height, "bands": bands, "variables": list(CUBES), "files": [], "folder": f"{base}.chunks"}
    first: dict[date, int] = {}
    laid = []
    try:
        for year, path in sorted(paths.items()):
            of_year = [r for r in found if r.date.year == year]
            variables = year_variables(of_year, ys, xs, crs, epoch, lambda name, n=len(of_year): np.broadcast_to(np.float32(np.nan), (n, len(ys), len(xs))))
            attributes = year_attributes(year, crs, r_threshold, min_stations)
            plan["files"].append({"path": path, "part": f"{path}.part", "first": len(first)})
            if kind == "classic":
                layout = netcdf3.Layout({"time": None, "y": len(ys), "x": len(xs)}, variables, attributes)
                plan["files"][-1] |= {"begin": {n: layout.spots[n].begin for n in CUBES}, "step": layout.step}
                with open(f"{path}.part", "wb") as f:
                    netcdf3.begin(f, layout, variables, frozenset(CUBES))
            else:
                laid.append((len(of_year), _chunked(variables, min(height, len(rows)), len(cols)), attributes))
            first |= {r.date: len(first) + k for k, r in enumerate(of_year)}
        plan["pieces"] = len(first) * bands
        if kind == "netcdf4":
            os.mkdir(plan["folder"])
        with open(f"{base}.plan", "w") as f:
            json.dump(plan, f)
        values = [F.col(c).cast("float").alias(name) for name, c in CUBES.items()]
        pieces(own, first, rows, height, bands, values).write.format("netcdf").mode("append").option("kind", kind).save(f"{base}.plan")
        if kind == "netcdf4":
            _assemble(spark, plan, laid, {"time": None, "y": len(ys), "x": len(xs)})
    finally:
        for f in [*(f["part"] for f in plan["files"]), f"{base}.plan"]:
            if os.path.exists(f):
                os.remove(f)
        shutil.rmtree(plan["folder"], ignore_errors=True)


def _assemble(spark: SparkSession, plan: dict, laid: list, dims: dict[str, int | None]) -> None:
    """Files around chunks that wait: the driver writes all but the chunks, tasks copy these."""
    with open(os.path.join(plan["folder"], "index")) as f:
        waiting = {(piece, name): where for piece, name, *where in json.load(f)}
    moves = []
    for file, (records, variables, attributes) in zip(plan["files"], laid, strict=True):
        own = range(file["first"] * plan["bands"], (file["first"] + records) * plan["bands"])
        for v in variables:
            if v.data is None:
                v.sizes = [waiting[p, v.name][2] for p in own]
        head, places, end = hdf5.layout(dims, records, variables, attributes)
        with open(file["part"], "wb") as f:
            f.write(head)
            f.truncate(end)
        moves += [(*waiting[p, name], file["part"], to) for name, at in places.items() for p, to in zip(own, at, strict=True)]
    move(spark, moves)
    for f in plan["files"]:
        os.replace(f["part"], f["path"])
