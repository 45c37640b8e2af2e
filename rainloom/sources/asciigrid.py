"""Elevation grids as ESRI ASCII files: read and written by tasks, and a Spark data source.

    asciigrid.load(spark, path)
    spark.dataSource.register(AsciiGrid); spark.read.format("asciigrid").load(path)

give row, col, x, y, z, one row for each cell, row 0 the northern one, z null where the file has NODATA. `load` reads the
file as Spark reads text, in byte ranges from any file system: a first pass counts the ranges' lines, whose running sums
number the lines of each range. The data source goes through the file once on the driver, for files of a person's size."""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .shared import move

NODATA = -9999.0
#: Rows of the grid that one partition reads.
ROWS = 256


@dataclass(frozen=True)
class GridHeader:
    """The six header lines, keys in any case, with the corner or the centre of the lower left cell."""

    ncols: int
    nrows: int
    x_left: float
    y_bottom: float
    cellsize: float
    nodata: float
    lines: int

    @classmethod
    def read(cls, path: str) -> GridHeader:
        with open(path) as f:
            return cls.of([f.readline() for _ in range(6)], path)

    @classmethod
    def of(cls, lines: list[str], path: str) -> GridHeader:
        found: dict[str, float] = {}
        for line in [*lines, *[""] * 6][:6]:
            words = line.split()
            if len(words) != 2:
                raise ValueError(f"{path} has no grid header of six lines")
            found[words[0].lower()] = float(words[1])
        for key in ("ncols", "nrows", "cellsize"):
            if key not in found:
                raise ValueError(f"{path} has no {key}")
        half = found["cellsize"] / 2
        edge = lambda c: found[f"{c}llcorner"] if f"{c}llcorner" in found else found[f"{c}llcenter"] - half
        try:
            return cls(int(found["ncols"]), int(found["nrows"]), edge("x"), edge("y"), found["cellsize"], found.get("nodata_value", NODATA), 6)
        except KeyError as key:
            raise ValueError(f"{path} has no {key}") from None


@dataclass
class _Rows(InputPartition):
    first: int
    last: int
    offset: int  # of the first row's line in the file


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.head = path, GridHeader.read(path)

    def partitions(self) -> list[_Rows]:
        """Runs of ROWS rows, with where each begins: the file is gone through once here, and no task reads what it doesn't need."""
        out = []
        with open(self.path, "rb") as f:
            for _ in range(self.head.lines):
                f.readline()
            for a in range(0, self.head.nrows, ROWS):
                out.append(_Rows(a, min(a + ROWS, self.head.nrows), f.tell()))
                for _ in range(ROWS):
                    f.readline()
        return out

    def read(self, part: _Rows) -> Iterator[pa.RecordBatch]:
        with open(self.path, "rb") as f:
            f.seek(part.offset)
            for row in range(part.first, part.last):
                yield _cells(self.head, row, f.readline(), self.path)


def _cells(h: GridHeader, row: int, line: bytes | str, path: str) -> pa.RecordBatch:
    values = line.split()
    if len(values) != h.ncols:
        raise ValueError(f"row {row} of {path} has {len(values)} values, not {h.ncols}")
    z, cols = np.array(values, float), np.arange(h.ncols, dtype=np.int32)
    x, y = h.x_left + (cols + 0.5) * h.cellsize, h.y_bottom + (h.nrows - row - 0.5) * h.cellsize
    columns = [np.full(h.ncols, row, np.int32), cols, x, np.full(h.ncols, y), np.where(z == h.nodata, np.nan, z)]
    return pa.RecordBatch.from_arrays([pa.array(c, from_pandas=True) for c in columns], ["row", "col", "x", "y", "z"])


class AsciiGrid(DataSource):
    @classmethod
    def name(cls) -> str:
        return "asciigrid"

    def schema(self) -> str:
        return "row int, col int, x double, y double, z double"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"])


def load(spark: SparkSession, path: str) -> DataFrame:
    """The grid, read in byte ranges. ValueError for a header that isn't one, or a number of lines that isn't the header's; a line without a value for each column fails its task."""
    text = spark.read.text(path).select("value", F.col("_metadata.file_block_start").alias("start"))
    # a row for each range of the file, some hundred megabytes each
    counts = sorted((r.start, r["count"]) for r in text.groupBy("start").count().collect())
    head = GridHeader.of([r.value for r in text.where("start = 0").limit(6).collect()], path)
    first = dict(zip([start for start, _ in counts], np.cumsum([0, *(n for _, n in counts)]).tolist(), strict=False))
    if (found := sum(n for _, n in counts) - head.lines) < head.nrows:
        raise ValueError(f"{path} has {found} rows, not {head.nrows}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = dict(first)  # a range's lines come in order, whatever ranges a task has
        for batch in batches:
            for line, start in zip(batch.column("value"), batch.column("start").to_pylist(), strict=True):
                row = at[start] - head.lines
                at[start] += 1
                if 0 <= row < head.nrows:
                    yield _cells(head, row, line.as_py(), path)

    return text.mapInArrow(run, "row int, col int, x double, y double, z double")


def lines(grid: DataFrame, cell: float, nodata: float = NODATA) -> DataFrame:
    """(line, text): the file's lines in order; values to three decimals, missing ones as NODATA."""
    text = F.when(F.col("z").isNull() | F.isnan("z"), F.format_string("%.0f", F.lit(nodata))).otherwise(F.format_string("%.3f", "z"))
    rows = grid.groupBy("row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", text.alias("t")))), lambda c: c["t"]), " ").alias("text"))
    corner = grid.agg((F.max("col") + 1).alias("nc"), (F.max("row") + 1).alias("nr"), (F.min("x") - cell / 2).alias("x"), (F.min("y") - cell / 2).alias("y"))
    head = corner.select(F.explode(F.array(*[F.struct(F.lit(k - 6).alias("line"), t.alias("text")) for k, t in enumerate((
        F.format_string("ncols %d", "nc"), F.format_string("nrows %d", "nr"), F.format_string("xllcorner %.6f", "x"), F.format_string("yllcorner %.6f", "y"), F.lit(f"cellsize {cell:.6f}"), F.lit(f"NODATA_value {nodata:.0f}"),
    ))])).alias("h")).select("h.*")
    return head.unionByName(rows.select(F.col("row").alias("line"), "text"))


def write(grid: DataFrame, path: str, cell: float, nodata: float = NODATA) -> None:
    """The grid as one file, which appears when it is whole; its folder has to be mounted everywhere.

    Tasks write runs of lines, in order, into files of their own; when the sizes of all are known, tasks put them in their
    places. No line passes through the driver."""
    spark, folder, part = grid.sparkSession, f"{path}.lines", f"{path}.part"

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, side, size = None, os.path.join(folder, uuid.uuid4().hex), 0
        with open(side, "wb") as f:
            for batch in batches:
                for line, text in zip(batch.column("line").to_pylist(), batch.column("text"), strict=True):
                    first = line if first is None else first
                    size += f.write(text.as_py().encode() + b"\n")
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (first, side, size)], schema=pa.schema([("first", pa.int64()), ("side", pa.string()), ("size", pa.int64())]))

    os.mkdir(folder)
    try:
        sorted_ = lines(grid, cell, nodata).select(F.col("line").cast("long").alias("line"), "text").repartitionByRange("line").sortWithinPartitions("line")
        runs = sorted((r for r in sorted_.mapInArrow(put, "first long, side string, size long").collect() if r.first is not None), key=lambda r: r.first)
        ends = np.cumsum([0, *(r.size for r in runs)]).tolist()
        with open(part, "wb") as f:
            f.truncate(ends[-1])
        move(spark, [(r.side, 0, r.size, part, to) for r, to in zip(runs, ends, strict=False)])
        os.replace(part, path)
    finally:
        if os.path.exists(part):
            os.remove(part)
        shutil.rmtree(folder, ignore_errors=True)
