"""Folders for files that one step writes and another reads."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the one that driver and executors share, as spark.checkpoint.dir names it; it goes when the application ends.

    Where the session names none, a temporary one serves a local master; on a cluster that is an error."""
    return _made(spark, f"{_base(spark)}/rainloom-{name}-{uuid.uuid4().hex}")


def application_folder(spark: SparkSession, name: str) -> str:
    """The application's one folder of a name, for what it makes once; it goes when the application ends."""
    return _made(spark, f"{_base(spark)}/rainloom-{name}-{spark.sparkContext.applicationId}")


def _base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='rainloom-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def _made(spark: SparkSession, folder: str) -> str:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return path.toString()


def mounted(folder: str) -> str:
    """The folder as plain files see it; ValueError if it isn't mounted, as grids and NetCDF files need it to be."""
    path = folder.removeprefix("file://").removeprefix("file:")
    if not os.path.isdir(path):
        raise ValueError(f"{folder} isn't mounted on this machine")
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: what several results start from is made once, and survives lost executors."""
    path = f"{new_folder(df.sparkSession, name)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes that are copied at a time.
COPIED = 1 << 24


def move(spark: SparkSession, moves: list[tuple[str, int, int, str, int]]) -> None:
    """Copies runs of bytes (from file, at, size, to file, at) by tasks, those of one file by one task: what tasks wrote aside goes to its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                with open(r["side"], "rb") as source, open(r["part"], "r+b") as f:
                    source.seek(r["at"])
                    f.seek(r["to"])
                    for a in range(0, r["size"], COPIED):
                        f.write(source.read(min(COPIED, r["size"] - a)))
                    f.flush()
                    os.fsync(f.fileno())
            yield pa.RecordBatch.from_arrays([pa.array([len(rows)], pa.int64())], ["n"])

    if moves:
        rows = spark.createDataFrame(moves, "side string, at long, size long, part string, to long").repartition("side")
        if (lacking := len(moves) - sum(r.n for r in rows.mapInArrow(run, "n long").collect())) > 0:
            raise RuntimeError(f"{lacking} runs of bytes are lacking")
