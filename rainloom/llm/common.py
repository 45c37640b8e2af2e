"""What the training-data operators share: table access, shared storage and vectorised text scanning."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Stands for a null doc_id inside the operators: it sorts before every other id.
NULL_ID = -(2**63)
#: Bytes of text handled at a time by the vectorised scanners.
SLICE_BYTES = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it.

    Where the session names none, a temporary one serves a local master; on a cluster that is an error, for each machine
    would write to a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='rainloom-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it again: later stages restart from files, not lineage.

    options are those of Spark's Parquet writer. The files go when the application ends, or earlier by `discard`."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/rainloom-{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    system, target = _file_system(spark, path)
    system.deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a table that materialize() wrote and nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        system, target = _file_system(df.sparkSession, path)
        if target.getName().startswith("rainloom-"):
            system.delete(target, True)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cuts a batch into runs of whole rows with about `limit` bytes of text; null texts come as empty ones.

    Only the texts of one run at a time are taken out of the batch."""
    texts = batch.column(column).cast(pa.binary())
    start = size = 0
    for i, n in enumerate(pc.binary_length(texts).fill_null(0).to_pylist()):
        size += n
        if size >= limit or i == len(texts) - 1:
            yield batch.slice(start, i + 1 - start), [x or b"" for x in texts.slice(start, i + 1 - start).to_pylist()]
            start, size = i + 1, 0


def sample_texts(df: DataFrame, column: str, limit: int) -> list:
    """The first rows of df whose texts have `limit` bytes together, about; at least one row, if there is one.

    Rows come to the driver partition by partition, so df should be a sample that is bounded by rows already."""
    out, total = [], 0
    for row in df.toLocalIterator():
        total += len((row[column] or "").encode())
        if out and total > limit:
            break
        out.append(row)
    return out


def runs_of(texts: list[bytes], limit: int) -> Iterator[slice]:
    """Neighbouring texts of about `limit` bytes together, at least one."""
    start = size = 0
    for i, x in enumerate(texts):
        size += len(x)
        if size >= limit or i == len(texts) - 1:
            yield slice(start, i + 1)
            start, size = i + 1, 0


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    found = np.zeros(256, bool)
    for low, high in ranges:
        found[low : high + 1] = True
    return found


#: Members of [^\x20\x09-\x0D].
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Members of [^\x00-\x2F\x3A-\x60\x7B-\x7F].
ALNUM = ~byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


class Words:
    """Words of some texts, found in one pass over their joined bytes.

    data: the texts, a space after each; starts, ends: bounds of every word in data; doc: each word's text;
    first: each text's first word, and the number of words at the end."""

    def __init__(self, texts: list[bytes], members: np.ndarray):
        self.blob = b" ".join([*texts, b""])
        self.data = np.frombuffer(self.blob, np.uint8)
        inside = members[self.data]
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
        self.starts, self.ends = edge[::2], edge[1::2]
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(x) + 1 for x in texts], out=bounds[1:])
        self.bounds = bounds
        self.first = np.searchsorted(self.starts, bounds)
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(self.first))
        self.inside = inside

    def __len__(self) -> int:
        return len(self.starts)

    def array(self) -> pa.Array:
        """The words as an Arrow array."""
        offsets = np.zeros(len(self) + 1, np.int64)
        np.cumsum(self.ends - self.starts, out=offsets[1:])
        data = self.data[self.inside]
        return pa.Array.from_buffers(pa.large_binary(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(data)])

    def joined(self) -> tuple[bytes, np.ndarray]:
        """All words with one space after each, and where each begins there, with the end at the end."""
        keep = self.inside.copy()
        keep[1:] |= self.inside[:-1]
        data = self.data[keep]
        offsets = np.zeros(len(self) + 1, np.int64)
        np.cumsum(self.ends - self.starts + 1, out=offsets[1:])
        data[offsets[1:] - 1] = 32
        return data.tobytes(), offsets


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over unsigned integers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenated ranges starts[i] .. starts[i] + lengths[i]."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """The least of every n neighbours."""
    width = 1
    while 2 * width <= n:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[: len(x) - (n - width)], x[n - width :]) if n > width else x
