"""FLAC media columns.

`to_flac` makes byte payloads into lossless 8-bit audio; `query` writes the streams to the shared folder and reads them
from there; `pcm_blocks` decodes streams to PCM blocks with seekable sample offsets; `features` describes streams by the
same blocks. Both verify every frame's checksums.

Defined results: a null or empty text is the payload of 64 zero bytes; a null media value yields no PCM blocks; a
stream that fails a checksum raises FlacError in `features`, and in `pcm_blocks` yields one row with the error; rows
that repeat are stored each; a null id is returned as null; extra columns are ignored; an empty table gives no rows."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flac
from .common import materialize, slices

UNIT = 64
#: Bytes that are coded at a time.
CODE_BYTES = 1_000_000


def payload(text: bytes) -> bytes:
    """The text with zero bytes up to a positive multiple of 64."""
    return text + bytes(-len(text) % UNIT or (0 if text else UNIT))


def to_flac(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes of the text and its payload as a FLAC stream in `media`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text", CODE_BYTES):
                media = flac.encode([payload(x) for x in texts])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(x) for x in texts], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, n_bytes long, media binary")


def _blocks(head: flac.Head, pcm: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(first sample, samples, PCM bytes) of each block of a decoded stream, cut where its frames begin."""
    size, step = head.channels * -(-head.bits // 8), head.block or flac.BLOCK
    for a in range(0, head.samples, step):
        yield a, min(step, head.samples - a), pcm[a * size : (a + step) * size]


def _feature(samples: np.ndarray) -> str:
    """Mean and energy in thousandths, zero crossings and peak, from integers alone."""
    n, negative = len(samples), samples < 0
    energy = int((samples.astype(np.int16) ** 2).sum(dtype=np.int64))
    crossings = int(np.count_nonzero(negative[1:] != negative[:-1]))
    return f"mean={int(samples.sum(dtype=np.int64)) * 1000 // n};energy={energy * 1000 // n};crossings={crossings};peak={max(int(samples.max()), -int(samples.min()))}"


def features(media: DataFrame) -> DataFrame:
    """Decodes `media` and returns doc_id, n_bytes, the payload's and the stream's digests, and a feature string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, streams in slices(batch, "media", CODE_BYTES):
                rows = []
                for stream, signed in zip(streams, flac.decode(streams), strict=True):
                    digest, count, last = hashlib.sha256(), 0, b""
                    for first, n, pcm in _blocks(flac.read_head(stream), signed):
                        read = pcm.translate(flac._SIGN)
                        digest.update(read)
                        count, last = first + n, (last + read)[-UNIT:]
                    rows.append((count, digest.hexdigest(), zlib.crc32(last[-UNIT:]), len(stream), hashlib.sha256(stream).hexdigest(), _feature(np.frombuffer(signed, np.int8))))
                cols = [pa.array(c) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), *cols], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)


def pcm_blocks(media: DataFrame, key: str = "doc_id", column: str = "media") -> DataFrame:
    """Rows (key, block, first_sample, n_samples, pcm, error): a block for each frame, which `flac.seek` also finds alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for own, stream in zip(batch.column("__key").to_pylist(), batch.column("__media").to_pylist(), strict=True):
                if stream is None:
                    continue
                try:
                    head = flac.read_head(stream)
                    pcm = flac.decode([stream])[0]
                except flac.FlacError as error:
                    rows.append({"key": own, "error": str(error)})
                    continue
                rows += [{"key": own, "block": k, "first_sample": a, "n_samples": n, "pcm": part} for k, (a, n, part) in enumerate(_blocks(head, pcm))]
            yield pa.RecordBatch.from_pylist(rows, schema)

    kind = media.schema[key].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([("key", to_arrow_type(media.schema[key].dataType)), ("block", pa.int64()), ("first_sample", pa.int64()), ("n_samples", pa.int64()), ("pcm", pa.binary()), ("error", pa.string())])
    own = media.select(F.col(key).alias("__key"), F.col(column).alias("__media"))
    return own.mapInArrow(run, f"key {kind}, block long, first_sample long, n_samples long, pcm binary, error string").withColumnRenamed("key", key)


def query(docs: DataFrame) -> DataFrame:
    """Stores all documents as FLAC streams in the shared folder and describes them as read from there."""
    return features(materialize(to_flac(docs), "media", compression="zstd"))
