"""Token ids in patched frame-of-reference blocks.

Texts are tokenised and written in ascending doc_id order. A document's ids are cut into blocks of 128. A block stores
its minimum, the ids less the minimum packed at the width that holds a percentile of them (of four percentiles the one
that makes the block smallest), and the others' positions and high bits as exceptions; an index tells where each block
starts, so any block can be read alone.

The files are Parquet containers: rows (part, seq, doc_id, n_tokens, payload), one payload per document. Parts are
ranges of doc_id in order, so a document's start is the ids of earlier parts plus those before it in its own.

Payload, little-endian: u32 ids, u32 blocks; the index, u32 for each block's first byte after the index, and the end;
then the blocks: u32 minimum, u8 width, u8 exceptions, packed ids (first id in the lowest bits), u8 exception
positions, u32 exception high bits. A document's last block may hold fewer ids.

Defined results: a null text is empty and yields the end id alone; a null doc_id comes first, and rows that share a doc_id
are ordered by xxhash64 of the text, so that they too are dealt out; repeated rows are written again; extra columns are ignored; an empty table gives no rows."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import expand, materialize, slices

BLOCK = 128
#: Parts of a block's ids that its packed width may hold.
PERCENTILES = (0.8, 0.9, 0.97, 1)
END_ID = 1
#: Pre-tokens whose ids a worker keeps.
CACHE = 600_000


# -- blocks ---------------------------------------------------------------------------------------------------------


def encode_blocks(ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """The payload of each document; ids: all their ids in a row, lengths: how many each has."""
    n_blocks = -(-lengths // BLOCK)
    total = int(n_blocks.sum())
    if not total:
        return [struct.pack("<III", 0, 0, 0)] * len(lengths)
    first_block = np.cumsum(n_blocks) - n_blocks
    grid = np.empty(total * BLOCK, np.uint32)
    slot = np.repeat(first_block * BLOCK - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(ids))
    filled = np.zeros(total * BLOCK, bool)
    filled[slot] = True
    grid[:] = np.iinfo(np.uint32).max
    grid[slot] = ids
    grid = grid.reshape(total, BLOCK)
    low = grid.min(axis=1)
    delta = np.where(filled.reshape(total, BLOCK), grid - low[:, None], np.uint32(0))
    # frexp gives the number of bits of a positive integer
    need = np.frexp(delta.astype(np.float64))[1].astype(np.uint8)
    need_sorted = np.sort(need, axis=1)
    widths = need_sorted[:, [round(p * BLOCK) - 1 for p in PERCENTILES]]
    costs = [w.astype(np.int64) * (BLOCK // 8) + 5 * np.count_nonzero(need > w[:, None], axis=1) for w in widths.T]
    width = widths[np.arange(total), np.argmin(costs, axis=0)]
    high = delta >> width[:, None].astype(np.uint32)
    block_of, position = np.nonzero(high)
    count = np.bincount(block_of, minlength=total)
    held = np.minimum(BLOCK, np.repeat(lengths, n_blocks) - (np.arange(total) - np.repeat(first_block, n_blocks)) * BLOCK)
    packed = -(-width.astype(np.int64) * held // 8)
    sizes = 6 + packed + 5 * count
    begins = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    out[begins[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    out[begins + 4] = width
    out[begins + 5] = count
    for w in np.unique(width[width > 0]):
        own = np.flatnonzero(width == w)
        bits = np.unpackbits(delta[own].astype("<u4").view(np.uint8).reshape(len(own), BLOCK, 4), axis=2, bitorder="little", count=int(w))
        rows = np.packbits(bits.reshape(len(own), -1), axis=1, bitorder="little")
        out[expand(begins[own] + 6, packed[own])] = rows[np.arange(rows.shape[1]) < packed[own, None]]
    if len(block_of):
        at = begins + 6 + packed
        rank = np.arange(len(block_of)) - (np.cumsum(count) - count)[block_of]
        out[at[block_of] + rank] = position
        out[(at[block_of] + count[block_of] + 4 * rank)[:, None] + np.arange(4)] = high[block_of, position].astype("<u4").view(np.uint8).reshape(-1, 4)
    data, payloads = out.tobytes(), []
    stops = np.append(begins, len(data))
    for n, k, a in zip(lengths.tolist(), n_blocks.tolist(), first_block.tolist(), strict=True):
        index = (stops[a : a + k + 1] - stops[a]).astype("<u4").tobytes()
        payloads.append(struct.pack("<II", n, k) + index + data[stops[a] : stops[a + k]])
    return payloads


def _decode(data: np.ndarray, begins: np.ndarray, held: np.ndarray) -> np.ndarray:
    """The (blocks, 128) ids of the blocks that begin there and hold so many."""
    low = np.ascontiguousarray(data[begins[:, None] + np.arange(4)]).view("<u4").ravel()
    width, count = data[begins + 4].astype(np.int64), data[begins + 5].astype(np.int64)
    packed = -(-width * held // 8)
    out = np.zeros((len(begins), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        rows = np.zeros((len(own), w * (BLOCK // 8)), np.uint8)
        rows[np.arange(rows.shape[1]) < packed[own, None]] = data[expand(begins[own] + 6, packed[own])]
        bits = np.unpackbits(rows, axis=1, bitorder="little").reshape(len(own), BLOCK, w)
        full = np.zeros((len(own), BLOCK, 32), np.uint8)
        full[:, :, :w] = bits
        out[own] = np.packbits(full, axis=2, bitorder="little").view("<u4")[:, :, 0]
    if count.any():
        at = begins + 6 + packed
        block_of = np.repeat(np.arange(len(begins)), count)
        rank = np.arange(len(block_of)) - np.repeat(np.cumsum(count) - count, count)
        high = np.ascontiguousarray(data[(at[block_of] + count[block_of] + 4 * rank)[:, None] + np.arange(4)]).view("<u4").ravel()
        out[block_of, data[at[block_of] + rank]] |= high << width[block_of].astype(np.uint32)
    return out + low[:, None]


def decode_blocks(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row, and how many each payload has."""
    heads = [struct.unpack_from("<II", x) for x in payloads]
    data = np.frombuffer(b"".join(payloads), np.uint8)
    lengths = np.array([n for n, _ in heads], np.int64)
    blocks = np.array([k for _, k in heads], np.int64)
    sizes = np.fromiter(map(len, payloads), np.int64, len(payloads))
    base = np.cumsum(sizes) - sizes
    at = expand(base + 8, 4 * (blocks + 1))
    index = data[at].view("<u4").astype(np.int64)
    is_end = np.zeros(len(index), bool)
    is_end[np.cumsum(blocks + 1) - 1] = True
    begins = (index + np.repeat(base + 8 + 4 * (blocks + 1), blocks + 1))[~is_end]
    number = np.arange(len(begins)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    held = np.minimum(BLOCK, np.repeat(lengths, blocks) - number * BLOCK)
    grid = _decode(data, begins, held) if len(begins) else np.zeros((0, BLOCK), np.uint32)
    return grid.ravel()[expand((np.cumsum(blocks) - blocks) * BLOCK, lengths)], lengths


def read_block(payload: bytes, k: int) -> np.ndarray:
    """The ids of one block alone, found through the index."""
    n, blocks = struct.unpack_from("<II", payload)
    if not 0 <= k < blocks:
        raise IndexError(k)
    start = 8 + 4 * (blocks + 1) + struct.unpack_from("<I", payload, 8 + 4 * k)[0]
    held = min(BLOCK, n - k * BLOCK)
    return _decode(np.frombuffer(payload, np.uint8), np.array([start]), np.array([held]))[0][:held]


# -- tokens ---------------------------------------------------------------------------------------------------------

#: What keeps a text from the classes by byte. They find the tokenizer's own pre-tokens in ASCII and the Latin letters U+00C0 to U+017F,
#: but for the two signs, the capital I that lower-cases to two characters and the letters that NFC or folding rewrites,
#: without control characters and special tokens.
_UNPLAIN = re.compile("[^\t-\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u0148\u014a-\u017e]|<\\|")
#: The two-byte characters from U+00C0 on: whether _UNPLAIN finds them, and else their lower case.
_LATIN = range(0xC0, 0x180)
_LATIN_UNPLAIN = np.array([bool(_UNPLAIN.match(chr(c))) for c in _LATIN])
_LATIN_LOWER = np.array([c if _UNPLAIN.match(chr(c)) else ord(chr(c).lower()) for c in _LATIN])
#: Bytes by class: 0 white space, 1 letters, 2 digits, 3 other signs, 4 what no plain text holds.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = 1
_CLASS[48:58] = 2
_CLASS[[c for c in range(128) if _UNPLAIN.match(chr(c))]] = _CLASS[0xC0:0xC3] = _CLASS[0xC6:] = 4
#: Contractions are pre-tokens of their own, where no sign stands before them.
_CONTRACTION = re.compile(rb"(?<![!-/:-@\[-`{-~])'(?:s|t|re|ve|m|ll|d)")


class TextEncoder:
    """Encodes texts just as the tokenizers library encodes them whole, but each distinct pre-token only once.

    Pre-tokens never span white space or a change between letters, digits and signs, and the model works on each
    alone; texts in which bytes don't show those bounds are encoded whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.whole = Tokenizer.from_file(path)
        self.alone = Tokenizer(self.whole.model)
        self.alone.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        size = self.whole.get_vocab_size()
        self.ends = np.zeros(size, bool)
        self.ends[[i for token, i in self.whole.get_vocab().items() if token.endswith("</w>")]] = True
        # known pre-tokens by number, their ids in a row with the bounds of each, and in how many slices each was
        self.known: dict[bytes, int] = {}
        self.ids, self.bounds, self.uses = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _learn(self, new: list[bytes]) -> None:
        # one part after the other, for what the library returns takes far more memory than the ids
        parts = (b" ".join(new[a : a + 1000]).decode() for a in range(0, len(new), 1000))
        ids = np.concatenate([np.array(self.alone.encode_batch_fast([x], add_special_tokens=False)[0].ids, np.uint32) for x in parts])
        ends = np.flatnonzero(self.ends[ids]) + 1
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(ends)), strict=True))
        self.bounds = np.append(self.bounds, ends + len(self.ids))
        self.ids = np.append(self.ids, ids)
        self.uses = np.append(self.uses, np.zeros(len(new), np.int32))

    def _forget(self) -> None:
        """Keeps half as many pre-tokens as the cache may hold, those of the most slices."""
        keep = np.sort(np.argsort(-self.uses, kind="stable")[: CACHE // 2])
        names, starts, lens = list(self.known), self.bounds[keep], np.diff(self.bounds)[keep]
        self.known = {names[i]: k for k, i in enumerate(keep.tolist())}
        self.ids, self.bounds, self.uses = self.ids[expand(starts, lens)], np.append(0, np.cumsum(lens)), self.uses[keep]

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """The number of each word; new ones are learnt."""
        if not len(words):
            return np.zeros(0, np.int64)
        coded = words.dictionary_encode()
        # no word holds a space
        names = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary.cast(pa.binary())), b" ")[0].as_py().split(b" ")
        if len(self.known) > CACHE:
            self._forget()
        number = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        if len(new := np.flatnonzero(number < 0)):
            number[new] = np.arange(len(self.known), len(self.known) + len(new))
            self._learn([names[i] for i in new.tolist()])
        self.uses[number] += 1
        return number[coded.indices.to_numpy()]

    @staticmethod
    def _unplain(data: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Where _UNPLAIN finds something in the bytes of some texts. Lower-cases their two-byte letters."""
        lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))
        letter = ((data[lead].astype(np.int64) & 31) << 6 | data[lead + 1] & 63) - _LATIN.start
        low = _LATIN_LOWER[letter]
        data[lead], data[lead + 1] = low >> 6 | 0xC0, low & 63 | 0x80
        sign = np.flatnonzero(data == ord("<"))
        return np.concatenate([np.flatnonzero(kind == 4), lead[_LATIN_UNPLAIN[letter]], sign[data[sign + 1] == ord("|")]])

    def _plain(self, data: np.ndarray, kind: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids and how many each text has; data: the texts in lower case, a space after each; stops: where each ends."""
        new = kind != 0
        solid = new.copy()
        new[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        blob = data.tobytes()
        if found := [m.span() for m in _CONTRACTION.finditer(blob)] if b"'" in blob else []:
            begin, end = np.array(found).T
            new[begin], new[end] = True, kind[end] != 0
            inner = expand(begin + 1, end - begin - 1)
            new[inner] = False
        starts = np.flatnonzero(new)
        letters = data[solid]
        offsets = np.append(np.flatnonzero(new[solid]), len(letters)).astype(np.int64)
        code = self._numbers(pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]))
        lens = np.diff(self.bounds)[code]
        ids = self.ids[expand(self.bounds[code], lens)]
        return ids, np.diff(np.append(0, np.cumsum(lens))[np.searchsorted(starts, stops)], prepend=0)

    def encode_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        blob = b" ".join([*texts, b""])
        blob.decode()  # bytes that are no UTF-8 are an error
        data = np.frombuffer(bytearray(blob.lower()), np.uint8)
        kind = _CLASS[data]
        stops = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        odd = np.zeros(len(texts), bool)
        odd[np.searchsorted(stops, self._unplain(data, kind), "right")] = True
        if not odd.any():
            return self._plain(data, kind, stops)
        sizes = np.diff(stops, prepend=0)
        keep = np.repeat(~odd, sizes)
        ids, lengths = self._plain(data[keep], kind[keep], np.cumsum(sizes[~odd]))
        plain = iter(np.split(ids, np.cumsum(lengths)[:-1]))
        out = [np.array(self.whole.encode(x.decode(), add_special_tokens=False).ids, np.uint32) if o else next(plain) for x, o in zip(texts, odd.tolist(), strict=True)]
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, lengths = self.encode_all([x.encode() for x in texts])
        return np.split(ids, np.cumsum(lengths)[:-1]) if texts else []


_encoders: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


# -- files ----------------------------------------------------------------------------------------------------------


def encode_ordered(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Rows (part, seq, doc_id, n_tokens, payload) in ascending doc_id order, part by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, own = TaskContext.get().partitionId(), 0, encoder(path)
        for batch in batches:
            for rows, texts in slices(batch, "text", 2_000_000):
                ids, lengths = own.encode_all(texts)
                n, lengths = len(texts), lengths + 1
                closed = np.full(len(ids) + n, end_id, np.uint32)
                inside = np.ones(len(closed), bool)
                inside[np.cumsum(lengths) - 1] = False
                closed[inside] = ids
                payloads = encode_blocks(closed, lengths)
                yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array(np.arange(seq, seq + n)), rows.column("doc_id"), pa.array(lengths), pa.array(payloads, pa.binary())], ["part", "seq", "doc_id", "n_tokens", "payload"])
                seq += n

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # the row number tells repeated rows apart, so a range of one document's copies can be cut as well
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("__tag"), F.monotonically_increasing_id().alias("__row"))
    order = [F.col("doc_id").asc_nulls_first(), "__tag", "__row"]
    return own.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, "part int, seq long, doc_id long, n_tokens long, payload binary")


def read_back(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                rows = batch.slice(a, 256)
                ids, lengths = decode_blocks(rows.column("payload").to_pylist())
                data = memoryview(ids.astype("<u4").tobytes())
                stops = (4 * np.cumsum(lengths)).tolist()
                crc = [zlib.crc32(data[x:y]) for x, y in zip([0, *stops[:-1]], stops, strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column("part"), rows.column("seq"), rows.column("doc_id"), pa.array(lengths), pa.array(crc, pa.int64())], ["part", "seq", "doc_id", "n_tokens", "ids_crc32"])

    # ids before a document: those of all earlier parts and those before it in its own; a part is one sorted range
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    read = files.select("part", "seq", "doc_id", "payload").mapInArrow(run, "part int, seq long, doc_id long, n_tokens long, ids_crc32 long")
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    return read.withColumn("__inside", inside).join(before, "part").select("doc_id", (F.col("base") + F.col("__inside")).alias("start"), "n_tokens", "ids_crc32")


def query(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return read_back(materialize(encode_ordered(docs, public_tokenizers.path("word_bpe_49k.json")), "tokens"))
