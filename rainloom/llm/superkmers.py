"""Exact substring dedup over word windows by super-k-mer partitioning.

Each window of 13 consecutive words has a minimiser, the least hash of its two-word runs. Consecutive windows with
the same minimiser travel together as one packed string, a super-k-mer, to the minimiser's bucket. Minimisers that would
bring one bucket too much, as a sample of documents tells, are split by their windows' second minimiser, the greatest
hash: equal windows still meet, and what the sample holds decides on places alone, not on results. Among equal strings
of a slice of documents only those of the slice's least document travel; the others are covered whole, whatever else
there is, and go on as ranges. All that goes to one bucket is one compressed row. So copies and common passages bring a
bucket one place for each slice, not for each document. A bucket sorts the windows of its distinct strings, counts equal
neighbours exactly (hash order, then word by word) and knows for each the least document it starts in.

Defined results: words are runs of [^\\x20\\x09-\\x0D]; a null or wordless text has no words and keeps the empty text;
documents of fewer than 13 words lose nothing; a null doc_id counts as smaller than every other and is returned as null;
rows with the same doc_id never remove words from each other; extra columns are ignored; an empty table gives no rows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import NOT_SPACE, NULL_ID, Words, discard, expand, materialize, mix, partitions, sliding_min, slices

WINDOW = 13
RUN = 2
#: Buckets for each shuffle partition, at least, and bytes of text for each bucket, at most: a bucket is what one Python call holds.
BUCKETS, BUCKET_BYTES = 6, 8_000_000
#: Documents that are looked at for minimisers to split, about: so many, and so many more for each partition.
LOOKED_AT, LOOKED_AT_EACH = 10_000, 4
#: Text that one slice packs at a time.
PACK_BYTES = 6_000_000
#: Compression of blobs: zstd's level, the size of its dictionary, and the texts that it is made from, about.
LEVEL, DICTIONARY_BYTES, SAMPLE = 6, 32_768, 300
_ODD = np.uint64(0x9E3779B97F4A7C15)


NONE = np.zeros(0, np.uint64)


def minimisers(words: Words, hot: np.ndarray = NONE, window: int = WINDOW, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """The windows' first words, and their minimisers; for those in `hot`, sorted, a hash of the minimiser and the second one."""
    if len(words) < window:
        return np.zeros(0, np.int64), NONE
    coded = words.array().dictionary_encode()
    each = np.array([xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    h = each[coded.indices.to_numpy()]
    runs = h[: len(h) - run + 1].copy()
    for j in range(1, run):
        runs = runs * _ODD + h[j : len(h) - run + 1 + j]
    mixed = mix(runs)
    begins = np.flatnonzero(words.doc[: len(words) - window + 1] == words.doc[window - 1 :])
    least = sliding_min(mixed, window - run + 1)[begins]
    if len(hot):
        at = np.flatnonzero(hot[np.minimum(np.searchsorted(hot, least), len(hot) - 1)] == least)
        if len(at):
            greatest = ~sliding_min(~mixed, window - run + 1)[begins[at]]
            least[at] = mix(least[at] * _ODD + greatest)
    return begins, least


def super_kmers(words: Words, hot: np.ndarray = NONE, window: int = WINDOW) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """The packed strings, their first and end words, and their minimisers."""
    begins, least = minimisers(words, hot, window)
    if not len(begins):
        return [], begins, begins, least
    new = np.ones(len(begins), bool)
    new[1:] = (np.diff(begins) != 1) | (least[1:] != least[:-1])
    at = np.flatnonzero(new)
    last = begins[np.append(at[1:], len(begins)) - 1] + window
    text, offsets = words.joined()
    strings = [text[a:b] for a, b in zip(offsets[begins[at]].tolist(), (offsets[last] - 1).tolist(), strict=True)]
    return strings, begins[at], last, least[at]


class Codec:
    """Compresses blobs, with a dictionary that keeps small ones small too."""

    def __init__(self, words: bytes):
        shared = zstandard.ZstdCompressionDict(words) if words else None
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared).compress
        self.decompress = zstandard.ZstdDecompressor(dict_data=shared).decompress


def sampled(docs: DataFrame, one_in: int) -> DataFrame:
    """One in so many documents, by a hash of id and text: the same ones on every run."""
    return docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(one_in)) == 0)


def dictionary(docs: DataFrame, rows: int) -> bytes:
    """A compression dictionary from some texts of so many; it only makes blobs smaller and none is needed for an empty table."""
    texts = sampled(docs, max(1, rows // SAMPLE)).where(F.length("text") > 0).select(F.substring("text", 1, 20_000).alias("t")).orderBy(F.xxhash64("t"), "t").limit(2 * SAMPLE)
    texts = [r.t.encode() for r in texts.collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [t[a : a + 500] for t in texts for a in range(0, len(t), 500)]).as_bytes()
    except zstandard.ZstdError:  # too little text to learn from
        return b""


def hot_minimisers(docs: DataFrame, rows: int, n_partitions: int, window: int = WINDOW) -> np.ndarray:
    """Minimisers, sorted, that alone bring more than half of a partition's mean share: 2 * n_partitions at most, by the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch, "text", PACK_BYTES):
                strings, _, _, least = super_kmers(Words(texts, NOT_SPACE), window=window)
                first = dict(zip(strings, least.tolist(), strict=True))
                keys, index = np.unique(np.array([*first.values()], np.uint64), return_inverse=True)
                size = np.bincount(index, [len(x) for x in first], minlength=len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(size)], ["key", "size"])

    one_in = max(1, rows // (LOOKED_AT + LOOKED_AT_EACH * n_partitions))
    sizes = sampled(docs, one_in).select("text").mapInArrow(run, "key long, size long").groupBy("key").agg(F.sum("size").alias("size"))
    sizes = materialize(sizes, "minimisers")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    found = [r.key for r in sizes.where(F.col("size") * (2 * n_partitions) > total).select("key").collect()]
    discard(sizes)
    return np.sort(np.array(found, np.int64).view(np.uint64))


def pack(codec: Codec, strings: list[bytes], code: np.ndarray, ids: np.ndarray, tags: np.ndarray, begins: np.ndarray) -> bytes:
    head = np.array([len(strings), len(code)], np.int32)
    sizes = np.fromiter(map(len, strings), np.int32, len(strings))
    with np.errstate(over="ignore"):
        parts = [head, sizes, np.diff(code, prepend=0).astype(np.int32), np.diff(ids, prepend=np.int64(0)), tags.astype(np.uint32), begins.astype(np.int32)]
    # bytes of equal weight stand together
    planes = [x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes() for x in parts[1:]]
    return codec.compress(b"".join([head.tobytes(), *planes, *strings]))


def unpack(codec: Codec, blob: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = codec.decompress(blob)
    n, m = np.frombuffer(data, np.int32, 2).tolist()
    at, out = 8, []
    for kind, count in ((np.int32, n), (np.int32, m), (np.int64, m), (np.uint32, m), (np.int32, m)):
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(data, np.uint8, count * size, at).reshape(size, count).T).view(kind).ravel())
        at += count * size
    out[1], out[2] = np.cumsum(out[1], dtype=np.int64), np.cumsum(out[2], dtype=np.int64)
    stops = (at + np.cumsum(out[0], dtype=np.int64)).tolist()
    return [data[a:b] for a, b in zip([at, *stops][: len(stops)], stops, strict=True)], *out[1:]


def scatter(docs: DataFrame, n_buckets: int, shared: bytes = b"", hot: np.ndarray = NONE, window: int = WINDOW) -> DataFrame:
    """Rows (bucket, whole, blob): the super-k-mers of each slice of documents, by bucket, and with `whole` the ranges
    that are covered already, to any bucket. shared: a compression dictionary; hot: minimisers to split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared)
        for batch in batches:
            for part, texts in slices(batch, "text", PACK_BYTES):
                words = Words(texts, NOT_SPACE)
                strings, begins, ends, least = super_kmers(words, hot, window)
                if not strings:
                    continue
                tag = np.array([zlib.crc32(x) for x in texts], np.uint32)
                doc = words.doc[begins]
                ids, tags, first = part.column("doc_id").to_numpy()[doc], tag[doc], words.first[doc]
                coded = pa.array(strings, pa.large_binary()).dictionary_encode()
                code, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
                lowest = np.full(len(distinct), np.iinfo(np.int64).max)
                np.minimum.at(lowest, code, ids)
                later = ids > lowest[code]
                bucket = (least % np.uint64(n_buckets)).astype(np.int64)
                travel = np.flatnonzero(~later)
                order = travel[np.argsort(bucket[travel], kind="stable")]
                cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                targets, rows = bucket[order][cuts].tolist(), []
                for own in np.split(order, cuts[1:]):
                    used, local = np.unique(code[own], return_inverse=True)
                    rows.append(pack(codec, [distinct[k] for k in used], local, ids[own], tags[own], begins[own] - first[own]))
                if later.any():
                    # the end words stand where codes do elsewhere
                    targets.append(int(mix(ids[:1].view(np.uint64))[0] % np.uint64(n_buckets)))
                    rows.append(pack(codec, [], (ends - first)[later], ids[later], tags[later], (begins - first)[later]))
                whole = np.arange(len(rows)) >= len(rows) - bool(later.any())
                yield pa.RecordBatch.from_arrays([pa.array(targets, pa.int64()), pa.array(whole), pa.array(rows, pa.binary())], ["bucket", "whole", "blob"])

    return docs.mapInArrow(run, "bucket long, whole boolean, blob binary")


def least_documents(strings: list[bytes], least: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all windows of the strings: the string, the first word in it, the least document that any equal window starts in.

    least: each string's least document."""
    words = Words(strings, NOT_SPACE)
    code = words.array().dictionary_encode().indices.to_numpy().astype(np.int64)
    begins = np.flatnonzero(words.doc[: len(words) - window + 1] == words.doc[window - 1 :])
    h = np.zeros(len(begins), np.uint64)
    mixed = mix(code.astype(np.uint64) + np.uint64(1))
    for j in range(window):
        h = h * _ODD + mixed[begins + j]
    order = np.argsort(h)
    at = begins[order]
    first = np.ones(len(at), bool)
    first[1:] = np.diff(h[order]) != 0
    again = np.flatnonzero(~first)
    heads = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
    if any((code[at[again] + j] != code[at[heads[again]] + j]).any() for j in range(window)):  # hashes collide: sort by words
        order = np.lexsort([code[begins + j] for j in reversed(range(window))])
        at = begins[order]
        first[1:] = np.any([code[at[1:] + j] != code[at[:-1] + j] for j in range(window)], axis=0)
    owner = words.doc[begins]
    low = np.empty(len(begins), np.int64)
    if len(at):
        starts = np.flatnonzero(first)
        low[order] = np.repeat(np.minimum.reduceat(least[owner[order]], starts), np.diff(starts, append=len(at)))
    return owner, begins - words.first[owner], low


def covered(codec: Codec, blobs: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one bucket: ids, tags, first and last words of covered ranges."""
    parts = [unpack(codec, x) for x in blobs]
    coded = pa.array([s for p in parts for s in p[0]], pa.large_binary()).dictionary_encode()
    strings, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    base = np.cumsum([0, *(len(p[0]) for p in parts[:-1])])
    code = index[np.concatenate([p[1] + b for p, b in zip(parts, base, strict=True)])]
    ids, tags, begins = (np.concatenate([p[k] for p in parts]) for k in (2, 3, 4))
    least = np.full(len(strings), np.iinfo(np.int64).max)
    np.minimum.at(least, code, ids)
    owner, place, low = least_documents(strings, least, window)
    n_windows = np.bincount(owner, minlength=len(strings))
    # a place in a larger document than the string's least one is covered whole
    whole = ids > least[code]
    # the others where a window starts in a still smaller document: runs of such windows, by string
    hit = low < least[owner]
    edge = hit.copy()
    edge[1:] &= ~(hit[:-1] & (owner[1:] == owner[:-1]))
    stop = hit.copy()
    stop[:-1] &= ~(hit[1:] & (owner[1:] == owner[:-1]))
    a, b, whose = place[edge], place[stop], owner[edge]
    runs = np.bincount(whose, minlength=len(strings))
    rest = np.flatnonzero(~whole & (runs[code] > 0))
    some = expand((np.cumsum(runs) - runs)[code[rest]], runs[code[rest]])
    again = np.repeat(rest, runs[code[rest]])
    whole = np.flatnonzero(whole)
    return (
        np.concatenate([ids[whole], ids[again]]),
        np.concatenate([tags[whole], tags[again]]),
        np.concatenate([begins[whole], begins[again] + a[some]]),
        np.concatenate([begins[whole] + n_windows[code[whole]], begins[again] + b[some] + 1]) + window - 1,
    )


def covered_ranges(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, tag (crc32 of the text), and ranges: packed pairs of first and end words, of every document with covered words."""

    def run(group: pa.Table) -> pa.Table:
        codec, whole = Codec(shared), group.column("whole").to_numpy()
        blobs = group.column("blob").to_pylist()
        found = [covered(codec, travelled, window)] if (travelled := [x for x, w in zip(blobs, whole, strict=True) if not w]) else []
        for x, w in zip(blobs, whole, strict=True):
            if w:
                _, end, own_ids, own_tags, begin = unpack(codec, x)
                found.append((own_ids, own_tags, begin, end))
        ids, tags, a, b = (np.concatenate([f[k] for f in found]) for k in range(4))
        order = np.lexsort((a, tags, ids))
        ids, tags, pairs = ids[order], tags[order], np.stack([a[order], b[order]], 1).astype(np.int32)
        cuts = np.flatnonzero((np.diff(ids, prepend=0) != 0) | (np.diff(tags.astype(np.int64), prepend=-1) != 0))
        ranges = [x.tobytes() for x in np.split(pairs, cuts[1:])] if len(cuts) else []
        return pa.table([pa.array(ids[cuts]), pa.array(tags[cuts].astype(np.int64)), pa.array(ranges, pa.binary())], ["doc_id", "tag", "ranges"])

    n, (rows, size) = partitions(docs.sparkSession), docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    buckets = max(BUCKETS * n, -(-size // BUCKET_BYTES))
    shared = dictionary(docs, rows)
    found = scatter(docs, buckets, shared, hot_minimisers(docs, rows, n, window), window).groupBy("bucket").applyInArrow(run, "doc_id long, tag long, ranges binary")
    return found.groupBy("doc_id", "tag").agg(F.collect_list("ranges").alias("ranges"))


def kept_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id (null as NULL_ID), n_words, n_removed and the kept text of each document."""
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ranges = covered_ranges(own, window)
    tagged = own.withColumn("tag", F.crc32(F.col("text").cast("binary")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                n_words, n_removed, kept = [], [], []
                for text, own_ranges in zip(texts, part.column("ranges").to_pylist(), strict=True):
                    words = text.split()
                    n_words.append(len(words))
                    if own_ranges:
                        step = np.zeros(len(words) + 1, np.int32)
                        pairs = np.frombuffer(b"".join(own_ranges), np.int32).reshape(-1, 2)
                        np.add.at(step, pairs[:, 0], 1)
                        np.add.at(step, pairs[:, 1], -1)
                        words = [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0)]
                    n_removed.append(n_words[-1] - len(words))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return tagged.join(ranges, ["doc_id", "tag"], "left").select("doc_id", "text", "ranges").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def query(docs: DataFrame) -> DataFrame:
    return kept_words(docs).select(F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, len(w) AS n, w, unnest(range(1, len(w) + 1)) AS i FROM d),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM p WHERE i + 12 <= n),
m AS (SELECT s, min(doc_id) AS least FROM g GROUP BY s),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM g JOIN m USING (s) WHERE least < doc_id),
k AS (SELECT p.doc_id, count(*) FILTER (WHERE c.i IS NOT NULL) AS n_removed,
             coalesce(string_agg(p.w[p.i], ' ' ORDER BY p.i) FILTER (WHERE c.i IS NULL), '') AS kept
      FROM p LEFT JOIN c ON p.doc_id = c.doc_id AND p.i = c.i GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
