"""SimHash fingerprints and near-duplicate components by deletion-variant signatures.

Two fingerprints within three bits agree, in one of their two 32-bit halves, up to one bit. Each distinct
fingerprint is therefore indexed under its 64 one-wildcard half variants; equal variants meet in an equality
shuffle and the whole distance is verified there. Copies collapse to one fingerprint before that, and a variant's
bucket hands on a spanning forest of its links, never its pairs.

Defined results: a null or wordless text has fingerprint zero and links like any other; rows that repeat are
separate documents with the same fingerprint; a null doc_id counts as smaller than every other and is returned as
null; extra columns are ignored; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import NULL_ID, discard, materialize, slices

SEED = 42
SHINGLE = 3
DISTANCE = 3
#: Buckets up to this many fingerprints compare them all; larger ones look up each fingerprint's neighbours.
COMPARE = 3000


def fingerprints(texts: list[bytes], n: int = SHINGLE) -> np.ndarray:
    """The fingerprints, as signed 64-bit integers, of lower-cased texts' word shingles."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= n:
            hashes.append(xxh64_intdigest(joined, SEED))
            counts[i] = 1
            continue
        stops = np.cumsum([len(w) + 1 for w in words])
        begins = [0, *stops[:-n].tolist()]
        hashes += [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begins, (stops[n - 1 :] - 1).tolist(), strict=True)]
        counts[i] = len(begins)
    out = np.zeros(len(texts), np.int64)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        starts = (np.cumsum(counts) - counts)[full]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        out[full] = np.packbits(2 * ones > counts[full, None], axis=1).view(">u8").ravel().astype(np.uint64).view(np.int64)
    return out


def tag_of(text: Column) -> Column:
    """A hash of the text that tells rows with the same doc_id apart."""
    return F.xxhash64(text.cast("string"))


def fingerprint_table(docs: DataFrame, tagged: bool = False) -> DataFrame:
    """doc_id (null as NULL_ID), fp and, if asked for, the text's tag of each document."""
    names = ["doc_id", "tag"] if tagged else ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text", 1_000_000):
                yield pa.RecordBatch.from_arrays([*map(part.column, names), pa.array(fingerprints(texts))], [*names, "fp"])

    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.col("text").cast("string").alias("text"), tag_of(F.col("text")).alias("tag"))
    return own.select(*names, "text").mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "fp"]))


def variants(distinct: DataFrame) -> DataFrame:
    """64 rows (key, fp) for each fingerprint: half and wildcard bit above, the half's other bits below."""
    half = F.when(F.col("v") < 32, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    wild = F.expr("shiftleft(1L, cast(v % 32 as int))")
    rows = distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("v"))
    return rows.select((F.expr("shiftleft(cast(v as long), 32)") + half.bitwiseAND(F.bitwise_not(wild))).alias("key"), "fp")


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


_FLIPS = [0, *(sum(1 << b for b in c) for r in (1, 2, 3) for c in combinations(range(32), r))]


def forest(fps: np.ndarray, key: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links of one bucket that this variant answers for.

    A pair whose halves agree entirely is left to the variant of bit 0, so that each link arises in few buckets."""
    fps = np.unique(fps.view(np.uint64))
    half, wild = divmod(key >> 32, 32)
    shift = np.uint64(0 if half else 32)
    bit = np.uint64(1) << (np.uint64(wild) + shift)
    parent = list(range(len(fps)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges: list[tuple[int, int]] = []

    def link(a: int, b: int) -> None:
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            edges.append((a, b))

    if len(fps) <= COMPARE:
        for i in range(len(fps) - 1):
            other = fps[i] ^ fps[i + 1 :]
            near = np.bitwise_count(other) <= DISTANCE
            if wild:
                near &= (other & bit) != 0
            for j in np.flatnonzero(near):
                link(i, i + 1 + int(j))
    else:
        rest = np.uint64(32) - shift
        for flip in _FLIPS:
            for own in (np.uint64(0), bit):
                mask = (np.uint64(flip) << rest) ^ own
                if not mask or (wild and not own) or int(mask).bit_count() > DISTANCE:
                    continue
                at = np.searchsorted(fps, fps ^ mask)
                at[at == len(fps)] = 0
                for i in np.flatnonzero((fps[at] == fps ^ mask) & (fps < fps ^ mask)):
                    link(int(i), int(at[i]))
    signed = fps.view(np.int64)
    return [(int(signed[a]), int(signed[b])) for a, b in edges]


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are those of all links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []  # parts of the last key so far

        def close(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            k, f = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 2
            at = np.flatnonzero(np.diff(k, prepend=k[:1] - 1)) if len(k) else np.zeros(0, np.int64)
            size = np.diff(at, append=len(k))
            out = [e for a, n in zip(at[size > 1], size[size > 1], strict=True) for e in forest(f[a : a + n], int(k[a]))]
            cols = np.array(out, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(cols[:, 0]), pa.array(cols[:, 1])], ["a", "b"])

        for batch in batches:
            k, f = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
            if not len(k):
                continue
            cut = int(np.searchsorted(k, k[-1]))
            if cut or held and held[-1][0][-1] != k[-1]:
                yield close([*held, (k[:cut], f[:cut])])
                held = []
            held.append((k[cut:], f[cut:]))
        yield close(held)

    return variants(distinct).repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node but the roots; a root is its component's least node. Alternating large and small stars.

    Each round is written to the shared folder, and the one before it deleted. The loop ends when a round leaves the edges as they are."""
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    seen = None
    while True:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(small.select("u", F.col("m").alias("v"))).distinct()
        done, edges = edges, materialize(small, "edges")
        discard(done)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.count_if(F.col("u") == F.col("v"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state


def members(prints: DataFrame, order: Column) -> DataFrame:
    """Each distinct fp with its component's root and the least `order` of its own documents."""
    distinct = materialize(prints.groupBy("fp").agg(F.min(order).alias("least")), "distinct")
    roots = materialize(components(links(distinct.select("fp"))), "roots")
    return distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id (null as NULL_ID), fp and component_id: the least doc_id of all documents reachable by links."""
    prints = materialize(fingerprint_table(docs), "fingerprints")
    member = members(prints, F.col("doc_id"))
    ids = member.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(member.join(ids, "root").select("fp", "component_id"), "fp")


def query(docs: DataFrame) -> DataFrame:
    real = lambda c: F.when(F.col(c) != NULL_ID, F.col(c)).alias(c)
    return near_duplicates(docs).select(real("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), real("component_id"))


def keep_each(docs: DataFrame) -> DataFrame:
    """Exactly one row of every component, with all its columns: the one with the least (doc_id, tag of the text).

    Components that share a doc_id, or whose documents have none, don't stand for one another.
    Of rows alike in doc_id and text any one stays."""
    prints = materialize(fingerprint_table(docs, tagged=True), "fingerprints")
    least = members(prints, F.struct("doc_id", "tag")).groupBy("root").agg(F.min("least").alias("least"))
    kept = least.select(F.col("least.doc_id").alias("kept"), F.col("least.tag").alias("kept_tag"))
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("key"), tag_of(F.col("text")).alias("tag"))
    same = (rows["key"] == kept["kept"]) & (rows["tag"] == kept["kept_tag"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["key", "tag"]).select("row.*")
