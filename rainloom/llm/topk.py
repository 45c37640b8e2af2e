"""Exact top-k search by inner product, with a three-phase uniform threshold.

The dimensions are cut into LISTS runs. A list knows, for every query, each vector's partial score over its own dimensions
and no more; a score is the sum of its partial scores.

1. Each list gives its vectors of greatest partial score, DEPTH of them. What the other lists hold for those is looked up, so
   their scores are exact, and the k-th of them is a cutoff that no vector of the result is below.
2. The cutoff goes to all lists. A score that reaches it has a partial score of the LISTS-th part of it or more in some
   list, of whatever sign the numbers are, so the entries that reach that uniform threshold are sufficient.
3. Entries are summed by vector. What a list left out is below the threshold and at most its greatest entry; vectors whose sum
   can't reach the cutoff by that go, and the rest are looked up in the lists that they lack.

Equal vectors are searched once: of each, the ids of its k + 1 first rows are enough for any result, and queries with one
vector share their results. Queries and vectors are dealt out in tiles of some thousands, a tile for each list, and a task
meets pairs of tiles with one matrix product; what travels is entries above thresholds. Nothing grows on the driver but the
numbers of tiles. The work is that of the queries against all vectors, by blocks.

Defined results: vectors that are null or hold null or non-finite components take no part, as candidates or queries; vectors
shorter than others count as filled up with 0, empty ones too; a null id is no query, and as a candidate it comes after all
ids; rows that repeat are candidates of each other, and each is a query; the query's own row is left out once; ties go to the
smaller id; an empty table gives no rows; other columns are ignored. Scores that might not fit a long raise ArithmeticError."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, partitions

K, EVERY, SCALE = 5, 50, 256
#: Runs of dimensions. Two need the fewest entries: their threshold is half the cutoff, those of more are nearer the middle.
LISTS = 2
#: Vectors and queries of a tile, at most, and its cells; queries of a matrix product.
VECTORS, QUERIES, CELLS, BLOCK = 4096, 1024, 1 << 20, 256
#: Entries of a list by which the cutoff is found: the more, the higher it is, and the fewer reach its part.
DEPTH = 32
#: Parts that the queries of one vector are dealt to.
SALTS = 16
#: The cutoff where there are fewer than k vectors: below every score.
NONE = -(2**62)
_FOUND = "query_id long, rank int, vec_id long, score long"
_ENTRY = "list int, qt int, vt int, q long, v long, part long"


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and x, the components as whole numbers, of the rows that take part."""
    solid = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.col("embedding").isNotNull() & solid)
    return own.select("vec_id", F.transform("embedding", lambda c: F.floor(c.cast("double") * scale)).alias("x"))


def distinct(rows: DataFrame, k: int) -> DataFrame:
    """v, x and ids: each vector once, with the ids of its k + 1 first rows. Partitions keep as many before they are shuffled."""
    first = F.row_number().over(Window.partitionBy("x").orderBy(F.col("vec_id").asc_nulls_last()))
    few = rows.withColumn("__k", first).where(F.col("__k") <= k + 1)
    packed = few.groupBy("x").agg(F.collect_list(F.struct("vec_id")).alias("ids"))
    return materialize(packed.withColumn("v", F.monotonically_increasing_id()), "vectors")


def tiles(vectors: DataFrame, per: int, lists: int, width: int, names: tuple[str, str, str, str]) -> tuple[DataFrame, int]:
    """Vectors (v, x) in tiles of about `per`: (list, tile, ids, data) under the names given, a row for each list, and the number of tiles.

    ids are sorted; data is a matrix of whole numbers as narrow as they allow."""
    n = -(-vectors.count() // per)
    dealt = vectors.groupBy(F.pmod(F.xxhash64("v"), F.lit(max(n, 1))).cast("int").alias("tile")).agg(F.array_sort(F.collect_list(F.struct("v", "x"))).alias("rows"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile, rows in zip(batch.column("tile").to_pylist(), batch.column("rows"), strict=True):
                own = rows.values
                x = own.field("x")
                lengths = x.value_lengths().to_numpy()
                whole = np.zeros((len(own), lists * width), np.int64)
                whole[np.arange(lists * width) < lengths[:, None]] = x.flatten().to_numpy()
                for j in range(lists):
                    part = np.ascontiguousarray(whole[:, j * width : (j + 1) * width])
                    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if t is np.int64 or np.abs(part).max(initial=0) <= np.iinfo(t).max)
                    yield pa.RecordBatch.from_arrays([pa.array([j], pa.int32()), pa.array([tile], pa.int32()), pa.array([own.field("v").to_numpy().tobytes()]), pa.array([part.astype(kind).tobytes()])], list(names))

    made = dealt.mapInArrow(pack, f"{names[0]} int, {names[1]} int, {names[2]} binary, {names[3]} binary")
    return materialize(made, "tiles"), n


def _matrix(ids: pa.Scalar, data: pa.Scalar, width: int) -> tuple[np.ndarray, np.ndarray]:
    names, raw = np.frombuffer(ids.as_py(), np.int64), data.as_py()
    cells = len(names) * width
    return names, np.frombuffer(raw, f"i{len(raw) // cells if cells else 8}").reshape(len(names), width)


class Lists:
    """The partial scores of queries (v, x) against vectors (v, x), by pairs of tiles."""

    def __init__(self, queries: DataFrame, vectors: DataFrame, lists: int, width: int, kind: type):
        self.spark, self.lists, self.width, self.kind = vectors.sparkSession, lists, max(width, 1), kind
        most = max(1, CELLS // (lists * self.width))
        self.queries, self.nq = tiles(queries, min(QUERIES, most), lists, self.width, ("list", "qt", "qs", "qdata"))
        self.vectors, self.nv = tiles(vectors, min(VECTORS, most), lists, self.width, ("list", "vt", "vs", "vdata"))

    def _meet(self, pairs: DataFrame) -> DataFrame:
        """Pairs (list, qt, vt) with both tiles, dealt out by the vectors' tiles, of which there are more."""
        n, key = partitions(self.spark), ["list", "vt"]
        return pairs.join(self.queries, ["list", "qt"]).repartition(n, *key).join(self.vectors.repartition(n, *key), key)

    def _every(self) -> DataFrame:
        k, each = F.col("id"), self.nq * self.nv
        return self.spark.range(self.lists * each).select((k / each).cast("int").alias("list"), (k % each / self.nv).cast("int").alias("qt"), (k % self.nv).cast("int").alias("vt"))

    def _scan(self, pairs: DataFrame, pick: Callable) -> DataFrame:
        width, kind = self.width, self.kind

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in range(batch.num_rows):
                    row = {c: batch.column(c)[r] for c in batch.schema.names}
                    (qs, a), (vs, b) = _matrix(row["qs"], row["qdata"], width), _matrix(row["vs"], row["vdata"], width)
                    turned = b.astype(kind).T
                    for at in range(0, len(qs), BLOCK):
                        part = a[at : at + BLOCK].astype(kind) @ turned
                        i, j = pick(part, row, at)
                        same = [pa.repeat(row[c], len(i)) for c in ("list", "qt", "vt")]
                        yield pa.RecordBatch.from_arrays([*same, pa.array(qs[at + i]), pa.array(vs[j]), pa.array(part[i, j].astype(np.int64))], ["list", "qt", "vt", "q", "v", "part"])

        return pairs.mapInArrow(run, _ENTRY)

    def best(self, k: int, depth: int) -> DataFrame:
        """Entries: for every query in each list, `depth` of great partial scores, among them the greatest. A tile gives the k greatest of its own."""

        def pick(part: np.ndarray, row: dict, at: int) -> tuple[np.ndarray, np.ndarray]:
            few = min(k, part.shape[1])
            top = np.argpartition(part, part.shape[1] - few, axis=1)[:, part.shape[1] - few :]
            return np.repeat(np.arange(len(part)), few), top.ravel()

        entries = self._scan(self._meet(self._every()), pick)
        rank = F.row_number().over(Window.partitionBy("q", "list").orderBy(F.col("part").desc(), "v"))
        return entries.withColumn("__k", rank).where(F.col("__k") <= depth).drop("__k")

    def reaching(self, cutoffs: DataFrame) -> DataFrame:
        """Entries of at least the LISTS-th part of their query's cutoff (qt, q, cutoff)."""
        lists = self.lists

        def pick(part: np.ndarray, row: dict, at: int) -> tuple[np.ndarray, np.ndarray]:
            own = row["cutoffs"].values.field("cutoff").to_numpy()[at : at + BLOCK]
            return np.nonzero(part >= -(-own // lists)[:, None])

        sent = cutoffs.groupBy("qt").agg(F.array_sort(F.collect_list(F.struct("q", "cutoff"))).alias("cutoffs"))
        return self._scan(self._meet(self._every().join(sent, "qt")), pick)

    def look_up(self, wanted: DataFrame) -> DataFrame:
        """Entries of wanted (list, qt, vt, q, v)."""
        width = self.width
        pairs = wanted.groupBy("list", "qt", "vt").agg(F.collect_list(F.struct("q", "v")).alias("wanted"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in range(batch.num_rows):
                    row = {c: batch.column(c)[r] for c in batch.schema.names}
                    (qs, a), (vs, b) = _matrix(row["qs"], row["qdata"], width), _matrix(row["vs"], row["vdata"], width)
                    own = row["wanted"].values
                    for at in range(0, len(own), 1 << 16):
                        few = own.slice(at, 1 << 16)
                        i, j = np.searchsorted(qs, few.field("q").to_numpy()), np.searchsorted(vs, few.field("v").to_numpy())
                        part = np.einsum("ij,ij->i", a[i].astype(np.int64), b[j].astype(np.int64))
                        same = [pa.repeat(row[c], len(few)) for c in ("list", "qt", "vt")]
                        yield pa.RecordBatch.from_arrays([*same, few.field("q"), few.field("v"), pa.array(part)], ["list", "qt", "vt", "q", "v", "part"])

        return self._meet(pairs).mapInArrow(run, _ENTRY)


def _summed(entries: DataFrame) -> DataFrame:
    """qt, vt, q, v, total of the partial scores at hand and the lists they come from."""
    return entries.groupBy("qt", "vt", "q", "v").agg(F.sum("part").alias("total"), F.collect_set("list").alias("seen"))


def _lacking(sums: DataFrame, lists: int) -> DataFrame:
    every = F.array(*[F.lit(j) for j in range(lists)])
    return sums.select(F.explode(F.array_except(every, "seen")).alias("list"), "qt", "vt", "q", "v")


def search(queries: DataFrame, vectors: DataFrame, k: int, lists: int = LISTS) -> DataFrame:
    """q, v, total: of every query (v, x) the k vectors (v, x) of greatest inner product, and all that tie with the last.

    Both tables hold each vector once, under ids of their own."""
    reach = vectors.agg(F.max(F.size("x")).alias("d"), F.max(F.array_max("x")).alias("high"), F.min(F.array_min("x")).alias("low")).first()
    most = (reach.d or 0) * max(abs(reach.high or 0), abs(reach.low or 0)) ** 2
    if most * lists >= -NONE:
        raise ArithmeticError("inner products of these components may not fit a long")
    # products and sums below 2^53 are exact as doubles
    own = Lists(queries, vectors, lists, -(-(reach.d or 0) // lists), np.float64 if most < 2**53 else np.int64)

    # 1: each list's best, their scores, and the cutoffs
    best = materialize(own.best(k, max(k, DEPTH)), "best")
    sums = _summed(best)
    scored = _summed(best.unionByName(own.look_up(_lacking(sums, lists))))
    kth = F.get(F.reverse(F.array_sort(F.collect_list("total"))), F.lit(k - 1))
    cutoffs = scored.groupBy("qt", "q").agg(F.coalesce(kth, F.lit(NONE)).alias("cutoff"))
    tops = best.groupBy("q").pivot("list", list(range(lists))).agg(F.max("part"))
    bounds = materialize(cutoffs.join(tops, "q"), "cutoffs")

    # 2: what reaches the uniform threshold
    hits = materialize(_summed(own.reaching(bounds.select("qt", "q", "cutoff"))), "hits")

    # 3: what may still reach the cutoff, resolved
    bounded = hits.join(bounds.withColumn("threshold", _ceil_div("cutoff", lists)).drop("qt"), "q")
    left_out = sum((F.when(~F.array_contains("seen", j), F.least(F.col(str(j)), F.col("threshold") - 1)).otherwise(0) for j in range(lists)), F.lit(0))
    able = bounded.where(F.col("total") + left_out >= F.col("cutoff")).select("qt", "vt", "q", "v", "total", "seen", "cutoff")
    found = own.look_up(_lacking(able, lists)).select("q", "v", F.col("part").alias("total"), F.lit(None).cast("long").alias("cutoff"))
    whole = able.select("q", "v", "total", "cutoff").unionByName(found).groupBy("q", "v").agg(F.sum("total").alias("total"), F.max("cutoff").alias("cutoff"))
    return whole.where("total >= cutoff").drop("cutoff")


def _ceil_div(name: str, n: int) -> F.Column:
    """Whole numbers divided and rounded up, without passing through doubles."""
    return F.expr(f"({name} - pmod({name}, {n})) div {n} + if(pmod({name}, {n}) > 0, 1, 0)")


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, lists: int = LISTS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each row whose vec_id is divisible by `every`."""
    spark, rows = vectors.sparkSession, scaled(vectors, scale)
    once = distinct(rows, k)
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "x")
    queries = materialize(asked.select("x").distinct().join(once, "x").select("v", "x"), "queries")
    if queries.isEmpty():
        return spark.createDataFrame([], _FOUND)
    found = search(queries, once.select("v", "x"), k + 1, lists)
    ids = found.join(once.select("v", "ids"), "v").select("q", "v", "total", F.explode("ids.vec_id").alias("vec_id"))
    order = [F.col("total").desc(), F.col("vec_id").asc_nulls_last(), "v"]
    few = ids.withColumn("k", F.row_number().over(Window.partitionBy("q").orderBy(*order))).where(F.col("k") <= k + 1)
    results = few.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("k", "v", "vec_id", "total"))).alias("results"))
    # one vector may belong to many queries: those are dealt to SALTS parts, each with the results
    salted = queries.withColumnRenamed("v", "q").join(results, "q").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = asked.withColumn("salt", F.pmod(F.xxhash64("query_id"), F.lit(SALTS)).cast("int")).join(salted, ["x", "salt"])
    at = F.array_position(F.transform("results", lambda r: (r["v"] == F.col("q")) & r["vec_id"].eqNullSafe(F.col("query_id"))), True)
    rest = F.when(at > 0, F.concat(F.expr("slice(results, 1, cast(at as int) - 1)"), F.expr(f"slice(results, cast(at as int) + 1, {k + 1})"))).otherwise(F.slice("results", 1, k))
    listed = own.withColumn("at", at).select("query_id", F.posexplode(rest).alias("rank", "r"))
    return listed.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "r.vec_id", F.col("r.total").alias("score"))


query = top_k

ORACLE = f"""
WITH v AS (SELECT vec_id, row_number() OVER () AS n, [floor({SCALE} * CAST(c AS DOUBLE)) FOR c IN embedding] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, q.n, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score FROM v q JOIN v c ON q.n <> c.n WHERE q.vec_id % {EVERY} = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s) WHERE rank <= {K}
"""
