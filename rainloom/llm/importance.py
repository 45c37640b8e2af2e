"""Importance resampling to a target distribution, by partition-local word tries.

A text's features are its runs of one and two words. A trie over the words holds them as paths: a node's count is how often
its path occurred, its CRC state that of the path's bytes, so a child goes on from its parent's state and no feature is
ever joined to a string. A task's first walk counts; its counts are summed by bucket, the state modulo BUCKETS, and the
buckets' totals of all tasks are merged. A second walk over the documents attaches the gain of its bucket to every node, and a
document's weight is the mean of the gains on its paths. A task's trie starts anew when it has NODES nodes, after its
counts have gone to the buckets, so its memory is bounded and results don't turn on where that happens.

What travels is BUCKETS numbers from each task. Scores are whole thousandths of a bounded range (below 10^6 of them are
possible), so a histogram over them, summed from its greatest score, tells where the drawn ones end; the drawn rows alone,
without their texts, are dealt out by ranges of their order and ranked inside these.

Defined results: a null text has no words, weight 0 and n_features 0, like one without words; a null doc_id draws its
noise as if its text were empty, and comes after all others among equal scores; rows that repeat are drawn each, arbitrarily
among rows alike in score and doc_id; without a benchmark t and T are 0, without documents s and S; other columns are
ignored; an empty table gives no rows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ALNUM, Words, materialize, slices

BUCKETS, SEED, PERCENT, LEAST_WORDS = 10_000, 7, 25, 20
#: Nodes of a trie at which it starts anew, after a slice of texts.
NODES = 2_000_000
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


class Trie:
    """Paths of one and two words, with their CRC states and counts.

    Nodes of the first level are numbered as their words come. Those of the second level are kept in order of
    (parent, word), as one sorted array of keys with their states and counts beside it."""

    def __init__(self):
        self.word: dict[bytes, int] = {}
        self.tails: list[bytes] = []
        self.states, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.keys, self.pair_states, self.pair_counts = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.states) + len(self.keys)

    def walk(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes of every word and of every two neighbours in one text, and the places of the latter's first words. New paths get nodes."""
        coded = words.array().dictionary_encode()
        spelled, known = coded.dictionary.to_pylist(), len(self.word)
        own = np.array([self.word.setdefault(w, len(self.word)) for w in spelled], np.int64)
        new = [w for w, k in zip(spelled, own.tolist(), strict=True) if k >= known]
        self.tails += [b" " + w for w in new]
        self.states = np.concatenate([self.states, np.array([zlib.crc32(w) for w in new], np.int64)])
        self.counts = np.concatenate([self.counts, np.zeros(len(new), np.int64)])
        node = own[coded.indices.to_numpy()]
        first = np.flatnonzero(words.doc[1:] == words.doc[:-1])
        wanted, path = np.unique(node[first] << 32 | node[first + 1], return_inverse=True)
        at = np.searchsorted(self.keys, wanted)
        there = np.zeros(len(wanted), bool)
        inside = at < len(self.keys)
        there[inside] = self.keys[at[inside]] == wanted[inside]
        new = wanted[~there]
        if len(new):
            begun, tail = self.states[new >> 32].tolist(), (new & 0xFFFFFFFF).tolist()
            states = np.array([zlib.crc32(self.tails[w], s) for w, s in zip(tail, begun, strict=True)], np.int64)
            where = at[~there]
            self.keys, self.pair_states = np.insert(self.keys, where, new), np.insert(self.pair_states, where, states)
            self.pair_counts = np.insert(self.pair_counts, where, 0)
            at = np.searchsorted(self.keys, wanted)
        return node, at[path], first

    def count(self, words: Words) -> None:
        nodes, pairs, _ = self.walk(words)
        self.counts += np.bincount(nodes, minlength=len(self.counts))
        self.pair_counts += np.bincount(pairs, minlength=len(self.pair_counts))

    def totals(self) -> np.ndarray:
        """Counts by bucket."""
        return sum(np.bincount(s % BUCKETS, c, BUCKETS) for s, c in ((self.states, self.counts), (self.pair_states, self.pair_counts))).astype(np.int64)

    def gains(self, words: Words, gain: np.ndarray) -> np.ndarray:
        """Each text's sum of the gains along its paths."""
        nodes, pairs, first = self.walk(words)
        texts = len(words.bounds) - 1
        out = np.zeros(texts, np.int64)
        # whole numbers below 2^53, so sums as doubles are exact
        for doc, g in ((words.doc, gain[self.states[nodes] % BUCKETS]), (words.doc[first], gain[self.pair_states[pairs] % BUCKETS])):
            out += np.bincount(doc, g, texts).astype(np.int64)
        return out


def _words(texts: list[bytes]) -> Words:
    return Words([t.translate(_LOWER) for t in texts], ALNUM)


def _texts(df: DataFrame, *more: Column) -> DataFrame:
    return df.select(*more, F.col("text").cast("string").alias("text"))


def bucket_totals(df: DataFrame) -> dict[int, int]:
    """How many features of all texts fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, total = Trie(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, texts in slices(batch, "text"):
                trie.count(_words(texts))
                if len(trie) > NODES:
                    total += trie.totals()
                    trie = Trie()
        total += trie.totals()
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(total[hit])], ["bucket", "n"])

    counted = _texts(df).mapInArrow(run, "bucket int, n long")
    return {r.bucket: r.n for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """Each bucket's gain, in whole thousandths, by its share of the target's features and of the documents'."""
    own, aim = bucket_totals(docs), bucket_totals(target)
    s, t = (np.array([float(x.get(b, 0)) for b in range(BUCKETS)]) for x in (own, aim))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document. gain has BUCKETS numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie()
        for batch in batches:
            for part, texts in slices(batch, "text"):
                words = _words(texts)
                total, n = trie.gains(words, gain), np.diff(words.first)
                features = np.maximum(2 * n - 1, 0)
                weight = total // np.maximum(features, 1)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(v.astype(np.int64)) for v in (n, features, weight))], ["doc_id", "n_words", "n_features", "weight"])
                if len(trie) > NODES:
                    trie = Trie()

    return _texts(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in whole thousandths, from the id alone."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(scored: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS) -> DataFrame:
    """Adds rank to scored (doc_id, n_words, score), 1 for the highest score: null for what isn't among the drawn per cent.

    scored is a stored table: it is read several times."""
    able = F.col("n_words") >= least
    by_score = scored.where(able).groupBy("score").count()
    drawn = (by_score.agg(F.sum("count")).first()[0] or 0) * percent // 100
    above = F.sum("count").over(Window.orderBy(F.col("score").desc())) - F.col("count")
    last = by_score.withColumn("above", above).where(F.col("above") < drawn).agg(F.min("score")).first()[0]
    within = able & (F.col("score") >= F.lit(last).cast("long"))
    # the row number tells rows apart that are alike in all else, so that ranges can cut between them
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "__row"]
    ranges = materialize(scored.where(within).withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "drawn")
    counts = ranges.groupBy("__range").count()
    firsts = counts.select("__range", (F.sum("count").over(Window.orderBy("__range")) - F.col("count")).alias("__first"))
    rank = F.col("__first") + F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    known = ranges.join(firsts, "__range").withColumn("rank", rank.cast("long")).drop("__range", "__row", "__first").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return known.unionByName(scored.where(~F.coalesce(within, F.lit(False))).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document."""
    found = weights(docs, gains(docs, target))
    scored = materialize(found.withColumn("score", F.col("weight") + noise(F.col("doc_id"))), "scores")
    return ranked(scored).select("doc_id", "n_features", "weight", "score", "rank")


query = resample

_W = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE = f"""
WITH RECURSIVE c(i, k, v) AS (SELECT i, 0, i FROM range(256) t(i) UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM c WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM c WHERE k = 8),
d AS (SELECT doc_id, row_number() OVER () AS n, {_W} AS w FROM documents),
b AS (SELECT {_W} AS w FROM benchmark),
f AS (SELECT n, unnest(w || [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS f FROM d),
g AS (SELECT unnest(w || [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS f FROM b),
e AS (SELECT f, [CAST('0x' || x AS BIGINT) FOR x IN regexp_extract_all(hex(encode(f)), '..')] AS b FROM (SELECT f FROM f UNION SELECT f FROM g)),
h AS (SELECT f, xor(list_reduce(list_prepend(4294967295, b), lambda a, x: xor(a >> 8, t[1 + (xor(a, x) & 255)])), 4294967295) % {BUCKETS} AS bucket FROM e, crc),
s AS (SELECT bucket, count(*) AS s FROM f JOIN h USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM g JOIN h USING (f) GROUP BY bucket),
gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + {BUCKETS})::DOUBLE
  / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + {BUCKETS})::DOUBLE))) AS BIGINT) AS gain FROM s FULL JOIN t USING (bucket)),
w AS (SELECT n, count(*) AS n_features, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight FROM f JOIN h USING (f) JOIN gain USING (bucket) GROUP BY n),
scored AS (SELECT doc_id, n, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
  + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM d LEFT JOIN w USING (n)),
drawn AS (SELECT n, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE n_words >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT count(*) * {PERCENT} // 100 FROM drawn) THEN rank END AS rank FROM scored LEFT JOIN drawn USING (n)
"""
