"""Sharding by jump consistent hashing, in DataFrame operations only.

A document's shard follows from its doc_id and the number of shards alone. The jump generator advances a 64-bit state
by a fixed multiplier; its high bits say at which number of shards the document would move next, and the last jump
below the number of shards is its shard. Appending a shard moves just those documents whose next jump lands on it.

Slots are ranks inside a shard by (doc_id, checksum, size), at every size of the table. A shard isn't ranked in one task:
rows, without their texts, are dealt out in ranges of that order, ranges are counted by shard, running sums over the
counts give the first slot of each shard in each range, and only these are ranked.

Defined results: a null text has 16 bytes of overhead, no text bytes and checksum 0; a null doc_id is a key like any
other, distinct from all numbers; rows that repeat get slots of their own, arbitrarily among rows alike in doc_id, checksum and size;
extra columns are ignored by `query` and kept by `write`; an empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

SHARDS = 40
OVERHEAD = 16
# fixed values of the published generator
MULTIPLIER = 2862933555777941757
_LOW = 0xFFFFFFFF


def _times(a: Column, c: int) -> Column:
    """a * c for a below 2^32 and c below 2^32, as (low 32 bits, high 32 bits), without overflow."""
    p0 = a.bitwiseAND(F.lit(0xFFFF)) * F.lit(c)
    p1 = F.shiftright(a, 16) * F.lit(c)
    low = p0.bitwiseAND(F.lit(_LOW)) + F.shiftleft(p1.bitwiseAND(F.lit(0xFFFF)), 16)
    high = F.shiftright(p0, 32) + F.shiftright(p1, 16) + F.shiftright(low, 32)
    return F.struct(low.bitwiseAND(F.lit(_LOW)).alias("low"), high.bitwiseAND(F.lit(_LOW)).alias("high"))


def _next(state: Column) -> Column:
    """The generator's next state; states are structs of two 32-bit halves, so nothing overflows."""
    low, high = state["low"], state["high"]
    c_low, c_high = MULTIPLIER & _LOW, MULTIPLIER >> 32
    return F.transform(
        F.array(F.struct(_times(low, c_low).alias("a"), _times(low, c_high).alias("b"), _times(high, c_low).alias("c"))),
        lambda x: F.struct(
            (x["a"]["low"] + 1).bitwiseAND(F.lit(_LOW)).alias("low"),
            (x["a"]["high"] + x["b"]["low"] + x["c"]["low"] + F.shiftright(x["a"]["low"] + 1, 32)).bitwiseAND(F.lit(_LOW)).alias("high"),
        ),
    )[0]


def jumps(key: Column, most: int) -> Column:
    """All numbers at which the key jumps, ascending from 0, below `most`: with n shards its shard is the last one below n."""
    zero = F.lit(0).cast("long")
    start = F.struct(
        F.struct(key.bitwiseAND(F.lit(_LOW)).alias("low"), F.shiftrightunsigned(key, 32).alias("high")).alias("state"),
        F.array(zero).alias("seen"),
        F.lit(False).alias("done"),
    )

    def drawn(x: Column, state: Column) -> Column:
        # the state's upper 31 bits, plus one, divide 2^31
        to = F.floor((F.element_at(x["seen"], -1) + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(state["high"], 1) + 1).cast("double")))
        return F.struct(state.alias("state"), F.when(to < most, F.array_append(x["seen"], to)).otherwise(x["seen"]).alias("seen"), (to >= most).alias("done"))

    def jump(x: Column, _: Column) -> Column:
        return F.when(x["done"], x).otherwise(F.transform(F.array(_next(x["state"])), lambda state: drawn(x, state))[0])

    # each jump goes up by one at least, so `most` steps are enough for any key
    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, jump, lambda x: x["seen"])


def key_of(doc_id: Column) -> Column:
    """A key of 60 bits, spread out from the id's text; null has a key of its own."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")), 1, 15), 16, 10).cast("long")


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and grown_shard, the shard with one shard more."""
    text = F.col("text").cast("string").cast("binary")
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD).alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        jumps(key_of(F.col("doc_id")), shards + 1).alias("__seen"),
    )
    grown = F.element_at("__seen", -1)
    shard = F.when(grown < shards, grown).otherwise(F.element_at("__seen", -2))
    return own.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"), grown.cast("int").alias("grown_shard"))


def with_slots(assigned: DataFrame) -> DataFrame:
    """Adds slot: gapless from 0 in each shard, in order of doc_id (null last), checksum and size."""
    # the row number tells rows apart that are alike in all else, so that they can be cut as well
    order = ["shard", F.col("doc_id").asc_nulls_last(), "text_crc32", "size", "__row"]
    numbered = materialize(assigned.withColumn("__row", F.monotonically_increasing_id()), "shards")
    ranges = materialize(numbered.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranges")
    counts = ranges.groupBy("shard", "__range").count()
    upto = Window.partitionBy("shard").orderBy("__range")
    firsts = counts.select("shard", "__range", (F.sum("count").over(upto) - F.col("count")).alias("__first"))
    inside = F.row_number().over(Window.partitionBy("shard", "__range").orderBy(*order[1:])) - 1
    return ranges.withColumn("__rank", inside).join(firsts, ["shard", "__range"]).withColumn("slot", (F.col("__first") + F.col("__rank")).cast("long")).drop("__range", "__rank", "__first", "__row")


def query(docs: DataFrame) -> DataFrame:
    found = with_slots(assign(docs))
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def write(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Writes the documents, with all their columns, to one folder for each shard."""
    seen = jumps(key_of(F.col("doc_id")), shards)
    docs.withColumn("shard", F.element_at(seen, -1).cast("int")).write.partitionBy("shard").parquet(path)


ORACLE = """
WITH RECURSIVE c(i, k, v) AS (SELECT i, 0, i FROM range(256) t(i) UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM c WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM c WHERE k = 8),
d AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 16 AS BIGINT) AS size,
        [CAST('0x' || x AS BIGINT) FOR x IN regexp_extract_all(hex(encode(coalesce(text, ''))), '..')] AS b,
        CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS HUGEINT) AS key FROM documents),
e AS (SELECT doc_id, size, key, xor(list_reduce(list_prepend(4294967295, b), lambda a, x: xor(a >> 8, t[1 + (xor(a, x) & 255)])), 4294967295) AS text_crc32 FROM d, crc),
j(key, state, b, seen) AS (SELECT DISTINCT key, key, CAST(0 AS BIGINT), CAST(-1 AS BIGINT) FROM d UNION ALL
  SELECT key, state2, CAST(floor((b + 1) * (2147483648::DOUBLE / CAST((state2 >> 33) + 1 AS DOUBLE))) AS BIGINT), b
  FROM (SELECT *, (state * 2862933555777941757 + 1) % 18446744073709551616 AS state2 FROM j WHERE b < 41)),
s AS (SELECT key, max(b) FILTER (WHERE b < 40) AS shard, max(b) FILTER (WHERE b < 41) AS grown_shard FROM j GROUP BY key)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, CAST(grown_shard AS INTEGER) AS grown_shard
FROM e JOIN s USING (key)
"""
