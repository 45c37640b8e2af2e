"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Targets share out all words by the sources' weights; a source takes at most 3 times its own words, and what is above
that is shared among the others by weight. A document first gets its certain whole copies, floor(target / source
size). The rest of the target is drawn as a Pareto order sample of fixed size, counted in words: each document has an
inclusion probability pi, min(1, c * sqrt(size)) with c such that the expected words, the sum of pi * size, are the rest;
documents are ranked by the odds of a uniform number over the odds of pi, and taken in that order while the words
taken stay nearest to the rest.

No source is ever sorted whole. c follows from the counts of each size, of which a source of n words has less than
sqrt(2 n) different ones. Ranks are cut into bins, each source's words are summed by bin, running sums over the
bins find the one in which the rest is met, and only that bin's documents are ranked one by one.

Defined results: words are runs of [^\\x20\\x09-\\x0D], a null text has none; documents without words are never taken;
null is a source of its own, after all others; rows that repeat are separate documents, and rows alike in doc_id and size
are ranked arbitrarily among themselves; a document without doc_id draws its number by its text; extra columns are
ignored by `query` and kept by `take`; an empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import NULL_ID, materialize

CAP = 3
#: Weights of the sources in order of code points, repeating.
WEIGHTS = (1, 2, 3)
#: Bins of the ranking variable; one source's bin is what a single task ranks.
BINS = 1 << 13
#: Sources up to which the plan, a row of some hundred bytes for each, is broadcast; beyond it each is dealt over SALTS tasks.
SOURCES, SALTS = 10_000, 64


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size and target. sizes: source, size.

    With sources in order of 3 * size / weight, a prefix of them is held at its cap; the level for the others is what
    the capped ones leave, divided by the others' weights. Source k is capped if its ratio is below the level at k."""
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int")).cast("long")
    each = each.withColumn("weight", weight).withColumn("cap", F.col("source_size") * CAP)
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    each = each.withColumn("level", (F.sum("source_size").over(everything) - (F.sum("cap").over(by_ratio) - F.col("cap"))) / (F.sum("weight").over(everything) - (F.sum("weight").over(by_ratio) - F.col("weight"))))
    each = each.withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)  # that of the first that isn't capped
    return each.select("source", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level * F.col("weight")).alias("target"))


def uniform(doc_id: Column, text: Column, seed: int) -> Column:
    """A number between 0 and 1 from the document's id or, without one, from its text."""
    of = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), of).cast("binary")), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)


def levels(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """goals (source, rest and others) with c: sum of size * min(1, c * sqrt(size)) over a source's documents is its rest.

    In order of size, the longest documents are certain. The level at a size is what c would be if just the longer ones
    were; the greatest level at which its own size isn't certain is c."""
    counts = sizes.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("m"))
    own = counts.join(F.broadcast(goals.select(F.col("source").alias("__source"), "rest")) if goals.count() <= SOURCES else goals.select(F.col("source").alias("__source"), "rest"), F.col("source").eqNullSafe(F.col("__source")))
    longer = Window.partitionBy("source").orderBy(F.col("size").desc())
    upto = Window.partitionBy("source").orderBy("size")
    words, weight = F.col("size") * F.col("m"), F.col("size") * F.sqrt(F.col("size").cast("double")) * F.col("m")
    level = (F.col("rest") - (F.sum(words).over(longer) - words)) / F.sum(weight).over(upto)
    found = own.select("source", "size", level.alias("level")).groupBy(F.col("source").alias("__source")).agg(F.max(F.when(F.col("level") * F.sqrt(F.col("size").cast("double")) < 1, F.col("level"))).alias("c"))
    return goals.join(found, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows with the columns of their source's row in plan."""
    plan = plan.withColumnRenamed("source", "__source")
    same = F.col("source").eqNullSafe(F.col("__source"))
    if plan.count() <= SOURCES:
        return rows.join(F.broadcast(plan), same).drop("__source")
    # dealt out, with every source's rows over many tasks
    salt = F.pmod(F.xxhash64("doc_id", "size"), F.lit(SALTS)).cast("int")
    spread = plan.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("__salt", salt).join(spread, same & (F.col("__salt") == F.col("__part"))).drop("__salt", "__part", "__source")


def allocate(sizes: DataFrame) -> DataFrame:
    """sizes (doc_id, source, size, __u and any others, read several times) with source_size, target, pi and copies."""
    goals = targets(sizes)
    goals = goals.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    goals = materialize(goals.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "goals")
    plan = materialize(levels(sizes, goals), "levels")
    root = F.sqrt(F.col("size").cast("double"))
    ranked = _with_plan(sizes, plan).withColumn("pi", F.when(F.col("size") > 0, F.least(F.lit(1.0), F.col("c") * root)).otherwise(F.lit(0.0)))
    ranked = ranked.withColumn("__q", F.when(F.col("pi") > 0, F.col("__u") / (1 - F.col("__u")) * (1 - F.col("pi")) / F.col("pi")))
    # bins keep the ranking's order: q / (1 + q) grows with q, and its fourth root spreads it out; what is certain comes first
    spread = F.floor(BINS * F.sqrt(F.sqrt(F.col("__q") / (F.lit(1.0) + F.col("__q"))))).cast("int")
    ranked = ranked.withColumn("__bin", F.when(F.col("pi") >= 1, -1).otherwise(spread))
    bins = ranked.where("__q IS NOT NULL").groupBy("source", "__bin").agg(F.sum("size").alias("bin_size"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("source").orderBy("__bin")
    met = bins.withColumn("before", F.sum("bin_size").over(upto) - F.col("bin_size")).where("before < rest")
    last = materialize(met.groupBy("source").agg(F.max(F.struct("__bin", "before")).alias("last")), "plan")
    edges = plan.select("source").join(last.withColumnRenamed("source", "__of"), F.col("source").eqNullSafe(F.col("__of")), "left").drop("__of")
    joined = _with_plan(ranked, edges)
    columns = [*(c for c in sizes.columns if c != "__u"), "source_size", "target", "pi"]
    before_edge = F.coalesce((F.col("__bin") < F.col("last.__bin")).cast("long"), F.lit(0))
    decided = joined.where("__q IS NULL OR last IS NULL OR __bin <> last.__bin").select(*columns, F.when(F.col("size") == 0, 0).otherwise(F.col("whole") + before_edge).alias("copies"))
    edge = joined.where("__q IS NOT NULL AND __bin = last.__bin")
    so_far = F.sum("size").over(Window.partitionBy("source").orderBy("__q", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0))
    # the sample ends where the words taken come nearest to the rest
    taken = F.col("last.before") + F.col("__so_far") - F.col("size") / 2 < F.col("rest")
    return decided.unionAll(edge.withColumn("__so_far", so_far).select(*columns, (F.col("whole") + taken.cast("long")).alias("copies")))


def sized(docs: DataFrame, *more: Column, seed: int = 0) -> DataFrame:
    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words().alias("size"), uniform(F.col("doc_id").cast("long"), F.col("text"), seed).alias("__u")]
    return materialize(docs.select(*own, *more), "sizes")


def query(docs: DataFrame) -> DataFrame:
    found = allocate(sized(docs))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", F.round("pi", 9).alias("pi"))


def take(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as many times as it has copies, with all its columns.

    Documents meet their copies by doc_id and a hash of text and source; rows alike in these share their copies out."""
    tag = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("source").cast("string"), F.lit("\0")))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    share = allocate(sized(docs, tag.alias("tag"))).withColumn("id", F.coalesce("doc_id", F.lit(NULL_ID)))
    share = share.groupBy("id", "tag").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0")
    # the document travels as one column, so none of its names can clash
    rows = docs.select(F.struct("*").alias("row"), key.alias("id"), tag.alias("tag")).join(share, ["id", "tag"])
    rank = F.row_number().over(Window.partitionBy("id", "tag").orderBy("copies"))
    each = F.floor(F.col("copies") / F.col("rows")) + (rank <= F.col("copies") % F.col("rows")).cast("long")
    many = rows.withColumn("n", each.cast("int")).where("n > 0")
    return many.select("row", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("k")).select("row.*")


ORACLE = """
WITH d AS (SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS BIGINT) AS weight, source_size * 3 AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () - (sum(cap) OVER r - cap)) / (sum(weight) OVER () - (sum(weight) OVER r - weight)) AS level
      FROM w WINDOW r AS (ORDER BY cap / weight, source NULLS LAST)),
c AS (SELECT *, cap <= level * weight AS capped FROM l),
g AS (SELECT source, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE (SELECT max(level) FROM c WHERE NOT capped) * weight END AS target FROM c),
p AS (SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS whole FROM g),
x AS (SELECT source, size, count(*) AS m FROM d WHERE size > 0 GROUP BY ALL),
y AS (SELECT x.source, size, (target - whole * source_size - (sum(size * m) OVER r - size * m)) / sum(size * sqrt(CAST(size AS DOUBLE)) * m) OVER (PARTITION BY x.source ORDER BY size) AS level
      FROM x JOIN p ON x.source IS NOT DISTINCT FROM p.source WINDOW r AS (PARTITION BY x.source ORDER BY size DESC)),
z AS (SELECT source, max(level) FILTER (WHERE level * sqrt(CAST(size AS DOUBLE)) < 1) AS c FROM y GROUP BY source),
u AS (SELECT d.*, (CAST(('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, '')))), 1, 12)) AS BIGINT) + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u,
      CASE WHEN size > 0 THEN least(1, c * sqrt(CAST(size AS DOUBLE))) ELSE 0 END AS pi FROM d LEFT JOIN z ON d.source IS NOT DISTINCT FROM z.source),
q AS (SELECT *, u / (1 - u) * (1 - pi) / pi AS q FROM u WHERE pi > 0),
o AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM q),
k AS (SELECT o.doc_id, o.size, p.source_size, p.target, pi, p.whole + CAST(o.upto - o.size / 2 < p.target - p.whole * p.source_size AS BIGINT) AS copies
      FROM o JOIN p ON o.source IS NOT DISTINCT FROM p.source
      UNION ALL SELECT u.doc_id, u.size, p.source_size, p.target, u.pi, CASE WHEN u.size > 0 THEN p.whole ELSE 0 END FROM u JOIN p ON u.source IS NOT DISTINCT FROM p.source WHERE u.pi = 0)
SELECT doc_id, size, source_size, target, copies * size AS taken, CAST(copies AS BIGINT) AS copies, round(pi, 9) AS pi FROM k
"""
