"""Documents to token blocks in five stages, each over all that the one before it kept.

Toxic documents go; of each near-duplicate component one document stays; documents with benchmark passages go; the
sources are mixed to their target weights, documents with several copies repeating; the mix is tokenised, written in
patched frame-of-reference blocks and read back. All but the last return the columns of `documents`.

Defined results: a null text counts as an empty one. toxicity: empty texts stay; without labels of both kinds all stay.
simhash near-dedup: all empty and wordless texts are one component, of which one row stays; rows that share a doc_id or
have none stand for themselves. benchmark decontamination: an empty benchmark leaves all. source mixing: documents
without words go, null is a source of its own, repeated rows share their copies out. token output: a row for each row,
null doc_ids first, rows that share a doc_id by hash of the text. Every stage keeps other columns as they are, whatever
their names, and gives no rows for an empty table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rainloom.llm import mixing, phrases, simhash, token_blocks, toxicity
from rainloom.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return phrases.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_blocks.query(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("source mixing", mix_sources),
    ("token output", write_tokens),
]

#: Learned scores, XXH64 and the tokenizer have no SQL: the tests hold run() against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder as Parquet and reread for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
