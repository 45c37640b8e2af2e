from collections import defaultdict

import corpus_pipeline
from rainloom.llm.common import NULL_ID

from .conftest import SCHEMA
from .test_dedup import closure, fingerprint


def check(spark, rows, given):
    """One row of every component stays, and it has the component's least doc_id."""
    stage = dict(corpus_pipeline.STAGES)["simhash near-dedup"]
    kept = stage(spark, given, None)
    assert kept.columns == given.columns
    fps = [fingerprint(r[1]) for r in rows]
    own = defaultdict(list)
    for r, c in zip(rows, closure(fps), strict=True):
        own[c].append(r)
    of = {fingerprint(r[1]): c for c, group in own.items() for r in group}
    order = lambda r: NULL_ID if r[0] is None else r[0]
    found = [tuple(r) for r in kept.collect()]
    assert sorted(of[fingerprint(r[1])] for r in found) == sorted(own)
    for r in found:
        group = own[of[fingerprint(r[1])]]
        assert r in group and order(r) == min(map(order, group))
    return found


def test_every_component_keeps_one_row(spark, docs, rows):
    check(spark, rows, docs)


def test_shared_and_missing_ids(spark):
    """Unlinked texts without an id, and an id that is the least of one component but not of another."""
    texts = [f"alpha{k} beta{k} gamma{k} delta{k} omega{k}" for k in range(12)]
    made = [(None, t) for t in texts[:8]] + [(3, texts[0]), (7, texts[8]), (9, texts[8]), (5, texts[9]), (7, texts[9]), (7, texts[10]), (7, texts[10]), (8, texts[11])]
    rows = [(d, t, *[None] * 7) for d, t in made]
    found = check(spark, rows, spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert len(found) == 12 and sum(r[0] is None for r in found) == 8
