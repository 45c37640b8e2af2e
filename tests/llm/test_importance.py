import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from rainloom.llm import importance

from .conftest import bag

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [(1, "the stone of the river", "clash"), (2, None, "clash"), (3, "north cloud north cloud SIGNAL", "clash"), (3, "", "clash")]


def features(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def plain(rows, items):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    own = Counter(bucket(f) for r in rows for f in features(r[1])[1])
    aim = Counter(bucket(f) for r in items for f in features(r[1])[1])
    s, t = sum(own.values()), sum(aim.values())
    gain = {b: math.floor(1000 * math.log((aim[b] + 1) * (s + 10000) / ((own[b] + 1) * (t + 10000)))) for b in own}
    out, able = [], []
    for k, r in enumerate(rows):
        w, f = features(r[1])
        weight = math.floor(sum(gain[bucket(x)] for x in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"7:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([r[0], len(f), weight, score, None])
        if len(w) >= 20:
            able.append((-score, math.inf if r[0] is None else r[0], k))
    for rank, (_, _, k) in enumerate(sorted(able)[: 25 * len(able) // 100], 1):
        out[k][4] = rank
    return out


def test_resample(spark, docs, rows, no_docs):
    target = spark.createDataFrame(ITEMS, "item_id long, text string, weight string")
    want = plain(rows, ITEMS)
    found = bag(importance.query(docs, target), "doc_id", "n_features", "weight", "score", "rank")
    # rows alike in score and doc_id may change places
    alone = [r for r in found if sum(1 for w in want if (w[0], w[3]) == (r[0], r[3])) == 1]
    assert alone == sorted((tuple(w) for w in want if sum(1 for v in want if (v[0], v[3]) == (w[0], w[3])) == 1), key=repr)
    assert sorted((r[:4] for r in found), key=repr) == sorted((tuple(w[:4]) for w in want), key=repr)
    assert sorted(r[4] for r in found if r[4]) == list(range(1, 1 + max(w[4] or 0 for w in want)))
    assert importance.query(no_docs, target).count() == 0


def test_without_a_target(docs, rows, no_docs):
    found = bag(importance.query(docs, no_docs), "doc_id", "weight", "score")
    assert found == sorted(((w[0], w[2], w[3]) for w in plain(rows, [])), key=repr)


def test_small_tries_and_partitions(spark, docs, monkeypatch):
    """Where a trie starts anew, and how rows are dealt out, doesn't show."""
    target = spark.createDataFrame(ITEMS, "item_id long, text string, weight string")
    gain = importance.gains(docs, target)
    assert (importance.gains(docs.repartition(1), target) == gain).all()
    texts = [(r.text or "").encode() for r in docs.select("text").collect()]
    words = importance._words(texts)
    whole, parts = importance.Trie(), importance.Trie()
    whole.count(words)
    for t in texts:
        parts.count(importance._words([t]))
    assert (whole.totals() == parts.totals()).all() and len(whole) == len(parts)
    each = [int(importance.Trie().gains(importance._words([t]), gain)[0]) for t in texts]
    assert each == whole.gains(words, gain).tolist()


@pytest.mark.parametrize("n, drawn", [(0, 0), (3, 0), (4, 1), (40, 10), (41, 10)])
def test_ranks_of_ties(spark, n, drawn):
    rows = [(k, 20, 5) for k in range(n)] + [(100 + k, 19, 9) for k in range(5)]
    found = importance.ranked(spark.createDataFrame(rows, "doc_id long, n_words long, score long")).collect()
    assert sorted((r.rank, r.doc_id) for r in found if r.rank) == [(k + 1, k) for k in range(drawn)] and len(found) == n + 5
