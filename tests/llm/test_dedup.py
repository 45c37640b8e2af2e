import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from rainloom.llm import simhash, superkmers
from rainloom.llm.common import NULL_ID, NOT_SPACE, Words

from .conftest import bag


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fingerprint(text):
    w = words_of("".join(c.lower() if c.isascii() else c for c in text or ""))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def closure(fps):
    fps = np.array(fps, np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= 3
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None], len(fps)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def test_fingerprints_and_components(docs, no_docs, rows):
    fps = [fingerprint(r[1]) for r in rows]
    label = closure(fps)
    least = defaultdict(list)
    for r, c in zip(rows, label, strict=True):
        least[c].append(NULL_ID if r[0] is None else r[0])
    real = lambda x: None if x == NULL_ID else x
    expected = sorted(((r[0], f"{f:016x}", real(min(least[c]))) for r, f, c in zip(rows, fps, label, strict=True)), key=repr)
    assert bag(simhash.query(docs), "doc_id", "fingerprint", "component_id") == expected
    assert simhash.query(no_docs).count() == 0 and simhash.keep_each(no_docs).count() == 0


@pytest.mark.parametrize("limit", [0, 10_000])
def test_forest_keeps_every_link(limit, monkeypatch):
    """Both ways, comparing all and looking neighbours up, connect just what is within three bits."""
    monkeypatch.setattr(simhash, "COMPARE", limit)
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 2**63, 6, dtype=np.uint64)
    fps = set(centre.tolist())
    for c in centre.tolist():
        for _ in range(25):
            c ^= sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False))
            fps.add(c)
    fps = sorted(fps)
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    buckets = defaultdict(list)
    for f in fps:
        for v in range(64):
            half = f >> 32 if v < 32 else f & 0xFFFFFFFF
            buckets[v << 32 | half & ~(1 << v % 32)].append(f)
    for key, own in buckets.items():
        edges = simhash.forest(np.array(own, np.uint64).view(np.int64), key) if len(own) > 1 else []
        assert len(edges) < len(own)
        for a, b in edges:
            a, b = a % 2**64, b % 2**64
            assert (a ^ b).bit_count() <= 3
            parent[max(root(a), root(b))] = min(root(a), root(b))
    label = closure(fps)
    found = [root(f) for f in fps]
    assert len(set(zip(label.tolist(), found, strict=True))) == len(set(label.tolist())) == len(set(found))


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 300), (300, 200), (-5, 100)]
    found = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(1, 41)}, **{k: -5 for k in (100, 200, 300)}}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def kept(rows, window=13):
    least = {}
    for r in rows:
        w = words_of(r[1])
        for i in range(len(w) - window + 1):
            g, d = tuple(w[i : i + window]), NULL_ID if r[0] is None else r[0]
            least[g] = min(d, least.get(g, d))
    out = []
    for r in rows:
        w, d = words_of(r[1]), NULL_ID if r[0] is None else r[0]
        gone = {j for i in range(len(w) - window + 1) if least[tuple(w[i : i + window])] < d for j in range(i, i + window)}
        text = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_substring_dedup(docs, no_docs, rows):
    expected = kept(rows)
    assert sum(r[2] for r in expected) > 3000
    assert bag(superkmers.query(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == expected
    assert superkmers.query(no_docs).count() == 0


@pytest.mark.parametrize("size", [200, 3000])
def test_substring_dedup_over_small_slices(docs, rows, size, monkeypatch):
    """What is settled inside a slice and what is settled in buckets add up the same, wherever slices end."""
    from rainloom.llm import common

    whole = superkmers.slices
    monkeypatch.setattr(superkmers, "slices", lambda batch, column, limit=0: whole(batch, column, size))
    assert bag(superkmers.query(docs.coalesce(1)), "doc_id", "n_words", "n_removed", "kept_sha256") == kept(rows)
    assert common.slices is whole


def test_substring_dedup_with_split_minimisers(docs, no_docs, rows, monkeypatch):
    """Whatever minimisers are split, the windows are the same."""
    texts = [(r[1] or "").encode() for r in rows]
    every = np.unique(superkmers.minimisers(Words(texts, NOT_SPACE))[1])
    own = docs.selectExpr("doc_id", "text")
    some = superkmers.hot_minimisers(own, len(rows), 400)
    assert 0 < len(some) <= 800 and set(some.tolist()) <= set(every.tolist()) and not len(superkmers.hot_minimisers(no_docs, 0, 400))
    least = superkmers.minimisers(Words(texts, NOT_SPACE), every)[1]
    assert len(np.unique(least)) > len(every)
    for hot in (every, every[::3]):
        monkeypatch.setattr(superkmers, "hot_minimisers", lambda *_, hot=hot: hot)
        assert bag(superkmers.query(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == kept(rows)


def test_super_kmers_hold_every_window_once(rows):
    texts = [(r[1] or "").encode() for r in rows]
    words = Words(texts, NOT_SPACE)
    strings, begins, ends, least = superkmers.super_kmers(words)
    found = [tuple(s.split()[i : i + 13]) for s in strings for i in range(len(s.split()) - 12)]
    assert found == [tuple(t.split()[i : i + 13]) for t in texts for i in range(len(t.split()) - 12)]
    assert [e - b for b, e in zip(begins, ends, strict=True)] == [len(s.split()) for s in strings]
    codec = superkmers.Codec(b"")
    ids, tags = np.arange(len(strings)) * -7, np.arange(len(strings), dtype=np.uint32) * 1000003
    back = superkmers.unpack(codec, superkmers.pack(codec, strings, np.arange(len(strings)), ids, tags, begins))
    assert back[0] == strings and (back[2] == ids).all() and (back[3] == tags).all() and (back[4] == begins).all()


def test_colliding_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(superkmers, "_ODD", np.uint64(0))
    monkeypatch.setattr(superkmers, "mix", lambda x: x * np.uint64(0))
    a, b = " ".join(f"w{i}" for i in range(14)).encode(), " ".join(f"v{i}" for i in range(13)).encode()
    _, _, low = superkmers.least_documents([a, b, a], np.array([5, 1, 3]))
    assert low.tolist() == [3, 3, 1, 3, 3]
