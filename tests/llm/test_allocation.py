import zlib
from collections import Counter, defaultdict

import pytest

from rainloom.llm import mixing, sharding

from .conftest import bag


def goals(sizes):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / max(1, sum(weight[r] for r in rest)) for s in rest}
        over = [s for s in rest if share[s] >= 3 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in over}


def test_mix(docs, no_docs, rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len((r[1] or "").encode().split())
    want = goals(dict(sizes))
    found = mixing.query(docs).withColumnRenamed("doc_id", "d").collect()
    assert len(found) == len(rows)
    for r in found:
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r["size"]
    taken, most, size_of = defaultdict(int), defaultdict(int), {}
    for r in found:
        key = (r.source_size, round(r.target, 6))
        taken[key] += r.taken
        most[key] = max(most[key], r["size"])
    expected = {(n, round(want[s], 6)) for s, n in sizes.items()}
    assert set(taken) == expected
    for key, n in taken.items():
        assert abs(n - key[1]) <= most[key] / 2 + 1, key
    assert bag(mixing.query(docs.repartition(3)), "doc_id", "size", "taken") == bag(mixing.query(docs), "doc_id", "size", "taken")
    assert mixing.query(no_docs).count() == 0


def test_many_sources_are_dealt_out(docs, monkeypatch):
    before = bag(mixing.query(docs), "doc_id", "size", "taken")
    monkeypatch.setattr(mixing, "SOURCES", 0)
    assert bag(mixing.query(docs), "doc_id", "size", "taken") == before


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 1000, "c": 5, "d": 5}, {"a": 10, "b": 10, "c": 10}, {"a": 0, "b": 7, None: 3}, {"z": 4}])
def test_targets_share_the_excess(spark, sizes):
    made = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    found = {r.source: r.target for r in mixing.targets(made).collect()}
    want = goals(sizes)
    assert found == {s: pytest.approx(want[s]) for s in sizes}
    assert sum(found.values()) == pytest.approx(sum(sizes.values()))


def test_take_repeats_documents(docs, no_docs, rows):
    copies = Counter()
    for r in mixing.query(docs).collect():
        copies[r.doc_id, r["size"]] += r.copies
    got = Counter((r.doc_id, len((r.text or "").encode().split())) for r in mixing.take(docs).collect())
    assert +copies == got
    assert mixing.take(docs).columns == docs.columns and mixing.take(no_docs).count() == 0


def test_longer_documents_are_likelier(spark):
    docs = spark.createDataFrame([(k, "w " * (10 if k % 2 else 160), s) for k in range(3000) for s in ("a", "b")], "doc_id long, text string, source string")
    part = Counter((r["size"], r.copies) for r in mixing.query(docs).where("target < source_size").collect())
    rate = lambda n: part[n, 1] / (part[n, 0] + part[n, 1])
    assert 0.05 < rate(10) < rate(160) < 1


def inclusion(sizes, rest):
    """Inclusion probabilities by bisection for c."""
    low, high = 0.0, 1e6
    for _ in range(200):
        c = (low + high) / 2
        low, high = (c, high) if sum(n * min(1, c * n**0.5) for n in sizes) < rest else (low, c)
    return {n: min(1, low * n**0.5) for n in sizes}


def test_inclusion_probabilities(docs, rows):
    """pi solves the expected words, and documents are taken in order of the odds of their number over those of pi."""
    own = defaultdict(list)
    for r in mixing.query(docs).collect():
        own[r.source_size, round(r.target, 6)].append(r)
    some = 0
    for (source_size, target), group in own.items():
        if not source_size:
            continue
        rest = target - int(target / source_size + 1e-12) * source_size
        pi = inclusion([r["size"] for r in group if r["size"]], rest)
        for r in group:
            assert r.pi == pytest.approx(pi.get(r["size"], 0.0), abs=1e-6)
        whole = int(target / source_size + 1e-12)
        assert all(r.copies > whole for r in group if r.pi > 1 - 1e-9)
        some += sum(0 < r.pi < 1 for r in group)
    assert some > 10


def test_pareto_sample_keeps_its_probabilities(spark):
    """Over many seeds the documents' frequencies come to their inclusion probabilities."""
    docs = spark.createDataFrame([(k, "w " * (4 + k * 7 % 40), s) for k in range(60) for s in ("a", "b", "c")], "doc_id long, text string, source string").cache()
    taken, pi, runs = Counter(), {}, 12
    for seed in range(runs):
        for r in mixing.allocate(mixing.sized(docs, seed=seed)).where("source = 'a'").collect():
            taken[r["size"]] += r.copies - int(r.target // r.source_size)
            pi[r["size"]] = r.pi
    count = Counter(4 + k * 7 % 40 for k in range(60))
    expected = {n: pi[n] * count[n] * runs for n in pi}
    assert sum(taken.values()) == pytest.approx(sum(expected.values()), rel=0.05)
    off = sum((taken[n] - e) ** 2 / (e * (1 - pi[n]) + 1) for n, e in expected.items()) / len(expected)
    assert off < 2


def jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_shards(spark, docs, no_docs, rows):
    import hashlib

    key = lambda d: int(hashlib.md5(("null" if d is None else str(d)).encode()).hexdigest()[:15], 16)
    found = sharding.query(docs)
    expected = []
    for r in rows:
        b = (r[1] or "").encode()
        expected.append((r[0], len(b) + 16, zlib.crc32(b), "key", jump(key(r[0]), 40), jump(key(r[0]), 41)))
    assert bag(found, "doc_id", "size", "text_crc32", "law", "shard", "grown_shard") == sorted(expected, key=repr)
    slots = defaultdict(list)
    for r in found.collect():
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 40)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sharding.query(no_docs).count() == 0


def test_slots_over_many_ranges(spark):
    docs = spark.createDataFrame([(k if k < 3000 else None if k % 2 else 7, "x" * (k % 3 if k < 3800 else 1), "clash") for k in range(4000)], "doc_id long, text string, slot string")
    found = sharding.query(docs).toPandas()
    for _, own in found.groupby("shard"):
        own = own.assign(last=own.doc_id.isna()).sort_values(["last", "doc_id", "text_crc32", "size"], kind="stable")
        assert sorted(own.slot) == list(range(len(own)))
        # slots follow the order at any size; rows alike share theirs out
        for _, alike in own.assign(at=range(len(own))).groupby(["last", "doc_id", "text_crc32"], dropna=False):
            assert sorted(alike.slot) == alike["at"].tolist()
    sizes = found[found.doc_id < 3000].drop_duplicates("doc_id").shard.value_counts()
    assert len(sizes) == 40 and sizes.max() < 120 and sizes.min() > 40
    moved = (found.shard != found.grown_shard).mean()
    assert 0.005 < moved < 0.1


def test_write(docs, tmp_path, spark):
    sharding.write(docs.drop("shard"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.count()
