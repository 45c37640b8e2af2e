import math
import random

import numpy as np
import pytest

from rainloom.llm import topk, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, q long, v string, x int, k int, list int, salt int, component int, at string"


def made_vectors() -> list[tuple]:
    """Vectors with nulls, infinities, ties, copies under ids of their own, repeated rows and ids, short ones and no ids."""
    rng = random.Random(5)
    draw = lambda n=9: [rng.uniform(-0.6, 0.6) for _ in range(n)]
    many = draw()
    pairs = [(k, draw()) for k in range(1, 140)] + [(k, many) for k in range(200, 330)]
    pairs += [(0, draw()), (50, draw()), (400, many), (400, many), (450, [0.0] * 9), (500, [-x for x in many]), (550, draw(4)), (600, []), (650, [1e-4, -1e-4])]
    pairs += [(-50, draw()), (None, many), (None, draw()), (700, None), (750, [0.1, None, 0.2] + [0.0] * 6), (800, [math.nan] * 9), (850, [math.inf] + [0.0] * 8), (3, pairs[2][1]), (3, draw())]
    return [(k, e, 1, 7, "clash", 7, 7, 7, 7, 7, "clash") for k, e in pairs]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(made_vectors(), SCHEMA).repartition(4).cache()


def usable(rows, scale, offset=0):
    """Ids, and whole numbers filled up with zeros, of the rows that take part."""
    kept = [(k, e) for k, e, *_ in rows if e is not None and all(c is not None and math.isfinite(c) for c in e)]
    wide = max((len(e) for _, e in kept), default=0)
    return [k for k, _ in kept], np.array([[math.floor(scale * float(np.float32(c))) + offset for c in e] + [offset] * (wide - len(e)) for _, e in kept], np.int64)


def plain_top(rows, k):
    ids, x = usable(rows, 256)
    out = []
    for i, own in enumerate(ids):
        if own is not None and own % 50 == 0:
            found = sorted((-int(x[i] @ x[j]), math.inf if ids[j] is None else ids[j]) for j in range(len(ids)) if j != i)[:k]
            out += [(own, r, None if other == math.inf else other, -s) for r, (s, other) in enumerate(found, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("lists", [1, 2, 3, 9])
def test_top_k(vectors, monkeypatch, lists):
    monkeypatch.setattr(topk, "VECTORS", 40)
    monkeypatch.setattr(topk, "QUERIES", 4)
    found = topk.top_k(vectors, lists=lists).collect()
    assert sorted(map(tuple, found), key=repr) == plain_top(made_vectors(), 5)


def test_few_and_no_vectors(spark, vectors):
    few = vectors.where("vec_id in (0, 50, 7)")
    assert sorted(map(tuple, topk.top_k(few).collect()), key=repr) == plain_top([r for r in made_vectors() if r[0] in (0, 50, 7)], 5)
    assert topk.top_k(vectors.where("vec_id = 100")).count() == 0
    assert topk.top_k(vectors.where("vec_id = 7")).count() == 0
    empty = topk.top_k(vectors.where("false"))
    assert empty.count() == 0 and empty.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]


def test_large_components(spark):
    """Beyond 2^53 whole numbers are multiplied as such; what might not fit a long is refused."""
    rows = [(0, [2.0**17, 3.0]), (1, [2.0**17 + 1, 5.0]), (2, [-(2.0**17), 1.0])]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert [(r.vec_id, r.score) for r in found] == [(1, 2**25 * (2**25 + 256) + 768 * 1280), (2, -(2**50) + 768 * 256)]
    with pytest.raises(ArithmeticError):
        topk.top_k(spark.createDataFrame([(0, [1e9]), (1, [1e9])], "vec_id long, embedding array<double>"))


def plain_whitening(rows):
    """By a dense eigensolver, over whole numbers of any size."""
    ids, x = usable(rows, 64, 1_000_000)
    written = {tuple(r[1]) for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])}
    _, fit = usable([(None, e) for e in written], 64, 1_000_000)
    seen = {(len(e), tuple(math.floor(64 * float(np.float32(c))) for c in e)): k for k, e in enumerate(written)}
    fit = fit[sorted(seen.values())]
    n, total = len(fit), fit.sum(axis=0)
    centred = (n * fit - total) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = values > 1e-11 * values[0]
    return ids, x, n, total, values[real][:16], vectors[:, real][:, :16], values.sum()


def test_whitening(vectors):
    ids, x, n, total, values, directions, trace = plain_whitening(made_vectors())
    found = whitening.whiten(vectors).collect()
    assert len(found) == len(ids) * len(values)
    assert {r.n for r in found} == {n} and max(r.identity_error for r in found) < 1e-10 and len({r.identity_error for r in found}) == 1
    for c in range(1, len(values) + 1):
        own = [r for r in found if r.component == c]
        assert own[0].explained == pytest.approx(values[c - 1] / trace, rel=1e-9)
        want = (x - total / n) @ directions[:, c - 1] / np.sqrt(values[c - 1])
        deviation = ((n * x - total) ** 2).sum(axis=1)
        expected = sorted(zip(deviation.tolist(), want.tolist(), [repr(k) for k in ids], strict=True))
        got = sorted((r.deviation, r.whitened, repr(r.vec_id)) for r in own)
        # one sign for all rows; equal deviations may sort differently by rounding
        sign = 1 if abs(sum(a[1] * b[1] for a, b in zip(got, expected, strict=True))) == pytest.approx(sum(a[1] * b[1] for a, b in zip(got, expected, strict=True))) else -1
        got = sorted((r.deviation, sign * r.whitened, repr(r.vec_id)) for r in own)
        assert [g[0] for g in got] == [e[0] for e in expected]
        by_id = lambda rows: sorted((k, d, round(w, 7) + 0.0) for d, w, k in rows)
        assert by_id(got) == by_id(expected)


def test_whitening_without_spread(spark, vectors):
    assert whitening.whiten(vectors.where("false")).count() == 0
    assert whitening.whiten(vectors.where("vec_id = 1")).count() == 0
    assert whitening.whiten(vectors.where("vec_id between 200 and 300")).count() == 0
    assert whitening.whiten(vectors.where("vec_id = 600")).count() == 0
    line = spark.createDataFrame([(k, [float(k), 2.0 * k, 0.5]) for k in range(8)], "vec_id long, embedding array<double>")
    found = whitening.whiten(line).collect()
    assert {r.component for r in found} == {1} and found[0].explained == pytest.approx(1.0)
    assert np.mean([r.whitened**2 for r in found]) == pytest.approx(1.0)


def test_whitening_of_large_components(spark):
    rows = [(k, [2.0**40 + 3 * k, 5.0 * (k % 3)]) for k in range(9)]
    found = {(r.vec_id, r.component): r for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    x = np.array([[int(64 * a), int(64 * b)] for _, (a, b) in rows], object)
    exact = ((9 * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert [found[k, 1].deviation for k in range(9)] == exact.tolist()
    huge = spark.createDataFrame([(k, [2.0**50 * k]) for k in range(3)] + [(9, [1e300])], "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in whitening.whiten(huge).collect()}
    assert sorted(found) == [0, 1, 2] and found[0].deviation is None and found[1].deviation == 0 and found[2].whitened == pytest.approx(math.sqrt(1.5), rel=1e-9) or found[0].whitened == pytest.approx(math.sqrt(1.5), rel=1e-9)


@pytest.mark.parametrize("values", [[5.0] * 20, [9, 9, 9, 3, 1], [1.0], [1e6, 1, 1e-6, 0, 0, 0], list(range(200, 0, -1)), [2.0] * 5 + [1.0] * 300, [0.0] * 4])
def test_leading_eigenvectors(values):
    """Eigenvalues that repeat, spent directions and whole spaces."""
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    matrix = turn @ np.diag(np.array(values, float)) @ turn.T
    found, vectors, _ = whitening.leading(lambda b: matrix @ b, len(values), min(16, len(values)))
    assert found == pytest.approx(sorted(values, reverse=True)[:16], rel=1e-9, abs=1e-9)
    assert vectors.T @ vectors == pytest.approx(np.eye(vectors.shape[1]), abs=1e-12)
    assert np.abs(matrix @ vectors - vectors * found).max() <= 1e-12 * max(max(values), 1)


def test_few_passes_where_eigenvalues_fall(monkeypatch):
    rng = np.random.default_rng(2)
    turn = np.linalg.qr(rng.standard_normal((400, 400)))[0]
    matrix = turn @ np.diag(0.5 ** np.arange(400)) @ turn.T
    found, _, passes = whitening.leading(lambda b: matrix @ b, 400, 16)
    assert passes < 8 and found == pytest.approx(0.5 ** np.arange(16), rel=1e-7)
