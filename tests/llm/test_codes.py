"""Vector codes against a plain integer version."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from pulsegrid.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int, code int, error string"


def scaled(x):
    return math.floor(Fraction(x) * 4096)


def brute(rows):
    """rows: (vec_id, embedding, label) -> ({row number: (vec_id, code, error, label_error)}, digest)."""
    kept = [(i, [scaled(x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    w = -(-max((len(v) for _, v, _ in kept), default=0) // 8)
    kept = [(i, v + [0] * (8 * w - len(v)), label) for i, v, label in kept]
    ids = sorted({i for i, _, _ in kept}, key=lambda i: (i is None, i or 0))[:16]
    first = [min(v for j, v, _ in kept if j == i) for i in ids]
    cut = lambda v, p: v[p * w: (p + 1) * w]
    books = [[cut(v, p) for v in first] for p in range(8)]

    def near(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), k) for k, e in enumerate(books[p]))

    for _ in range(6):
        groups = [[[] for _ in book] for book in books]
        for _, v, _ in kept:
            for p in range(8):
                groups[p][near(v, p)[1]].append(cut(v, p))
        books = [[[sum(c) // len(g) for c in zip(*g)] if g else old for g, old in zip(groups[p], books[p])] for p in range(8)]
    out = []
    for i, v, label in kept:
        best = [near(v, p) for p in range(8)]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label))
    by = {}
    for _, _, e, label in out:
        by[label] = by.get(label, 0) + e
    fits = lambda e: e if e < 2**63 else None
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return [(i, code, fits(e), fits(by[label]), digest) for i, code, e, label in out]


def check(spark, rows, parts=4):
    df = spark.createDataFrame([(i, v, label, 1, "x") for i, v, label in rows], SCHEMA).repartition(parts)
    got = [tuple(r) for r in codes.report(df).collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def vectors(n, dims, scale=1.0, seed=1):
    rng = random.Random(seed)
    return [(i, [round(rng.gauss(0, 1), 2) * scale for _ in range(dims)], rng.choice([None, 1, 2, 3])) for i in range(n)]


@pytest.mark.parametrize("dims", [16, 12, 8, 3])
def test_codes_equal_brute_force(spark, dims):
    rows = vectors(150, dims)
    rows += [(0, rows[5][1], 1), (None, rows[6][1], None), (None, rows[7][1], 2), (3, rows[3][1], rows[3][2])]
    rows += [(500, None, 1), (501, [0.5] * (dims - 1) + [None], 1), (502, [math.nan] * dims, 1), (503, [math.inf] * dims, 2)]
    rows += [(600 + i, rows[9][1], 1) for i in range(80)] + [(700, [], 4), (701, [1.0], 4)]
    check(spark, rows)


@pytest.mark.parametrize("scale", [1e5, 3e8, 1e30, 1e200])
def test_large_components_are_exact(spark, scale):
    rows = vectors(40, 16, scale) + vectors(40, 16, 1.0, 2)
    check(spark, [(j, v, label) for j, (_, v, label) in enumerate(rows)])


def test_runs_do_not_change_results(spark, monkeypatch):
    rows = vectors(120, 16)
    monkeypatch.setattr(codes, "RUN", 7)
    check(spark, rows, 2)


def test_traversal_shares_prefixes_and_keeps_its_path():
    rng = np.random.default_rng(3)
    x = rng.integers(-3, 4, (500, 4))
    x = x[np.lexsort(x.T[::-1])]
    book = rng.integers(-3, 4, (16, 4)).tolist()
    want = ((x[:, None, :] - np.array(book)[None]) ** 2).sum(axis=2)
    walk = codes.Traversal(book)
    got = np.concatenate([walk.distances(x[lo: lo + 33]) for lo in range(0, 500, 33)])
    assert (got == want).all()


def test_few_or_no_vectors(spark):
    check(spark, vectors(3, 16))
    check(spark, [(1, None, 1), (2, [math.nan], 2)])
    check(spark, [(1, [], 1), (2, [], None)])
    assert codes.report(spark.createDataFrame([], SCHEMA)).count() == 0
