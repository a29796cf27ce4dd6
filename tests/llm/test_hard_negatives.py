import numpy as np
import pytest

from funnelspark.llm import hard_negatives as h
from tests.llm.oracle import both

SCHEMA = "vec_id long, label string, embedding array<double>, row long, v string, score string"


def brute_force(rows, anchors, scale=256):
    """In Python integers, from distinct usable (id, label, vector)."""
    rows = [(i, label, [int(np.floor(scale * float(x))) for x in v]) for i, label, v in rows]
    out = []
    for i, (anchor, label, v) in enumerate(rows):
        if not anchors(anchor):
            continue
        met = [(-sum(x * y for x, y in zip(v, w)), other, kind) for j, (other, kind, w) in enumerate(rows) if j != i and len(w) == len(v)]
        met.sort(key=lambda m: m[:2])
        for p, positive, _ in [m for m in met if m[2] == label][:5]:
            fit = [m for m in met if m[2] != label and 30 * -p <= 100 * -m[0] <= 90 * -p]
            out += [(anchor, positive, r, other, -p, -s) for r, (s, other, _) in enumerate(fit[:10], 1)]
    return sorted(out)


def run(spark, rows, anchors="id % 3 = 0"):
    named = [(*r, 1, "x", "y") for r in rows]
    return sorted(tuple(r) for r in h.hard_negatives(spark.createDataFrame(named, SCHEMA).repartition(3), anchors).collect())


@pytest.mark.parametrize("scale", [1, 40, 20_000])
def test_against_integers(spark, monkeypatch, scale):
    """Several cells, ties, one label of half of all rows, equal vectors."""
    monkeypatch.setattr(h, "ANCHORS", 20)
    monkeypatch.setattr(h, "ROWS", 50)
    rng = np.random.default_rng(scale)
    base = rng.normal(size=(30, 6)) * scale
    rows = [(i, "a" if i % 2 else str(i % 5), (base[rng.integers(30)] + (i % 3) * rng.normal(size=6) * 0.1 * scale).tolist()) for i in range(240)]
    got = run(spark, rows)
    assert len(got) > 500 and got == brute_force([(i, label, v) for i, label, v in rows], lambda i: i % 3 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    usable = [(0, "a", [1.0, 0.0]), (1, "a", [1.0, 0.1]), (2, "b", [0.6, 0.0]), (2, "b", [0.5, 0.0]), (3, "b", [0.0, 0.0]), (4, "a", [-1.0, 0.0]), (5, "b", [1.0]), (6, "b", [])]
    odd = [(7, None, [1.0, 0.0]), (8, "b", None), (9, "b", [1.0, None]), (10, "b", [nan, 0.0]), (11, "b", [inf, 0.0]), (None, "b", [0.7, 0.0])]
    assert run(spark, usable + usable[:3] + odd) == brute_force(usable, lambda i: i % 3 == 0)
    assert run(spark, []) == [] and run(spark, odd) == []


def test_scores_beyond_exact(spark):
    with pytest.raises(ValueError, match="scores may reach"):
        run(spark, [(0, "a", [1e9]), (1, "b", [1e9])])


def test_residues_give_exact_products():
    rng = np.random.default_rng(3)
    for size, d in [(1, 1), (300, 64), (30_000, 3000), (2_000_000, 700)]:
        a, b = rng.integers(-size, size + 1, (5, d)), rng.integers(-size, size + 1, (7, d))
        a[0], b[0] = size, -size
        primes = h.primes_for(d * size * size)
        assert (h.products([h.residues(a, p) for p in primes], [h.residues(b, p) for p in primes], primes) == a @ b.T).all()
    assert np.prod([float(p) for p in h.PRIMES[:7]]) > 2 * h.LARGEST


def test_against_sql(spark):
    got, expected = both(spark, "/root/testdata/sf0.01", "op11_residue_gemm", ["embeddings"])
    assert got == expected and len(got) > 100
