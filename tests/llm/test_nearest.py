import math

import numpy as np
import pytest

from funnelspark.llm import nearest
from funnelspark.llm.nearest import fit_tree, neighbours
from funnelspark.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label string, v int"


def brute(rows, query_ids, k):
    """Exact neighbours in double precision, ties to smaller ids."""
    ok = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, dtype=np.float32).astype(float)
    out = {}
    for q in query_ids:
        if q in ok:
            a = ok[q]
            scores = sorted((-float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), i) for i, b in ok.items() if i != q)
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def grouped(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_odd_vectors_ties_and_copies(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4)], "x", 1) for i in range(60)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0], "x", 1) for i in range(40)]
    rows += [(200, None, "", 1), (201, [], "", 1), (202, [0.0] * 4, "", 1), (203, [1.0, None, 1.0, 1.0], "", 1)]
    rows += [(204, [float("nan"), 1.0, 1.0, 1.0], "", 1), (205, [float("inf"), 1.0, 1.0, 1.0], "", 1), (None, [1.0] * 4, "", 1)]
    rows += [rows[3], rows[3], rows[60]]
    x = spark.createDataFrame(rows, SCHEMA)
    ids = [i for i, *_ in rows if i is not None and i % 2 == 0]
    got = grouped(neighbours(x, x.where("vec_id % 2 = 0"), 5, visits=10**6).collect())
    want = brute(rows, ids, 5)
    assert got.keys() == want.keys()
    for q, w in want.items():
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in w], abs=1e-12)
    assert [i for i, _ in got[110]] == [100, 101, 102, 103, 104] and [i for i, _ in got[100]] == [101, 102, 103, 104, 105]


def test_queries_dealt_over_cells_and_a_larger_tree(spark, monkeypatch):
    monkeypatch.setattr(nearest, "QUERIES", 7)
    monkeypatch.setattr(nearest, "BLOCK", 20)
    monkeypatch.setattr(nearest, "SAMPLE", 100)
    monkeypatch.setattr(nearest, "SHARE", 2)
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=6)], "x", 1) for i in range(600)]
    x = spark.createDataFrame(rows, SCHEMA)
    assert nearest.build(nearest.usable(x, "vec_id", "embedding"))[0].leaves > nearest.fit_tree(nearest._unit(rng.normal(size=(100, 6)))).leaves
    got = grouped(neighbours(x, x.where("vec_id % 4 = 0"), 5, visits=10**6).collect())
    want = brute(rows, [i for i in range(600) if i % 4 == 0], 5)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_few_and_no_vectors(spark):
    x = spark.createDataFrame([(i, [1.0, float(i)], "", 0) for i in range(3)], SCHEMA)
    assert {q: len(v) for q, v in grouped(neighbours(x, x).collect()).items()} == {0: 2, 1: 2, 2: 2}
    assert neighbours(x.limit(0), x.limit(0)).count() == 0
    assert neighbours(x.where("vec_id = 0"), x).where("query_id = 0").count() == 0


def test_vectors_meet_those_of_their_dimension(spark):
    """The smallest id has another dimension than most; one dimension holds a query alone."""
    rows = [(0, [1.0, 2.0], "", 0), (1, [1.0, 0.0, 0.0], "", 0), (2, [0.0, 1.0, 0.2], "", 0), (50, [1.0, 0.1, 0.0], "", 0)]
    rows += [(4, [2.0, 1.0], "", 0), (100, [1.0], "", 0)]
    x = spark.createDataFrame(rows, SCHEMA)
    got = grouped(neighbours(x, x.where("vec_id % 50 = 0")).collect())
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [4], 50: [1, 2]}


def test_best_bin_first_meets_every_leaf_once():
    x = np.random.default_rng(1).normal(size=(800, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = fit_tree(x)
    assert tree.leaves > 10
    own = tree.assign(x)
    for v, leaf in zip(x[:50], own):
        visits = tree.visits(v, tree.leaves)
        assert sorted(visits) == list(range(tree.leaves)) and visits[0] == leaf


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = brute(rows, [i for i, _ in rows if i % 50 == 0], 5)
    got = grouped(QUERIES["op8_k_means_tree"](spark, folder).collect())
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
