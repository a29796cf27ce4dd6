import numpy as np
import pytest

from funnelspark.llm import cap_filters as c

SCHEMA = "vec_id long, label string, embedding array<double>, n_links string, row long, v string"


def brute_force(rows, least=0.93):
    """(id, n_links, component_id, kept) of every (id, label, vector), all pairs compared."""
    usable = [i for i, (a, label, v) in enumerate(rows) if a is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    for p, i in enumerate(usable):
        for j in usable[:p]:
            (_, k, v), (_, m, w) = rows[i], rows[j]
            v, w = (np.array(x) / max(map(abs, x)) for x in (v, w))
            if k == m and len(v) == len(w) and np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w)) >= least:
                links[i].add(j)
                links[j].add(i)
    out = []
    for i, (a, _, _) in enumerate(rows):
        seen, to = {i}, [i]
        while to:
            to += (new := links[to.pop()] - seen)
            seen |= new
        first = None if a is None else min(rows[j][0] for j in seen)
        out.append((a, len(links[i]), first, a is not None and first == a))
    return sorted(out, key=str)


def run(spark, rows):
    named = [(*r, "x", 1, "y") for r in rows]
    return sorted((tuple(r) for r in c.near_vectors(spark.createDataFrame(named, SCHEMA).repartition(3)).collect()), key=str)


def planted(rng, n, d, groups, spread):
    """Groups of near vectors, one of half of them, among scattered ones; ids not in order."""
    centres = rng.normal(size=(groups, d))
    ids = rng.permutation(n).tolist()
    rows = []
    for i in range(n):
        v = centres[0 if i % 2 else rng.integers(groups)] + rng.normal(size=d) * spread if i % 3 else rng.normal(size=d)
        rows.append((ids[i], "a" if i % 4 else "b", v.tolist()))
    return rows


@pytest.mark.parametrize("block", [2048, 16])
def test_planted_groups(spark, monkeypatch, block):
    """Groups with all, some and few of their pairs linked; whole cells and cells of blocks. 0.25 straddles the bound."""
    monkeypatch.setattr(c, "BLOCK", block)
    rows = planted(np.random.default_rng(block), 300, 16, 6, 0.25)
    got, expected = run(spark, rows), brute_force(rows)
    links = sum(r[1] for r in expected)
    assert links > 2000 and 0.99 * links <= sum(r[1] for r in got) <= links
    assert all(g[1] <= e[1] for g, e in zip(got, expected)) and np.mean([g == e for g, e in zip(got, expected)]) > 0.9


def test_dense_groups_are_exact(spark):
    rows = planted(np.random.default_rng(4), 400, 24, 5, 0.05)
    assert run(spark, rows) == brute_force(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 0.2, 0.0]
    rows = [(5, "a", v), (3, "a", v), (5, "a", v), (5, "a", [2.0, 0.4, 0.0]), (9, "b", v), (8, "b", [-1.0, 0.0, 0.0]), (7, None, v), (None, "a", v)]
    rows += [(10, "a", None), (11, "a", []), (12, "a", [0.0, 0.0, 0.0]), (13, "a", [1.0, None, 0.0]), (14, "a", [nan, 1.0, 1.0]), (15, "a", [inf, 1.0, 1.0])]
    rows += [(16, "a", [1.0, 0.2]), (17, "a", [1.0, 0.21]), (18, "a", [3.0]), (19, "a", [5.0]), (20, "a", [-5.0]), (21, "a", [1e300, 2e299, 0.0]), (22, "a", [1e-300, 2e-301, 0.0])]
    assert run(spark, rows) == brute_force(rows)
    assert run(spark, []) == []


@pytest.mark.parametrize("d, vectors", [(2, 10_000), (8, 10_000), (64, 50_000), (64, 1_000_000)])
def test_pairs_at_the_bound_share_a_filter(d, vectors):
    code = c.make_code(d, vectors, 0.93)
    x, y = c._pairs(np.random.default_rng(99), d, 0.93)
    (rx, fx), (ry, fy) = code.decode(x), code.decode(y)
    together = {*zip(rx.tolist(), fx.tolist())} & {*zip(ry.tolist(), fy.tolist())}
    assert len({r for r, _ in together}) >= 0.985 * len(x)
    assert len(rx) <= 130 * len(x)
    every = [sum(np.meshgrid(*p, indexing="ij")).ravel() >= code.threshold for p in _parts(code, x[0])]
    assert fx[rx == 0].tolist() == np.flatnonzero(np.concatenate(every)).tolist()


def _parts(code, x):
    """Of each code, the share of every direction of each block."""
    out = []
    for turn, blocks in zip(code.rotations, code.directions):
        cuts = np.cumsum([b.shape[1] for b in blocks])[:-1]
        out.append([part @ b.T / np.sqrt(len(blocks)) for part, b in zip(np.split(x @ turn, cuts), blocks)])
    return out


def test_sketches_of_near_vectors_agree():
    x, y = c._pairs(np.random.default_rng(7), 64, 0.93)
    code = c.make_code(64, 1000, 0.93)
    x, y = code.sketch(x).view(np.uint64), code.sketch(y).view(np.uint64)
    differ = np.bitwise_count(x ^ y).sum(axis=1)
    assert differ.max() <= c._allowed(0.93) and np.bitwise_count(x[1:] ^ x[:-1]).sum(axis=1).mean() > 55
