import random
import re

import numpy as np
import pytest

from funnelspark.llm import ngram_join
from funnelspark.llm.ngram_join import near_duplicates, one_of_each

SCHEMA = "doc_id long, text string, n string, rep int"


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets = {}
    for i, t, *_ in rows:
        sets.setdefault(i, []).append(shingles(t))
    ids = sorted(i for i in sets if i is not None)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and any(s and t and 100 * len(s & t) >= 80 * len(s | t) for s in sets[a] for t in sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def corpus(seed, n=260):
    r = random.Random(seed)
    words = [f"w{int(r.expovariate(0.01))}" for _ in range(900)] + ["É", "日本", "THE", "the"]
    passage = [r.choice(words) for _ in range(60)]
    bases = [[r.choice(words) for _ in range(r.choice([1, 3, 4, 5, 6, 9, 30, 90, 300]))] for _ in range(30)]
    hot = [r.choice(words) for _ in range(120)]
    rows = []
    for i in range(n):
        w = list(hot) if r.random() < 0.35 else list(r.choice(bases))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
            w[r.randrange(len(w))] = r.choice(words)
        if r.random() < 0.2:
            at = r.randrange(len(w) + 1)
            w[at:at] = passage
        rows.append((r.randrange(10**5) * 7, r.choice([" ", "\n", " \t"]).join(w), "x", 1))
    return rows + [(5, None, "x", 1), (6, "", "x", 1), (8, " \n", "x", 1), (None, "w1 w2 w3", "x", 1), rows[0], rows[1]]


@pytest.mark.parametrize("seed, matches", [(1, None), (2, (1, 4)), (3, (8,))])
def test_components_as_brute_force(spark, monkeypatch, seed, matches):
    if matches:
        monkeypatch.setattr(ngram_join, "MATCHES", matches)
    rows = corpus(seed)
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    found = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert found == want and len(set(want.values())) < len(want)
    assert sorted((repr(r.doc_id), r.n_shingles) for r in got) == sorted((repr(i), len(shingles(t))) for i, t, *_ in rows)


def test_crowded_shingles(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CROWDED", 3)
    rows = corpus(7, 150)
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == brute(rows)


def test_long_lists_in_blocks(spark, monkeypatch):
    """A hot group whose copies are borderline to each other, compared in cells of a few documents."""
    monkeypatch.setattr(ngram_join, "SHORT", 4)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    r = random.Random(11)
    base = [f"b{i}" for i in range(90)]
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(r.choice([0, 1, 2, 3, 4])):
            w[r.randrange(90)] = f"v{r.randrange(1000)}"
        rows.append((i, " ".join(w), "", 0))
    rows += corpus(5, 60)
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert len({c for i, c in want.items() if i < 160}) > 1


def test_one_document_of_each_group_stays(spark):
    rows = corpus(3, 80)
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(brute(rows).values())) and ids.count(None) == 1


def test_texts_that_share_an_id_are_not_lost(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(2, a, 1, None), (2, b, 2, None), (2, b + " more", 3, None), (7, a, 4, None), (7, c, 5, None), (2, None, 6, None), (2, "", 7, None), (None, a, 8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_number int, row_number string").repartition(3)
    got = one_of_each(docs)
    assert got.columns == docs.columns
    kept = {r.kept_number for r in got.collect()}
    assert kept - {2, 3} == {1, 5, 6, 7, 8} and len(kept & {2, 3}) == 1


def test_marks_bound_the_difference():
    r = np.random.default_rng(2)
    for n, m, shared in [(1, 1, 0), (1, 1, 1), (10, 700, 5), (400, 420, 390), (5000, 40, 0), (3000, 3100, 2900)]:
        tokens = r.integers(0, 1 << 63, n + m - shared, dtype=np.uint64)
        a, b = tokens[:n], tokens[n - shared :]
        differ = ngram_join._differ(ngram_join.marks(a), ngram_join.marks(b))
        assert differ == ngram_join._differ(ngram_join.marks(b), ngram_join.marks(a)) <= n + m - 2 * shared
        assert differ >= 0.25 * min(n + m - 2 * shared, 2 * min(n, m))


def test_empty_table_and_very_long_text(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    long = " ".join(f"w{i}" for i in range(60000))
    rows = [(3, long, "", 0), (2, long + " x", "", 0), (9, "a b c d e", "", 0)]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in got} == {3: 2, 2: 2, 9: 9}
