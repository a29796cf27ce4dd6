import random

import pytest
from pyspark.sql import functions as F

from funnelspark.llm.mixing import cycle_weights, mixed_documents, pareto_mix

SCHEMA = "doc_id long, source string, text string, mix_size int, size string"


def brute_targets(sizes, most=3):
    """Reshare the excess over the limit until none is above."""
    sources = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1.0 + i % 3 for i, s in enumerate(sources)}
    target, full, left = {}, set(), float(sum(sizes.values()))
    while True:
        open_ = [s for s in sources if s not in full]
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = float(most * sizes[s])
            full.add(s)
        left = sum(sizes.values()) - sum(target.values())


def documents(spark, seed, n=600):
    r = random.Random(seed)
    sources = [None, "a", "B", "é", "tiny", "hot"]
    rows = []
    for i in range(n):
        source = "hot" if r.random() < 0.4 else r.choice(sources[: 3 + seed])
        text = r.choice([None, "", " \n"]) if r.random() < 0.05 else "w " * r.choice([1, 5, 20, 80, 300])
        rows.append((i, source, text, i, "x"))
    rows += [(n, "tiny", "one two", 0, "x")]
    return spark.createDataFrame(rows, SCHEMA), rows


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_taken_words(spark, seed):
    docs, rows = documents(spark, seed)
    got = pareto_mix(docs).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() >= {"doc_id", "mix_size", "size"}
    size = {i: len((t or "").split()) for i, _, t, _, _ in rows}
    by_source = {}
    for i, s, _, _, _ in rows:
        by_source[s] = by_source.get(s, 0) + size[i]
    want = brute_targets(by_source)
    taken = dict.fromkeys(by_source, 0)
    mix_size = {}
    plain = pareto_mix(docs.drop("mix_size", "size")).collect()
    for r in plain:
        assert 0 <= r.mix_copies <= 3
        mix_size[r.doc_id] = r.mix_size
        assert r.mix_target == pytest.approx(want[r.source]) and r.mix_source_size == by_source[r.source]
        taken[r.source] += r.mix_copies * r.mix_size
    assert mix_size == size
    for s, words in taken.items():
        assert abs(words - want[s]) <= 150.5
    again = {(r.doc_id, r.mix_copies) for r in pareto_mix(docs.drop("mix_size", "size").repartition(7)).collect()}
    assert again == {(r.doc_id, r.mix_copies) for r in plain}


def test_inclusion_follows_the_probabilities(spark):
    """Over many seeds each document of a source is taken about as often as its expected copies say."""
    docs = spark.createDataFrame([(i, "ab"[i % 2], "w " * (1 + i % 4 * 20), 0, "") for i in range(400)], SCHEMA).drop("mix_size", "size")
    weights = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "source string, weight double")
    mean = {}
    for seed in range(4):
        for r in pareto_mix(docs, weights, seed=seed, preference=0.3).collect():
            key = (r.source, r.mix_size)
            mean.setdefault(key, []).append(r.mix_copies)
    mean = {k: sum(v) / len(v) for k, v in mean.items()}
    for source in "ab":
        ratios = [mean[source, n] / (1 + 0.3 * ((n + 1).bit_length() - 1)) for n in sorted(n for s, n in mean if s == source)]
        assert max(ratios) / min(ratios) < 1.25


def test_whole_copies_are_certain(spark):
    """A source at its limit gives every document the most copies."""
    docs = spark.createDataFrame([(1, "small", "a b"), (2, "small", "c"), *[(9 + i, "z", "w " * 50) for i in range(20)]], "doc_id long, source string, text string")
    weights = spark.createDataFrame([("small", 9.0), ("z", 1.0)], "source string, weight double")
    got = mixed_documents(docs, weights)
    assert got.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert counts[1] == counts[2] == 3


def test_columns_of_any_name(spark):
    """Those named like an added one give way where it is added, and come through in the mix itself."""
    docs = spark.createDataFrame([(i, "ab"[i % 2], "w " * (i % 7), i, -i, "r", i) for i in range(60)], "doc_id long, source string, text string, mix_copies int, mix_copy int, rank string, Mix_Size int")
    mixed = pareto_mix(docs)
    assert len(mixed.columns) == len({c.lower() for c in mixed.columns}) and {r.mix_copies for r in mixed.collect()} <= {0, 1, 2, 3}
    got = mixed_documents(docs)
    assert got.columns == docs.columns and got.count() > 0
    assert all(r.mix_copies == r.doc_id == -r.mix_copy == r.Mix_Size for r in got.collect())


def test_edge_cases(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert pareto_mix(docs).count() == 0
    empty = spark.createDataFrame([(1, None, None), (2, "a", "")], docs.schema)
    assert [r.mix_copies for r in pareto_mix(empty).collect()] == [0, 0]
    same = spark.createDataFrame([(1, "a", "x y")] * 5 + [(2, "b", "z")] * 3, docs.schema)
    assert pareto_mix(same).count() == 8
    turn = cycle_weights(spark.createDataFrame([(s,) for s in ["b", None, "a", "c"]], "source string")).orderBy(F.col("source").asc_nulls_last())
    assert [r.weight for r in turn.collect()] == [1.0, 2.0, 3.0, 1.0]
