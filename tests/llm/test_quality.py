import math

import numpy as np
import pytest

from funnelspark.llm.quality import N_FEATURES, Classifier, features, posterior_quality, shrinkage, train
from funnelspark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr("doc_id", "source as host", "lang as path", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    seen = labels.where("doc_id % 2 = 0")
    rated = posterior_quality(docs, seen, train(docs, seen)).select("doc_id", "keep")
    got = rated.join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    assert np.mean([r.keep for r in got if r.quality]) > 0.97
    assert np.mean([r.keep for r in got if not r.quality]) < 0.15


def by_hand(rows, labels, evidence, mean, over_hosts, over_paths):
    """Priors of each row from the other rows of its path and host."""
    rate = min(max(np.mean([v > 0 for v in labels.values()]), 1e-3), 1 - 1e-3)
    base = math.log(rate / (1 - rate))
    y = [float(labels[d] > 0) if d in labels else 1 / (1 + math.exp(-(evidence[i] + base))) for i, (d, *_ ) in enumerate(rows)]
    out = []
    for i, (d, h, p, _) in enumerate(rows):
        host = [y[j] for j, r in enumerate(rows) if r[1] == h and j != i]
        path = [y[j] for j, r in enumerate(rows) if r[1:3] == (h, p) and j != i]
        host_prior = (sum(host) + over_hosts * mean) / (len(host) + over_hosts)
        path_prior = (sum(path) + over_paths * host_prior) / (len(path) + over_paths)
        z = evidence[i] + math.log(path_prior / (1 - path_prior))
        out.append((host_prior, path_prior, 1 / (1 + math.exp(-z))))
    return out


def test_shrinkage_by_hand(spark):
    rows = [(i, f"h{i % 3}", "p" if i % 2 else None, "word " * i) for i in range(30)]
    rows += [(30, None, None, None), (31, "alone", "x", ""), (32, "h0", "p", "A! " * 20000), (32, "h0", "p", "A! " * 20000)]
    labels = {i: int(i % 3 == 0) for i in range(0, 30, 2)}
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, host string, path string, text string, quality string")
    label_rows = spark.createDataFrame([*labels.items(), (None, 1), (99999, None)], "doc_id long, quality int")
    model = Classifier(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.linspace(-1, 1, N_FEATURES), 0.1, 0.0)
    evidence = model.evidence(features([(r[3] or "").encode() for r in rows]))
    got = posterior_quality(docs, label_rows, model).collect()
    assert len(got) == len(rows)
    # The two strengths, from the same moments in plain Python.
    y = [float(labels[d] > 0) if d in labels else None for d, *_ in rows]
    rate = np.mean([v for v in labels.values()])
    base = math.log(rate / (1 - rate))
    y = [v if v is not None else 1 / (1 + math.exp(-(e + base))) for v, e in zip(y, evidence)]

    def moments(key):
        groups = {}
        for r, v in zip(rows, y):
            groups.setdefault(key(r), []).append(v)
        return {k: (len(g), sum(g)) for k, g in groups.items()}

    def excess(groups):
        """Spread of means beyond sampling, and the room for it."""
        n, s = sum(g[0] for g in groups), sum(g[1] for g in groups)
        spread = sum(g[1] ** 2 / g[0] for g in groups) - s * s / n
        return spread / (s / n * (1 - s / n)) - (len(groups) - 1), n - sum(g[0] ** 2 for g in groups) / n - (len(groups) - 1)

    def strength(beyond, room):
        return 1 / min(max(beyond / room, 1e-4), 0.9) - 1

    hosts, paths = moments(lambda r: r[1]), moments(lambda r: r[1:3])
    mean, over_hosts = sum(y) / len(y), strength(*excess(list(hosts.values())))
    inside = [excess([v for k, v in paths.items() if k[0] == h]) for h in hosts]
    over_paths = strength(sum(x[0] for x in inside), sum(x[1] for x in inside))
    want = by_hand(rows, labels, evidence, mean, over_hosts, over_paths)
    got = sorted((r.doc_id, r.host_prior, r.path_prior, r.quality) for r in got)
    assert [g[0] for g in got] == [r[0] for r in rows]
    for g, w in zip(got, want):
        assert g[1:] == pytest.approx(w, rel=1e-9)


def test_sparse_sites_move_towards_the_corpus(spark):
    spread = spark.createDataFrame([(100, 90.0), (100, 10.0), (100, 50.0)], "n long, s double")
    alike = spark.createDataFrame([(100, 50.0), (100, 51.0), (100, 49.0)], "n long, s double")
    assert shrinkage(spread)[1] < 10 < 1000 < shrinkage(alike)[1]


def test_paths_are_compared_within_their_host(spark):
    """Hosts at 0.1 and 0.9. Alike paths leave everything to the host; differing ones by the moments."""
    alike = [("a", 20, 2.0), ("a", 20, 2.0), ("b", 20, 18.0), ("b", 20, 18.0)]
    assert shrinkage(spark.createDataFrame(alike, "host string, n long, s double"), ("host",)) == pytest.approx((0.5, 9999.0))
    # In each host, room 40 - 800 / 40 - 1 = 19 and one difference expected from sampling.
    differ = [("a", 20, 0.0), ("a", 20, 16.0), ("b", 20, 20.0), ("b", 20, 4.0)]
    spread = ((0 + 16**2) / 20 - 16**2 / 40) / (0.4 * 0.6) - 1, ((20**2 + 4**2) / 20 - 24**2 / 40) / (0.6 * 0.4) - 1
    got = shrinkage(spark.createDataFrame(differ, "host string, n long, s double"), ("host",))
    assert got == pytest.approx((0.5, 1 / min(sum(spread) / 38, 0.9) - 1))
    # Documents of a sparse path of an alike host are rated by the host.
    docs = spark.createDataFrame(
        [(i, "good" if i % 2 else "bad", f"p{i // 2 % 10}" if i < 400 else "new", "") for i in range(402)], "doc_id long, host string, path string, text string"
    )
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    zero = Classifier(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0, 0.0)
    rated = {r.doc_id: r for r in posterior_quality(docs, labels, zero).where("doc_id >= 400").collect()}
    assert rated[400].path_prior == pytest.approx(rated[400].host_prior) and rated[400].host_prior < 0.05 and rated[401].host_prior > 0.95


def test_empty_tables_and_no_labels(spark):
    docs = spark.createDataFrame([(1, "h", "p", "text")], "doc_id long, host string, path string, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = train(docs, labels)
    assert posterior_quality(docs.limit(0), labels, model).count() == 0
    assert [r.evidence for r in posterior_quality(docs, labels, model).collect()] == [0.0]


def test_the_query_rates_every_document(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op1_hierarchical_quality"](spark, folder)
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
