"""Document quality by hierarchical empirical Bayes.

A logistic classifier gives each document's own evidence. Its host and path (a section of the host)
give a prior: the mean quality of the other documents there, shrunk towards the host's, and the
host's towards the corpus's, the more strongly the fewer documents there are. How strongly is
estimated from the spread of means over hosts, and over the paths within hosts. Evidence and prior add up as log-odds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.toxicity import labelled_sample
from funnelspark.llm.words import hash_words, parts, slices, texts_of
from funnelspark.sources.sinks import via_shared_table

#: Most labelled documents the classifier is fitted on, those with the smallest hash of their id.
SAMPLE = 8192

_GROUPS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".", b",", b"!?", b"|", b"*#$%&@^~=+_", b"<>{}[]()\\/", b"'\"-:;", b"\n"]
_CLASS = np.full(256, len(_GROUPS), dtype=np.int64)
for _i, _group in enumerate(_GROUPS):
    _CLASS[list(_group)] = _i
N_FEATURES = len(_GROUPS) + 7


def features(texts: list[bytes]) -> np.ndarray:
    """One row per text: shares of kinds of bytes, and measures of length, repetition and word length."""
    out = np.zeros((len(texts), N_FEATURES))
    for first, run in slices(texts):
        n = len(run)
        data = np.frombuffer(b"".join(run), dtype=np.uint8)
        sizes = np.array([len(t) for t in run])
        owner = np.repeat(np.arange(n), sizes)
        kinds = np.bincount(owner * (len(_GROUPS) + 1) + _CLASS[data], minlength=n * (len(_GROUPS) + 1)).reshape(n, -1)
        block = out[first : first + n]
        block[:, : len(_GROUPS)] = np.sqrt(kinds[:, :-1] / np.maximum(sizes, 1)[:, None])
        words, of = hash_words(run, lower=True)
        count = np.bincount(of, minlength=n)
        at_least_one = np.maximum(count, 1)
        order = np.lexsort((words, of))
        w, o = words[order], of[order]
        new = np.ones(len(w), dtype=bool)
        new[1:] = (w[1:] != w[:-1]) | (o[1:] != o[:-1])
        at = np.flatnonzero(new)
        most = np.zeros(n)
        np.maximum.at(most, o[at], np.diff(np.append(at, len(w))))
        repeated = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
        log_n = np.log1p(count)
        block[:, len(_GROUPS) :] = np.stack(
            [
                log_n,
                log_n**2 / 10,
                np.bincount(o[at], minlength=n) / at_least_one,
                most / at_least_one,
                np.bincount(of[1:][repeated], minlength=n) / at_least_one,
                sizes / at_least_one / 10,
                count == 0,
            ],
            axis=1,
        )
    return out


@dataclass(frozen=True)
class Classifier:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float  # log-odds of good documents in the sample

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log-likelihood ratio of good to bad: log-odds without the sample's prior."""
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return np.clip(z - self.prior, -30, 30)


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> Classifier:
    prior = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.column_stack([np.clip((x - mean) / scale, -8, 8), np.ones(len(x))])
    b = np.append(np.zeros(x.shape[1]), prior)
    penalty = np.append(np.full(x.shape[1], ridge), 1e-6) * len(y)
    for _ in range(rounds):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        slope = z.T @ (p - y) + penalty * (b - np.append(np.zeros(x.shape[1]), 0))
        curve = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(penalty)
        b = b - np.linalg.solve(curve, slope)
    return Classifier(mean, scale, b[:-1], float(b[-1]), prior)


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE) -> Classifier:
    """Fit on a bounded sample of labelled documents, of which only features come to the driver.

    Without labels of both kinds the classifier has no evidence for any document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            x = features(list(texts_of(batch.column(1))))
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(list(x), pa.list_(pa.float64()))], names=["grade", "x"])

    sample = labelled_sample(documents, labels, label, most).select("doc_id", "text", F.col("grade").cast("int").alias("grade"))
    rows = sample.mapInArrow(run, "grade int, x array<double>").toPandas()
    y = (rows.grade.to_numpy() > 0).astype(float)
    if not 0 < y.sum() < len(y):
        zero = np.zeros(N_FEATURES)
        return Classifier(zero, zero + 1, zero, 0.0, 0.0)
    x = np.stack(rows.x)
    order = np.lexsort([*x.T, y])  # the same sums whatever order the rows came in
    return _fit(x[order], y[order])


def classify(documents: DataFrame, model: Classifier, prior: float) -> DataFrame:
    """doc_id, host, path, evidence, p: the classifier's say on every row, without its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            e = model.evidence(features(list(texts_of(batch.column(3)))))
            p = 1 / (1 + np.exp(-(e + prior)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(e), pa.array(p)], names=["doc_id", "host", "path", "evidence", "p"])

    read = documents.select("doc_id", "host", "path", "text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in read.schema if f.name != "text")
    return read.mapInArrow(run, f"{schema}, evidence double, p double")


def shrinkage(groups: DataFrame, parents: tuple[str, ...] = ()) -> tuple[float, float]:
    """Mean, and the number of documents the level above counts for, from groups (n, s, and their parents).

    By moments of a beta-binomial: the means of a parent's groups spread around its own mean as sampling
    alone would make them, plus what groups truly differ by. Spread and room are added up over parents, so
    that differences between parents don't count. No true difference gives a large number, a great one a
    small number.
    """
    one = groups.groupBy(*parents).agg(
        F.count("*").alias("g"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum(F.expr("n * n")).alias("n2"), F.sum(F.expr("s * s / n")).alias("q")
    )
    mean = F.expr("least(greatest(s / n, 1e-6D), 1 - 1e-6D)")
    r = (
        one.where("n > 0")
        .withColumn("m", mean)
        .agg(
            F.sum(F.expr("(q - s * s / n) / (m * (1 - m)) - (g - 1)")).alias("beyond"),
            F.sum(F.expr("n - n2 / n - (g - 1)")).alias("room"),
            F.sum("n").alias("n"),
            F.sum("s").alias("s"),
        )
        .first()
    )
    if not r.n:
        return 0.5, 1.0
    rho = r.beyond / r.room if r.room > 0 else 0.0
    rho = min(max(rho, 1e-4), 0.9)
    return min(max(r.s / r.n, 1e-6), 1 - 1e-6), 1 / rho - 1


def _shrunk(total: str, n: str, mean: Column | str, strength: float) -> Column:
    mean = F.expr(mean) if isinstance(mean, str) else mean
    return (F.expr(total) + mean * strength) / (F.expr(n) + strength)


def posterior_quality(documents: DataFrame, labels: DataFrame, model: Classifier, keep_at: float = 0.5) -> DataFrame:
    """One row per document: doc_id, host, path, evidence, host_prior, path_prior, quality, keep.

    `documents` has doc_id, host, path, text. Null hosts and paths are groups of their own. A site's
    sum holds the label of labelled documents and the classifier's probability of others; a document's
    own part is taken out of its priors, so a site of one document says what the level above says.
    Null and empty texts are classified by their features like others. Of several labels of a document
    the highest counts. Repeated rows count each; an empty table gives no rows.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("label_id")).agg(F.max("quality").alias("label"))
    rate = known.agg(F.avg(F.expr("cast(label > 0 as int)")).alias("rate")).first().rate
    rate = min(max(rate if rate is not None else 0.5, 1e-3), 1 - 1e-3)
    scored = classify(documents, model, float(np.log(rate / (1 - rate))))
    scored = scored.join(known, scored["doc_id"] == known["label_id"], "left").withColumn("y", F.expr("coalesce(cast(label > 0 as double), p)"))
    scored = via_shared_table(scored.drop("label_id", "label", "p"), "quality-evidence")

    paths = scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("y").alias("s"))
    paths = via_shared_table(paths, "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    mean, over_hosts = shrinkage(hosts.selectExpr("host_n as n", "host_s as s"))
    _, over_paths = shrinkage(paths, ("host",))
    named = hosts.withColumnRenamed("host", "h")
    sites = paths.join(named, paths["host"].eqNullSafe(named["h"])).select(
        F.col("host").alias("site_host"), F.col("path").alias("site_path"), "n", "s", "host_n", "host_s"
    )
    sites = via_shared_table(sites, "quality-sites")
    joined = scored.join(sites, scored["host"].eqNullSafe(sites["site_host"]) & scored["path"].eqNullSafe(sites["site_path"]))
    return (
        joined.withColumn("host_prior", _shrunk("host_s - y", "host_n - 1", F.lit(mean), over_hosts))
        .withColumn("path_prior", _shrunk("s - y", "n - 1", "host_prior", over_paths))
        .withColumn("bounded", F.expr("least(greatest(path_prior, 1e-6D), 1 - 1e-6D)"))
        .withColumn("quality", F.expr("1 / (1 + exp(-(evidence + ln(bounded / (1 - bounded)))))"))
        .withColumn("keep", F.col("quality") >= keep_at)
        .select("doc_id", "host", "path", "evidence", "host_prior", "path_prior", "quality", "keep")
    )
