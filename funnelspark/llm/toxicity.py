"""Toxicity grades by a cumulative-link ordinal regression over sparse word counts.

P(grade <= k) = sigmoid(threshold[k] - x . w): one weight per word, shared by ordered thresholds.
A document's expected severity is the sum over k of P(grade > k). Words that begin alike, by a beginning that
tells the grades apart, share a weight on top of their own: that also weighs inflected forms each of which is rare.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.words import PUNCTUATION, hash_words, parts, slices, texts_of

#: Most labelled documents the model is fitted on, those with the smallest hash of their id.
SAMPLE = 8192
#: Most words it looks at, those that tell the grades apart best in the sample.
WORDS = 512
#: Fewest labelled documents a word must occur in.
LEAST_DOCUMENTS = 4
GRADES = 4
#: Bytes of the beginnings of words, most of them looked at, and the standard errors by which one must differ.
STEM_BYTES = (4, 6)
STEMS = 64
STEM_ERRORS = 6
#: Most words that are known by a beginning, and fewest labelled documents each must occur in.
STEM_WORDS = 8192
STEM_LEAST_DOCUMENTS = 2


@dataclass(frozen=True)
class OrdinalModel:
    words: np.ndarray  # hashes, ascending
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    def at_most(self, z: np.ndarray) -> np.ndarray:
        """P(grade <= k) for every document and every k but the last."""
        return _sigmoid(self.thresholds[None, :] - z[:, None])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def word_counts(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, int]]:
    """Per slice of texts: index of its first text, then text, word and count of each distinct pair, and its texts."""
    for first, run in slices(texts):
        words, owner = hash_words(run, lower=True, also_between=PUNCTUATION)
        order = np.lexsort((words, owner))
        words, owner = words[order], owner[order]
        new = np.ones(len(words), dtype=bool)
        new[1:] = (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        yield first, owner[at], words[at], np.diff(np.append(at, len(words))), len(run)


def _texts(column: pa.Array) -> list[bytes]:
    return list(texts_of(column))


def sample_counts(sample: DataFrame) -> DataFrame:
    """doc_id, grade, word, count of the sample's documents (doc_id, text, grade)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            ids, grades = batch.column(0), batch.column(2)
            for first, owner, words, counts, _ in word_counts(_texts(batch.column(1))):
                rows = pa.array(owner + first)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(rows), grades.take(rows), pa.array(words.view(np.int64)), pa.array(counts)],
                    names=["doc_id", "grade", "word", "count"],
                )

    return sample.select("doc_id", "text", F.col("grade").cast("int").alias("grade")).mapInArrow(
        run, f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, grade int, word long, count long"
    )


def labelled_sample(documents: DataFrame, labels: DataFrame, grade: str, most: int = SAMPLE) -> DataFrame:
    """doc_id, text, grade of at most `most` labelled documents, the same ones in every run.

    One row of each, however often its label or the document itself is repeated: of several texts of a
    doc_id the smallest, null only if there is no other.
    """
    chosen = (
        labels.where(f"doc_id is not null and {grade} is not null")
        .groupBy("doc_id")
        .agg(F.max(grade).alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    found = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by `most`
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("grade").alias("grade"))


def sample_stems(sample: DataFrame) -> DataFrame:
    """word, stem: the beginnings of STEM_BYTES bytes of the sample's words, repeated as they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            for _, texts in slices(_texts(batch.column(0))):
                words, _ = hash_words(texts, lower=True, also_between=PUNCTUATION)
                some, at = np.unique(words, return_index=True)
                for size in STEM_BYTES:
                    stems, _ = hash_words(texts, lower=True, also_between=PUNCTUATION, first=size)
                    # A word of no more bytes is its own beginning.
                    longer = stems[at] != some
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some[longer].view(np.int64)), pa.array(stems[at][longer].view(np.int64))], names=["word", "stem"]
                    )

    return sample.select("text").mapInArrow(run, "word long, stem long")


def choose_stems(counts: DataFrame, stems: DataFrame) -> pd.DataFrame:
    """word, stem: the beginnings whose presence differs by STEM_ERRORS standard errors or more between grade 0 and
    higher ones, with the words that begin so, the most frequent ones."""
    totals = counts.groupBy("grade").agg(F.countDistinct("doc_id").alias("n")).collect()
    above, zero = (max(1, sum(r.n for r in totals if (r.grade > 0) == high)) for high in (True, False))
    pairs = stems.distinct()
    tally = (
        counts.join(pairs, "word").select("doc_id", "grade", "stem").distinct().groupBy("stem")
        .agg(F.count_if(F.col("grade") > 0).alias("a"), F.count_if(F.col("grade") == 0).alias("z"))
    )
    share = F.expr(f"(a + z) / {above + zero}D")
    error = F.sqrt((share * (F.lit(1.0) - share) + 1e-6) * (1 / above + 1 / zero))
    strength = F.abs(F.expr(f"a / {above}D - z / {zero}D")) / error
    best = tally.withColumn("strength", strength).where(f"a + z >= {LEAST_DOCUMENTS} and strength >= {STEM_ERRORS}")
    best = [r.stem for r in best.orderBy(F.desc("strength"), "stem").limit(STEMS).collect()]
    told = pairs.where(F.col("stem").isin(best))
    often = counts.join(told.select("word").distinct(), "word").groupBy("word").agg(F.countDistinct("doc_id").alias("n"))
    often = often.where(f"n >= {STEM_LEAST_DOCUMENTS}").orderBy(F.desc("n"), "word").limit(STEM_WORDS).select("word")
    return told.join(often, "word").toPandas().sort_values(["word", "stem"])


def choose_words(counts: DataFrame, most: int = WORDS, least: int = LEAST_DOCUMENTS) -> np.ndarray:
    """The words whose presence differs most, in standard errors, between grade 0 and higher ones."""
    totals = counts.groupBy("grade").agg(F.countDistinct("doc_id").alias("n")).collect()
    above = max(1, sum(r.n for r in totals if r.grade > 0))
    zero = max(1, sum(r.n for r in totals if r.grade == 0))
    tally = counts.groupBy("word").agg(
        F.count_if(F.col("grade") > 0).alias("a"), F.count_if(F.col("grade") == 0).alias("z")
    )
    share = F.expr(f"(a + z) / {above + zero}D")
    strength = F.abs(F.expr(f"a / {above}D - z / {zero}D")) / F.sqrt(share * (F.lit(1.0) - share) + 1e-6)
    best = tally.where(f"a + z >= {least}").withColumn("strength", strength).orderBy(F.desc("strength"), "word").limit(most)
    return np.sort(np.array([r.word for r in best.select("word").collect()], dtype=np.int64).view(np.uint64))


def fit_ordinal(
    row: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray, n_words: int, grades: int = GRADES,
    ridge: float = 1e-5, rounds: int = 600,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by gradient steps on the mean log-likelihood."""
    n = len(grade)
    upto = np.array([(np.sum(grade <= k) + 0.5) / (n + 1) for k in range(grades - 1)])
    start = np.log(upto / (1 - upto))
    # The first threshold, and the logarithms of the steps to the next ones, keep them in order.
    free = np.concatenate([[start[0]], np.log(np.maximum(np.diff(start), 1e-2)), np.zeros(n_words)])
    first, second = np.zeros_like(free), np.zeros_like(free)
    for t in range(1, rounds + 1):
        steps = np.exp(free[1 : grades - 1])
        thresholds = free[0] + np.concatenate([[0], np.cumsum(steps)])
        weights = free[grades - 1 :]
        z = np.bincount(row, value * weights[column], n)
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        high, low = _sigmoid(edges[grade + 1] - z), _sigmoid(edges[grade] - z)
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
        by_threshold = np.bincount(grade, d_high, grades)[:-1] - np.bincount(grade, d_low, grades)[1:]
        tail = np.cumsum(by_threshold[::-1])[::-1]
        gradient = np.concatenate([[-tail[0]], -tail[1:] * steps, np.bincount(column, value * (d_high - d_low)[row], n_words)])
        gradient /= n
        gradient[grades - 1 :] += ridge * weights
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        free = free - 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return free[grades - 1 :], free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1 : grades - 1]))])


def severity_grades(labels: dict, spread: pd.DataFrame, grades: int = GRADES) -> dict:
    """doc_id -> grade from yes-or-no labels: 0 for no, else by the sum of log(1 + count) of telling words, in equal parts.

    A telling word is in a column of `spread` (doc_id, word, column, count) that at least ten times as many documents
    hold, per document, under yes as under no. The sum is what the regression weighs: by the share of telling words,
    short documents of little evidence would be the worst ones, and no weights could fit that.
    """
    yes = max(1, sum(label > 0 for label in labels.values()))
    no = max(1, sum(label <= 0 for label in labels.values()))
    held = spread[["doc_id", "column"]].drop_duplicates()
    above = held.doc_id.map(labels) > 0
    present = held.groupby(["column", above]).size().unstack(fill_value=0).reindex(columns=[False, True], fill_value=0)
    telling = present.index[present[True] / yes >= 10 * (present[False] + 0.5) / no]
    hits = spread[spread.column.isin(telling)].drop_duplicates(["doc_id", "word"])
    evidence = np.log1p(hits["count"]).groupby(hits.doc_id).sum()
    marked = evidence[[labels[d] > 0 for d in evidence.index]]
    cuts = np.quantile(marked, np.arange(1, grades - 1) / (grades - 1)) if len(marked) else []
    of = {d: 1 + int(np.searchsorted(cuts, e, side="right")) for d, e in marked.items()}
    return {d: of.get(d, 1) if label > 0 else 0 for d, label in labels.items()}


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", graded: bool = False, most: int = SAMPLE) -> OrdinalModel:
    """Fit on a bounded sample of labelled documents. With `graded`, labels are grades 0 to 3 already; lower
    ones count as 0, higher ones as 3, and fractions are cut off.

    Labels of documents that are not there, and null ones, are left out; of several labels of a document
    the highest counts. Without any labelled document every document gets grade 0.
    """
    sample = labelled_sample(documents, labels, label, most).persist()
    counts = sample_counts(sample).persist()
    words = choose_words(counts)
    if not len(words):
        counts.unpersist()
        sample.unpersist()
        return OrdinalModel(words, np.zeros(0), np.full(GRADES - 1, 40.0))
    given = {r.doc_id: r.grade for r in counts.select("doc_id", "grade").distinct().collect()}
    stems = choose_stems(counts, sample_stems(sample))
    known = np.union1d(words, stems.word.to_numpy(dtype=np.int64).view(np.uint64))
    # An Arrow table is made into rows by the executors alone; others start Python workers of their own for that, which stay.
    table = documents.sparkSession.createDataFrame(pa.table({"word": known.view(np.int64)}))
    picked = counts.join(F.broadcast(table), "word").toPandas().sort_values(["doc_id", "word"])  # bounded by WORDS and STEM_WORDS
    counts.unpersist()
    sample.unpersist()
    # One column for each word chosen by itself, then one for each beginning.
    own = pd.DataFrame({"word": words.view(np.int64), "column": np.arange(len(words))})
    kinds, kind = np.unique(stems.stem.to_numpy(dtype=np.int64), return_inverse=True)
    columns = pd.concat([own, pd.DataFrame({"word": stems.word.to_numpy(dtype=np.int64), "column": len(words) + kind})])
    spread = picked.merge(columns, on="word").sort_values(["doc_id", "word", "column"])
    if graded:
        grade_of = {d: min(max(int(g), 0), GRADES - 1) for d, g in given.items()}
    else:
        grade_of = severity_grades(given, spread)
    ids = {d: i for i, d in enumerate(sorted(grade_of))}
    grade = np.array([grade_of[d] for d in ids])
    row = spread.doc_id.map(ids).to_numpy()
    fitted, thresholds = fit_ordinal(
        row, spread.column.to_numpy(), np.log1p(spread["count"].to_numpy()), grade, len(words) + len(kinds)
    )
    at = np.searchsorted(known, columns.word.to_numpy(dtype=np.int64).view(np.uint64))
    return OrdinalModel(known, np.bincount(at, fitted[columns.column.to_numpy()], len(known)), thresholds)


def evidence(model: OrdinalModel, texts: list[bytes]) -> np.ndarray:
    """x . w of every text."""
    z = np.zeros(len(texts))
    for first, owner, words, counts, n in word_counts(texts):
        if len(model.words):
            at = np.minimum(np.searchsorted(model.words, words), len(model.words) - 1)
            known = model.words[at] == words
            z[first : first + n] = np.bincount(owner[known], model.weights[at[known]] * np.log1p(counts[known]), n)
    return z


#: Columns `score` adds.
ADDED = ["tox_severity", "tox_probability", "tox_grade", "tox_rejected"]


def score(documents: DataFrame, model: OrdinalModel, reject_at: float = 0.5) -> DataFrame:
    """The rows of `documents` with tox_severity (0 to 3), tox_probability of a grade above 0, the most
    likely tox_grade, and tox_rejected: whether that probability is `reject_at` or more.

    Null and empty texts have no evidence and get what the thresholds alone give. Columns named alike
    are replaced. No rows are lost, repeated ones included, and nothing is shuffled.
    """
    kept = [c for c in documents.columns if c not in ADDED]
    text = kept.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            upto = model.at_most(evidence(model, _texts(batch.column(text))))
            each = np.diff(upto, axis=1, prepend=0, append=1)
            above = 1 - upto[:, 0]
            new = [(1 - upto).sum(axis=1), above, np.argmax(each, axis=1).astype(np.int32), above >= reject_at]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, new)], names=[*kept, *ADDED])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*kept).schema)
    return documents.select(*kept).mapInArrow(
        run, f"{schema}, tox_severity double, tox_probability double, tox_grade int, tox_rejected boolean"
    )


def reject(documents: DataFrame, model: OrdinalModel, reject_at: float = 0.5) -> DataFrame:
    """The documents that are not rejected, with their own columns, filtered where they are scored."""
    text = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            above = 1 - model.at_most(evidence(model, _texts(batch.column(text))))[:, 0]
            yield batch.filter(pa.array(above < reject_at))

    return documents.mapInArrow(run, documents.schema)
