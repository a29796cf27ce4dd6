import numpy as np
import pytest

from funnelspark.llm.queries import QUERIES
from funnelspark.llm.toxicity import ADDED, GRADES, OrdinalModel, fit_ordinal, labelled_sample, reject, score, train

FOLDER = "/root/testdata/sf0.1"


def test_fit_recovers_weights_and_ordered_thresholds():
    rng = np.random.default_rng(1)
    n, words = 6000, 6
    x = (rng.random((n, words)) < 0.3) * rng.integers(1, 4, (n, words)).astype(float)
    w, cuts = np.array([2.0, -1.5, 1.0, 0.0, 0.5, -0.5]), np.array([0.5, 2.0, 3.5])
    z = x @ w + rng.logistic(size=n)
    grade = np.searchsorted(cuts, z)
    row, column = np.nonzero(x)
    weights, thresholds = fit_ordinal(row, column, x[row, column], grade, words, GRADES, ridge=0.0, rounds=800)
    assert np.all(np.diff(thresholds) > 0)
    assert weights == pytest.approx(w, abs=0.2) and thresholds == pytest.approx(cuts, abs=0.25)


def plain_scores(model, text):
    """The same by the letter of the model, a word at a time."""
    import re

    from funnelspark.llm.words import hash_words

    counts = {}
    for word in re.split(rb"[^A-Za-z\x80-\xff]+", (text or "").encode()):
        if word:
            h = int(hash_words([word], lower=True)[0][0])
            counts[h] = counts.get(h, 0) + 1
    z = sum(model.weights[i] * np.log1p(counts[int(h)]) for i, h in enumerate(model.words) if int(h) in counts)
    upto = [1 / (1 + np.exp(-(t - z))) for t in model.thresholds]
    return sum(1 - u for u in upto), 1 - upto[0]


def test_held_out_accuracy_and_scores_by_the_letter(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = train(docs, labels.where("doc_id % 2 = 0"))
    assert np.all(np.diff(model.thresholds) > 0)
    held = score(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").select("doc_id", "text", "toxic", *ADDED).collect()
    toxic = [r for r in held if r.toxic]
    clean = [r for r in held if not r.toxic]
    # A third of the toxic labels are on documents without any telling word.
    assert np.mean([r.tox_rejected for r in toxic]) > 0.6
    assert np.mean([r.tox_rejected for r in clean]) < 0.01
    assert np.mean([r.tox_severity for r in toxic]) > 10 * np.mean([r.tox_severity for r in clean])
    for r in [*toxic[:15], *clean[:15]]:
        assert (r.tox_severity, r.tox_probability) == pytest.approx(plain_scores(model, r.text), abs=1e-9)


def test_odd_rows_and_clashing_names(spark):
    model = OrdinalModel(np.zeros(0, dtype=np.uint64), np.zeros(0), np.array([1.0, 2.0, 3.0]))
    rows = [(1, None, "a"), (1, None, "a"), (None, "", "b"), (3, "x " * 50000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tox_grade string")
    got = score(docs, model).collect()
    assert len(got) == 4 and not any(r.tox_rejected for r in got) and {r.tox_grade for r in got} == {0}
    assert reject(docs, model).columns == docs.columns and reject(docs, model).count() == 4
    assert score(docs.limit(0), model).count() == 0


def test_without_labels_nothing_is_rejected(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1), (None, 1), (1, None)], "doc_id long, toxic int")
    assert reject(docs, train(docs, labels)).count() == 2


def test_the_query_scores_every_document(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op2_ordinal_toxicity"](spark, folder)
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_the_sample_is_bounded_however_rows_repeat(spark):
    docs = spark.range(5000).selectExpr("1L as doc_id", "if(id % 2 = 0, 'b', 'a') as text").union(spark.range(2, 9).selectExpr("id", "null"))
    labels = spark.range(9).selectExpr("id as doc_id", "1 as toxic").unionByName(spark.range(5000).selectExpr("1L as doc_id", "0 as toxic"))
    got = labelled_sample(docs, labels, "toxic", most=5).collect()
    assert 1 <= len(got) <= 5 and len({r.doc_id for r in got}) == len(got)
    assert all((r.text, r.grade) == (("a", 1) if r.doc_id == 1 else (None, 1)) for r in got)


def test_grades_out_of_range(spark):
    words = ["calm", "rude", "vile", "hate", "gone"]
    docs = spark.createDataFrame([(i, f"{words[i % 5]} text here") for i in range(100)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, [-3, 1, 2, 3, 99][i % 5]) for i in range(100)], "doc_id long, toxic int")
    got = {r.doc_id % 5: r.tox_grade for r in score(docs, train(docs, labels, graded=True)).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 3}


def test_rare_forms_of_a_word_are_told_by_how_they_begin(spark):
    rng = np.random.default_rng(3)
    plain = [f"{a}{b}" for a in ("kan", "mol", "ter", "sul", "vin") for b in "abcdefghij"]

    def form(i):
        return "grobian" + "".join("abcdefghijklmnopqrstuvwxyz"[i // 26**k % 26] for k in range(2))

    def text(toxic):
        words = [*rng.choice(plain, 20), *(form(i) for i in rng.integers(0, 400, 8 if toxic else 0))]
        return " ".join(rng.permutation(words))

    toxic = [i % 4 == 0 for i in range(1200)]
    docs = spark.createDataFrame([(i, text(t)) for i, t in enumerate(toxic)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic) if i < 600], "doc_id long, toxic int")
    held = {r.doc_id: r.tox_rejected for r in score(docs.where("doc_id >= 600"), train(docs, labels)).collect()}
    assert np.mean([v for i, v in held.items() if toxic[i]]) > 0.95
    assert np.mean([v for i, v in held.items() if not toxic[i]]) < 0.01


def test_few_telling_words_tell_in_short_and_long_texts(spark):
    rng = np.random.default_rng(5)
    plain = [f"{a}{b}" for a in ("kan", "mol", "ter", "sul", "vin") for b in "abcdefghijklmnopqrst"]
    telling = ["snarl", "gripe", "scoff", "jeer", "taunt", "sneer", "mock", "hiss"]

    def text(toxic):
        n = int(rng.choice([30, 100, 300, 900]))
        return " ".join(rng.permutation([*rng.choice(plain, n), *rng.choice(telling, 2 + n // 60 if toxic else 0)]))

    toxic = [i % 8 == 0 for i in range(2400)]
    docs = spark.createDataFrame([(i, text(t)) for i, t in enumerate(toxic)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic) if i < 1200], "doc_id long, toxic int")
    held = {r.doc_id: r for r in score(docs.where("doc_id >= 1200"), train(docs, labels)).collect()}
    assert np.mean([r.tox_rejected for i, r in held.items() if toxic[i]]) > 0.95
    assert np.mean([r.tox_rejected for i, r in held.items() if not toxic[i]]) < 0.01
    # The more telling words, the higher the grade.
    grades = [[r.tox_severity for i, r in held.items() if toxic[i] and (len(r.text.split()) > 600) == long] for long in (False, True)]
    assert np.mean(grades[0]) < np.mean(grades[1])


def test_training_starts_no_python_workers_for_its_word_table(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    want = train(docs, labels)

    def refuse(*args, **kwargs):
        raise AssertionError("rows made by Python workers")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refuse)
    got = train(docs, labels)
    assert len(got.words) and got.words.tolist() == want.words.tolist() and got.weights == pytest.approx(want.weights)
