"""Every stage on its predecessor's rows, beside brute force."""

import pyarrow as pa
import pytest

import corpus_pipeline
from funnelspark.llm.toxicity import score, train
from tests.llm import test_line_dedup, test_ngram_join
from tests.llm.test_mixing import brute_targets
from tests.llm.test_packing import plain_ids

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        stage(spark, docs, FOLDER).write.parquet(path)
        out.append((docs, docs := spark.read.parquet(path)))
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_and_order(kept):
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "toxicity"
    assert all(after.columns == before.columns for before, after in kept[:-1])


def test_toxic_documents_go(spark, kept):
    before, after = kept[0]
    scored = score(before, train(before, spark.read.parquet(f"{FOLDER}/labels.parquet")))
    assert sorted(texts(after), key=repr) == sorted(texts(scored.where("not tox_rejected")), key=repr)
    assert 0 < before.count() - after.count() < 0.2 * before.count()


def test_lines_go(kept):
    before, after = kept[1]
    removed = test_line_dedup.brute(texts(before))
    want = []
    for i, t in texts(before):
        if i in removed:
            t = "\n".join(x for n, x in enumerate(t.split("\n")) if n not in removed[i])
            if not t.split():
                continue
        want.append((i, t))
    assert removed and sorted(texts(after), key=repr) == sorted(want, key=repr)


def test_one_of_each_group_stays(kept):
    before, after = kept[2]
    want = sorted(set(test_ngram_join.brute(texts(before)).values()))
    assert sorted(i for i, _ in texts(after)) == want


def test_sources_come_near_their_targets(kept):
    before, after = kept[3]

    def words(df):
        out = {}
        for r in df.collect():
            out[r.source] = out.get(r.source, 0) + len((r.text or "").encode().split())
        return out

    have, taken = words(before), words(after)
    longest = max(len((r.text or "").split()) for r in before.collect())
    for source, target in brute_targets(have).items():
        assert abs(taken.get(source, 0) - target) <= longest / 2 + 1


def test_everything_is_packed(kept):
    before, after = kept[4]
    want = sum(len(plain_ids(t)) + 1 for _, t in texts(before))
    rows = after.collect()
    assert sum(r.length for r in rows) == want
    fill = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 1024 and len(fill) <= 1.02 * want / 1024 + 1


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(got.columns) and got.count() > 0


@pytest.mark.parametrize("at", [i for i, (name, _) in enumerate(corpus_pipeline.STAGES) if not name.startswith("mixing")])
def test_batches_of_texts_are_small_when_a_stage_is_run(spark, at):
    """A stage's last job runs after the stage has returned, so what bounds its batches has to last until then."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.unset(name)
    try:
        corpus_pipeline.STAGES[at][1](spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), FOLDER)
        sizes = spark.range(0, 3000, 1, 1).mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"id": [b.num_rows]}) for b in batches), "id long")
        seen = [r.id for r in sizes.collect()]
    finally:
        spark.conf.set(name, before)
    assert sum(seen) == 3000 and max(seen) <= 1024
