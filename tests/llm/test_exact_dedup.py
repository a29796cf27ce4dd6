import hashlib
import random
import re

import pytest

from funnelspark.llm.exact_dedup import CHUNK, chunks_of, deduplicate, exact_groups
from pyspark.sql import functions as F
from tests.llm.oracle import both

FOLDER = "/root/testdata/sf0.001"


def brute(rows):
    plain = [(i, t or "", re.sub("[\x20\x09-\x0d]", "", t or "")) for i, t, *_ in rows]
    groups = {}
    for i, t, p in plain:
        groups.setdefault(p, []).append((-len(t), i is None, i or 0, i))
    return sorted(
        (repr((i, min(groups[p])[3], len(groups[p]), hashlib.sha256(p.encode()).hexdigest())) for i, t, p in plain)
    )


def rows_of(seed):
    r = random.Random(seed)
    words = ["alpha", "beta", "gamma", "né", "日本語", "😀", "x"]
    texts = [" ".join(r.choice(words) for _ in range(n)) for n in (0, 1, 3, 400, 900, 3000)]
    rows = []
    for i in range(60):
        t = r.choice(texts)
        t = None if t == "" and r.random() < 0.5 else "".join(c + r.choice(["", "", "", " ", "\t", "\x0b"]) for c in t)
        if r.random() < 0.2 and t:
            t = t[:-1] + "!"
        rows.append((i, t, "clash", 1))
    return rows + [rows[5], rows[5], (None, "alpha", "c", 2), (61, "y" * 9000, None, 0), (62, "y" * 9000 + " ", None, 0), (63, "a b", "", 0), (64, "ab", "", 0)]


@pytest.mark.parametrize("seed, bits", [(1, 64), (2, 64), (1, 2), (2, 3)])
def test_groups_as_brute_force_also_when_hashes_collide(spark, seed, bits):
    rows = rows_of(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep_id string, kept int")
    got = exact_groups(docs, bits).collect()
    assert sorted(repr((r.doc_id, r.keep_id, r.group_size, r.text_sha256)) for r in got) == brute(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) and all(r.doc_id == r.keep_id for r in kept)


def test_chunks_follow_content(spark):
    r = random.Random(3)
    text = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60000))
    moved = "inserted" + text
    df = spark.createDataFrame([(text,), (moved,)], "t string").select(chunks_of(F.col("t")).alias("c"))
    a, b = (row.c for row in df.collect())
    assert "".join(a) == text and "".join(b) == moved
    assert len(set(a) & set(b)) > 0.9 * len(a)
    assert CHUNK.startswith("(?s)")


def test_deduplicated_documents(spark):
    rows = rows_of(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep_id string, kept int")
    got = deduplicate(docs)
    assert got.columns == docs.columns
    assert got.count() == len({re.sub("[\x20\x09-\x0d]", "", t or "") for _, t, *_ in rows})
    assert exact_groups(docs.limit(0)).count() == 0


def test_same_as_sql(spark):
    got, want = both(spark, FOLDER, "op6_chunk_recipes", ["documents"])
    assert got == want
