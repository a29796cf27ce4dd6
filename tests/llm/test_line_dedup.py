import random

import pytest

from funnelspark.llm import line_dedup
from funnelspark.llm.line_dedup import drop_lines

SCHEMA = "doc_id long, text string, removed_lines int, _x string"


def brute(rows):
    """doc_id -> numbers of removed lines, comparing every line with every earlier one."""
    lines = sorted((i, n, frozenset(line.encode().split())) for i, t, *_ in rows if i is not None and t for n, line in enumerate(t.split("\n")))
    out = {}
    for at, (i, n, s) in enumerate(lines):
        if s and any(e and 100 * len(s & e) >= 80 * len(s | e) for j, m, e in lines[:at] if (j, m) != (i, n)):
            out.setdefault(i, set()).add(n)
    return {i: sorted(v) for i, v in out.items()}


def corpus(seed, n):
    r = random.Random(seed)
    words = [f"w{int(r.expovariate(0.02))}" for _ in range(400)] + ["é", "日本", "The"]
    pool = [" ".join(r.choice(words) for _ in range(r.choice([1, 2, 3, 5, 8, 12, 20, 40]))) for _ in range(60)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(r.randrange(6)):
            line = r.choice(pool).split(" ")
            for _ in range(r.choice([0, 0, 0, 1, 1, 2, 4])):
                line[r.randrange(len(line))] = r.choice(words)
            lines.append(r.choice([" ", "  ", "\t"]).join(line) if r.random() < 0.9 else r.choice(["", " ", "\r"]))
        rows.append((r.randrange(10**6), "\n".join(lines) if lines or r.random() < 0.5 else None, 1, "x"))
    return rows + [(None, pool[0], 1, "x"), (None, None, 1, "x")]


@pytest.mark.parametrize("seed, few", [(1, 3), (2, 1)])
def test_as_brute_force(spark, monkeypatch, seed, few):
    monkeypatch.setattr(line_dedup, "FEW", few)
    rows = corpus(seed, 250)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = drop_lines(docs).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    assert {r.doc_id: r.removed_lines for r in got if r.removed_lines} == want and len(want) > 50
    text = {i: t for i, t, *_ in rows}
    for r in got:
        if r.doc_id is not None:
            gone = set(want.get(r.doc_id, []))
            whole = text[r.doc_id]
            assert r.text == (whole if not gone else "\n".join(x for n, x in enumerate(whole.split("\n")) if n not in gone))


def test_many_variants_of_one_line(spark, monkeypatch):
    """A group of near copies much larger than what is verified first, with strays among it."""
    monkeypatch.setattr(line_dedup, "FEW", 2)
    r = random.Random(4)
    base = [f"b{i}" for i in range(30)]
    rows = []
    for i in range(300):
        line = list(base)
        for _ in range(r.choice([1, 2, 3, 5])):
            line[r.randrange(30)] = f"v{r.randrange(50)}"
        rows.append((i, " ".join(line), 0, ""))
    got = drop_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.removed_lines for r in got if r.removed_lines} == brute(rows)


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    shared = "a line that three documents share word for word"
    rows = [(1, shared, 1, "x"), (2, shared + "\nkept one", 2, "y"), (2, "unique words nobody else has\nkept two", 3, "z"), (2, None, 4, None), (None, shared, 5, None)]
    schema = "doc_id long, text string, _removed_id int, removed_number string"
    got = drop_lines(spark.createDataFrame(rows, schema).repartition(2))
    assert got.columns == ["doc_id", "text", "_removed_id", "removed_number", "removed_lines"]
    assert {r._removed_id: (r.text, r.removed_lines) for r in got.collect()} == {
        1: (shared, None), 2: ("kept one", [0]), 3: (rows[2][1], None), 4: (None, None), 5: (shared, None)
    }


def test_many_equal_lines_in_one_text(spark):
    text = "\n".join(["the same few words"] * 80_000)
    (row,) = drop_lines(spark.createDataFrame([(1, text, 0, "")], SCHEMA)).collect()
    assert row.text == "the same few words" and len(row.removed_lines) == 79_999


def test_empty_and_long(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert drop_lines(docs).count() == 0
    long = " ".join(f"w{i}" for i in range(100000))
    rows = [(1, long, 0, ""), (2, long + " more", 0, ""), (2, long + " more", 0, ""), (3, "\n\n", 0, "")]
    got = drop_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, len(r.text), r.removed_lines) for r in got)[:2] == [(1, len(long), None), (2, 0, [0])] and len(got) == 4


def test_texts_are_dealt_alike_at_every_size(spark):
    """The lists of removed lines grow with the texts: they are not broadcast while they are small, nor texts sorted."""
    docs = spark.createDataFrame([(i, f"a line\nof its own {i} words", 0, "") for i in range(20)], SCHEMA)
    plan = drop_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan and "SortMergeJoin" not in plan


def test_entries_of_prefix_words_are_short_and_keep_their_sets_apart():
    """41 bytes an entry (49 before); sets that share a word and a short key stay apart by their maps."""
    assert line_dedup._ENTRY.itemsize == 41
    e = line_dedup.np.zeros(5, dtype=line_dedup._ENTRY)
    e["token"], e["key"], e["n"], e["doc"], e["map1"] = 7, 9, 50, [4, 2, 3, 1, 5], [1, 1, 3, 1, 3]
    assert set(line_dedup._first_of(e)["doc"].tolist()) >= {1, 3}


def test_lines_around_the_sizes_of_maps(spark):
    """Lines of 44 to 56 and of 135 to 160 words, some within and some just beyond the bound of each other."""
    r = random.Random(9)
    rows = []
    for size in (44, 48, 49, 56, 135, 144, 145, 160):
        for group in range(6):
            base = [f"g{size}_{group}_{i}" for i in range(size)]
            for k in range(8):
                line = [w for w in base if r.random() > r.choice([0.02, 0.1, 0.13])]
                rows.append((len(rows), " ".join(line + [f"x{len(rows)}_{j}" for j in range(r.randrange(size // 8))]), 0, ""))
    r.shuffle(rows)
    got = drop_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute(rows)
    assert {x.doc_id: x.removed_lines for x in got if x.removed_lines} == want and 50 < len(want) < len(rows) - 50


def test_memory_of_lines_that_meet_at_one_word():
    import tracemalloc

    e = line_dedup.np.zeros(3000, dtype=line_dedup._ENTRY)
    e["n"], e["line"] = 20, range(3000)
    tracemalloc.start()
    met = sum(len(i) for i, _ in line_dedup._meetings(e))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert met == 3000 * 2999 // 2 and peak < 32 << 20
