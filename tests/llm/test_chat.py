import random

from hypothesis import given, settings
from hypothesis import strategies as st

from funnelspark.llm.chat import escape, format_paths, number_messages, read_back, root_to_leaf_paths, unescape
from pyspark.sql import functions as F
from tests.llm.oracle import both

SCHEMA = "conv_id long, message_id long, parent_id long, score double, role string, text string, turns int"


def brute_paths(rows):
    """conv, leaf -> (root, rank, messages from the root on)."""
    out = {}
    for conv in {r[0] for r in rows if r[0] is not None}:
        own = {}
        for c, m, p, s, *_ in rows:
            if c == conv and m is not None:
                own[m] = min(own.get(m, (p is not None, p or 0, p, s)), (p is not None, p or 0, p, s), key=lambda x: x[:2])
        parent = {m: v[2] if v[2] in own else None for m, v in own.items()}
        paths = []
        for leaf in set(parent) - set(parent.values()):
            path, seen = [leaf], {leaf}
            while parent[path[-1]] is not None and parent[path[-1]] not in seen:
                path.append(parent[path[-1]])
                seen.add(path[-1])
            if parent[path[-1]] is None:
                paths.append((path[-1], -sum(own[m][3] or 0 for m in path), -len(path), leaf, path[::-1]))
        rank = {}
        for root, *_, leaf, path in sorted(paths):
            rank[root] = rank.get(root, 0) + 1
            out[conv, leaf] = (root, rank[root], path)
    return out


def trees(seed):
    r = random.Random(seed)
    rows = []
    for conv in range(6):
        n = r.choice([1, 2, 5, 30])
        for m in range(n):
            parent = None if m == 0 or r.random() < 0.1 else r.choice([m - 1, r.randrange(m), 999 if r.random() < 0.1 else m - 1])
            rows.append((conv, m, parent, r.choice([None, 0.5, 1.0, -1.0]), r.choice(["user", "assistant", None]), r.choice([None, "", "a\n", "</s>\\[INST] é😀"]), 1))
    rows += [(9, 1, 3, 1.0, "user", "x", 1), (9, 2, 1, 1.0, "user", "x", 1), (9, 3, 2, 1.0, "user", "x", 1), (9, 4, 3, 1.0, "user", "x", 1), (9, 5, None, 1.0, "user", "x", 1)]
    return rows + [(None, 1, None, 1.0, "user", "x", 1), (8, None, None, 1.0, "user", "x", 1)]


def test_paths_and_texts_of_trees(spark):
    rows = trees(4)
    tree = spark.createDataFrame(rows, SCHEMA)
    want = brute_paths(rows)
    got = {(r.conv_id, r.leaf): r for r in read_back(format_paths(tree)).collect()}
    assert got.keys() == want.keys() and len({k[0] for k in want}) == 7
    said = {(c, m): (role or "", text or "") for c, m, _, _, role, text, _ in rows}
    for key, (root, rank, path) in want.items():
        r = got[key]
        assert (r.root, r.path_rank) == (root, rank)
        assert [(m.role, m.text) for m in r.messages] == [said[key[0], m] for m in path]
        assert [m.learned for m in r.messages] == [t if role == "assistant" else "" for role, t in (said[key[0], m] for m in path)]
        assert r.formatted.count("</s>") == r.formatted.count("<s>[INST] ") == len(path)
        assert r.turns[-1].start + r.turns[-1].length == len(r.formatted)
    best = root_to_leaf_paths(tree, 1).select("conv_id", "root", "leaf").distinct().collect()
    assert {(r.conv_id, r.leaf) for r in best} == {k for k, v in want.items() if v[1] == 1}


def test_long_chain_and_nothing(spark):
    chain = spark.createDataFrame([(1, i, i - 1 if i else None, 1.0, "user", str(i), 0) for i in range(700)], SCHEMA)
    rows = root_to_leaf_paths(chain).orderBy("place").collect()
    assert [(r.place, r.message_id, r.leaf) for r in rows] == [(i, i, 699) for i in range(700)]
    assert format_paths(chain.limit(0)).count() == 0


def test_repeated_turns_stay_apart(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "b"), (1, 0, "user", None), (1, None, "assistant", "first")]
    tree = number_messages(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    (r,) = read_back(format_paths(tree)).collect()
    assert [m.text for m in r.messages] == ["first", "", "b", "b"]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(st.sampled_from("<>/s[]INST\\ a\n")), min_size=300, max_size=300))
def test_escaping_is_reversible(spark, texts):
    texts = [*texts, "</s>[INST] ok [/INST]", "<s><\\s>\\", "[/INST]" * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("e", escape(F.col("t")))
    for r in df.withColumn("back", unescape(F.col("e"))).collect():
        assert r.back == r.t
        assert not any(c in r.e for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_same_as_sql(spark):
    got, want = both(spark, "/root/testdata/sf0.001", "op4_reply_trees", ["conversations"])
    assert got == want and any(r[0] == -7 for r in got)
