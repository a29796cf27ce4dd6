"""Reply trees to training conversations: paths from root to leaf, ranked and formatted.

Iterative self-joins double the reach of every message's pointer to an ancestor: after k of them it
is 2**k steps up. The same pointers let the set of a leaf's known ancestors double, so a path of n
messages takes log2(n) joins and rows in proportion to the paths given back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.sources.sinks import via_shared_table

#: Fixed values of the template: what opens a turn, ends its role, and closes it. The control strings
#: are `<s>`, `</s>`, `[INST]` and `[/INST]`.
OPEN, BODY, CLOSE = "<s>[INST] ", " [/INST]", "</s>"
_CONTROL = r"(<)(?=/?s>)|(\[)(?=/?INST\])"


def escape(text: Column) -> Column:
    r"""Control strings broken by a backslash after their first character, backslashes doubled.

    No control string is left in the result, and `unescape` gives the text back.
    """
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, _CONTROL, r"$1$2\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def number_messages(conversations: DataFrame) -> DataFrame:
    """Linear conversations as trees: message n replies to message n - 1 of its conversation.

    Rows are taken by turn, then role and text, nulls first; score is 0.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.withColumn("message_id", F.row_number().over(order).cast("long")).select(
        "conv_id",
        "message_id",
        F.expr("nullif(message_id - 1, 0)").alias("parent_id"),
        F.lit(0.0).alias("score"),
        "role",
        "text",
    )


def ancestors(tree: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """For k = 0, 1, ...: who is 2**k steps above whom; and the root and depth of every message.

    `tree` has conv_id, message_id and parent_id. A parent that is not a message of the conversation
    counts as none. Messages on or below a cycle have no root and don't appear in the second result.
    """
    nodes = tree.select("conv_id", "message_id").distinct()
    parents = tree.where("parent_id is not null").select("conv_id", "message_id", F.col("parent_id").alias("up")).distinct()
    known = nodes.withColumnRenamed("message_id", "up")
    step = via_shared_table(parents.join(known, ["conv_id", "up"], "left_semi").select("conv_id", "message_id", "up"), "parents")
    is_root = nodes.join(step, ["conv_id", "message_id"], "left_anti")
    depth = via_shared_table(is_root.select("conv_id", "message_id", F.col("message_id").alias("root"), F.lit(0).cast("long").alias("depth")), "roots")
    steps, reach, most = [], 1, tree.count()
    while reach <= most and not step.isEmpty():
        steps.append(step)
        # All messages with depth below `reach` are known; those up to twice as deep follow.
        above = depth.withColumnRenamed("message_id", "up").withColumn("depth", F.col("depth") + reach)
        deeper = step.join(above, ["conv_id", "up"]).select("conv_id", "message_id", "root", "depth")
        depth = via_shared_table(depth.unionByName(deeper), "depths")
        further = step.select("conv_id", F.col("message_id").alias("up"), F.col("up").alias("top"))
        step = via_shared_table(
            step.join(further, ["conv_id", "up"]).select("conv_id", "message_id", F.col("top").alias("up")), "steps"
        )
        reach *= 2
    return steps, depth


def root_to_leaf_paths(tree: DataFrame, most_per_root: int | None = None) -> DataFrame:
    """conv_id, root, leaf, path_rank, place, message_id: the messages of each chosen path from its root on.

    Paths of a root are ranked by the sum of their messages' scores, highest first (null scores count
    0), then the longer, then the leaf with the smaller id; `most_per_root` keeps the best ones, by
    default all. Message ids must be unique in a conversation; of rows alike in it, parents and
    scores are taken from the one with the smallest parent_id.
    """
    own = tree.groupBy("conv_id", "message_id").agg(F.min(F.struct("parent_id", "score")).alias("own"))
    own = own.select("conv_id", "message_id", "own.parent_id", F.coalesce("own.score", F.lit(0.0)).cast("double").alias("score"))
    own = via_shared_table(own, "messages")
    steps, depth = ancestors(own)
    has_reply = steps[0].select("conv_id", F.col("up").alias("message_id")).distinct() if steps else None
    leaves = depth if has_reply is None else depth.join(has_reply, ["conv_id", "message_id"], "left_anti")
    paths = leaves.select("conv_id", "root", F.col("message_id").alias("leaf"), "message_id", F.lit(0).cast("long").alias("up_steps"))
    for k, step in enumerate(steps):
        above = paths.join(step, ["conv_id", "message_id"]).select(
            "conv_id", "root", "leaf", F.col("up").alias("message_id"), (F.col("up_steps") + (1 << k)).alias("up_steps")
        )
        paths = via_shared_table(paths.unionByName(above), "paths")
    totals = paths.join(own, ["conv_id", "message_id"]).groupBy("conv_id", "root", "leaf").agg(
        F.sum("score").alias("path_score"), F.count("*").alias("path_length")
    )
    order = Window.partitionBy("conv_id", "root").orderBy(F.desc("path_score"), F.desc("path_length"), "leaf")
    ranked = totals.withColumn("path_rank", F.row_number().over(order))
    if most_per_root is not None:
        ranked = ranked.where(F.col("path_rank") <= most_per_root)
    return paths.join(ranked, ["conv_id", "root", "leaf"]).select(
        "conv_id", "root", "leaf", "path_rank", (F.col("path_length") - F.col("up_steps") - 1).alias("place"), "message_id"
    )


def format_paths(tree: DataFrame, most_per_root: int | None = None, learn_role: str = "assistant") -> DataFrame:
    """conv_id, root, leaf, path_rank, formatted, turns: one row per chosen path.

    `formatted` is, for every message, `<s>[INST] role [/INST]text</s>`, role and text escaped; null
    ones count as empty. `turns` holds for each turn the code points (start, length) of its stretch of
    `formatted`, and those of the text that a model learns from (loss_start, loss_length), which is the
    escaped text of messages by `learn_role` and of length 0 for others. Conversations may have several
    roots. A null conv_id or message_id belongs to no tree and gives no row. Other columns are not
    looked at. A path is one row, so a task must hold the longest path.
    """
    said = tree.groupBy("conv_id", "message_id").agg(F.min(F.struct("role", "text")).alias("said"))
    role, text = (escape(F.coalesce(F.col(f"said.{c}"), F.lit(""))) for c in ("role", "text"))
    said = said.select(
        "conv_id",
        "message_id",
        F.concat(F.lit(OPEN), role, F.lit(BODY)).alias("head"),
        text.alias("body"),
        F.coalesce(F.col("said.role") == learn_role, F.lit(False)).alias("learn"),
    )
    paths = root_to_leaf_paths(tree.where("conv_id is not null and message_id is not null"), most_per_root)
    path = ["conv_id", "root", "leaf", "path_rank"]
    lengths = {"head_n": F.length("head").cast("long"), "body_n": F.length("body").cast("long")}
    turns = paths.join(said, ["conv_id", "message_id"]).withColumns(lengths)
    turns = turns.withColumn("length", F.col("head_n") + F.col("body_n") + len(CLOSE))
    turns = turns.withColumn("start", F.sum("length").over(Window.partitionBy(*path).orderBy("place")) - F.col("length"))
    gathered = turns.groupBy(*path).agg(
        F.array_sort(F.collect_list(F.struct("place", "head", "body", "start", "length", "head_n", "body_n", "learn"))).alias("t")
    )
    span = "named_struct('start', x.start, 'length', x.length, 'loss_start', x.start + x.head_n, 'loss_length', if(x.learn, x.body_n, 0L))"
    return gathered.select(
        *path,
        F.expr(f"array_join(transform(t, x -> concat(x.head, x.body, '{CLOSE}')), '')").alias("formatted"),
        F.expr(f"transform(t, x -> {span})").alias("turns"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds `messages`, an array of (role, text, learned), got from `formatted` and `turns` alone.

    `learned` is what lies under the loss span, unescaped.
    """
    pieces = F.expr(f"slice(split(formatted, '{CLOSE}', -1), 1, size(turns))")
    plain = r"regexp_replace({}, '(?s)\\\\(.)', '$1')"
    head = f"substring_index(p.piece, '{BODY}', 1)"
    parts = {
        "role": plain.format(f"substring({head}, {len(OPEN) + 1})"),
        "text": plain.format(f"substring(p.piece, length({head}) + {len(BODY) + 1})"),
        "learned": plain.format("substring(p.piece, cast(p.span.loss_start - p.span.start + 1 as int), cast(p.span.loss_length as int))"),
    }
    fields = ", ".join(f"'{name}', {sql}" for name, sql in parts.items())
    return formatted.withColumn("pieces", pieces).withColumn(
        "messages", F.expr(f"transform(zip_with(pieces, turns, (a, b) -> struct(a as piece, b as span)), p -> named_struct({fields}))")
    ).drop("pieces")
