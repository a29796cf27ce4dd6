"""Approximate nearest neighbours by cosine: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample and sent to every task; every vector is put in the leaf it
descends to. A query opens the branch whose centre is nearest, keeps the others in a priority queue,
and goes on with the best of those until it has visited as many leaves as calibration found to be
needed: the visits are widened until sample queries reach the wanted recall against all vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.sources.sinks import via_shared_table

#: Vectors the tree is fitted on, those with the smallest hash of their id: so many, or one in SHARE of a larger
#: table, up to MOST. The leaves grow with it.
SAMPLE, SHARE, MOST = 16384, 64, 1 << 18
#: Children of a node, and the number of sample vectors below which a node is a leaf.
BRANCHES, LEAF = 8, 48
#: Most vectors of a leaf that one task scores at a time, and about as many queries; more are dealt over several.
BLOCK, QUERIES = 2048, 4096
#: Queries that calibration compares with a scan of all vectors.
PROBES = 64
WANTED_RECALL = 0.97


@dataclass
class Tree:
    """Children of node i are rows first[i] to last[i] of centres; leaf[i] is its number or -1."""

    centres: np.ndarray
    first: list[int] = field(default_factory=list)
    last: list[int] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector: always on to the nearest child."""
        out = np.zeros(len(x), dtype=np.int64)
        at = [(0, np.arange(len(x)))]
        while at:
            node, rows = at.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            a, b = self.first[node], self.last[node]
            child = np.argmax(x[rows] @ self.centres[a:b].T, axis=1)
            at += [(a + c, rows[child == c]) for c in np.unique(child)]
        return out

    def visits(self, x: np.ndarray, most: int) -> list[int]:
        """The first `most` leaves of one unit vector, best bin first."""
        queue, found = [(0.0, 0)], []
        while queue and len(found) < most:
            _, node = heapq.heappop(queue)
            while self.leaf[node] < 0:
                a, b = self.first[node], self.last[node]
                near = self.centres[a:b] @ x
                best = int(np.argmax(near))
                for c in range(b - a):
                    if c != best:
                        heapq.heappush(queue, (-float(near[c]), a + c))
                node = a + best
            found.append(self.leaf[node])
        return found


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Unit centres by cosine, and each row's; fewer than k where rows repeat."""
    centres = [x[rng.integers(len(x))]]
    far = 1 - x @ centres[0]
    while len(centres) < k and far.max() > 1e-9:
        weight = np.maximum(far, 0)
        centres.append(x[np.searchsorted(np.cumsum(weight), rng.random() * weight.sum())])
        far = np.minimum(far, 1 - x @ centres[-1])
    c = np.array(centres)
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        norms = np.linalg.norm(sums, axis=1)
        used = norms > 0
        c[used] = sums[used] / norms[used, None]
    return c, np.argmax(x @ c.T, axis=1)


def fit_tree(x: np.ndarray, seed: int = 5) -> Tree:
    """A tree over unit vectors; x may be empty, which gives a single leaf."""
    rng = np.random.default_rng(seed)
    tree = Tree(np.zeros((1, x.shape[1] if x.ndim == 2 else 0)), [0], [0], [-1])
    rows, centres = [np.arange(len(x))], [tree.centres]
    node = total = 0
    total = 1
    while node < total:
        own = rows[node]
        c, child = (_k_means(x[own], BRANCHES, rng) if len(own) > LEAF else (None, None))
        kept = np.unique(child) if c is not None else []
        if len(kept) < 2:
            tree.leaf[node] = tree.leaves
            tree.leaves += 1
        else:
            tree.first[node], tree.last[node] = total, total + len(kept)
            centres.append(c[kept])
            for j in kept:
                rows.append(own[child == j])
                tree.first.append(0)
                tree.last.append(0)
                tree.leaf.append(-1)
            total += len(kept)
        rows[node] = None
        node += 1
    tree.centres = np.concatenate(centres)
    return tree


def usable(vectors: DataFrame, id_column: str, vector_column: str, dimension: int | None = None) -> DataFrame:
    """id, v (doubles) of the vectors that take part: not null, not empty, all components finite, not all zero."""
    v = f"transform(`{vector_column}`, x -> cast(x as double))"
    finite = "v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(v, x -> x != 0)"
    out = vectors.where(f"`{id_column}` is not null").selectExpr(f"`{id_column}` as id", f"{v} as v").where(finite)
    return out if dimension is None else out.where(F.size("v") == dimension)


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    if isinstance(column, pd.Series):
        return np.stack(column.to_list()) if len(column) else np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows of a with rows of b, each by the same order of additions wherever it stands."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    b = b / np.abs(b).max(axis=1, keepdims=True)
    dot = (a * b).sum(axis=1)
    return dot / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def nearest_in_block(query_ids, queries: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query, id, score) of the k nearest of a block for each query, itself included, ties to smaller ids.

    A matrix product finds all that may be among them; their scores are then made one by one.
    """
    out = []
    uq, ux = _unit(queries), _unit(x)
    for i in range(0, len(uq), 256):
        rough = uq[i : i + 256] @ ux.T
        for j, row in enumerate(rough, i):
            n = min(k, len(row))
            cut = np.partition(row, len(row) - n)[len(row) - n]
            near = np.flatnonzero(row >= cut - 1e-9)
            score = cosine(np.broadcast_to(queries[j], (len(near), x.shape[1])), x[near])
            order = np.lexsort((ids[near], -score))[:n]
            out += [(int(query_ids[j]), int(ids[near[o]]), float(score[o])) for o in order]
    return out


def _top(candidates: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best per query, each vector once."""
    best = F.array_sort(F.collect_set(F.struct((-F.col("score")).alias("minus"), "vec_id")))
    ranked = candidates.groupBy("query_id").agg(F.slice(best, 1, k).alias("b"))
    return ranked.selectExpr("query_id", "posexplode(b) as (place, hit)").selectExpr(
        "query_id", "cast(place + 1 as int) as rank", "hit.vec_id as vec_id", "-hit.minus as score"
    )


_CANDIDATES = "query_id long, vec_id long, score double"


def _scan(vectors: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """Exact neighbours of a bounded number of queries: each task scans its vectors for all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = nearest_in_block(ids, queries, batch.column(0).to_numpy(), _matrix(batch.column(1)), k)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.float64()))] if found else
                                                 [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())], names=["query_id", "vec_id", "score"])

    return _top(vectors.mapInArrow(run, _CANDIDATES), k)


def build(vectors: DataFrame, sample: int | None = None) -> tuple[Tree, DataFrame]:
    """The tree, and every vector (id, v) with its leaf, in the shared folder."""
    sample = sample or min(max(SAMPLE, vectors.count() // SHARE), MOST)
    chosen = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).toPandas().sort_values("id")
    x = _matrix(chosen["v"])
    tree = fit_tree(_unit(x) if len(x) else x)
    session = vectors.sparkSession
    sent = session.sparkContext.broadcast(tree)  # at most 2 * MOST / LEAF * BRANCHES centres

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sent.value.assign(_unit(_matrix(batch.column(1)))))], names=["id", "v", "leaf"])

    placed = via_shared_table(vectors.mapInArrow(run, "id long, v array<double>, leaf long"), "ann-index")
    return tree, placed


def search(index: tuple[Tree, DataFrame], queries: DataFrame, k: int, visits: int) -> DataFrame:
    """query_id, rank, vec_id, score over the first `visits` leaves of each query (id, v)."""
    tree, placed = index
    sent = placed.sparkSession.sparkContext.broadcast(tree)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = [sent.value.visits(x, visits) for x in _unit(_matrix(batch.column(1)))]
                rows = pa.array(np.repeat(np.arange(len(leaves)), [len(v) for v in leaves]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(np.concatenate(leaves))], names=["id", "v", "leaf"])

    # Leaves larger than a block are dealt over several; their queries go to each of those.
    sizes = placed.groupBy("leaf").agg(F.count("*").alias("n")).select("leaf", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    sizes = via_shared_table(sizes, "ann-leaves")
    # The queries of a leaf are dealt over groups, each of which meets every block.
    groups = max(1, -(-queries.count() * min(visits, tree.leaves) // (tree.leaves * QUERIES)))
    asked = queries.mapInArrow(ask, "id long, v array<double>, leaf long").join(sizes, "leaf").select(
        "leaf",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("id", F.lit(3)), F.lit(groups)).cast("int").alias("group"),
        "id",
        "v",
    )
    stored = placed.join(sizes, "leaf").select(
        "leaf",
        F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
        "id",
        "v",
    )

    def score(asked: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(asked) and len(stored):
            found = nearest_in_block(asked["id"].to_numpy(), _matrix(asked["v"]), stored["id"].to_numpy(), _matrix(stored["v"]), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    pairs = asked.groupBy("leaf", "block", "group").cogroup(stored.groupBy("leaf", "block", "group")).applyInPandas(score, _CANDIDATES)
    return _top(pairs, k)


def calibrate(index: tuple[Tree, DataFrame], k: int, recall: float = WANTED_RECALL, probes: int = PROBES) -> tuple[int, float]:
    """Fewest leaf visits, doubled and then narrowed, with which probe vectors reach the recall; and that recall.

    The leaves of a probe's true neighbours, found by a scan of all vectors, tell at which visit it meets each.
    The probe itself, which it always meets, is not one of them.
    """
    tree, placed = index
    sample = placed.orderBy(F.xxhash64("id", F.lit(7)), "id").limit(probes).toPandas()
    if not len(sample):
        return 1, 1.0
    ids, x = sample["id"].to_numpy(), _matrix(sample["v"])
    exact = _scan(placed.select("id", "v"), ids, x, k + 1).where("query_id != vec_id")
    where = placed.select(F.col("id").alias("vec_id"), "leaf").join(F.broadcast(exact), "vec_id")  # probes * (k + 1) rows
    order = {i: {leaf: n for n, leaf in enumerate(tree.visits(u, tree.leaves), 1)} for i, u in zip(ids.tolist(), _unit(x))}
    met = np.sort([order[r.query_id][r.leaf] for r in where.select("query_id", "leaf").collect()])
    if not len(met):
        return 1, 1.0
    visits = int(met[max(0, int(np.ceil(recall * len(met))) - 1)])
    return visits, float((met <= visits).mean())


def neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding",
    recall: float = WANTED_RECALL, visits: int | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query among `vectors`, but itself.

    Nearest is the largest cosine of the vectors as given, in double precision; ties go to the smaller
    id. Vectors that are null, empty, zero, or hold a null or non-finite component take no part. A query
    meets vectors of its own dimension; each dimension has an index. A query with fewer than k candidates
    gets them all, one without any gives no row. Rows alike in id and vector count once. An empty table
    gives no rows.

    Of equal vectors only the k + 1 smallest ids can be among anyone's nearest, so only those are
    indexed, and equal queries are searched once: a vector that a third of all rows share costs no more
    than another. `visits` fixes the number of leaves instead of calibrating it; all leaves give exact
    neighbours.
    """
    # Dimensions are few, however many vectors there are.
    sizes = sorted(r.d for r in usable(vectors, id_column, vector_column).select(F.size("v").alias("d")).distinct().collect())
    found = [
        _of_dimension(usable(vectors, id_column, vector_column, d), usable(queries, id_column, vector_column, d), k, recall, visits)
        for d in sizes or [0]
    ]
    return reduce(DataFrame.unionByName, found)


def _of_dimension(x: DataFrame, asked: DataFrame, k: int, recall: float, visits: int | None) -> DataFrame:
    """`neighbours` among usable vectors (id, v) of one dimension."""
    place = F.dense_rank().over(Window.partitionBy("v").orderBy("id"))
    index = build(x.withColumn("place", place).where(F.col("place") <= k + 1).select("id", "v").distinct())
    if visits is None:
        visits, _ = calibrate(index, k, recall)

    each = via_shared_table(asked.groupBy("v").agg(F.min("id").alias("id")).select("id", "v"), "ann-queries")
    found = via_shared_table(search(index, each, k + 1, visits), "ann-found")
    # Fewer than k + 1 in the visited leaves: such queries visit all leaves.
    full = found.groupBy("query_id").agg(F.count("*").alias("n")).where(f"n > {k}").select(F.col("query_id").alias("id"))
    again = via_shared_table(each.join(full, "id", "left_anti").select("id", "v"), "ann-again")
    if visits < index[0].leaves and not again.isEmpty():
        kept = found.join(again.select(F.col("id").alias("query_id")), "query_id", "left_anti")
        found = kept.unionByName(search(index, again, k + 1, index[0].leaves))

    members = asked.distinct().join(each.withColumnRenamed("id", "first_id"), "v").select("id", "first_id")
    others = members.join(found.withColumnRenamed("query_id", "first_id"), "first_id").where("vec_id != id")
    order = Window.partitionBy("id").orderBy("rank")
    return (
        others.withColumn("own_rank", F.row_number().over(order))
        .where(F.col("own_rank") <= k)
        .select(F.col("id").alias("query_id"), F.col("own_rank").alias("rank"), "vec_id", "score")
    )
