"""Hard negatives by exact inner products of integer vectors, multiplied in float32 by residues.

Vectors are reduced modulo several small primes. Products of residues are small enough for float32 to
hold every partial sum exactly, so one fast matrix product per prime gives the scores modulo that prime,
and Chinese remaindering gives the signed scores themselves. Anchors meet rows in blocks; the best of
each block go to a window per anchor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.sources.sinks import via_shared_table

#: Primes whose centred residues are at most 125, and how many products of two of those float32 adds exactly.
PRIMES = (251, 241, 239, 233, 229, 227, 223, 211)
STEP = (1 << 24) // 125**2
#: Scores are below this, so that a hundred times one fits 64 bits.
LARGEST = 1 << 53
#: Anchors and rows of a cell, and anchors of it scored at a time.
ANCHORS, ROWS, AT_ONCE = 1024, 16384, 64


def primes_for(bound: int) -> list[int]:
    """Enough of PRIMES to tell apart all numbers of at most `bound` in size."""
    product, n = 1, 0
    while product <= 2 * bound:
        product *= PRIMES[n]
        n += 1
    return list(PRIMES[:n])


def residues(x: np.ndarray, prime: int) -> np.ndarray:
    """Centred residues as float32."""
    r = x % prime
    return np.where(r > prime // 2, r - prime, r).astype(np.float32)


def products(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact products of all rows of two integer matrices, given by their residues."""
    score, size = None, 1
    for prime, x, y in zip(primes, a, b):
        rest = np.zeros((len(x), len(y)), dtype=np.int64)
        for k in range(0, x.shape[1], STEP):
            rest += np.rint(x[:, k : k + STEP] @ y[:, k : k + STEP].T).astype(np.int64)
        rest %= prime
        if score is None:
            score = rest
        else:
            rest -= score
            rest *= pow(size, -1, prime)
            rest %= prime
            rest *= size
            score += rest
        size *= prime
    return np.where(score > size // 2, score - size, score)


def integer_vectors(rows: DataFrame, vector: str, scale: int) -> Column:
    """floor(scale * x) of every component of a vector of finite ones."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def first_places(scores: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """The places of the k highest scores of those `among`, ties to earlier places."""
    places = np.flatnonzero(among)
    if len(places) > k:
        some = scores[places]
        least = np.partition(some, len(some) - k)[len(some) - k]
        above = places[some > least]
        places = np.concatenate([above, places[some == least][: k - len(above)]])
    return places[np.lexsort((places, -scores[places]))]


def _cells(anchors: DataFrame, rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides by keys, dealt into groups of anchors and blocks of rows that meet in cells (keys, group, block)."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count("*") / ROWS).cast("int").alias("blocks"))
    asked = anchors.groupBy(*keys).agg(F.ceil(F.count("*") / ANCHORS).cast("int").alias("groups"))
    sizes = via_shared_table(sizes.join(asked, keys), "negative-cells")
    place = F.xxhash64("row")
    named = anchors.toDF(*anchors.columns)  # columns of its own: both sides come from one table
    left = named.join(sizes, keys).withColumn("group", F.pmod(place, "groups").cast("int"))
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = rows.join(sizes, keys).withColumn("block", F.pmod(place, "blocks").cast("int"))
    right = right.withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    cell = [*keys, "group", "block"]
    left, right = left.drop("blocks", "groups"), right.drop("blocks", "groups")
    return left.toDF(*left.columns).groupBy(*cell), right.groupBy(*cell)


def _scores(left: pa.Table, right: pa.Table, primes: list[int]):
    """Runs of anchors of a cell and their scores with its rows, which are in the order of ids."""
    b = _matrix(right["v"])
    b = [residues(b, p) for p in primes]
    a = _matrix(left["v"])
    for i in range(0, len(a), AT_ONCE):
        some = a[i : i + AT_ONCE]
        yield i, products([residues(some, p) for p in primes], b, primes)


def _by_id(table: pa.Table) -> pa.Table:
    return table.sort_by([("id", "ascending"), ("row", "ascending")])


def _best(rows: DataFrame, of: list[str], k: int, tie: list[str]) -> DataFrame:
    """The k rows of the highest score of each, with their rank."""
    order = Window.partitionBy(*of).orderBy(F.desc("score"), *tie)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def positives(anchors: DataFrame, rows: DataFrame, primes: list[int], k: int) -> DataFrame:
    """anchor_row, rank, row, id, score: the k best other rows of each anchor's label."""

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            right = _by_id(right)
            anchor, own, ids = left["row"].to_numpy(), right["row"].to_numpy(), right["id"].to_numpy()
            for i, scores in _scores(left, right, primes):
                for j, s in enumerate(scores, i):
                    at = first_places(s, own != anchor[j], k)
                    found.append(np.stack([np.full(len(at), anchor[j]), own[at], ids[at], s[at]]))
        table = np.concatenate(found, axis=1) if found else np.zeros((4, 0), dtype=np.int64)
        return pa.table([pa.array(c) for c in table], names=["anchor_row", "row", "id", "score"])

    left, right = _cells(anchors, rows, ["d", "label"])
    met = left.cogroup(right).applyInArrow(meet, "anchor_row long, row long, id long, score long")
    return _best(met, ["anchor_row"], k, ["id", "row"])


def negatives(anchors: DataFrame, rows: DataFrame, primes: list[int], k: int, low: int, high: int) -> DataFrame:
    """anchor_row, positive, id, score, rank: the k best rows of other labels for each of an anchor's scores.

    `anchors` has `scores`, those of its positives; `positive` is the place in it. A negative's score is
    from low to high hundredths of the positive's.
    """

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            right = _by_id(right)
            anchor, wanted = left["row"].to_numpy(), left["scores"].to_pylist()
            own, ids = right["row"].to_numpy(), right["id"].to_numpy()
            codes = pa.concat_arrays([left["label"].combine_chunks(), right["label"].combine_chunks()]).dictionary_encode().indices.to_numpy()
            left_label, right_label = codes[: len(anchor)], codes[len(anchor) :]
            for i, scores in _scores(left, right, primes):
                for j, s in enumerate(scores, i):
                    other, hundred, done = right_label != left_label[j], 100 * s, {}
                    for place, score in enumerate(wanted[j]):
                        if score not in done:
                            done[score] = first_places(s, other & (hundred >= low * score) & (hundred <= high * score), k)
                        at = done[score]
                        found.append(np.stack([np.full(len(at), anchor[j]), np.full(len(at), place), own[at], ids[at], s[at]]))
        table = np.concatenate(found, axis=1) if found else np.zeros((5, 0), dtype=np.int64)
        return pa.table([pa.array(c) for c in table], names=["anchor_row", "positive", "row", "id", "score"])

    left, right = _cells(anchors, rows, ["d"])
    met = left.cogroup(right).applyInArrow(meet, "anchor_row long, positive long, row long, id long, score long")
    return _best(met, ["anchor_row", "positive"], k, ["id", "row"])


def hard_negatives(
    vectors: DataFrame, anchors: str, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchors` is a condition on `id` that names the anchors. Components count as floor(scale * x); a score
    is the integer inner product with the anchor, the highest first, ties to the smaller id. Positives are
    an anchor's first other rows of its label; negatives of a positive the first rows of another label
    with low * positive_score <= 100 * negative_score <= high * positive_score.

    Rows with a null id, label or vector, or with a null or non-finite component take no part. Rows alike
    in id, label and vector count once; other rows that share an id are rows of their own. Only vectors of
    equal dimension meet. An anchor without positives, or a positive without negatives, has no row; an
    empty table gives none. Scores of 2 ** 53 or more raise an error. Other columns are not looked at.
    """
    finite = "label is not null and id is not null and v is not null and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    given = vectors.selectExpr(f"`{id_column}` as id", f"`{label_column}` as label", f"transform(`{vector_column}`, x -> cast(x as double)) as v").where(finite)
    # By Cauchy and Schwarz no score is above the largest squared length; flooring lengthens by a root of d at most.
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x * scale * scale)) + F.sqrt(F.size("v"))
    longest = given.agg(F.max(length).alias("m")).first().m or 0.0
    bound = longest * longest * (1 + 1e-9)
    if bound >= LARGEST:
        raise ValueError(f"scores may reach {bound:g}; the largest allowed is {LARGEST}")
    primes = primes_for(int(bound) + 1)
    rows = given.select(F.col("id").cast("long").alias("id"), "label", integer_vectors(given, "v", scale).alias("v")).distinct()
    rows = via_shared_table(rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", F.size("v").alias("d"), "v"), "negative-rows")
    asked = rows.where(anchors)

    near = via_shared_table(positives(asked, rows, primes, n_positives), "positives")
    scores = near.groupBy(F.col("anchor_row").alias("row")).agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("p"))
    named = asked.join(scores.selectExpr("row", "p.score as scores"), "row")
    far = negatives(named, rows, primes, n_negatives, low, high)
    told = near.selectExpr("anchor_row", "cast(rank - 1 as long) as positive", "id as positive_id", "score as positive_score")
    return (
        far.withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
        .join(told, ["anchor_row", "positive"])
        .join(asked.selectExpr("row as anchor_row", "id as anchor_id"), "anchor_row")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
