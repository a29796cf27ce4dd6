"""Documents whose sets of word shingles overlap by a Jaccard of 0.8 or more, and their components.

Adaptive multi-match prefixes. The shingles of a document are ordered from rare to frequent. If two
sets overlap enough, their prefixes of |x| - ceil(t |x|) + l shingles share at least l. Each document
picks its own l, the one for which reading the posting lists of its prefix and verifying the
candidates that can come of them is estimated to cost least; a pair needs as many shared shingles as
the smaller of its two l.

Posting lists may be as long as a group of near copies is large, and its pairs are not enumerated.
First every document of a list is verified against one, the list's hub. What that links is one
component. Pairs that bit maps of their sets rule out are not verified. Then documents of a list that are still in different components are compared: those of
short lists as pairs, where their distances to the hub, with the triangle inequality of the Jaccard
distance, don't rule a link out; those of long lists in blocks, by products of their sets' incidence
matrices, of which only links that join components come out. No link between components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.components import components
from funnelspark.llm.rows import free_name, numbered
from funnelspark.llm.tables import count_table, maybe, rarity, seen, slot
from funnelspark.llm.words import mix, set_key, sets_of, small_batches, texts_of
from funnelspark.sources.sinks import via_shared_table

SHINGLE = 5
#: A link: PERCENT * union <= 100 * intersection.
PERCENT = 80
#: Slots of the table of shingle counts, as a power of two.
TABLE_BITS = 20
#: The l a document chooses from, and what verifying a pair costs in reads of a posting.
MATCHES = (1, 2, 4, 8, 16, 32)
VERIFY = 50.0
#: A shingle with more documents in one task than this keeps them there; its owner learns only that.
CROWDED = 64
#: Longest list whose pairs are made, and documents of a longer one that are compared as a block.
SHORT, BLOCK = 64, 512
_ENTRY = np.dtype([("token", "<u8"), ("doc", "<i8"), ("level", "u1")])
#: Levels are the l from which on a shingle is in the prefix, up to the largest of MATCHES; added to it:
_CERTAIN = 64


def _needed(n: np.ndarray | int):
    """ceil(t n): the smallest overlap of a set of n with any that it links with."""
    return -(-PERCENT * n // 100)


class Order:
    """Rarity levels of shingles, and estimates of how many documents hold them, from hashed counts."""

    def __init__(self, counts: np.ndarray):
        self.levels = rarity(counts)
        # Slots are shared by many rare shingles; what is above the usual filling counts as frequency.
        usual = float(np.median(counts))
        excess = np.maximum(np.exp2(np.arange(int(self.levels.max(initial=0)) + 1) / 64) - usual - 3 * np.sqrt(usual), 0)
        self.excess = excess

    def prefix(self, tokens: np.ndarray) -> tuple[np.ndarray, int, int]:
        """The tokens in order as far as any prefix may reach, the length of the first, and the chosen l."""
        n = len(tokens)
        level = self.levels[slot(tokens, TABLE_BITS)]
        base = n - int(_needed(n)) + 1
        longest = min(n, base + MATCHES[-1] - 1)
        if longest < n:
            chosen = np.argpartition(level, longest - 1)[:longest]
            edge = level[chosen].max()
            chosen = np.flatnonzero(level <= edge)
            order = chosen[np.lexsort((tokens[chosen], level[chosen]))][:longest]
        else:
            order = np.lexsort((tokens, level))
        reads = np.cumsum(1 + self.excess[level[order]])
        seen_before = np.cumsum(self.excess[level[order]])
        best, cost = 1, np.inf
        for l in MATCHES:
            if base + l - 1 > n:
                break
            now = reads[base + l - 2] + VERIFY * seen_before[base + l - 2] / l
            if now < cost:
                best, cost = l, now
        return tokens[order], base, best


def shingle_table(documents: DataFrame, k: int = SHINGLE) -> np.ndarray:
    """Hashed counts over the shingle sets of all documents."""

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        some: list[np.ndarray] = []
        for tokens in sets_of(texts_of(batch.column(0)), k):
            some.append(tokens)
            if len(some) == 256:
                yield np.concatenate(some)
                some = []
        if some:
            yield np.concatenate(some)

    return count_table(documents.select("text"), hashes, TABLE_BITS)


def marks(tokens: np.ndarray) -> bytes:
    """A bit map of a set, two to four bits a token: each token flips the bit that its hash names.

    Sets that differ in d tokens have maps that differ in d bits at most, also when the larger map is
    folded to the size of the smaller one.
    """
    bits = max(64, 1 << (2 * len(tokens) - 1).bit_length())
    places = (mix(tokens ^ np.uint64(0xA0761D6478BD642F)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(bool), bitorder="little").tobytes()


def _differ(a: bytes, b: bytes) -> int:
    """In how many bits two maps differ at the smaller one's size."""
    x, y = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
    if len(x) < len(y):
        x, y = y, x
    folded = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(folded ^ y).sum())


def _summaries(documents: DataFrame, order, k: int) -> DataFrame:
    """doc_id, n, l, the two keys of its set and its marks, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tokens in sets_of(texts_of(batch.column(1)), k):
                rows.append((len(tokens), order.value.prefix(tokens)[2], *set_key(tokens), marks(tokens)) if len(tokens) else (0, 1, 0, 0, None))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n", "l", "key1", "key2", "marks"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, l int, key1 long, key2 long, marks binary")


def document_classes(documents: DataFrame, order, k: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """doc_id, n, l, rep of every row; rep is the smallest doc_id of an equal set, its own for empty ones. And doc_id, n, marks.

    Sets are equal when their size and two independent 64-bit keys are.
    """
    rows = via_shared_table(_summaries(documents, order, k), "summaries")
    keys = ["n", "key1", "key2"]
    classes = rows.where("n > 0").groupBy(*keys).agg(F.min("doc_id").alias("rep"))
    joined = rows.join(classes, keys, "left")
    told = via_shared_table(joined.selectExpr("doc_id", "n", "l", "if(doc_id is null or n = 0, doc_id, rep) as rep"), "classes")
    return told, rows.where("n > 0 and doc_id is not null").select("doc_id", "n", "marks")


def _prefix_blobs(documents: DataFrame, order, k: int, owners: int) -> DataFrame:
    """owner, entries: the prefix entries of each task, packed by the owner of their shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_task = np.array([TaskContext.get().partitionId()], dtype=np.uint64)
        have: set[tuple[int, int]] = set()
        tokens_, docs_, levels_, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            entries = np.zeros(size, dtype=_ENTRY)
            if size:
                entries["token"], entries["doc"], entries["level"] = np.concatenate(tokens_), np.concatenate(docs_), np.concatenate(levels_)
            entries = entries[np.argsort(entries["token"], kind="stable")]
            owner = (mix(entries["token"]) % np.uint64(owners)).astype(np.int64)
            first = np.flatnonzero(np.diff(entries["token"], prepend=entries["token"][:1] ^ np.uint64(1)))
            count = np.diff(np.append(first, size))
            crowded = np.repeat(count > CROWDED, count)
            if crowded.any():
                # Two stay with the owner, so that it sees more than one; the rest are dealt anywhere.
                kept = np.concatenate([first[count > CROWDED], first[count > CROWDED] + 1])
                rest = crowded.copy()
                rest[kept] = False
                entries["level"][rest] += _CERTAIN
                spread = mix(entries["token"][rest] + own_task * np.uint64(0x9E3779B97F4A7C15) + np.arange(rest.sum(), dtype=np.uint64))
                owner[rest] = (spread % np.uint64(owners)).astype(np.int64)
            by_owner = np.argsort(owner, kind="stable")
            entries, owner = entries[by_owner], owner[by_owner]
            which, at = np.unique(owner, return_index=True)
            parts = [e.tobytes() for e in np.split(entries, at[1:])] if size else []
            return pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(parts, pa.binary())], names=["owner", "entries"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc, tokens in zip(ids, sets_of(texts_of(batch.column(1)), k)):
                if doc is None or not len(tokens):
                    continue
                key = set_key(tokens)
                if key in have:  # an equal set, of which this task has told already
                    continue
                have.add(key)
                ordered, base, l = order.value.prefix(tokens)
                ordered = ordered[: base + l - 1]
                tokens_.append(ordered)
                docs_.append(np.full(len(ordered), doc, dtype=np.int64))
                levels_.append(np.maximum(np.arange(len(ordered)) - base + 2, 1).astype(np.uint8))
                size += len(ordered)
                if size > 500_000:
                    yield flush()
                    tokens_, docs_, levels_, size = [], [], [], 0
        yield flush()

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "owner int, entries binary")


def _shared_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """token, doc_id, level of the shingles that more than one document has, of the owners in this task."""
    blobs = [np.frombuffer(b, dtype=_ENTRY) for batch in batches for b in batch.column(1).to_pylist()]
    if not blobs:
        return
    entries = np.concatenate(blobs)
    del blobs
    certain = entries["level"] >= _CERTAIN
    order = np.argsort(entries["token"], kind="stable")
    entries, certain = entries[order], certain[order]
    token = entries["token"]
    same = np.zeros(len(token), dtype=bool)
    same[1:] = token[1:] == token[:-1]
    several = same | certain
    several[:-1] |= same[1:]
    found = entries[several]
    for i in range(0, len(found), 500_000):
        part = found[i : i + 500_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part["token"].view(np.int64)), pa.array(part["doc"]), pa.array((part["level"] % _CERTAIN).astype(np.int32))],
            names=["token", "doc_id", "level"],
        )


def postings(documents: DataFrame, classes: DataFrame, order, k: int = SHINGLE) -> DataFrame:
    """token, x, n, l, level: who has which prefix shingle, one document for each set, shared shingles only."""
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blobs = _prefix_blobs(documents, order, k, 16 * parts).repartition(parts, "owner")
    entries = via_shared_table(blobs.mapInArrow(_shared_entries, "token long, doc_id long, level int"), "entries")
    told = classes.where("doc_id is not null").select("doc_id", F.col("rep").alias("x"), "n", "l").distinct()
    return via_shared_table(entries.join(told, "doc_id").select("token", "x", "n", "l", "level").distinct(), "postings")


def _size_fits(a: str, b: str) -> str:
    return f"100 * least({a}, {b}) >= {PERCENT} * greatest({a}, {b})"


def shingle_sets(documents: DataFrame, ids: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, tokens of the documents named in ids.doc_id, found by a scan with a bit table and an exact join."""
    table = documents.sparkSession.sparkContext.broadcast(seen(ids, "doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(maybe(table.value, numbers)))
            sets = [t.tobytes() for t in sets_of(texts_of(batch.column(1)), k)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["doc_id", "tokens"])

    rows = documents.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, tokens binary").join(ids, "doc_id", "left_semi")


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            rows.append((shared, len(x) + len(y) - shared))
        columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 2
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=["a", "b", "shared", "either"])


def verify(pairs: DataFrame, documents: DataFrame, k: int = SHINGLE) -> DataFrame:
    """a, b, shared, either of every pair (a, b) of documents: sizes of intersection and union."""
    ids = via_shared_table(pairs.selectExpr("explode(array(a, b)) as doc_id").distinct(), "pair-ids")
    sets = via_shared_table(shingle_sets(documents, ids, k), "pair-sets")
    joined = pairs.join(sets.withColumnsRenamed({"doc_id": "b", "tokens": "of_b"}), "b").join(
        sets.withColumnsRenamed({"doc_id": "a", "tokens": "of_a"}), "a"
    )
    return joined.select("a", "b", "of_a", "of_b").mapInArrow(_overlaps, "a long, b long, shared long, either long")


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, n, m, x, y = (c.to_pylist() for c in batch.columns)
        low, may = [], []
        for both, differ in zip(map(sum, zip(n, m)), map(_differ, x, y)):
            low.append(2 * differ / (both + differ))
            may.append(100 * (both - differ) >= PERCENT * (both + differ))
        columns = [*batch.columns[:2], pa.array(low, pa.float64()), pa.array(may, pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "low", "may"])


def bounded(pairs: DataFrame, marked: DataFrame) -> DataFrame:
    """a, b, low, may of every pair: a lower bound of its Jaccard distance, and whether that lets it link.

    Marks are a thirtieth of a set, so pairs that they rule out cost little.
    """
    b, a = (marked.withColumnsRenamed({c: f"{s}_{c}" for c in ("n", "marks")}).withColumnRenamed("doc_id", s) for s in "ba")
    joined = pairs.join(b, "b").join(a, "a").select("a", "b", "a_n", "b_n", "a_marks", "b_marks")
    told = joined.mapInArrow(_bounds, "a long, b long, low double, may boolean")
    return told.groupBy("a", "b").agg(F.min("low").alias("low"), F.bool_or("may").alias("may"))


_LINKS = f"100 * shared >= {PERCENT} * either and shared > 0"


def _linking(rows: pd.DataFrame) -> pd.DataFrame:
    """Links a, b between components of one cell: x of side 0 with x of side 1, or all x if there is one side."""
    rows = rows.sort_values(["side", "x"]).reset_index(drop=True)
    sets = [np.frombuffer(t, dtype=np.uint64) for t in rows["tokens"]]
    n = np.array([len(t) for t in sets])
    token = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), n)
    values, code, count = np.unique(token, return_inverse=True, return_counts=True)
    shared = count[code] > 1
    code, owner = code[shared], owner[shared]
    _, code = np.unique(code, return_inverse=True)
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = 2048
    for first in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, [first, first + width])
        part = np.zeros((len(sets), width), dtype=np.float32)
        part[owner[a:b], code[a:b] - first] = 1
        both += part @ part.T
    component, side = rows["component"].to_numpy(), rows["side"].to_numpy()
    link = 100 * both >= PERCENT * (n[:, None] + n[None, :] - both)
    link &= (both > 0) & (component[:, None] != component[None, :])
    link &= (side[:, None] < side[None, :]) if side.max() else np.triu(np.ones_like(link), 1)
    # Of the links only a forest that joins the same components.
    ends = {c: c for c in component.tolist()}

    def end(c: int) -> int:
        while ends[c] != c:
            ends[c] = ends[ends[c]]
            c = ends[c]
        return c

    found = []
    for i, j in zip(*np.nonzero(link)):
        p, q = end(int(component[i])), end(int(component[j]))
        if p != q:
            ends[max(p, q)] = min(p, q)
            found.append((int(rows["x"][i]), int(rows["x"][j])))
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def _block_links(members: DataFrame, documents: DataFrame, k: int) -> DataFrame:
    """Links between the components of each hub's documents: hub_x, x, component, stray, one row each.

    Those that are not strays are in the hub's component already, so only strays meet the others: their
    blocks meet the blocks of the rest (kind 1) and each other (kind 0).
    """
    count = f"cast(ceil(count_if({{}}) / {float(BLOCK)}) as int)"
    blocks = members.groupBy("hub_x").agg(F.expr(count.format("stray")).alias("strays"), F.expr(count.format("not stray")).alias("rest"))
    dealt = members.join(blocks, "hub_x").withColumn("block", F.expr("cast(pmod(xxhash64(x), if(stray, strays, rest)) as int)"))
    cells = [
        ("stray and rest > 0", "sequence(0, rest - 1)", ("1", "block", "other", "0")),
        ("not stray", "sequence(0, strays - 1)", ("1", "other", "block", "1")),
        ("stray", "sequence(0, strays - 1)", ("0", "least(block, other)", "greatest(block, other)", "cast(block > other as int)")),
    ]
    parts = [
        dealt.where(which).withColumn("other", F.explode(F.expr(others))).selectExpr(
            "hub_x", "x", "component", *[f"{sql} as {name}" for sql, name in zip(cell, ("kind", "low", "high", "side"))]
        )
        for which, others, cell in cells
    ]
    placed = parts[0].unionByName(parts[1]).unionByName(parts[2])
    ids = via_shared_table(members.select(F.col("x").alias("doc_id")).distinct(), "block-ids")
    sets = shingle_sets(documents, ids, k).withColumnRenamed("doc_id", "x")
    return placed.join(sets, "x").groupBy("hub_x", "kind", "low", "high").applyInPandas(_linking, "a long, b long")


def similar_pairs(documents: DataFrame, posted: DataFrame, marked: DataFrame, k: int = SHINGLE) -> DataFrame:
    """Links (a, b) that join all documents whose sets are similar, directly or by way of others."""
    entry = F.struct("x", "n", "l", "level")
    hubs = posted.groupBy("token").agg(F.min(entry).alias("hub"), F.count("*").alias("many")).where("many > 1")
    hubs = via_shared_table(hubs, "hubs")
    listed = posted.join(hubs, "token")
    met = listed.where(f"x != hub.x and {_size_fits('n', 'hub.n')} and greatest(level, hub.level) <= least(l, hub.l)")
    pairs = met.groupBy(F.col("hub.x").alias("a"), F.col("x").alias("b")).agg(
        F.count("*").alias("met"), F.first(F.least("l", "hub.l")).alias("needed")
    )
    pairs = via_shared_table(bounded(pairs.where("met >= needed").select("a", "b"), marked), "hub-pairs")
    checked = via_shared_table(verify(pairs.where("may").select("a", "b"), documents, k), "checked")
    links = checked.where(_LINKS).select("a", "b")
    near = via_shared_table(components(links), "first-components")

    # Second: documents of a list in different components. `near` and `far` bound the distance to the list's hub.
    exact = checked.selectExpr("a as hub_x", "b as x", "1 - shared / cast(either as double) as near", "1 - shared / cast(either as double) as far")
    known = exact.unionByName(pairs.where("not may").selectExpr("a as hub_x", "b as x", "low as near", "1D as far"))
    known = known.groupBy("hub_x", "x").agg(F.min("near").alias("near"), F.max("far").alias("far"))
    comp = near.select(F.col("node").alias("x"), "component")
    hub_comp = near.select(F.col("node").alias("hub_x"), F.col("component").alias("hub_component"))
    placed = (
        listed.select("token", "x", "n", "l", "level", "many", F.col("hub.x").alias("hub_x"))
        .join(comp, "x", "left")
        .withColumn("component", F.coalesce("component", "x"))
        .join(hub_comp, "hub_x", "left")
        .withColumn("stray", F.col("component") != F.coalesce("hub_component", "hub_x"))
        .drop("hub_component")
    )
    placed = via_shared_table(placed, "listed")

    long_ = placed.where(f"many > {SHORT}").groupBy("hub_x", "x", "component").agg(F.max("stray").alias("stray"))
    mixed = long_.where("stray").select("hub_x").distinct()
    members = via_shared_table(long_.join(mixed, "hub_x", "left_semi"), "block-members")
    in_blocks = via_shared_table(_block_links(members, documents, k), "block-links")

    short = placed.where(f"many <= {SHORT}").join(known, ["hub_x", "x"], "left").withColumns(
        {"near": F.expr("if(x = hub_x, 0D, coalesce(near, 0D))"), "far": F.expr("if(x = hub_x, 0D, coalesce(far, 1D))")}
    )
    stray = short.where("stray").select(*[F.col(c).alias(f"s_{c}") for c in ("token", "x", "n", "l", "level", "component", "near", "far")])
    met = short.join(stray, F.col("token") == F.col("s_token")).where(
        f"component != s_component and (not stray or x < s_x) and {_size_fits('n', 's_n')}"
        f" and greatest(level, s_level) <= least(l, s_l) and greatest(near - s_far, s_near - far) <= {1 - PERCENT / 100} + 1e-9"
    )
    done = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = met.groupBy(F.least("x", "s_x").alias("a"), F.greatest("x", "s_x").alias("b")).agg(
        F.count("*").alias("met"), F.first(F.least("l", "s_l")).alias("needed")
    )
    # A pair that also meets in a long list has been compared there, so that its count here may fall short.
    pairs = pairs.where("met >= needed").select("a", "b").join(done, ["a", "b"], "left_anti")
    pairs = via_shared_table(bounded(pairs, marked).where("may").select("a", "b"), "more-pairs")
    more = verify(pairs, documents, k).where(_LINKS).select("a", "b")
    # The first links by their components: a link to the smallest node for each.
    first = near.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a != b")
    return first.unionByName(in_blocks).unionByName(more)


def near_duplicates(documents: DataFrame, k: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Words are lower-cased (A to Z) and separated by space and \\t to \\r; a document of fewer than k words is
    one shingle. `component_id` is the smallest doc_id reachable by links, itself included. Documents without
    words have no shingles and no links. Rows of equal doc_id are one document to links; a null doc_id has
    none and a null component. Other columns are not looked at; an empty table gives no rows.
    """
    documents = documents.select("doc_id", "text")
    with small_batches(documents.sparkSession):
        order = documents.sparkSession.sparkContext.broadcast(Order(shingle_table(documents, k)))
        classes, marked = document_classes(documents, order, k)
        posted = postings(documents, classes, order, k)
        same = components(similar_pairs(documents, posted, marked, k))
    labels = same.select(F.col("node").alias("rep"), "component")
    return classes.join(labels, "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id")
    )


def one_of_each(documents: DataFrame, k: int = SHINGLE) -> DataFrame:
    """The rows of `documents` without those near another of a smaller doc_id in their component.

    Rows are documents of their own here, also those that share a doc_id: of near or equal texts under one
    id any one row stays, other texts all do. Rows without words (null, empty, white space) and rows with a
    null doc_id stay. Columns may have any names; an empty table gives no rows.
    """
    rows, number = numbered(documents)
    kept = near_duplicates(rows.select(F.col(number).alias("doc_id"), "text"), k).where("doc_id = component_id")
    name = free_name(rows, "kept_number")
    kept = kept.select(F.col("doc_id").alias(name)).distinct()
    known = rows.where(F.col(number).isNotNull())
    found = known.join(kept, known[number] == kept[name], "left_semi").select(*documents.columns)
    return found.unionByName(rows.where(F.col(number).isNull()).select(*documents.columns))
