"""Near-duplicate embeddings by spherical-cap filters: every pair of one label whose cosine is high enough.

A random product code gives very many filter directions from a few short random vectors: a direction
takes one of them for each block of components. A vector passes the filters whose direction it exceeds
a threshold along, and list-decoding the blocks finds those without looking at the others. Vectors that
share a filter meet. Of those that meet, bit sketches tell who may be near anyone; only those are
verified, on the vectors themselves, each pair in the first filter that both pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.components import components
from funnelspark.llm.nearest import cosine, usable
from funnelspark.sources.sinks import via_shared_table

#: Filters a vector passes on average, the fewest that miss few enough pairs; and vectors wanted to a filter.
PASSED, WANTED = (24, 32, 48, 64, 96), 256
#: Independent codes, each with a rotation of its own, and blocks of each.
CODES, BLOCKS = 8, 2
#: Of random pairs exactly at the wanted cosine, how many may share no filter; and how many are tried.
MISSED, TRIED = 0.005, 1000
#: Members of a filter that meet in one cell; more are dealt over several.
BLOCK = 2048
#: Bits of a sketch, and how many may differ, in standard deviations over the mean at the wanted cosine.
BITS, SPREAD = 128, 6.0


@dataclass
class Code:
    """Block k of a vector turned by rotations[c] is compared with directions[c][k]; a filter is one row of each k."""

    rotations: list[np.ndarray]
    directions: list[list[np.ndarray]]
    planes: np.ndarray
    threshold: float = 0.0

    @property
    def filters(self) -> int:
        """Of one code."""
        return int(np.prod([len(c) for c in self.directions[0]]))

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and filter of every filter that a unit vector passes, rows ascending, filters ascending in each."""
        found = [self._decode(unit, c) for c in range(len(self.rotations))]
        row, number = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        order = np.lexsort((number, row))
        return row[order], number[order]

    def _decode(self, unit: np.ndarray, code: int) -> tuple[np.ndarray, np.ndarray]:
        turned, at, parts = unit @ self.rotations[code], 0, []
        for c in self.directions[code]:
            parts.append(turned[:, at : at + c.shape[1]] @ c.T / np.sqrt(len(self.directions[code])))
            at += c.shape[1]
        # What the blocks to come can add at most; partial directions that can't get there go.
        rest = [*np.cumsum([p.max(axis=1) for p in parts[:0:-1]], axis=0)[::-1], np.zeros(len(unit))]
        row, number, sums = np.arange(len(unit)), np.zeros(len(unit), dtype=np.int64), np.zeros(len(unit))
        for part, most in zip(parts, rest):
            held, step = [(row[:0], number[:0], sums[:0])], max(1, (1 << 20) // part.shape[1])
            for i in range(0, len(row), step):
                r = row[i : i + step]
                total = sums[i : i + step, None] + part[r]
                at, chosen = np.nonzero(total + most[r, None] >= self.threshold)
                held.append((r[at], number[i + at] * part.shape[1] + chosen, total[at, chosen]))
            row, number, sums = (np.concatenate([h[k] for h in held]) for k in range(3))
        return row, number + code * self.filters

    def sketch(self, unit: np.ndarray) -> np.ndarray:
        """Two words of bits: on which side of random planes a vector is."""
        bits = np.packbits(unit @ self.planes.T > 0, axis=1)
        return np.ascontiguousarray(bits).view("<i8")


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pairs(rng: np.random.Generator, d: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Random unit vectors, and others at that cosine of them (in one dimension the same ones)."""
    x, side = _unit(rng.normal(size=(TRIED, d))), rng.normal(size=(TRIED, d))
    if d == 1:
        return x, x
    side -= (side * x).sum(axis=1, keepdims=True) * x
    return x, least * x + np.sqrt(1 - least**2) * _unit(side)


def _threshold(code: Code, x: np.ndarray, passed: float) -> float:
    """The one that the vectors x exceed along `passed` directions on average; found from above, where few pass."""

    def many(threshold: float) -> bool:
        code.threshold = threshold
        return len(code.decode(x)[0]) > passed * len(x)

    high = 1.0
    while high > -1 and not many(high - 0.04):
        high -= 0.04
    low = high - 0.04
    for _ in range(10):
        middle = (low + high) / 2
        low, high = (middle, high) if many(middle) else (low, middle)
    return low


def make_code(d: int, vectors: int, least: float, seed: int = 11) -> Code:
    """Codes for so many vectors of dimension d, such that pairs at cosine `least` share a filter.

    There are as many filters as make one hold WANTED vectors, if every vector passes PASSED of them. The
    threshold says how many pass; that number is raised, and if that is not enough (in few dimensions) the
    number of filters is lowered, until no more than MISSED of random pairs at that cosine share none. The
    last resort is one filter for all.
    """
    rng = np.random.default_rng([seed, d])
    x, y = _pairs(rng, d, least)
    codes, blocks = (CODES, BLOCKS) if d >= 2 * BLOCKS else (1, 1)
    rotations = [np.linalg.qr(rng.normal(size=(d, d)))[0] for _ in range(codes)]
    planes = rng.normal(size=(BITS, d))
    sizes = np.diff(np.linspace(0, d, blocks + 1).round().astype(int))
    while True:
        for passed in PASSED:
            each = max(2, round((vectors * passed / WANTED / codes) ** (1 / blocks)))
            code = Code(rotations, [[_unit(rng.normal(size=(each, n))) for n in sizes] for _ in range(codes)], planes)
            code.threshold = _threshold(code, x[:200], min(passed, 0.5 * codes * code.filters))
            (rx, fx), (ry, fy) = code.decode(x), code.decode(y)
            width = codes * code.filters
            together = np.unique(np.intersect1d(rx * width + fx, ry * width + fy) // width)
            if len(x) - len(together) <= MISSED * len(x):
                return code
        if vectors <= WANTED:  # one filter that all pass
            return Code(rotations[:1], [[b[:1] for b in code.directions[0]]], planes, -2.0)
        vectors //= 4


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _codes(rows: DataFrame, least: float) -> dict[int, Code]:
    """A code for each dimension there is, for its largest label; dimensions are few however many vectors there are."""
    sizes = rows.groupBy("d", "label").agg(F.count("*").alias("n")).groupBy("d").agg(F.max("n").alias("n")).collect()
    return {r.d: make_code(r.d, r.n, least) for r in sizes}


def filtered(rows: DataFrame, codes) -> DataFrame:
    """rows (row, label, d, v, many) with their filters (ascending) and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for d in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == d))
                unit = _unit(_matrix(part.column(2)))
                owner, number = codes.value[d].decode(unit)
                offsets = np.searchsorted(owner, np.arange(len(unit) + 1)).astype(np.int32)
                sketch = codes.value[d].sketch(unit)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(number))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists, pa.array(sketch[:, 0].copy()), pa.array(sketch[:, 1].copy())], names=["row", "filters", "s1", "s2"]
                )

    found = rows.select("row", "d", "v").mapInArrow(run, "row long, filters array<long>, s1 long, s2 long")
    return via_shared_table(rows.join(found, "row"), "cap-rows")


_CELL = ["label", "d", "filter", "low", "high"]


def _dealt(listed: DataFrame) -> DataFrame:
    """Members of filters dealt to cells: all of a small filter in one, a large one's blocks by pairs of blocks."""
    large = listed.groupBy("label", "d", "filter").agg(F.count("*").alias("n")).where(f"n > {BLOCK}")
    large = via_shared_table(large.select("label", "d", "filter", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "large-filters")
    dealt = listed.join(large, ["label", "d", "filter"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("row"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = "least(block, other) as low", "greatest(block, other) as high", "cast(block > other as int) as side"
    return dealt.selectExpr("label", "d", "filter", *cell, "row", "s1", "s2")


def _allowed(least: float) -> int:
    """Bits in which sketches of vectors at that cosine differ, but for one in a thousand million."""
    p = np.arccos(np.clip(least, -1, 1)) / np.pi
    return int(np.ceil(BITS * p + SPREAD * np.sqrt(BITS * p * (1 - p))))


def _may_meet(table: pa.Table, allowed: int) -> pa.Table:
    """row, filter, low, high, side of the members of a cell whose sketch is near another's there."""
    side = table["side"].to_numpy()
    words = [table[c].to_numpy().view(np.uint64) for c in ("s1", "s2")]
    near = np.zeros(len(side), dtype=bool)
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if side.any() else left
    for i in range(0, len(left), 256):
        a = left[i : i + 256]
        differ = sum(np.bitwise_count(w[a][:, None] ^ w[right][None, :]).astype(np.int16) for w in words)
        close = (differ <= allowed) & (a[:, None] != right[None, :])
        near[a] |= close.any(axis=1)
        near[right] |= close.any(axis=0)
    return table.filter(pa.array(near)).select([*_CELL, "row", "side"])


def _verified(table: pa.Table, least: float) -> pa.Table:
    """a, b, n of a cell: links that join its vectors (b not null, n 0), and the links each has (b null).

    A pair counts in the first filter that both of its vectors pass.
    """
    side, row, many = table["side"].to_numpy(), table["row"].to_numpy(), table["many"].to_numpy()
    x = _matrix(table["v"])
    unit = _unit(x)
    lists = table["filters"].combine_chunks()
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    before = lists.flatten().to_numpy() < table["filter"][0].as_py()
    _, code, count = np.unique(lists.flatten().to_numpy()[before], return_inverse=True, return_counts=True)
    owner, shared = owner[before], count[code] > 1
    owner, code = owner[shared], np.unique(code[shared], return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if side.any() else left
    counts, ends, links = np.zeros(len(row), dtype=np.int64), np.arange(len(row)), []

    def end(i: int) -> int:
        while ends[i] != i:
            ends[i] = ends[ends[i]]
            i = ends[i]
        return i

    for i in range(0, len(left), 512):
        a = left[i : i + 512]
        score = unit[a] @ unit[right].T
        near = (score >= least - 1e-9) & (a[:, None] < right[None, :] if not side.any() else True)
        for p, q in np.argwhere(near & (score < least + 1e-9)):
            near[p, q] = cosine(x[a[p]][None], x[right[q]][None])[0] >= least
        if not near.any():
            continue
        met = np.zeros(near.shape, dtype=np.float32)
        for first in range(0, int(code[-1]) + 1 if len(code) else 0, 1024):
            b, c = np.searchsorted(code, [first, first + 1024])
            held = np.zeros((len(row), 1024), dtype=np.float32)
            held[owner[b:c], code[b:c] - first] = 1
            met += held[a] @ held[right].T
        near &= met == 0
        counts[a] += near @ many[right]
        counts[right] += near.T @ many[a]
        for p, q in np.argwhere(near):
            p, q = a[p], right[q]
            s, t = end(p), end(q)
            if s != t:
                ends[max(s, t)] = min(s, t)
                links.append((p, q))
    linked = np.flatnonzero(counts)
    a, b = (np.array([x[k] for x in links], dtype=np.int64) for k in (0, 1))
    return pa.table(
        {
            "a": pa.array(np.concatenate([row[linked], row[a]])),
            "b": pa.array(np.concatenate([row[linked], row[b]]), mask=np.arange(len(linked) + len(a)) < len(linked)),
            "n": pa.array(np.concatenate([counts[linked], np.zeros(len(a), dtype=np.int64)])),
        }
    )


def near_vectors(
    vectors: DataFrame, least: float = 0.93, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label"
) -> DataFrame:
    """One row per row of `vectors`: its id, n_links, component_id, kept.

    Rows of equal, not null labels whose cosine (in double precision) is `least` or more are linked,
    if they share a filter, which of random pairs just there all but MISSED do, and of nearer ones more.
    `n_links` counts the other rows linked directly, repeated ones included; `component_id` is the
    smallest id reachable by links, itself included; kept tells whether that is the row's own. Vectors
    that are null, empty, zero or hold null or non-finite components, and rows with a null id or label, have
    no links; a null id has a null component and is not kept. Vectors of different dimensions never link.
    Other columns are not looked at; an empty table gives no rows.
    """
    named = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("v"), F.col(label_column).alias("label"))
    valid = usable(named.where("label is not null").withColumn("both", F.struct("id", "label")), "both", "v").selectExpr("id.id as id", "id.label as label", "v")
    classes = valid.where("id is not null").groupBy("label", "v").agg(F.min("id").alias("first"), F.count("*").alias("many"))
    # Rows of equal label and vector are one to all that follows, so a common vector costs no more than another.
    rows = via_shared_table(classes.select(F.monotonically_increasing_id().alias("row"), "label", F.size("v").alias("d"), "v", "first", "many"), "cap-classes")
    codes = vectors.sparkSession.sparkContext.broadcast(_codes(rows, least))
    told = filtered(rows, codes)

    listed = told.select("label", "d", "row", "s1", "s2", F.explode("filters").alias("filter"))
    allowed = _allowed(least)
    schema = {f.name: f.dataType.simpleString() for f in listed.schema} | {"low": "int", "high": "int", "side": "int"}
    cells = _dealt(listed).groupBy(*_CELL)
    active = cells.applyInArrow(lambda t: _may_meet(t, allowed), ", ".join(f"{c} {schema[c]}" for c in [*_CELL, "row", "side"]))
    active = via_shared_table(active, "cap-active")

    asked = active.join(told.select("row", "v", "many", "filters"), "row").groupBy(*_CELL)
    found = via_shared_table(asked.applyInArrow(lambda t: _verified(t, least), "a long, b long, n long"), "cap-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("row")).agg(F.sum("n").alias("n"))
    joined = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "row")
    placed = rows.select("row", "label", "v", "first", "many").join(counts, "row", "left").join(joined, "row", "left")
    placed = via_shared_table(placed.withColumn("component", F.coalesce("component", "row")), "cap-placed")
    smallest = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    by_class = placed.join(smallest, "component").select(
        F.col("label").alias("class_label"), F.col("v").alias("class_v"), "component_id", (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links")
    )
    doubles = named.select("id", "label", F.expr("transform(v, x -> cast(x as double))").alias("v"))
    out = doubles.join(by_class, (F.col("label") == F.col("class_label")) & (F.col("v") == F.col("class_v")) & F.col("id").isNotNull(), "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )
