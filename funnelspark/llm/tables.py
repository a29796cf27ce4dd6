"""Fixed-size tables of hashed counts, added up over all rows and handed to every task.

They only ever steer: a table orders tokens by how often their slot was hit, or tells that a key was
certainly not seen. Their size is a parameter and doesn't grow with the data; fuller slots make
orders and tests weaker, never a result wrong.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from funnelspark.llm.words import mix

PARTS = 256


def slot(keys: np.ndarray, bits: int) -> np.ndarray:
    """The slot of each key (64-bit hashes)."""
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


class Slots:
    """What one task counts, and its rows (part, counts) for the table."""

    def __init__(self, bits: int, flags: bool = False):
        self.bits, self.flags = bits, flags
        self.total = np.zeros(1 << bits, dtype=np.uint8 if flags else np.uint32)

    def add(self, hashes: np.ndarray) -> None:
        if self.flags:
            self.total[slot(hashes, self.bits)] = 1
        else:
            np.add.at(self.total, slot(hashes, self.bits), np.uint32(1))

    def parts(self) -> tuple[list[int], list[bytes]]:
        rows = self.total.reshape(PARTS, -1)
        full = np.flatnonzero(rows.any(axis=1)).tolist()
        return full, [rows[i].tobytes() for i in full]


def added_up(parts: DataFrame, bits: int, flags: bool = False) -> np.ndarray:
    """The table of all tasks' rows (part, counts); counts stay at the largest 32-bit number once there."""
    width, kind = (1 << bits) // PARTS, np.dtype(np.uint8 if flags else np.uint32)
    most = 1 if flags else np.iinfo(np.uint32).max

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, dtype=np.int64)
        for data in rows["counts"]:
            total += np.frombuffer(data, dtype=kind)
        return pd.DataFrame({"part": rows["part"][:1], "counts": [np.minimum(total, most).astype(kind).tobytes()]})

    out = np.zeros(1 << bits, dtype=kind)
    for r in parts.groupBy("part").applyInPandas(add, "part int, counts binary").collect():  # PARTS rows
        out[r.part * width : (r.part + 1) * width] = np.frombuffer(r.counts, dtype=kind)
    return out


def _added_up(rows: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int, flags: bool) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = Slots(bits, flags)
        for batch in batches:
            for some in hashes(batch):
                slots.add(some)
        parts, data = slots.parts()
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(data, pa.binary())], names=["part", "counts"])

    return added_up(rows.mapInArrow(run, "part int, counts binary"), bits, flags)


def count_table(rows: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int) -> np.ndarray:
    """How many of all hashes fell in each of 2 ** bits slots. `hashes` gives those of a batch, in parts."""
    return _added_up(rows, hashes, bits, False)


def rarity(counts: np.ndarray) -> np.ndarray:
    """A level for each slot, the rarer the lower: 64 steps for each doubling of the count."""
    return np.rint(64 * np.log2(np.maximum(counts, 1))).astype(np.uint16)


def seen(keys: DataFrame, column: str, bits: int = 22) -> np.ndarray:
    """A bit table of the keys of a long column; `maybe` asks it."""
    return np.packbits(_added_up(keys.select(column), lambda b: iter([hashed(b.column(0).to_numpy(zero_copy_only=False))]), bits, True))


def seen_of(rows: DataFrame, keys: Callable[[pa.RecordBatch], np.ndarray], bits: int = 22) -> np.ndarray:
    """A bit table of the long keys that a batch gives, made in the task that reads it: no second Python worker."""
    return np.packbits(_added_up(rows, lambda b: iter([hashed(keys(b))]), bits, True))


def hashed(keys: np.ndarray) -> np.ndarray:
    return mix(keys.astype(np.int64).view(np.uint64))


def maybe(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False only for keys that are certainly not among those the table was made of."""
    at = slot(hashed(keys), int(np.log2(len(table))) + 3)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
