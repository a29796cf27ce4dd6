"""Alignment of the tokens of two tokenizers over a corpus, by inverted bitmaps of token pairs.

Tokens A of a text cover a space and the text, and so do tokens B. Where an A token and a B token end
at the same byte they are linked. Each pair of linked ids has, for every chunk of documents, a
compressed bitmap of the documents that hold it, and bitmaps of the bits of how often they hold it
beyond once: its multiplicity planes. Popcounts of a pair's bitmaps give its document count and, by
plane, its link count; the bitmaps then carry the pair's scores back to its documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.packing import FileTokenizer
from funnelspark.llm.words import small_batches
from funnelspark.sources.sinks import via_shared_table

#: Documents of a chunk, as a power of two. A bitmap has a bit for each; with fewer set than half its
#: bytes, it is a list of 16-bit places instead.
CHUNK_BITS = 13
BITMAP = (1 << CHUNK_BITS) // 8
#: Links of a chunk held back before they become bitmaps; a chunk of more has several for one pair.
HELD = 1 << 20
#: Characters of texts aligned in one go, or one longer text.
RUN = 1 << 17


class Aligner:
    """Token ids, links and groups of texts, many at a time.

    Tokens A are merged by tiktoken over the file's own vocabulary, which gives the ids that tokenizers
    gives with special tokens as plain text, in a sixth of the time.
    """

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        self.a = FileTokenizer(path_a)
        self.b = SentencePieceProcessor(model_file=path_b)
        merger = self.a.merger
        self.bytes_a = [merger.decode_single_token_bytes(i) for i in range(merger.n_vocab)]
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.lengths = [np.array([len(x) for x in part]) for part in (self.bytes_a, self.bytes_b)]
        self.width = len(self.bytes_b)
        # What stands for a token in a text's groups, when it doesn't end a group, and when it does.
        self.shown = [f"{i}{end}".encode() for i in range(len(self.bytes_a)) for end in ",|"]
        self.shown += [f"{i}{end}".encode() for i in range(self.width) for end in ",;"]

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """n_a, n_b, n_links of each text; the digest of its groups; and the text and the pair of each link."""
        n, ids = np.zeros((2, len(texts)), dtype=np.int64), ([], [])
        for i, text in enumerate(texts):
            if not text:
                continue
            spaced = f" {text}"
            a, b, data = self.a.plain(spaced), self.b.encode(text), spaced.encode()
            if b"".join(map(self.bytes_a.__getitem__, a)) == data == b"".join(map(self.bytes_b.__getitem__, b)):
                n[:, i] = len(a), len(b)
                ids[0].append(np.array(a, dtype=np.int64))
                ids[1].append(np.array(b, dtype=np.int64))
        a, b = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in ids)
        # The texts left are one run of bytes to both tokenizers, and end together too.
        ends_a, ends_b = np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b])
        at = np.searchsorted(ends_b, ends_a)
        last_a = ends_b[at] == ends_a if len(a) else np.zeros(0, dtype=bool)
        i = np.flatnonzero(last_a)
        j = at[i]
        last_b = np.zeros(len(b), dtype=bool)
        last_b[j] = True
        # Groups in order, in each its A tokens, then its B tokens.
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + np.append(0, j + 1)[np.cumsum(last_a) - last_a]] = 2 * a + last_a
        order[np.arange(len(b)) + np.append(i + 1, 0)[np.cumsum(last_b) - last_b]] = 2 * (len(self.bytes_a) + b) + last_b
        shown = list(map(self.shown.__getitem__, order.tolist()))
        bounds = np.append(0, np.cumsum(n.sum(axis=0))).tolist()
        digests = [hashlib.sha256(b"".join(shown[x:y])[:-1]).hexdigest() if x < y else "" for x, y in zip(bounds[:-1], bounds[1:])]
        text = np.repeat(np.arange(len(texts)), n[0])[i]
        return np.column_stack([*n, np.bincount(text, minlength=len(texts))]), digests, text, a[i] * self.width + b[j]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The one of this process."""
    return _aligners.get((path_a, path_b)) or _aligners.setdefault((path_a, path_b), Aligner(path_a, path_b))


def bitmaps(pair: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """(pairs, plane, offsets, bytes) of the bitmaps of links, by pair and place of the document in its chunk.

    Plane -1 is the documents' bitmap, plane k that of bit k of how often beyond once.
    """
    keys, many = np.unique((pair << CHUNK_BITS) | place, return_counts=True)
    pair, place, more = keys >> CHUNK_BITS, keys & ((1 << CHUNK_BITS) - 1), many - 1
    for plane in range(-1, int(more.max(initial=0)).bit_length()):
        if plane >= 0:
            held = (more >> plane) & 1 == 1
            pair_, place_ = pair[held], place[held]
        else:
            pair_, place_ = pair, place
        if not len(pair_):
            continue
        first = np.flatnonzero(np.diff(pair_, prepend=-1))
        count = np.diff(np.append(first, len(pair_)))
        dense = 2 * count >= BITMAP
        if (~dense).any():
            sizes = 2 * count[~dense]
            yield pair_[first[~dense]], plane, np.append(0, np.cumsum(sizes)), place_[np.repeat(~dense, count)].astype("<u2").view(np.uint8)
        if dense.any():
            bits = np.zeros((dense.sum(), 8 * BITMAP), dtype=np.uint8)
            bits[np.repeat(np.arange(dense.sum()), count[dense]), place_[np.repeat(dense, count)]] = 1
            yield pair_[first[dense]], plane, np.arange(dense.sum() + 1) * BITMAP, np.packbits(bits, axis=1).ravel()


def index(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id") -> DataFrame:
    """Rows of two kinds, in the shared folder: a document's counts (row, id, n_a, n_b, n_links, groups_sha256)
    and bitmaps (pair, chunk, plane, bits), the columns of the other kind null.

    `row` numbers the rows of `docs`, repeated ones included; a chunk is a run of rows of one task.
    """
    kind = docs.schema[id_column].dataType
    schema = f"row long, id {kind.simpleString()}, n_a long, n_b long, n_links long, groups_sha256 string, pair long, chunk long, plane int, bits binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [pa.int64(), to_arrow_type(kind), *[pa.int64()] * 3, pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        names = [c.split()[0] for c in schema.split(", ")]
        use = aligner(path_a, path_b)
        row = TaskContext.get().partitionId() << 33
        pairs, places, held = [], [], 0

        def rows(columns: dict) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, t) for c, t in zip(names, types)], names=names)

        def flush(chunk: int) -> Iterator[pa.RecordBatch]:
            nonlocal pairs, places, held
            if held:
                for pair, plane, offsets, data in bitmaps(np.concatenate(pairs), np.concatenate(places)):
                    for i in range(0, len(pair), 1 << 16):
                        some = offsets[i : i + (1 << 16) + 1]
                        bits = pa.Array.from_buffers(
                            pa.binary(), len(some) - 1, [None, pa.py_buffer((some - some[0]).astype(np.int32)), pa.py_buffer(data[some[0] : some[-1]].tobytes())]
                        )
                        n = len(bits)
                        yield rows({"pair": pa.array(pair[i : i + n]), "chunk": pa.array(np.full(n, chunk)), "plane": pa.array(np.full(n, plane, dtype=np.int32)), "bits": bits})
            pairs, places, held = [], [], 0

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                # A few texts at a time, never of two chunks.
                texts, size, upto = [], 0, at
                while upto < batch.num_rows and (upto == at or (size < RUN and (row + upto - at) >> CHUNK_BITS == row >> CHUNK_BITS)):
                    texts.append(batch.column(1)[upto].as_py() or "")
                    size += len(texts[-1])
                    upto += 1
                counts, digests, text, pair = use.align(texts)
                n = upto - at
                yield rows(
                    {
                        "row": pa.array(np.arange(row, row + n)),
                        "id": batch.column(0).slice(at, n),
                        **{c: pa.array(counts[:, i].copy()) for i, c in enumerate(("n_a", "n_b", "n_links"))},
                        "groups_sha256": pa.array(digests),
                    }
                )
                pairs.append(pair)
                places.append((text + row) & ((1 << CHUNK_BITS) - 1))
                held += len(pair)
                chunk, row, at = row >> CHUNK_BITS, row + n, upto
                if held > HELD or row >> CHUNK_BITS != chunk:
                    yield from flush(chunk)
        yield from flush(row >> CHUNK_BITS)

    with small_batches(docs.sparkSession, 512):
        return via_shared_table(docs.select(id_column, "text").mapInArrow(run, schema), "pair-index")


#: Set bits of a bitmap, and what a set bit of its plane counts for.
_SET = f"cast(if(length(bits) = {BITMAP}, bitmap_count(bits), length(bits) div 2) as bigint)"
_WORTH = "if(plane < 0, 1L, shiftleft(1L, plane))"


def pair_counts(indexed: DataFrame, width: int) -> DataFrame:
    """pair, a, b, documents, links of every linked pair of ids: popcounts of its bitmaps and planes.

    The bitmaps of one pair hold different documents, so their union's popcount is the sum of theirs,
    taken before anything is shuffled; a pair that every document holds is no hot key.
    """
    set_bits = indexed.where("pair is not null").select("pair", F.expr(f"if(plane < 0, {_SET}, 0L)").alias("documents"), F.expr(f"{_SET} * {_WORTH}").alias("links"))
    counted = set_bits.groupBy("pair").agg(F.sum("documents").alias("documents"), F.sum("links").alias("links"))
    return counted.selectExpr("pair", f"pair div {width} as a", f"pair % {width} as b", "documents", "links")


def _returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (chunk, bits, worth, links, best), by chunk, to row, n_best, count_sum of its documents."""
    chunk, sums = None, np.zeros((1 << CHUNK_BITS, 2), dtype=np.int64)

    def done() -> pa.RecordBatch:
        place = np.flatnonzero(sums.any(axis=1))
        rows = [place + (chunk << CHUNK_BITS), sums[place, 0].copy(), sums[place, 1].copy()]
        sums[:] = 0
        return pa.RecordBatch.from_arrays([pa.array(c) for c in rows], names=["row", "n_best", "count_sum"])

    for batch in batches:
        chunks = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(chunks)) + 1).tolist(), len(chunks)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if chunk is not None and chunks[a] != chunk:
                yield done()
            chunk = int(chunks[a])
            part = batch.slice(a, b - a)
            bits, worth = part.column(1), part.column(2).to_numpy()
            links, best = part.column(3).to_numpy(), part.column(4).to_numpy(zero_copy_only=False)
            each = np.stack([worth * best, worth * links], axis=1)
            offsets = np.frombuffer(bits.buffers()[1], dtype=np.int32)[bits.offset : bits.offset + len(bits) + 1]
            size = np.diff(offsets)
            data = np.frombuffer(bits.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
            listed = np.repeat(size < BITMAP, size)
            of = np.repeat(np.flatnonzero(size < BITMAP), size[size < BITMAP] // 2)
            np.add.at(sums, data[listed].copy().view("<u2").astype(np.int64), each[of])
            for i in np.flatnonzero(size == BITMAP):
                start = offsets[i] - offsets[0]
                sums[np.unpackbits(data[start : start + BITMAP]).astype(bool)] += each[i]
    if chunk is not None:
        yield done()


def scored(indexed: DataFrame, counts: DataFrame) -> DataFrame:
    """row, n_best, count_sum of the documents with links: pair scores returned over the pairs' bitmaps.

    A pair's score is its link count, and whether that is the highest of its B id, ties included.
    """
    highest = counts.groupBy("b").agg(F.max("links").alias("highest"))
    scores = via_shared_table(counts.join(highest, "b").select("pair", "links", (F.col("links") == F.col("highest")).alias("best")), "pair-scores")
    posted = indexed.where("pair is not null").select("pair", "chunk", F.expr(_WORTH).alias("worth"), "bits").join(scores, "pair")
    by_chunk = posted.select("chunk", "bits", "worth", "links", "best").repartition("chunk").sortWithinPartitions("chunk")
    each = by_chunk.mapInArrow(_returned, "row long, n_best long, count_sum long")
    return each.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: its id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `path_a` is a byte-level file of the tokenizers library, `path_b` a sentencepiece model that adds a
    space in front. A text that is null or empty, or that a tokenizer does not give back byte for byte
    behind a space, has no tokens: zeros and an empty digest; it counts for no pair. Rows that repeat an
    id or have a null one are documents of their own. An empty table gives no rows. Other columns are
    not looked at.
    """
    indexed = index(docs, path_a, path_b, id_column)
    counts = via_shared_table(pair_counts(indexed, aligner(path_a, path_b).width), "pair-counts")
    found = scored(indexed, counts)
    rows = indexed.where("row is not null").join(found, "row", "left")
    return rows.selectExpr(
        f"id as `{id_column}`", "n_a", "n_b", "n_links as n_groups", "n_links",
        "coalesce(n_best, 0L) as n_best", "coalesce(count_sum, 0L) as count_sum", "groups_sha256",
    )
