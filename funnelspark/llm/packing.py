"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

`tokenize` cuts documents into pieces, `pack` assigns every piece a sequence and a place in it, and
`sequences` gathers the token ids of each sequence.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.words import mix, small_batches
from funnelspark.sources.sinks import via_shared_table

#: White space longer than this is not given to the merger's own pattern, which can't go back that far.
LONG = 50_000
# White space to the tokenizers library; Python's own class also has U+001C to U+001F.
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SEGMENT = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]")
_SPACE = re.compile(f"[{_WHITE}]+")
_LONG_RUN = re.compile(f"[{_WHITE}]{{{LONG}}}")
# The public byte-level rule's pattern, and the bytes it shows as themselves.
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _SHOWN]
_BYTE_OF = {chr(b): b for b in _SHOWN} | {chr(256 + i): b for i, b in enumerate(_HIDDEN)}


class FileTokenizer:
    """Ids of whole texts by a byte-level BPE file of the tokenizers library.

    tiktoken merges over the file's own vocabulary, whose ids are its merge order; that gives the ids
    tokenizers gives in a quarter of the time. A text that holds an added token's string is left to
    tokenizers itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = [t.content for t in added.values()]
        ranks = {
            bytes(map(_BYTE_OF.__getitem__, token)): i for token, i in self.tokenizer.get_vocab(False).items() if i not in added
        }
        self.merger = tiktoken.Encoding("bytes", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def plain(self, text: str) -> list[int]:
        """Ids, added tokens' strings as plain text."""
        if len(text) < LONG or not _LONG_RUN.search(text):
            return self.merger.encode_ordinary(text)
        # White space is cut off as the pattern does, which never joins it, but for one space, with what follows.
        ids: list[int] = []
        for segment in _SEGMENT.findall(text):
            white = _SPACE.fullmatch(segment)
            ids += self.merger._encode_single_piece(segment.encode()) if white else self.merger.encode_ordinary(segment)
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        return [
            np.array(
                self.tokenizer.encode(text, add_special_tokens=False).ids if any(a in text for a in self.added) else self.plain(text), dtype="<u4"
            ).tobytes()
            for text in texts
        ]


_tokenizers: dict[str, FileTokenizer] = {}


def cut_pieces(length: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of each piece: whole ones of `most` at the end, the rest first."""
    first = length % most or min(length, most)
    starts = [0, *range(first, length, most)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], length])]


def tokenize(
    docs: DataFrame, path: str, most: int = 1024, end_id: int = 2, id_column: str = "doc_id", keep_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, salt, with `keep_ids` also ids.

    A null or empty text is its end id alone. `salt` is spread evenly over pieces, repeated rows
    included, because it comes from a row's place in its task and not from its content.
    """
    kinds = {"piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "salt": pa.int64()}
    end = np.array([end_id], dtype="<u4").tobytes()
    extra = ", ids array<int>" if keep_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizers.get(path) or _tokenizers.setdefault(path, FileTokenizer(path))
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                upto, size = at, 0
                while upto < len(texts) and (upto == at or size + len(texts[upto]) <= 1 << 18):
                    size += len(texts[upto])
                    upto += 1
                own, rows, ids = [], [], []
                for i, data in enumerate(tokenizer.encode(texts[at:upto]), at):
                    data += end
                    for piece, (start, length) in enumerate(cut_pieces(len(data) // 4, most)):
                        part = data[4 * start : 4 * (start + length)]
                        own.append(i)
                        rows.append((piece, start, length, zlib.crc32(part), row))
                        row += 1
                        if keep_ids:
                            ids.append(np.frombuffer(part, dtype="<u4"))
                columns = [batch.column(0).take(pa.array(own, pa.int64()))]
                columns += [pa.array(x, t) for x, t in zip(zip(*rows), kinds.values())]
                columns[-1] = pa.array(mix(np.asarray(columns[-1], dtype=np.uint64)).view(np.int64))
                if keep_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=[id_column, *kinds, *(["ids"] if keep_ids else [])])
                at = upto

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, "text").mapInArrow(
        run, f"{id_column} {kind}, piece int, start long, length long, ids_crc32 long, salt long{extra}"
    )


def best_two_fit(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of each item; lengths are 1 to `most`.

    Bins are filled one after another: the longest item left, then again and again the longest one
    that still fits. Then the bin's smallest item gives way to the two unpacked items that fit the
    gap it leaves most tightly, if they fill more of it than it did, until no such two are left.
    """
    stock = [list(x) for x in np.split(np.argsort(lengths, kind="stable"), np.cumsum(np.bincount(lengths, minlength=most + 1))[:-1])]
    left = np.array([len(s) for s in stock])
    # below[x]: the longest length up to x of which items are left, 0 if none.
    below = np.maximum.accumulate(np.where(left > 0, np.arange(most + 1), 0))
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)

    def refresh(length: int) -> None:
        down = below[length - 1]
        stop = np.searchsorted(below[length:], length, side="right") + length
        below[length:stop] = down

    def restore(length: int) -> None:
        below[length:] = np.maximum(below[length:], length)

    def take(length: int) -> int:
        left[length] -= 1
        if not left[length]:
            refresh(length)
        return length

    number = 0
    while below[most]:
        chosen = [take(int(below[most]))]
        gap = most - chosen[0]
        while gap and below[gap]:
            chosen.append(take(int(below[gap])))
            gap -= chosen[-1]
        while gap and len(chosen) > 1 and below[most]:
            smallest = min(chosen)
            room = gap + smallest
            a = np.flatnonzero(left[: room // 2 + 1])
            b = below[room - a]
            single = (b == a) & (left[a] < 2)
            b[single] = below[a[single] - 1]
            b = np.where(b > 0, b, -most)
            if not len(a) or (a + b).max() <= smallest:
                break
            best = int(np.argmax(a + b))
            chosen.remove(smallest)
            pair = [take(int(a[best])), take(int(b[best]))]
            left[smallest] += 1
            restore(smallest)
            chosen += pair
            gap = room - sum(pair)
        offset = 0
        for length in chosen:
            item = stock[length].pop()
            bins[item], offsets[item] = number, offset
            offset += length
        number += 1
    return bins, offsets


def pack(pieces: DataFrame, most: int = 1024, block_rows: int = 1 << 16) -> DataFrame:
    """Pieces with sequence_id and offset. `pieces` needs length (1 to most) and salt.

    Pieces are dealt by salt into blocks of about `block_rows`; each is packed by itself, at the
    price of less than one partly filled sequence per block. `pieces` is read twice: write it first
    where it is costly to make. The rows of a sequence keep their own columns.
    """
    blocks = max(1, -(-pieces.count() // block_rows))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "salt"], kind="stable")
        bins, offsets = best_two_fit(rows["length"].to_numpy(), most)
        rows["sequence_id"] = bins * blocks + rows["block"]
        rows["offset"] = offsets
        return rows.drop(columns="block")

    dealt = pieces.withColumn("block", F.pmod("salt", F.lit(blocks).cast("long")))
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("block").applyInPandas(run, f"{out}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, most: int = 1024, end_id: int = 2, id_column: str = "doc_id") -> DataFrame:
    """Pack whole documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The ids of a document are those of its text and then `end_id`; a null text counts as empty.
    Documents are cut only if longer than `most`. Rows that repeat a document are packed each; an
    empty table gives no rows; other columns of `docs` are not looked at. Tokenising happens once:
    the pieces, without text or ids, are written to the shared folder.
    """
    with small_batches(docs.sparkSession, 512):
        pieces = via_shared_table(tokenize(docs, path, most, end_id, id_column), "pieces")
    return pack(pieces, most).drop("salt")


def sequences(docs: DataFrame, path: str, most: int = 1024, end_id: int = 2, id_column: str = "doc_id") -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, lengths (one number per piece, for attention masks)."""
    with small_batches(docs.sparkSession, 512):
        pieces = via_shared_table(tokenize(docs, path, most, end_id, id_column, keep_ids=True), "pieces")
    placed = pack(pieces.select("salt", "length"), most)
    joined = pieces.select("salt", "ids").join(placed, "salt")
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return joined.groupBy("sequence_id").agg(parts.alias("parts")).selectExpr(
        "sequence_id", "flatten(parts.ids) as ids", "parts.length as lengths"
    )
