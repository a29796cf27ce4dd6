"""Removal of lines that match an earlier line, by an exact set-similarity join of their words.

A line is the set of its words, ordered from rare to frequent. Two lines of Jaccard 0.8 or more share
a word in their prefixes of |x| - ceil(t |x|) + 1 words, so lines meet in the posting lists of their
prefix words. Length and positional filters, and a bound from word maps of 64 or 128 bits, drop most of
what meets, and larger maps most of the rest where both lines are long; what remains is verified on the
words themselves. Lines of equal sets are one line to all this.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.rows import free_name, numbered
from funnelspark.llm.tables import Slots, added_up, maybe, rarity, seen_of, slot
from funnelspark.llm.words import hash_words, mix, order_within, parts, slices, small_batches, texts_of
from funnelspark.sources.sinks import intermediates, via_shared_table

#: A match: PERCENT * union <= 100 * intersection.
PERCENT = 80
#: Slots of the table of word counts, as a power of two.
TABLE_BITS = 22
#: Earlier lines kept for a line and word; if none of them matches and there are more, all are verified.
FEW = 3
#: Earliest candidates of a line that are verified first.
FIRST = 3
#: Most words of a line whose map has 64 bits, and of one for which 128 bits tell enough.
SMALL, LONG = 48, 144
#: Pairs of one posting list looked at in one go.
CHUNK = 1 << 17
_ENTRY = np.dtype(
    [("token", "<u4"), ("key", "<u4"), ("map1", "<u8"), ("map2", "<u8"), ("doc", "<i8"), ("line", "<u4"), ("n", "<u4"), ("place", "u1")]
)


class Lines:
    """The lines of some texts with their distinct words: line i has words[start[i] : start[i] + n[i]]."""

    def __init__(self, texts: list[bytes]):
        split = [t.split(b"\n") for t in texts]
        counts = np.array([len(s) for s in split], dtype=np.int64)
        self.text = np.repeat(np.arange(len(texts)), counts)
        self.number = np.arange(len(self.text)) - np.repeat(np.cumsum(counts) - counts, counts)
        words, line = hash_words([x for s in split for x in s])
        order = order_within(words, line)
        words, line = words[order], line[order]
        new = np.ones(len(words), dtype=bool)
        new[1:] = (words[1:] != words[:-1]) | (line[1:] != line[:-1])
        self.words, self.line = words[new], line[new]
        self.n = np.bincount(self.line, minlength=len(self.text))
        self.start = np.cumsum(self.n) - self.n

    def _each(self, add: np.ufunc, values: np.ndarray) -> np.ndarray:
        """`add` over the words of each line; 0 for lines without words."""
        out = np.zeros(len(self.n), dtype=np.uint64)
        if len(values):
            full = self.n > 0
            out[full] = add.reduceat(values, self.start[full])
        return out

    def key(self) -> np.ndarray:
        """A 64-bit key of each line's set."""
        return mix(self._each(np.add, mix(self.words + np.uint64(0x632BE59BD9B4E019))) + self.n.astype(np.uint64))

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit keys of each line's set."""
        return self.key(), mix(self._each(np.add, mix(self.words ^ np.uint64(0xC2B2AE3D27D4EB4F))))

    def order(self, level: np.ndarray) -> np.ndarray:
        """The places of the words by line, level and hash."""
        size = len(level)
        if size < 1 << 20 and len(self.n) < 1 << 27:
            places = (self.line.astype(np.uint64) << np.uint64(36)) | (level.astype(np.uint64) << np.uint64(20)) | np.arange(size, dtype=np.uint64)
            places.sort()
            return (places & np.uint64((1 << 20) - 1)).astype(np.int64)
        return np.argsort((self.line.astype(np.int64) << 16) | level, kind="stable")

    def maps(self) -> tuple[np.ndarray, np.ndarray]:
        """A map of 128 bits for each line, in two words: each word of the line flips a bit. Of lines of SMALL words
        or fewer the two are folded into the first."""
        spread = mix(self.words ^ np.uint64(0xD6E8FEB86659FD93))
        bit, high = np.uint64(1) << (spread >> np.uint64(58)), spread & np.uint64(1) == 0
        high |= (self.n <= SMALL)[self.line]
        return self._each(np.bitwise_xor, np.where(high, bit, 0)), self._each(np.bitwise_xor, np.where(high, 0, bit))

    def marks(self) -> tuple[np.ndarray, np.ndarray]:
        """A larger map of lines of more than LONG words, two to four bits a word: bytes of all lines, and where each
        line's end."""
        bits = np.where(self.n > LONG, 1 << np.ceil(np.log2(np.maximum(2 * self.n, 64))).astype(np.int64), 0)
        first = np.cumsum(bits) - bits
        some = (self.n > LONG)[self.line]
        words, line = self.words[some], self.line[some]
        place = (mix(words ^ np.uint64(0xA0761D6478BD642F)) & (bits[line] - 1).astype(np.uint64)).astype(np.int64)
        odd = np.bincount(first[line] + place, minlength=int(bits.sum())) & 1
        return np.packbits(odd.astype(bool), bitorder="little"), np.cumsum(bits) // 8


def token(words: np.ndarray) -> np.ndarray:
    """The part of a word's hash by which its owner tells words apart; two that share it only meet more lines."""
    return words & np.uint64(0xFFFFFFFF)


def line_id(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """A 64-bit hash of document and line number."""
    return mix(mix(doc.astype(np.int64).view(np.uint64)) + line.astype(np.uint64)).view(np.int64)


def _runs(batch: pa.RecordBatch, among: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, Lines]]:
    """Of a batch (doc_id, text) in slices: document id and number of each line, and the lines; rows without an id
    are left out. With `among`, a bit table of tokens, only lines of which a word may be in it."""
    batch = batch.filter(batch.column(0).is_valid())
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    for first, run in slices(texts_of(batch.column(1))):
        if among is None:
            lines = Lines(run)
            yield ids[first + lines.text], lines.number, lines
            continue
        doc, number, every = _split(ids[first : first + len(run)], run)
        words, line = hash_words(every)
        some = np.unique(line[maybe(among, token(words).view(np.int64))])
        yield doc[some], number[some], Lines([every[i] for i in some])


def _split(ids: np.ndarray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Document id, number and bytes of each line."""
    split = [t.split(b"\n") for t in texts]
    counts = np.array([len(x) for x in split], dtype=np.int64)
    number = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(ids, counts), number, [x for t in split for x in t]


def read_lines(documents: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """doc_id, line, key1, key2, n, marks (empty up to LONG words) of every line that has words; and, by the same
    scan, hashed counts of the lines that each word is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = Slots(TABLE_BITS)
        names = ["doc_id", "line", "key1", "key2", "n", "marks", "part", "counts"]
        for batch in batches:
            for doc, number, lines in _runs(batch):
                slots.add(lines.words)
                full = np.flatnonzero(lines.n)
                key1, key2 = lines.keys()
                marks, ends = lines.marks()
                ends = np.append(0, ends).astype(np.int32)
                marks = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(marks)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc[full], pa.int64()),
                        pa.array(number[full].astype(np.int32)),
                        pa.array(key1[full].view(np.int64)),
                        pa.array(key2[full].view(np.int64)),
                        pa.array(lines.n[full].astype(np.int32)),
                        marks.take(pa.array(full)),
                        pa.nulls(len(full), pa.int32()),
                        pa.nulls(len(full), pa.binary()),
                    ],
                    names=names,
                )
        parts, counts = slots.parts()
        for i in range(0, len(parts), 16):
            n = len(parts[i : i + 16])
            empty = [pa.nulls(n, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*empty, pa.array(parts[i : i + 16], pa.int32()), pa.array(counts[i : i + 16], pa.binary())], names=names)

    rows = documents.select(F.col("doc_id").cast("long"), "text")
    read = rows.mapInArrow(run, "doc_id long, line int, key1 long, key2 long, n int, marks binary, part int, counts binary")
    read = via_shared_table(read, "lines")
    table = added_up(read.where("part is not null").select("part", "counts"), TABLE_BITS)
    return read.where("part is null").drop("part", "counts"), table


def _packed(entries: np.ndarray) -> bytes:
    """Byte planes, one after another: the many zero ones compress to nothing on the way."""
    return np.ascontiguousarray(entries.view(np.uint8).reshape(-1, _ENTRY.itemsize).T).tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, dtype=np.uint8).reshape(_ENTRY.itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(_ENTRY)


def _first_of(entries: np.ndarray) -> np.ndarray:
    """Entries by word, length, set and place in the corpus; of each word and set the first. Key and maps together
    tell sets apart."""
    entries = entries[np.lexsort(tuple(entries[k] for k in ("place", "line", "doc", "key", "n", "token")))]
    new = np.ones(len(entries), dtype=bool)
    new[1:] = np.logical_or.reduce([entries[k][1:] != entries[k][:-1] for k in ("token", "key", "n", "map1", "map2")])
    return entries[new]


def _prefix_blobs(documents: DataFrame, levels, owners: int, among=None) -> DataFrame:
    """owner, entries: prefix words with what the filters need, packed by the owner of the word.

    With `among`, a bit table of tokens, only those of the words that may be in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def flush() -> pa.RecordBatch:
            entries = np.concatenate([e for e, _ in parts]) if parts else np.zeros(0, dtype=_ENTRY)
            owner = np.concatenate([o for _, o in parts]) if parts else np.zeros(0, dtype=np.int32)
            order = np.argsort(owner, kind="stable")
            which, at = np.unique(owner[order], return_index=True)
            blobs = [_packed(_first_of(entries[i])) for i in np.split(order, at[1:])] if len(entries) else []
            return pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(blobs, pa.binary())], names=["owner", "entries"])

        for batch in batches:
            for doc, number, lines in _runs(batch, None if among is None else among.value):
                level = levels.value[slot(lines.words, TABLE_BITS)]
                order = lines.order(level)
                line, level = lines.line[order], level[order]
                place = np.arange(len(line)) - lines.start[line]
                n = lines.n[line]
                # A word whose slot was hit once is in no other line.
                kept = np.flatnonzero((place < n + (-PERCENT * n // 100) + 1) & (level > 0))
                words = lines.words[order[kept]]
                if among is not None:
                    some = maybe(among.value, token(words).view(np.int64))
                    kept, words = kept[some], words[some]
                line = line[kept]
                entries = np.zeros(len(line), dtype=_ENTRY)
                entries["token"], entries["place"] = token(words), np.minimum(place[kept], 255)
                entries["key"] = (lines.key() >> np.uint64(32))[line]
                entries["map1"], entries["map2"] = (m[line] for m in lines.maps())
                entries["doc"], entries["line"], entries["n"] = doc[line], number[line], lines.n[line]
                parts.append((entries, (mix(words) % np.uint64(owners)).astype(np.int32)))
                size += len(entries)
                if size > 250_000:
                    yield flush()
                    parts, size = [], 0
        yield flush()

    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "owner int, entries binary")


def _meetings(e: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of entries of one word, j shorter or equal, that pass the filters. `e` is by word and length."""
    if not len(e):
        return
    word, n, maps = e["token"].copy(), e["n"].astype(np.int64), (e["map1"].copy(), e["map2"].copy())
    # The larger of two maps folded to the smaller one's size still differs in no more bits than the sets in words.
    folds = [(0, [maps[0] ^ maps[1]]), (SMALL, maps)]
    place = np.minimum(e["place"], n - 1).astype(np.int64)
    group = np.concatenate([[0], np.cumsum(word[1:] != word[:-1])])
    least = -(-PERCENT * n // 100)
    rank = group * (int(n.max()) + 1)
    low = np.searchsorted(rank + n, rank + least)  # the word's first entry that is long enough
    count = np.arange(len(e)) - low
    bounds = np.cumsum(count)
    i0 = 0
    while i0 < len(e):
        before = bounds[i0 - 1] if i0 else 0
        i1 = max(i0 + 1, int(np.searchsorted(bounds, before + CHUNK, side="right")))
        c = count[i0:i1]
        i = np.repeat(np.arange(i0, i1), c)
        j = np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c) + np.repeat(low[i0:i1], c)
        both = n[i] + n[j]
        overlap = -(-PERCENT * both // (100 + PERCENT))
        good = np.minimum(n[i] - place[i], n[j] - place[j]) >= overlap
        i, j, spare = i[good], j[good], (both - 2 * overlap)[good]
        for least_words, fold in folds:
            good = n[j] <= least_words
            good |= sum(np.bitwise_count(m[i] ^ m[j]).astype(np.int64) for m in fold) <= spare
            i, j, spare = i[good], j[good], spare[good]
        yield i, j
        i0 = i1


def _candidates(few: int | None, only) -> callable:
    """Task body: from entries, sorted by owner, to pairs (x, y), y the earlier line, and whether both are long;
    with `few` the earliest ones of each word, and the word's token where there are more. One owner's entries are
    held at a time.

    With `only`, a bit table, just the pairs whose x may be among its lines.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs, current = [], None
        for batch in batches:
            for owner, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if blobs and owner != current:
                    yield from meet(blobs)
                    blobs = []
                current = owner
                blobs.append(_unpacked(blob.as_py()))
        if blobs:
            yield from meet(blobs)

    def meet(blobs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        e = _first_of(np.concatenate(blobs))
        doc, line, n = e["doc"].copy(), e["line"].astype(np.int64), e["n"].copy()
        for i, j in _meetings(e):
            later = (doc[i] > doc[j]) | ((doc[i] == doc[j]) & (line[i] > line[j]))
            x, y = np.where(later, i, j), np.where(later, j, i)
            if only is not None:
                asked = maybe(only.value, line_id(doc[x], line[x]))
                x, y = x[asked], y[asked]
            more = np.zeros(len(x), dtype=bool)
            if few is not None and len(x):
                order = np.lexsort((line[y], doc[y], x))
                x, y = x[order], y[order]
                first = np.flatnonzero(np.diff(x, prepend=-1))
                at = np.arange(len(x)) - np.repeat(first, np.diff(np.append(first, len(x))))
                kept = at < few
                more = np.repeat(np.diff(np.append(first, len(x))) > few, np.diff(np.append(first, len(x))))[kept]
                x, y = x[kept], y[kept]
            long = np.minimum(n[x], n[y]) > LONG
            asked_by = pa.array(e["token"][x].astype(np.int64), mask=~more)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[x]), pa.array(line[x].astype(np.int32)), pa.array(doc[y]), pa.array(line[y].astype(np.int32)), pa.array(long), asked_by],
                names=["x_doc", "x_line", "y_doc", "y_line", "long", "more"],
            )

    return run


def candidates(documents: DataFrame, levels, few: int | None = None, only=None, among=None) -> DataFrame:
    owners = 16 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blobs = _prefix_blobs(documents, levels, owners, among).repartition("owner").sortWithinPartitions("owner")
    return blobs.mapInArrow(_candidates(few, only), "x_doc long, x_line int, y_doc long, y_line int, long boolean, more long")


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs (x_doc, x_line, y_doc, y_line, x_n, y_n, x_marks, y_marks) those that the marks let match."""
    for batch in batches:
        n, m = (batch.column(i).to_numpy().astype(np.int64) for i in (4, 5))
        differ = np.zeros(len(n), dtype=np.int64)
        sides = [batch.column(i) for i in (6, 7)]
        sizes = [pc.binary_length(c).to_numpy() for c in sides]
        for a, b in np.unique(np.stack(sizes, axis=1), axis=0).tolist():
            rows = np.flatnonzero((sizes[0] == a) & (sizes[1] == b))
            maps = [np.frombuffer(b"".join(c.take(pa.array(rows)).to_pylist()), dtype=np.uint64).reshape(len(rows), -1) for c in sides]
            # The larger map folded to the smaller one's size still differs in no more bits than the sets in words.
            width = min(a, b) // 8
            maps = [np.bitwise_xor.reduce(x.reshape(len(rows), -1, width), axis=1) for x in maps]
            differ[rows] = np.bitwise_count(maps[0] ^ maps[1]).sum(axis=1)
        may = 100 * (n + m - differ) >= PERCENT * (n + m + differ)
        yield pa.RecordBatch.from_arrays(batch.columns[:4], names=batch.schema.names[:4]).filter(pa.array(may))


def plausible(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The pairs (x_doc, x_line, y_doc, y_line; long) without those of long lines that their marks, a thirtieth of the
    words, rule out. Each pair comes once if it does in `pairs`."""
    columns = ["x_doc", "x_line", "y_doc", "y_line"]
    marked = lines.where(f"n > {LONG}").select("doc_id", "line", "n", "marks")
    named = {s: marked.toDF(f"{s}_doc", f"{s}_line", f"{s}_n", f"{s}_marks") for s in "xy"}
    joined = pairs.where("long").join(named["y"], ["y_doc", "y_line"]).join(named["x"], ["x_doc", "x_line"])
    kept = joined.select(*columns, "x_n", "y_n", "x_marks", "y_marks").mapInArrow(_plausible, "x_doc long, x_line int, y_doc long, y_line int")
    return pairs.where("not long").select(*columns).unionByName(kept)


def _line_ids(batch: pa.RecordBatch) -> np.ndarray:
    """Of the first two columns, document and line."""
    return line_id(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False))


def _bits(n: int) -> int:
    """The size of a bit table of n keys: at least 16 slots a key, up to 2 ** 26 slots."""
    return min(26, max(16, (16 * n).bit_length()))


def line_words(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, line, words of the lines named in wanted (doc_id, line; stored), by a bit table and an exact join,
    stored."""
    table = documents.sparkSession.sparkContext.broadcast(seen_of(wanted, _line_ids, _bits(wanted.count())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, texts in slices(texts_of(batch.column(1))):
                doc, number, every = _split(ids[first : first + len(texts)], texts)
                some = np.flatnonzero(maybe(table.value, line_id(doc, number)))
                # Every line wanted is a text of one line.
                lines = Lines([every[i] for i in some])
                words = [lines.words[a : a + n].tobytes() for a, n in zip(lines.start, lines.n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[some], pa.int64()), pa.array(number[some].astype(np.int32)), pa.array(words, pa.binary())],
                    names=["doc_id", "line", "words"],
                )

    rows = documents.select(F.col("doc_id").cast("long"), "text")
    found = rows.mapInArrow(run, "doc_id long, line int, words binary").join(wanted, ["doc_id", "line"], "left_semi")
    return via_shared_table(found, "line-words")


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        match = []
        for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist()):
            x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            match.append(100 * shared >= PERCENT * (len(x) + len(y) - shared))
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(match, pa.bool_())], names=["x_doc", "x_line", "y_doc", "y_line", "match"])


def matched(pairs: DataFrame, documents: DataFrame) -> DataFrame:
    """x_doc, x_line of the pairs' x that match their y, stored."""
    with intermediates(documents.sparkSession):
        wanted = pairs.selectExpr("inline(array(struct(x_doc as doc_id, x_line as line), struct(y_doc as doc_id, y_line as line)))").distinct()
        words = line_words(documents, via_shared_table(wanted, "pair-lines"))
        named = {s: words.withColumnsRenamed({"doc_id": f"{s}_doc", "line": f"{s}_line", "words": f"{s}_words"}) for s in "xy"}
        joined = pairs.join(named["y"], ["y_doc", "y_line"]).join(named["x"], ["x_doc", "x_line"])
        found = joined.select("x_doc", "x_line", "y_doc", "y_line", "x_words", "y_words").mapInArrow(
            _matches, "x_doc long, x_line int, y_doc long, y_line int, match boolean"
        )
        return via_shared_table(found.where("match").select("x_doc", "x_line").distinct(), "similar-lines", outlive=True)


def copied_lines(rows: DataFrame) -> DataFrame:
    """doc_id, line of the lines (as by read_lines) whose set an earlier line has."""
    keys = ["key1", "key2", "n"]
    spark = rows.sparkSession
    with intermediates(spark):
        groups = rows.groupBy(*keys).agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("lines"))
        groups = groups.where("lines > 1").drop("lines")
        repeated = via_shared_table(rows.select("doc_id", "line", *keys).join(groups, keys), "repeated-lines", outlive=True)
    # Only in the first document one of them stays.
    own = repeated.where("doc_id = first_doc")
    first = own.groupBy(*keys).agg(F.min("line").alias("first_line"))
    later = own.join(first, keys).where("line != first_line")
    return repeated.where("doc_id != first_doc").select("doc_id", "line").unionByName(later.select("doc_id", "line"))


def removed_lines(documents: DataFrame) -> DataFrame:
    """doc_id, removed: the sorted numbers (from 0) of the lines that match an earlier line.

    Lines end at a line feed. Earlier is by doc_id, then line number; two lines match if the Jaccard of
    their sets of words (runs of other bytes than space and \\t to \\r, as they are) is 0.8 or more. A line
    is removed whether or not the earlier one is. Lines without words never match. Rows that repeat a
    doc_id are one document whose lines are numbered alike: a line goes where it goes in any of them.
    Documents with a null doc_id or without removed lines have no row.
    """
    documents, spark = documents.select("doc_id", "text"), documents.sparkSession
    rows, table = read_lines(documents)
    levels = spark.sparkContext.broadcast(rarity(table))
    copies = copied_lines(rows)
    pair = ["x_doc", "x_line", "y_doc", "y_line"]
    with intermediates(spark):
        met = via_shared_table(candidates(documents, levels, FEW), "line-candidates")
        # Lines of which more was cut off are asked again, by the words it was cut off from, if nothing matches.
        cut = via_shared_table(met.where("more is not null").select("x_doc", "x_line", "more").distinct(), "cut-lines", outlive=True)
        once = plausible(via_shared_table(met.select(*pair, "long").distinct(), "line-pairs"), rows)
        by_line = once.groupBy("x_doc", "x_line").agg(F.array_sort(F.collect_list(F.struct("y_doc", "y_line"))).alias("ys"))
        by_line = via_shared_table(by_line, "line-candidates", outlive=True)
    # First the earliest candidates of each line, then, of lines they don't match, all others.
    pairs = by_line.select("x_doc", "x_line", F.inline(F.slice("ys", 1, FIRST)))
    similar = matched(via_shared_table(pairs, "line-pairs"), documents)
    rest = by_line.where(f"size(ys) > {FIRST}").join(similar, ["x_doc", "x_line"], "left_anti")
    pairs = rest.select("x_doc", "x_line", F.inline(F.expr(f"slice(ys, {FIRST + 1}, size(ys))")))
    open_ = via_shared_table(cut.join(similar, ["x_doc", "x_line"], "left_anti"), "open-lines")
    with intermediates(spark):
        if asked := open_.count():
            only = spark.sparkContext.broadcast(seen_of(open_, _line_ids, _bits(asked)))
            among = seen_of(open_.select("more"), lambda b: b.column(0).to_numpy(zero_copy_only=False), _bits(asked))
            more = candidates(documents, levels, None, only, spark.sparkContext.broadcast(among))
            more = via_shared_table(more.join(open_, ["x_doc", "x_line"], "left_semi").select(*pair, "long").distinct(), "line-candidates")
            pairs = pairs.select(*pair).unionByName(plausible(more, rows)).distinct()
        pairs = via_shared_table(pairs.select(*pair), "line-pairs", outlive=True)
    if not pairs.isEmpty():
        similar = similar.unionByName(matched(pairs, documents))
    lines = copies.unionByName(similar.toDF("doc_id", "line"))
    return lines.groupBy("doc_id").agg(F.array_sort(F.collect_set("line")).alias("removed"))


def _cut(text: str | None, removed: list[int] | None) -> str | None:
    if text is None or removed is None:
        return text
    gone = set(removed)
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)


def drop_lines(documents: DataFrame) -> DataFrame:
    """The rows of `documents` with the removed lines cut out of their text, and removed_lines (null if none).

    Earlier lines are those of smaller doc_ids, and of the same row; rows that share a doc_id are documents
    of their own, in no fixed order. The lines left are joined by line feeds as before. Texts that are null
    or of rows with a null doc_id stay as they are. No rows are lost; an empty table gives no rows. A column
    named removed_lines is replaced; others may have any names.
    """
    rows, number = numbered(documents)
    with small_batches(documents.sparkSession), intermediates(documents.sparkSession):
        removed = via_shared_table(removed_lines(rows.select(F.col(number).alias("doc_id"), "text")), "removed-lines", outlive=True)
    name = free_name(rows, "removed_number")
    kept = [c for c in documents.columns if c.lower() != "removed_lines"]
    rows = rows.select(*kept, *([number] if number not in kept else []))
    # The lists grow with the texts, so they are dealt out with them at every size; texts are not sorted for that.
    lists = removed.withColumnRenamed("doc_id", name).withColumnRenamed("removed", "removed_lines").hint("shuffle_hash")
    joined = rows.join(lists, rows[number] == F.col(name), "left")
    joined = joined.select(*kept, F.col("removed_lines"))
    at = kept.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            text = pa.array(map(_cut, batch.column(at).to_pylist(), batch.column(len(kept)).to_pylist()), batch.column(at).type)
            yield pa.RecordBatch.from_arrays([text if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

    return joined.mapInArrow(run, joined.schema)
