import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from funnelspark.llm import alignment
from funnelspark.llm.alignment import align_documents, aligner, bitmaps, index, pair_counts
from funnelspark.llm.packing import _BYTE_OF

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, row long, pair string"
TEXTS = [
    None, "", " ", "  ", "a ", "a  ", "\n", "a\n b", "a\n\n  b", " x　 y", "<s> </s> <|endoftext|> [INST] x", "don't  stop\t\tnow ",
    "你好世界 你好", "é ﬁne ▁ bar", "▁", "\x1c a\x1cb \x85 c", "\U0001f600 ok \U0001f600", "x" * 5000, "the cat " * 4000, "the cat sat", "12 345 6.7",
]


def slow(texts):
    """The whole text through each tokenizer, every pair of tokens that end together."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    shown = {v: k for k, v in a.get_vocab(True).items()}
    out, counts = [], Counter()
    for t in texts:
        ids_a = a.encode(f" {t}", add_special_tokens=False).ids if t else []
        ids_b = b.encode(t) if t else []
        bytes_a = [bytes(_BYTE_OF[c] for c in shown[i]) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if b"".join(bytes_a) != f" {t or ''}".encode() or b"".join(bytes_b) != f" {t or ''}".encode():
            ids_a = ids_b = bytes_a = bytes_b = []
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        links = [(i, j) for i, e in enumerate(ends_a) for j in ([ends_b.index(e)] if e in set(ends_b) else [])]
        groups, last = [], (0, 0)
        for i, j in links:
            groups.append(",".join(map(str, ids_a[last[0] : i + 1])) + "|" + ",".join(map(str, ids_b[last[1] : j + 1])))
            last = (i + 1, j + 1)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        pairs = [(ids_a[i], ids_b[j]) for i, j in links]
        counts.update(pairs)
        out.append((len(ids_a), len(ids_b), len(groups), pairs, digest))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    rows = [(x, y, n, len(p), sum(counts[q] == best[q[1]] for q in p), sum(counts[q] for q in p), d) for x, y, n, p, d in out]
    return rows, counts, out


def test_against_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(alignment, "HELD", 300)
    monkeypatch.setattr(alignment, "RUN", 40)
    texts = [t for t in TEXTS if t is None or len(t) < 6000] + TEXTS[4:10]
    docs = spark.createDataFrame([(i % 20 or None, t, i, "x") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = align_documents(docs, A, B)
    expected, _, _ = slow(texts)
    assert sorted(map(str, got.collect())) == sorted(
        str(r) for r in spark.createDataFrame([(i % 20 or None, *e) for i, e in enumerate(expected)], got.schema).collect()
    )


def test_pair_counts(spark):
    texts = [t for t in TEXTS if t is None or len(t) < 6000]
    indexed = index(spark.createDataFrame([(i, t, i, "") for i, t in enumerate(texts)], SCHEMA).repartition(2), A, B)
    _, counts, out = slow(texts)
    documents = Counter(p for *_, pairs, _ in out for p in set(pairs))
    got = {(r.a, r.b): (r.documents, r.links) for r in pair_counts(indexed, aligner(A, B).width).collect()}
    assert got == {p: (documents[p], n) for p, n in counts.items()}


def test_no_rows(spark):
    assert align_documents(spark.createDataFrame([], SCHEMA), A, B).count() == 0


@pytest.mark.parametrize("documents", [40, 8000])
def test_bitmaps_hold_all(documents):
    """Both forms of bitmap, and multiplicities over one."""
    rng = np.random.default_rng(1)
    pair, place = np.minimum(rng.geometric(0.3, 60_000), 40), rng.integers(0, documents, 60_000)
    back = Counter()
    for pairs, plane, offsets, data in bitmaps(pair, place):
        for p, a, b in zip(pairs.tolist(), offsets[:-1], offsets[1:]):
            some = data[a:b]
            places = np.flatnonzero(np.unpackbits(some)) if b - a == alignment.BITMAP else some.copy().view("<u2")
            for x in places.tolist():
                back[p, x] += 1 if plane < 0 else 1 << plane
    assert back == Counter(zip(pair.tolist(), place.tolist()))


def test_random_texts():
    rng = np.random.default_rng(2)
    letters = list(" \n\t\x1c\x85 　ab'sT1.,你é\U0001f600▁") + ["  ", " the", "ing", "<s>", "'s"]
    texts = ["".join(rng.choice(letters, rng.integers(1, 25))) for _ in range(3000)]
    counts, digests, text, pair = aligner(A, B).align(texts)
    rows, _, out = slow(texts)
    assert counts.tolist() == [[x, y, n] for x, y, n, *_ in rows] and digests == [r[-1] for r in rows]
    assert pair.tolist() == [x * aligner(A, B).width + y for *_, pairs, _ in out for x, y in pairs]
