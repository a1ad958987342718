"""Token ids, pieces and sequences."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from staffcast.llm import packing
from staffcast.llm.common import text_column
from tests.llm.helpers import ODD_TEXTS, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_ids_are_those_of_the_whole_text():
    whole = Tokenizer.from_file(PATH)
    r = random.Random(1)
    parts = ["'s", "'", "s", "t", "'LL", "<|endoftext|>", "<|EndOfText|>", "<|", "é", "É", "—", "-", "!", "9", " ", " ", "\n", "\x1c", "\u00a0", "İ", "ſ", "Σ", "ς", "中", "\u0301", "_", "the", ",", "%%%", "The"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(25))) for _ in range(3000)] + [t or "" for t in ODD_TEXTS]
    with open(PATH) as f:
        ids, begin = packing.WordTokens(f.read())(*text_column(pa.array(texts)))
    for i, t in enumerate(texts):
        assert ids[begin[i] : begin[i + 1]].tolist() == [*whole.encode(t, add_special_tokens=False).ids, 0], t[:60]


def placed(rows, capacity):
    """Sequences have no gaps, no overlaps and no more than the capacity."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return by


def test_documents_become_packed_pieces(spark):
    texts = [*ODD_TEXTS, "many words here " * 3000, "short", "short"]
    parts = packing.pieces(frame(spark, texts), "text", ["doc_id", "row"], PATH, capacity=64, tokens=True)
    rows = packing.pack(parts, "length", 64).collect()
    whole = Tokenizer.from_file(PATH)
    got = {(r.kept.doc_id, r.piece): r for r in rows}
    assert len(got) == len(rows)
    for i, t in enumerate(texts):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        for p in range(-(-len(ids) // 64)):
            own = ids[64 * p : 64 * p + 64]
            r = got.pop((i, p))
            assert (r.start, r.length, r.ids) == (64 * p, len(own), own)
            assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
    assert not got
    placed(rows, 64)
    assert packing.pack(parts.limit(0), "length", 64).count() == 0


@pytest.mark.parametrize("shard", [1 << 14, 100])
def test_few_sequences(spark, monkeypatch, shard):
    monkeypatch.setattr(packing, "SHARD_PIECES", shard)
    rows = spark.range(2000).select((1 + F.pmod(F.xxhash64("id"), F.lit(100))).alias("length"), F.lit("x").alias("number"), F.lit(0).alias("shard"))
    out = packing.pack(rows, "length", 100).collect()
    sequences = placed(out, 100)
    least = -(-sum(r.length for r in out) // 100)
    assert len(out) == 2000 and len(sequences) <= (1.02 if shard > 100 else 1.15) * least


def test_place_with_the_smallest_sum_of_squares():
    def squares(gaps, capacity):
        return sum(gaps.count(g) ** 2 for g in set(gaps) if g)

    sizes = sorted(np.random.default_rng(3).integers(1, 21, 120).tolist(), reverse=True)
    sequence, offset = packing.sum_of_squares(np.array(sizes), 20)
    gaps = []
    for size, s, o in zip(sizes, sequence.tolist(), offset.tolist(), strict=True):
        fits = [k for k, g in enumerate(gaps) if g >= size]
        if fits:
            cost = lambda k: squares(gaps[:k] + [gaps[k] - size] + gaps[k + 1 :], 20)  # noqa: E731, B023
            assert cost(s) == min(map(cost, fits)) and o == 20 - gaps[s]
            gaps[s] -= size
        else:
            assert s == len(gaps) and o == 0
            gaps.append(20 - size)


def test_forgotten_units_are_encoded_again(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_UNITS", 20)
    whole = Tokenizer.from_file(PATH)
    with open(PATH) as f:
        encode = packing.WordTokens(f.read())
    for k in range(6):
        texts = [f"word{k} other{i} again {i % 3} x{i * k}" for i in range(15)]
        ids, begin = encode(*text_column(pa.array(texts)))
        assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:], strict=False)] == [[*whole.encode(t, add_special_tokens=False).ids, 0] for t in texts]
        assert len(encode.begin) == len(encode.known) + 2
