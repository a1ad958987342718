"""Words that a polynomial hash takes for the same."""

import re

import numpy as np
import pytest

from staffcast.llm import count_min, packing, positional
from staffcast.llm.common import PlacedHash
from tests.llm.helpers import frame, repeated


def thue_morse(n):
    """A word of two letters and its complement: their polynomials agree modulo 2**64 for any odd base if n is large."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def spans(words):
    raw = [w.encode() for w in words]
    sizes = np.array([len(w) for w in raw])
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum(sizes) - sizes, np.cumsum(sizes)


@pytest.mark.parametrize("n", [256, 1024, 4096])
@pytest.mark.parametrize("hash_", [count_min.WORDS, packing.WORDS, positional.WORDS, PlacedHash(9)])
def test_words_and_their_complements_differ(n, hash_):
    first, second = hash_(*spans(thue_morse(n)))
    assert first != second


def test_hashes_depend_on_the_word_alone():
    words = [f"w{i}" for i in range(20_000)] + ["a", "aa", "aaa", "ab", "ba", "é", "\x00", "\x00\x00"]
    once, again = PlacedHash(1)(*spans(words)), PlacedHash(1)(*spans(words[::-1]))[::-1]
    assert (once == again).all() and len(np.unique(once)) == len(words)
    assert (once != PlacedHash(2)(*spans(words))).all()
    assert not len(PlacedHash(1)(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)))


@pytest.mark.parametrize("n", [256, 4096])
def test_operators_tell_them_apart(spark, n):
    one, other = thue_morse(n)
    tail = " ".join(f"t{i}" for i in range(40))
    texts = [f"{one} {tail[:100]}", f"{other} {tail[:100]}", " ".join([one] + [f"x{i}" for i in range(34)]), " ".join([other] + [f"x{i}" for i in range(34)])]
    got = {r.id: r.n_removed for r in count_min.remove_repeats(frame(spark, texts), "doc_id", "text", texts=False).collect()}
    assert got == {i: len(gone) for i, (_, gone) in enumerate(repeated(texts))}
    hashes, heads = positional.hashed_words(*document_bytes([one, other]))
    assert len(set(hashes.tolist())) == 2 and re.fullmatch("[ab]+", one)


def document_bytes(texts):
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    return np.cumsum([0] + [len(t) for t in texts]), raw
