"""Spelling variants against a plain search of all pairs."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest

from staffcast.llm import spelling
from tests.llm.helpers import ODD_TEXTS, frame, lower


def counted(rows, one_in):
    n = Counter()
    for i, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = lower(word)
            h = crc32(f"{'' if i is None else i}:{word}".encode())
            if one_in and h % one_in == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += 1
    return n


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected(n):
    near = {a: [b for b in n if one_edit(a, b)] for a in n}
    form = {}
    for a in n:
        best = min(near[a], key=lambda b: (-n[b], b), default=None)
        form[a] = best if best is not None and n[best] >= 2 * n[a] else None
    out = []
    for a in n:
        root = a
        while form[root]:
            root = form[root]
        out.append((a, form[a], root, n[a], len(near[a]), n[form[a]] if form[a] else None))
    return sorted(out)


def got(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


@pytest.mark.parametrize("hot,letters", [(4096, "abÀ"), (3, "ab"), (4096, "abcdefgÿ")])
def test_forms_equal_a_plain_search(spark, monkeypatch, hot, letters):
    monkeypatch.setattr(spelling, "HOT_ROWS", hot)
    r = random.Random(hot)
    n = {"".join(r.choice(letters) for _ in range(r.randrange(5, 9))): r.choice([3, 3, 4, 6, 8, 16, 40]) for _ in range(150)}
    n |= {"aaaaa": 5, "aaaaaa": 10, "aaaaaaa": 20, "z" * 5000: 4, "z" * 5001: 9}
    words = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    assert got(spelling.spelling_forms(words)) == expected(n)
    pairs = [(r.a, r.b) for r in spelling.near_words(words).collect()]
    assert len(pairs) == len({frozenset(p) for p in pairs})


def test_words_of_texts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE_BYTES", 50)
    monkeypatch.setattr(spelling, "HELD_WORDS", 20)
    r = random.Random(5)
    base = ["receive", "recieve", "Colour", "color", "naïveté", "NAÏVETÉ", "café", "x×y÷zab", "Œuvre", "ābcdefg", "Überall", "ohne中文worte", "don't", "ab12cdefg"]
    texts = [r.choice([" ", "-", ", ", "\n"]).join(r.choice(base) for _ in range(r.randrange(60))) for _ in range(50)] + ODD_TEXTS
    for one_in in (None, 3):
        want = {w: c for w, c in counted(enumerate(texts), one_in).items() if len(w) >= 5 and c >= 3}
        words = spelling.word_counts(frame(spark, texts), "doc_id", "text", drop_one_in=one_in)
        assert {x.word: x.n for x in words.collect()} == want


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "seldom heard"), (1, "seldom heard"), (1, "seldom heard"), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.word: x.n for x in spelling.word_counts(docs, "doc_id", "text").collect()} == {"seldom": 3, "heard": 3}
    want = {w: c for w, c in counted(rows, 2).items() if len(w) >= 5 and c >= 3}
    assert {x.word: x.n for x in spelling.word_counts(docs, "doc_id", "text", drop_one_in=2).collect()} == want


def test_empty_table_and_bad_factor(spark):
    assert got(spelling.spelling_forms(spelling.word_counts(frame(spark, [""]), "doc_id", "text"))) == []
    with pytest.raises(ValueError):
        spelling.spelling_forms(spark.createDataFrame([("a", 1)], "word string, n long"), times=1)
