"""Licence scans: phrases against a plain search, templates with names filled in, words moved and parts missing."""

import random

import numpy as np
import pytest

from staffcast.llm import licenses
from staffcast.llm.common import Vocabulary
from tests.llm.helpers import ODD_TEXTS, frame, plain_words

BY_LABEL = {t.label: t for t in licenses.TEMPLATES}
FILLER = "the rain fell on the old town and nobody in the market knew which way the river had gone that year".split()


def prose(r, n):
    return " ".join(r.choice(FILLER) for _ in range(n))


def scanned(spark, texts):
    rows = licenses.scan_licenses(frame(spark, texts), "text").select("kept.doc_id", "n_words", "places").collect()
    return {r.doc_id: (r.n_words, [tuple(p) for p in r.places]) for r in rows}


def test_phrases_equal_a_plain_search(spark):
    r = random.Random(2)
    parts = ["GNU General Public License", "gnu general", "Apache-License", "apache", "CC BY", "cc by-nc", "cc", "MIT\nlicense", "mit licensed", "é", "by", "license"]
    texts = [" ".join(r.choice(parts) for _ in range(r.randrange(40))) for _ in range(80)] + ODD_TEXTS
    got = scanned(spark, texts)
    for i, text in enumerate(texts):
        words = plain_words(text)
        want = sorted(
            (k, label)
            for phrase, label in licenses.PHRASES
            for k in range(len(words))
            if words[k : k + len(phrase.split())] == phrase.split()
        )
        n_words, places = got[i]
        assert n_words == len(words)
        assert sorted((p[1], p[0]) for p in places if p[4] == "phrase") == want, text


def labels(places, kind="template"):
    return {p[0] for p in places if p[4] == kind}


def test_whole_notices_between_prose(spark):
    r = random.Random(7)
    texts = [f"{prose(r, 30)}\n/* {t.text.upper()} */ {prose(r, 40)}" for t in licenses.TEMPLATES] + [prose(r, 200) for _ in range(60)]
    got = scanned(spark, texts)
    for i, t in enumerate(licenses.TEMPLATES):
        [place] = [p for p in got[i][1] if p[4] == "template" and p[0] == t.label]
        assert place[1] == 30 and place[2] == 30 + len(plain_words(t.text)) and place[3] == pytest.approx(1.0)
        assert labels(got[i][1]) == {t.label}
    assert not any(got[i][1] for i in range(len(licenses.TEMPLATES), len(texts)))


def test_changed_and_broken_notices(spark):
    r = random.Random(8)
    mit, gpl, bsd = (BY_LABEL[x].text for x in ("mit", "gpl", "bsd"))
    words = mit.split()
    texts = [
        mit.replace("obtaining a copy", "and any legal body obtaining one or another copy"),  # moved by some words
        " ".join(words[: len(words) // 2]),  # half of it
        " ".join(r.sample(words, len(words))),  # all its words in no order
        mit.replace("free of charge", "at no charge"),  # a mandatory phrase is missing
        f"{mit} {prose(r, 25)} {bsd}",  # two notices
        f"{gpl} {prose(r, 3)} {gpl}",  # one twice
        "// " + "\n// ".join(mit[k : k + 60] for k in range(0, 60, 60)),
    ] + [prose(r, 100) for _ in range(100)]
    got = scanned(spark, texts)
    assert labels(got[0][1]) == {"mit"}
    assert labels(got[1][1]) == labels(got[2][1]) == labels(got[3][1]) == set()
    assert "mit" in labels(got[3][1], "near")
    assert labels(got[4][1]) == {"mit", "bsd"}
    assert [p[0] for p in got[5][1] if p[4] == "template"] == ["gpl", "gpl"]


def test_rare_words_look_a_template_up():
    """The index is asked with the rarest words a file has, whatever its commoner words would say."""
    index = licenses.LicenseIndex(licenses.TEMPLATES, licenses.PHRASES)
    mit = index.labels.index("mit")
    idf = np.ones(len(index.vocabulary.words))
    text = index.texts[mit]
    [(start, end, share)] = index.align(np.concatenate([np.full(50, -1, np.int32), text]), mit, idf)
    assert (start, end, share) == (50, 50 + len(text), 1.0)
    assert index.align(np.full(10, -1, np.int32), mit, idf) == []


def test_vocabulary_compares_bytes():
    """Two different words that any polynomial hash modulo 2**64 confuses."""
    word = "a"
    while len(word) < 2048:
        word += word.translate({97: 98, 98: 97})
    other = word.translate({97: 98, 98: 97})
    words = Vocabulary([word.encode(), b"the"])
    raw = np.frombuffer(f"{other} the {word}".encode(), np.uint8)
    assert words.find(raw, np.array([0, 2049, 2053]), np.array([2048, 2052, 4101])).tolist() == [-1, words.number(b"the"), words.number(word.encode())]


def test_empty_table_and_no_templates(spark):
    docs = frame(spark, ["mit license", None])
    assert licenses.scan_licenses(docs.limit(0), "text").count() == 0
    rows = licenses.scan_licenses(docs, "text", templates=()).collect()
    assert sorted(len(r.places) for r in rows) == [0, 1]
    assert licenses.scan_licenses(docs.select("text"), "text", (), ()).count() == 2


def test_very_many_places(spark):
    [(_, places)] = scanned(spark, ["MIT License, " * 20_000 + BY_LABEL["mit"].text]).values()
    assert sum(p[4] == "phrase" for p in places) == 20_000 and labels(places) == {"mit"}
