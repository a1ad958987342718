"""Repeated windows and near-duplicates against plain versions."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from staffcast.llm import components, count_min, simhash
from tests.llm.helpers import ODD_TEXTS, fingerprint, frame, groups, repeated


def passages(seed, n):
    """Texts that share passages of many lengths, with few different words so that keys repeat too."""
    r = random.Random(seed)
    shared = [" ".join(r.choice("abcd") + str(r.randrange(9)) for _ in range(r.randrange(30, 90))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [" ".join(r.choice(["the", "of", "and", "zu", "é"]) + str(r.randrange(40)) for _ in range(r.randrange(0, 60)))]
        parts += [r.choice(shared) for _ in range(r.randrange(0, 3))]
        r.shuffle(parts)
        out.append(r.choice([" ", "\n", "  \t"]).join(parts))
    return out


@pytest.mark.parametrize("flush", [1 << 21, 50])
def test_windows_that_repeat_go(spark, monkeypatch, flush):
    monkeypatch.setattr(count_min, "FLUSH", flush)
    texts = passages(1, 60) + ODD_TEXTS + ["und " * 80, "und " * 34, "und " * 35, "und " * 36] + passages(1, 3)
    got = {r.id: r for r in count_min.remove_repeats(frame(spark, texts), "doc_id", "text").collect()}
    assert len(got) == len(texts)
    for i, (own, gone) in enumerate(repeated(texts)):
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept) == (len(own), len(gone), kept), i
        assert got[i].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_a_full_sketch_loses_nothing(spark, monkeypatch):
    """With eight cells every count is too high; the exact pass still decides."""
    texts = passages(2, 40)
    docs = count_min.numbered(frame(spark, texts), "number").select("number", "text")
    assert all(row.any() for row in count_min.sketch_of(docs))
    monkeypatch.setattr(count_min, "sketch_of", lambda docs: [np.full(8, 255, np.uint8)] * count_min.DEPTH)
    got = {r.id: r.n_removed for r in count_min.remove_repeats(frame(spark, texts), "doc_id", "text", texts=False).collect()}
    assert got == {i: len(gone) for i, (_, gone) in enumerate(repeated(texts))}


def test_sketch_never_counts_too_low(spark):
    keys = np.random.default_rng(0).integers(0, 300, 2000).astype(np.uint64)
    merged = [np.zeros(count_min.BLOCK // 8, np.uint8) for _ in range(count_min.DEPTH)]
    for i, cell in enumerate(count_min.cells(keys, count_min.BLOCK)):
        value, n = np.unique(cell, return_counts=True)
        for v in value[n > 1]:
            merged[i][v >> 3] |= 1 << (v & 7)
    value, n = np.unique(keys, return_counts=True)
    assert count_min.repeated(value[n > 1], merged).all()
    assert not count_min.repeated(np.arange(10**6, 10**6 + 100, dtype=np.uint64), merged).any()


def test_gaps_round_trip():
    for values in ([0], [254], [255], [0, 1, 255, 510, 511, 100_000], []):
        assert count_min._from_gaps(count_min._gaps(np.array(values, np.int64))).tolist() == values


def test_no_documents(spark):
    empty = frame(spark, ["a"]).limit(0)
    assert count_min.remove_repeats(empty, "doc_id", "text").count() == 0
    assert simhash.near_duplicates(empty, "doc_id", "text").count() == 0


def near_copies(seed, n):
    r = random.Random(seed)
    base = [[f"w{r.randrange(500)}" for _ in range(r.randrange(3, 400))] for _ in range(n)]
    out = []
    for own in base:
        for _ in range(r.randrange(1, 6)):
            copy = list(own)
            for _ in range(r.randrange(0, 3)):
                copy[r.randrange(len(copy))] = "changed"
            out.append(" ".join(copy) if r.random() < 0.5 else "\n".join(copy).upper())
    return out


@pytest.mark.parametrize("hot", [1 << 12, 3])
def test_components_of_close_fingerprints(spark, monkeypatch, hot):
    """Also with every bucket of more than three rows compared tile by tile."""
    monkeypatch.setattr(simhash, "HOT_ROWS", hot)
    monkeypatch.setattr(simhash, "TILE_ROWS", 2 if hot == 3 else 1 << 11)
    texts = near_copies(3, 40) + ODD_TEXTS + ["", None]
    prints = [fingerprint(t) for t in texts]
    want = groups(list(range(len(texts))), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    found = simhash.near_duplicates(frame(spark, texts), "doc_id", "text").collect()
    assert {r.id: r.fp & (1 << 64) - 1 for r in found} == dict(enumerate(prints))
    assert {r.id: r.component_id for r in found} == want
    firsts = {r.row: r.id for r in found}
    assert all(firsts[r.first_row] == r.component_id for r in found) and len(found) == len(texts)


def test_repeated_and_missing_ids(spark):
    docs = spark.createDataFrame([(None, "same text"), (7, "same text"), (7, "same text"), (None, "other words here now")], "doc_id long, text string")
    found = simhash.near_duplicates(docs, "doc_id", "text").collect()
    assert sorted((r.id is None, r.component_id is None) for r in found) == [(False, False), (False, False), (True, False), (True, True)]
    assert len({r.first_row for r in found}) == 2


def test_chains_and_stars_become_one_component(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1200)] + [(5000 - i, 5000) for i in range(1, 50)] + [(9, 9)]
    df = spark.createDataFrame(links, "a long, b long").withColumn("a", F.col("a"))
    found = {r.node: r.root for r in components.roots(df).collect()}
    assert found == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1200)}, **{i: 4951 for i in range(4951, 5001)}}
    assert components.roots(df.where("a = b")) is None


def test_blocks_share_whole_runs():
    """Any four bits leave two of six blocks untouched."""
    r = random.Random(5)
    masks = [m & (1 << 64) - 1 for m in simhash.masks(4, 6)]
    for _ in range(500):
        change = sum(1 << b for b in r.sample(range(64), 4))
        assert any(change & m == 0 for m in masks)
