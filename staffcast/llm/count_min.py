"""Exact removal of repeated word windows, with a count-min sketch that keeps most windows out of the shuffle."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffcast.llm.common import UNSPACED, PlacedHash, Powers, chunks, expand, mix, numbered, read_table, run_hashes, word_spans
from staffcast.staging import stage

WINDOW = 35
KEY_WORDS = 8  # a window is counted by the least hash of its runs of so many words
DEPTH = 2  # rows of the sketch
MOST_CELLS = 1 << 29  # cells in a row at most; tasks then hold 2 * 64 MB
BLOCK = 1 << 20  # cells that merge as one unit
FLUSH = 1 << 21  # windows, or keys, that a task gathers before it writes

WORDS, KEYS, WHOLE = PlacedHash(1), Powers(0x9E3779B97F4A7C15), Powers(0xC2B2AE3D27D4EB4F)

RUNS = pa.schema([("key", pa.int64()), ("row", pa.int64()), ("start", pa.int32()), ("held", pa.int32()), ("known", pa.int32()), ("hashes", pa.binary())])
RUNS_SQL = "key long, row long, start int, held int, known int, hashes binary"


def first_minima(values: np.ndarray, span: int) -> np.ndarray:
    """Place of the first least value in each run of ``span`` values."""
    place, size = np.arange(len(values)), 1
    while size < span:
        shift = min(size, span - size)
        a, b = place[:-shift], place[shift:]
        place = np.where(values[b] < values[a], b, a)
        size += shift
    return place


def windows(at: np.ndarray, raw: np.ndarray, window: int = WINDOW, key_words: int = KEY_WORDS):
    """All windows of a piece in runs that share a key: (key, document, start of the run, length), hashes of all windows.

    The key is the least hash of ``key_words`` consecutive words in the window, at its first place. Equal windows
    have equal keys at different places, so the number of places with a key is at least that of equal windows.
    """
    starts, ends, first = word_spans(at, raw, UNSPACED)
    none = np.zeros(0, np.int64)
    counts = np.maximum(np.diff(first) - window + 1, 0)
    heads = expand(first[:-1], counts)
    if not len(heads):
        return none.astype(np.uint64), none, none, none, none.astype(np.uint64)
    hashes = WORDS(raw, starts, ends)
    whole = np.arange(len(hashes) - key_words + 1)
    keys = run_hashes(hashes, whole, whole + key_words, KEYS)
    place = first_minima(keys, window - key_words + 1)[heads]
    document = np.repeat(np.arange(len(counts)), counts)
    new = np.ones(len(heads), bool)
    new[1:] = (place[1:] != place[:-1]) | (document[1:] != document[:-1])
    begin = np.flatnonzero(new)
    length = np.diff(begin, append=len(heads))
    start = heads[begin] - first[document[begin]]
    return keys[place[begin]], document[begin], start, length, run_hashes(hashes, heads, heads + window, WHOLE)


def cells(keys: np.ndarray, size: int) -> list[np.ndarray]:
    """The cell of each key in each row of the sketch."""
    return [(mix(keys + np.uint64(0x632BE59BD9B4E019 * (i + 1) & (1 << 64) - 1)) & np.uint64(size - 1)).astype(np.int64) for i in range(DEPTH)]


def _gaps(sorted_cells: np.ndarray) -> bytes:
    """Ascending numbers as gaps of one byte each; 255 says that the gap goes on."""
    more, rest = np.divmod(np.diff(sorted_cells, prepend=0), 255)
    out = np.full(int((more + 1).sum()), 255, np.uint8)
    out[np.cumsum(more + 1) - 1] = rest
    return out.tobytes()


def _from_gaps(data: bytes) -> np.ndarray:
    gaps = np.frombuffer(data, np.uint8)
    return np.cumsum(gaps, dtype=np.int64)[gaps < 255]


def _partial_sketches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The sketch of some MB of text: cells hit once and more than once, by block."""

    def sketch(keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for i, cell in enumerate(cells(np.concatenate(keys), size)):
            cell, count = np.unique(cell, return_counts=True)
            cuts = np.flatnonzero(np.diff(cell // BLOCK)) + 1
            for own, n in zip(np.split(cell, cuts), np.split(count, cuts), strict=True):
                block, own = int(own[0]) // BLOCK, own % BLOCK
                yield pa.RecordBatch.from_pydict(
                    {"depth": pa.array([i], pa.int32()), "block": pa.array([block], pa.int32()), "once": [_gaps(own[n == 1])], "more": [_gaps(own[n > 1])]}
                )

    held, total = [], 0
    for batch in batches:
        for _, _, at, raw in chunks(batch.column("text")):
            keys = windows(at, raw)[0]
            if len(keys):
                held.append(keys)
                total += len(keys)
            if total >= FLUSH:
                yield from sketch(held)
                held, total = [], 0
    if held:
        yield from sketch(held)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells that all partial sketches together hit more than once; rows come sorted by depth and block."""
    unit, once, more = None, None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"depth": pa.array([unit[0]], pa.int32()), "block": pa.array([unit[1]], pa.int32()), "cells": [np.packbits(more, bitorder="little").tobytes()]})

    for batch in batches:
        for row in batch.to_pylist():
            if (row["depth"], row["block"]) != unit:
                if unit is not None:
                    yield done()
                unit, once, more = (row["depth"], row["block"]), np.zeros(BLOCK, bool), np.zeros(BLOCK, bool)
            hit, again = _from_gaps(row["once"]), _from_gaps(row["more"])
            more[again] = True
            more[hit[once[hit]]] = True
            once[hit] = True
            once[again] = True
    if unit is not None:
        yield done()


def repeated(keys: np.ndarray, sketch: list[np.ndarray]) -> np.ndarray:
    """Whether the smallest of a key's counts is over one. ``sketch``: bits of the cells hit more than once, by row."""
    out = np.ones(len(keys), bool)
    for row, cell in zip(sketch, cells(keys, 8 * len(sketch[0])), strict=True):
        out &= (row[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
    return out


def settle(key: np.ndarray, held: np.ndarray, known: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of runs with equal keys and hashes become known as repeated; of each one stays held, to tell others.

    ``held`` has a bit for each window of a run whose hash is in ``hashes`` (run after run, lowest bit first),
    ``known`` for each known to be repeated. Returns both, and the hashes that are left.
    """
    bits = (held[:, None] >> np.arange(32)) & 1
    run, bit = np.nonzero(bits)
    order = np.lexsort((hashes, key[run]))
    k, h = key[run][order], hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (h[1:] != h[:-1])
    heads = np.flatnonzero(new)
    size = np.diff(heads, append=len(order))
    told = (known[run[order]] >> bit[order]) & 1
    group = np.cumsum(new) - 1
    repeated = (size > 1) | (np.add.reduceat(told, heads) > 0) if len(heads) else np.zeros(0, bool)
    known = known.copy()
    np.bitwise_or.at(known, run[order], np.where(repeated[group], 1 << bit[order], 0))
    stays = np.zeros(len(order), bool)
    stays[order] = new
    held = np.zeros(len(held), np.int64)
    np.bitwise_or.at(held, run[stays], 1 << bit[stays])
    return held, known, hashes[stays]


def _run_batch(key, row, start, held, known, hashes) -> pa.RecordBatch:
    counts = np.bitwise_count(held.astype(np.uint64)).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(counts * 8)])
    data = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(hashes.astype("<u8").tobytes())])
    # Nothing is asked of a run that holds no hash; its key is only where it goes.
    key = np.where(held == 0, mix(row.astype(np.uint64) + start.astype(np.uint64)), key)
    columns = (pa.array(key.view(np.int64)), pa.array(row), *[pa.array(c.astype(np.int32)) for c in (start, held, known)], data.cast(pa.binary()))
    return pa.RecordBatch.from_arrays(list(columns), schema=RUNS)


def _candidates(batches: Iterator[pa.RecordBatch], sketch) -> Iterator[pa.RecordBatch]:
    """Runs of windows estimated to be repeated, settled among some MB of text."""

    def flush(parts) -> pa.RecordBatch:
        key, row, start, length, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
        held, known, hashes = settle(key, (1 << length) - 1, np.zeros(len(key), np.int64), hashes)
        some = (held | known) != 0
        return _run_batch(key[some], row[some], start[some], held[some], known[some], hashes)

    parts, total = [], 0
    for batch in batches:
        rows = np.asarray(batch.column("row"))
        for first, _, at, raw in chunks(batch.column("text")):
            key, document, start, length, hashes = windows(at, raw)
            kept = repeated(key, sketch.value)
            hashes = hashes[np.repeat(kept, length)]
            parts.append((key[kept], rows[first + document[kept]], start[kept], length[kept], hashes))
            total += len(hashes)
            if total >= FLUSH:
                yield flush(parts)
                parts, total = [], 0
    if parts:
        yield flush(parts)


def _settle_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of each run; rows come sorted by key.

    A key that goes on in the next batch keeps one hash of each different window; what is known is written at once.
    """

    def told(row, start, known) -> pa.RecordBatch:
        some = known != 0
        return pa.RecordBatch.from_arrays([pa.array(row[some]), pa.array(start[some].astype(np.int32)), pa.array(known[some].astype(np.int32))], names=["row", "start", "known"])

    rest = None
    for batch in batches:
        key, row, start, held, known = (np.asarray(batch.column(c)).astype(np.int64) for c in ("key", "row", "start", "held", "known"))
        hashes = np.frombuffer(b"".join(batch.column("hashes").to_pylist()), "<u8")
        if rest is not None:
            key, row, start, held, known, hashes = (np.concatenate(x) for x in zip(rest, (key, row, start, held, known, hashes), strict=True))
        held, known, hashes = settle(key, held, known, hashes)
        last = (key == key[-1]) & (held != 0)
        yield told(row[~last], start[~last], known[~last])
        counts = np.bitwise_count(held.astype(np.uint64)).astype(np.int64)
        rest = (key[last], row[last], start[last], held[last], known[last], hashes[np.repeat(last, counts)])
    if rest is not None:
        yield told(rest[1], rest[2], rest[4])


def _removed(batches: Iterator[pa.RecordBatch], window: int, texts: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("id")
        for first, end, at, raw in chunks(batch.column("text")):
            starts, ends, heads = word_spans(at, raw, UNSPACED)
            lists = batch.column("runs").slice(first, end - first)
            counts = np.diff(np.asarray(lists.offsets)) * np.asarray(lists.is_valid())
            flat = lists.flatten()
            begin = np.asarray(flat.field("start")).astype(np.int64) + np.repeat(heads[:-1], counts)
            run, bit = np.nonzero((np.asarray(flat.field("known")).astype(np.int64)[:, None] >> np.arange(32)) & 1)
            change = np.zeros(len(starts) + 1, np.int64)
            np.add.at(change, begin[run] + bit, 1)
            np.add.at(change, begin[run] + bit + window, -1)
            kept = np.cumsum(change)[:-1] == 0
            lengths = (ends - starts + 1)[kept]
            text = raw[np.minimum(expand(starts[kept], lengths), max(0, len(raw) - 1))].copy()
            to = np.cumsum(lengths)
            text[to - 1] = 0x20
            cuts = np.concatenate([[0], to])[np.concatenate([[0], np.cumsum(kept)])[heads]]
            text = text.tobytes()
            pieces = [text[a : max(a, b - 1)] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            words = np.diff(heads)
            gone = words - np.diff(np.concatenate([[0], np.cumsum(kept)])[heads])
            columns = [ids.slice(first, end - first), pa.array(words), pa.array(gone), pa.array([hashlib.sha256(p).hexdigest() for p in pieces])]
            names = ["id", "n_words", "n_removed", "kept_sha256"]
            if texts:
                columns.append(pa.array([p.decode() for p in pieces], pa.string()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names=names)


def sketch_of(docs: DataFrame) -> list[np.ndarray]:
    """The merged sketch of all window keys of ``docs`` (``text``). Its size follows the text up to ``MOST_CELLS``."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # About one key in 80 bytes of text, and four cells for each.
    cell_count = max(BLOCK, min(MOST_CELLS, 1 << int(size // 20).bit_length()))
    parts = docs.select("text").mapInArrow(lambda b: _partial_sketches(b, cell_count), "depth int, block int, once binary, more binary")
    merged = parts.repartition("depth", "block").sortWithinPartitions("depth", "block").mapInArrow(_merge, "depth int, block int, cells binary")
    rows = [np.zeros(cell_count // 8, np.uint8) for _ in range(DEPTH)]
    for b in merged.toArrow().to_pylist():
        at = b["block"] * (BLOCK // 8)
        rows[b["depth"]][at : at + BLOCK // 8] = np.frombuffer(b["cells"], np.uint8)
    return rows


def remove_repeats(docs: DataFrame, id_column: str, text_column: str, texts: bool = True) -> DataFrame:
    """``id, n_words, n_removed, kept_sha256`` and, if ``texts``, ``kept`` of each document without repeated windows.

    Words are runs of characters that aren't ASCII white space. A word goes if one of the windows of 35 words over it
    also starts elsewhere, in another document or in the same; both copies go. ``kept`` joins the words that stay by
    one space. Windows are judged on the input. Null and empty texts, and texts of fewer than 35 words, lose
    nothing. Equal rows are different documents, so their windows repeat; other columns are ignored; an empty table
    gives an empty result.

    Two reads: the first makes sketches of window keys, merged block by block; the second groups exactly, by key and
    64-bit window hash together, the windows whose estimated count is over one. A count never is too small, so none is lost.
    Tasks settle equal windows among their own text first, so a passage in very many documents costs each task one row.
    Beyond about ``MOST_CELLS`` keys the sketch lets more windows through; results stay the same.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    docs = stage(numbered(docs, "row"), "documents")
    sketch = spark.sparkContext.broadcast(sketch_of(docs))
    runs = docs.select("row", "text").mapInArrow(lambda b: _candidates(b, sketch), RUNS_SQL)
    runs = runs.repartition("key").sortWithinPartitions("key").mapInArrow(_settle_all, "row long, start int, known int")
    runs = runs.groupBy("row").agg(F.collect_list(F.struct("start", "known")).alias("runs"))
    id_type = docs.schema["id"].dataType.simpleString()
    out = f"id {id_type}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts
    return docs.join(runs, "row", "left").select("id", "text", "runs").mapInArrow(lambda b: _removed(b, WINDOW, texts), out)


def op2_count_min(spark, sf_dir: str) -> DataFrame:
    found = remove_repeats(read_table(spark, sf_dir, "documents"), "doc_id", "text", texts=False)
    return found.withColumnRenamed("id", "doc_id")
