"""Documents as token pieces, packed into sequences of fixed capacity by the sum-of-squares rule."""

from __future__ import annotations

import hashlib
import os
import sys
import zlib
from collections.abc import Iterator
from pathlib import Path
from types import ModuleType

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffcast.llm.common import LOWER, UNSPACED, PlacedHash, chunks, expand, free_name, numbered, read_table, word_spans
from staffcast.staging import stage

CAPACITY = 2048
END_ID = 0
SHARD_PIECES = 16_384  # pieces that one task packs together
CACHED_UNITS = 400_000  # about 40 MB in a worker process

WORDS = PlacedHash(3)
MARK = b"<|endoftext|>"
SHARED = "_token_units_of_this_process"
# Bytes that are ASCII letters (1), other visible ASCII (2), or neither; and those that make a word odd.
KIND = np.zeros(256, np.int8)
KIND[0x21:0x7F] = 2
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
ODD = np.zeros(256, bool)
ODD[[0x27, 0x3C]] = True


def units(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, starts, ends, units before each word) of the parts that the tokenizer surely keeps apart.

    It lower-cases, never joins what white space parts, and parts ASCII letters from ASCII digits and punctuation. Not so
    around an apostrophe (``it's``), nor in what may be the name of a special token: such words stay as they are.
    """
    odd = np.flatnonzero(ODD[raw])
    plain = np.ones(len(starts), bool)
    plain[np.searchsorted(starts, odd, "right") - 1] = False
    kind = KIND[raw]
    edges = np.flatnonzero(kind[1:] + kind[:-1] == 3) + 1
    word = np.searchsorted(starts, edges, "right") - 1
    # Two texts meet without white space between them, and then an edge is a word's beginning.
    inside = (starts[word] < edges) & plain[word]
    edges, word = edges[inside], word[inside]
    before = np.arange(len(starts) + 1) + np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(starts)))])
    text = LOWER[raw]
    for i in np.flatnonzero(~plain).tolist():
        text[starts[i] : ends[i]] = raw[starts[i] : ends[i]]
    return text, np.sort(np.concatenate([starts, edges])), np.sort(np.concatenate([ends, edges])), before


class WordTokens:
    """Token ids of texts, unit by unit (see :func:`units`).

    Each different unit is encoded once and kept, up to a bound. Units are told apart by 64-bit hashes.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(definition)
        self.encode, self.mark = tokenizer.encode_batch_fast, tokenizer.token_to_id(MARK.decode())
        # Unit 0 is the closing id; ``known`` has each other unit's number, and ``begin`` where the ids of each unit begin.
        self.known: dict[int, int] = {}
        self.ids, self.begin = np.array([END_ID], np.uint32), np.array([0, 1])

    @staticmethod
    def shared(definition: str) -> WordTokens:
        """The one of this worker process: later tasks find the units that earlier ones have met."""
        kept = sys.modules.setdefault(SHARED, ModuleType(SHARED)).__dict__
        key = hashlib.sha256(definition.encode()).hexdigest()
        if key not in kept:
            kept[key] = WordTokens(definition)
        return kept[key]

    def _encoded(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units, encoded as one text with a special token after each, and the number of ids of each unit."""
        size = len(MARK) + ends - starts
        text = raw[np.minimum(expand(starts, size), max(0, len(raw) - 1))]
        to = np.cumsum(size)
        for i, byte in enumerate(MARK):
            text[to - len(MARK) + i] = byte
        [encoded] = self.encode([text.tobytes().decode()], add_special_tokens=False)
        ids = np.array(encoded.ids, np.uint32)
        marks = np.flatnonzero(ids == self.mark)
        if len(marks) == len(starts):
            return ids[ids != self.mark], np.diff(marks, prepend=-1) - 1
        if len(starts) == 1:  # it holds the special token itself
            return ids[:-1], np.array([len(ids) - 1])
        halves = [self._encoded(raw, starts[part], ends[part]) for part in np.array_split(np.arange(len(starts)), 2)]
        return tuple(np.concatenate(x) for x in zip(*halves, strict=True))

    def __call__(self, at: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a piece, each with the closing id, and where each document begins (plus the end)."""
        starts, ends, first = word_spans(at, raw, UNSPACED)
        raw, starts, ends, before = units(raw, starts, ends)
        first = before[first]
        which, hashes = pd.factorize(WORDS(raw, starts, ends))
        sample = np.flatnonzero(np.diff(np.maximum.accumulate(which), prepend=-1))  # where each was first seen
        if len(self.known) > CACHED_UNITS:
            # The units met first are the common ones; the later half goes.
            half = CACHED_UNITS // 2
            self.known = {h: i for h, i in self.known.items() if i <= half}
            self.begin = self.begin[: half + 2]
            self.ids = self.ids[: self.begin[-1]].copy()
        known = self.known
        number = np.fromiter((known.get(h, 0) for h in hashes.tolist()), np.int64, len(hashes))
        new = np.flatnonzero(number == 0)
        if len(new):
            ids, sizes = self._encoded(raw, starts[sample[new]], ends[sample[new]])
            number[new] = len(self.begin) - 1 + np.arange(len(new))
            known.update(zip(hashes[new].tolist(), number[new].tolist(), strict=True))
            self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])
            self.ids = np.concatenate([self.ids, ids])
        # The closing id is a last "unit" of each document.
        in_each = np.diff(first)
        unit = np.zeros(len(which) + len(in_each), np.int64)
        unit[np.arange(len(which)) + np.repeat(np.arange(len(in_each)), in_each)] = number[which]
        sizes = self.begin[unit + 1] - self.begin[unit]
        to = np.cumsum(sizes)
        return self.ids[expand(self.begin[unit], sizes)], np.concatenate([[0], to[np.cumsum(in_each + 1) - 1]])


def _pieces(batches: Iterator[pa.RecordBatch], definition: str, capacity: int, tokens: bool) -> Iterator[pa.RecordBatch]:
    encode = WordTokens.shared(definition)
    for batch in batches:
        for first, end, at, raw in chunks(batch.column("text")):
            ids, begin = encode(at, raw)
            size = np.diff(begin)
            count = -(-size // capacity)
            piece = expand(np.zeros(len(count), np.int64), count)
            document = np.repeat(np.arange(len(count)), count)
            start = piece * capacity
            length = np.minimum(size[document] - start, capacity)
            whole = ids.astype("<u4").tobytes()
            cuts = [(4 * a, 4 * b) for a, b in zip((begin[document] + start).tolist(), (begin[document] + start + length).tolist(), strict=True)]
            crc = [zlib.crc32(whole[a:b]) for a, b in cuts]
            columns = [batch.column("kept").slice(first, end - first).take(pa.array(document)), *[pa.array(c, pa.int64()) for c in (piece, start, length, crc)]]
            names = ["kept", "piece", "start", "length", "ids_crc32"]
            if tokens:
                offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)


def pieces(docs: DataFrame, text_column: str, keep: list[str], tokenizer: str, capacity: int = CAPACITY, tokens: bool = False) -> DataFrame:
    """``kept, piece, start, length, ids_crc32`` (and ``ids``) of each document's pieces.

    A document's ids are those of the tokenizer file for its text, then 0; only what is longer than ``capacity`` is cut.
    ``kept`` is a struct of the columns in ``keep``, at least one; null texts count as empty, and have one piece of one id. Other columns are
    ignored. The file is read by the driver alone.
    """
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("kept"), F.col(text_column).cast("string").alias("text"))
    definition = Path(tokenizer).read_text()
    kind = rows.schema["kept"].dataType.simpleString()
    out = f"kept {kind}, piece long, start long, length long, ids_crc32 long" + ", ids array<int>" * tokens
    return rows.mapInArrow(lambda b: _pieces(b, definition, capacity, tokens), out)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece, placed in the given order.

    A piece goes where the sum over residual gaps of (open sequences with that gap) squared becomes smallest;
    among equals to the smallest gap. A new sequence is opened where no open one has room.
    """
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = 0
    never = np.iinfo(np.int64).max
    for i, size in enumerate(lengths.tolist()):
        # From gap g to g - size: (n[g] - 1)^2 and (n[g - size] + 1)^2 instead of both squares; a full one counts nowhere.
        change = np.where(count[size:] > 0, 2 * (count[: capacity + 1 - size] - count[size:]) + 2, never)
        if change[0] < never:
            change[0] = 1 - 2 * count[size]
        best = int(change.argmin())
        if change[best] < never:
            gap = size + best
            own = open_at[gap].pop()
            count[gap] -= 1
        else:
            gap, own, opened = capacity, opened, opened + 1
        sequence[i], offset[i] = own, capacity - gap
        if gap > size:
            open_at[gap - size].append(own)
            count[gap - size] += 1
    return sequence, offset


def _pack(table: pa.Table, capacity: int) -> pa.Table:
    table = table.sort_by([("length", "descending"), ("number", "ascending")])
    sequence, offset = sum_of_squares(table.column("length").to_numpy(), capacity)
    shard = table.column("shard")[0].as_py()
    # At most one sequence for each piece, so the sequences of different shards never meet.
    ids = pa.array(sequence + shard * (1 << 32))
    return pa.table({"number": table.column("number"), "sequence_id": ids, "offset": pa.array(offset)})


def pack(parts: DataFrame, length: str, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (rows with a length of 1 to ``capacity``) with ``sequence_id`` and ``offset``, gapless from 0.

    Rows are dealt by a hash of their number into shards of about ``SHARD_PIECES``, and each shard is packed by itself,
    longest first: the number of shards follows the rows, and each leaves a few sequences open at most. Full
    pieces are sequences of their own. Equal rows are placed one by one; an empty table gives an empty result. Column
    names must not be ``sequence_id`` or ``offset``.
    """
    number, shard = free_name(parts, "number"), "shard"
    parts = stage(numbered(parts, number), "pieces")
    short = parts.where(F.col(length) < capacity)
    n = max(1, -(-short.count() // SHARD_PIECES))
    dealt = short.select(F.col(number).alias("number"), F.col(length).cast("long").alias("length"), F.pmod(F.xxhash64(number), F.lit(n)).cast("long").alias(shard))
    places = dealt.groupBy(shard).applyInArrow(lambda t: _pack(t, capacity), "number long, sequence_id long, offset long")
    # Full pieces take the numbers below zero.
    whole = parts.where(F.col(length) >= capacity).withColumns({"sequence_id": -1 - F.col(number), "offset": F.lit(0).cast("long")}).drop(number)
    placed = short.join(places.withColumnRenamed("number", number), number).drop(number)
    return placed.unionByName(whole)


def op3_sum_of_squares(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    parts = pieces(docs, "text", ["doc_id"], public_tokenizers.path("word_bpe_49k.json"))
    return pack(parts, "length").select(F.col("kept.doc_id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
