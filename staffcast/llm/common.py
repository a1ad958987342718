"""Helpers the operators share: tables, row numbers, and words of Arrow text columns as numpy arrays.

Text arrives in tasks as Arrow buffers. :func:`chunks` cuts a batch into pieces of a few MB (a longer
document is one piece), :func:`word_spans` finds words by a table of byte classes, and :func:`word_hashes`
hashes all words of a piece at once with prefix sums. No Python object is made for each word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
# A word is a run of bytes that aren't white space, or of ASCII letters, digits and bytes beyond ASCII.
UNSPACED = ~SPACES
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a number of its own for each row; write the result once before using it twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


def text_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows) and bytes of a string column; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at - at[0], raw[at[0] : at[-1]]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, offsets, bytes) of pieces of a string column of about ``limit`` bytes."""
    at, raw = text_column(column)
    first = 0
    while first < len(at) - 1:
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, end, at[first : end + 1] - at[first], raw[at[first] : at[end]]
        first = end
    # Python workers live on after a task; what a batch took goes back.
    pa.default_memory_pool().release_unused()


def word_spans(at: np.ndarray, raw: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each document the number of its first word (plus the total)."""
    inside = table[raw]
    before = np.empty_like(inside)
    before[1:], before[:1] = inside[:-1], False
    edges = at[:-1][at[:-1] < len(raw)]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1], after[-1:] = inside[1:], False
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, at)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finalizer of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, made longer when asked for more."""

    def __init__(self, base: int):
        self.base = base | 1
        self.up = self.down = np.ones(1, np.uint64)

    def __reduce__(self):
        return Powers, (self.base,)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, len(self.up) * 5 // 4)
            self.up, self.down = (self._powers(b, n) for b in (self.base, pow(self.base, -1, 1 << 64)))
        return self.up, self.down

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """Hash of each run ``values[start:end]`` of 64-bit numbers: equal runs have equal hashes."""
    up, down = powers.to(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class WordHash:
    """64-bit hashes of words from their bytes; another seed gives an independent hash."""

    def __init__(self, seed: int = 0):
        numbers = np.random.default_rng(0x5EED + seed)
        self.bytes = numbers.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.powers = Powers(int(numbers.integers(1 << 61, 1 << 62)))

    def __call__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return run_hashes(self.bytes[raw], starts, ends, self.powers)


class PlacedHash:
    """64-bit hashes of words as sums of a mixed number for each byte at its place; another seed gives an independent hash.

    The sum of :class:`WordHash` is a polynomial, in which regular patterns of two letters cancel out for any base. Here each byte's
    number depends on its place in no regular way.
    """

    def __init__(self, seed: int = 0):
        self.salt = np.random.default_rng(0x9A5EED + seed).integers(1 << 63, dtype=np.uint64)

    def __call__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        size = np.asarray(ends - starts, np.int64)
        to = np.cumsum(size)
        place = np.arange(int(to[-1]) if len(to) else 0)
        bytes_ = raw[place + np.repeat(starts - (to - size), size)]
        place -= np.repeat(to - size, size)
        numbers = place.view(np.uint64) << np.uint64(8)
        numbers |= bytes_
        numbers *= np.uint64(0x9E3779B97F4A7C15)
        numbers += self.salt
        sums = np.zeros(len(numbers) + 1, np.uint64)
        np.cumsum(mix(numbers), out=sums[1:])
        return mix(sums[to] - sums[to - size] + size.astype(np.uint64))


class Vocabulary:
    """Finds the words of a bounded list in texts: a hash proposes, the bytes decide."""

    def __init__(self, words: list[bytes]):
        self.words = sorted(set(words))
        self.ends = np.cumsum([len(w) for w in self.words], dtype=np.int64)
        self.sizes = np.diff(self.ends, prepend=0)
        self.raw = np.frombuffer(b"".join(self.words), np.uint8)
        seed = 0
        while True:  # words of the list never share a hash
            self.hash = WordHash(seed)
            hashes = self.hash(self.raw, self.ends - self.sizes, self.ends)
            if len(np.unique(hashes)) == len(self.words):
                break
            seed += 1
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def number(self, word: bytes) -> int:
        return int(np.searchsorted(np.array(self.words, object), word))

    def find(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word ``raw[start:end]``, or -1 if it isn't listed."""
        out = np.full(len(starts), -1, np.int32)
        if not len(self.words) or not len(starts):
            return out
        hashes = self.hash(raw, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        number = self.order[at]
        maybe = np.flatnonzero((self.hashes[at] == hashes) & (self.sizes[number] == ends - starts))
        if len(maybe):
            number, size = number[maybe], (ends - starts)[maybe]
            equal = raw[expand(starts[maybe], size)] == self.raw[expand(self.ends[number] - size, size)]
            same = np.logical_and.reduceat(equal, np.cumsum(size) - size)
            out[maybe[same]] = number[same]
        return out


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` of ``count`` numbers for each pair, one after the other."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.repeat(np.asarray(starts, np.int64) - before, counts) + np.arange(total)


def rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
