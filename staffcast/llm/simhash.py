"""Near-duplicates by SimHash fingerprints: pigeonhole blocks find the pairs, components join them."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffcast.llm.common import LOWER, UNSPACED, chunks, expand, free_name, numbered, read_table, word_spans
from staffcast.llm.components import roots
from staffcast.staging import stage

SHINGLE, SEED, BITS, RADIUS = 4, 42, 64, 4
# Fingerprints fall into BLOCKS runs of bits; two that differ in RADIUS bits share BLOCKS - RADIUS whole runs.
BLOCKS = 6
TILE_ROWS = 2048
HOT_ROWS = 2 * TILE_ROWS  # a bucket with more rows is compared tile by tile
KNOWN_ROWS = 100_000  # sizes of hot buckets are broadcast up to so many rows
HELD_LINKS = 1 << 18


def fingerprints(at: np.ndarray, raw: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """SimHash of each document of a piece: XXH64 of its lower-cased shingles, one bit by majority."""
    starts, ends, first = word_spans(at, raw, UNSPACED)
    lengths = ends - starts
    # All words again, each with one space after it: a shingle is then a slice.
    text = LOWER[raw[np.minimum(expand(starts, lengths + 1), len(raw) - 1)]] if len(starts) else np.zeros(0, np.uint8)
    to = np.cumsum(lengths + 1)
    text[to - 1] = 0x20
    text, begin, end = text.tobytes(), to - lengths - 1, to - 1
    words = np.diff(first)
    counts = np.where(words == 0, 0, np.maximum(words - size + 1, 1))
    heads = expand(first[:-1], counts)
    tails = np.minimum(heads + size, np.repeat(first[1:], counts)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(text[a:b], SEED) for a, b in zip(begin[heads].tolist(), end[tails].tolist(), strict=True)), np.uint64, len(heads)
    )
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        before = np.cumsum(counts) - counts
        ones = np.add.reduceat(bits, before[some], axis=0, dtype=np.int64)
        chosen = (2 * ones > counts[some][:, None]).astype(np.uint8)
        out[some] = np.packbits(chosen, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _fingerprint(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, at, raw in chunks(batch.column("text")):
            values = pa.array(fingerprints(at, raw, size).view(np.int64), pa.int64())
            part = batch.slice(first, end - first)
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("id"), values], names=["row", "id", "fp"])


def masks(radius: int, blocks: int) -> list[int]:
    """Bits of each choice of ``blocks - radius`` blocks, as signed numbers."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    runs = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    wholes = (sum(c) for c in combinations(runs, blocks - radius))
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in wholes]


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each row's smallest linked row) after more links."""
    while True:
        left, right = label[a], label[b]
        apart = left != right
        if not apart.any():
            return label
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(left, right)[apart], np.minimum(left, right)[apart])
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label = further


def close_rows(group: np.ndarray, value: np.ndarray, radius: int) -> np.ndarray:
    """For each row the smallest row of its group that links of ``radius`` bits lead to.

    Rows of a group lie together. All pairs of a group are compared, a shift at a time; links are folded into
    labels as soon as many are held, so memory doesn't follow their number.
    """
    label, rows = np.arange(len(group)), np.arange(len(group))
    held: list[tuple[np.ndarray, np.ndarray]] = []
    count, shift = 0, 0
    while len(rows):
        shift += 1
        rows = rows[: np.searchsorted(rows, len(group) - shift)]
        rows = rows[group[rows + shift] == group[rows]]
        near = rows[np.bitwise_count(value[rows] ^ value[rows + shift]) <= radius]
        near = near[label[near] != label[near + shift]]
        held.append((near, near + shift))
        count += len(near)
        if count > HELD_LINKS or not len(rows):
            label = join_labels(label, *(np.concatenate(x) for x in zip(*held, strict=True)))
            held, count = [], 0
    return label


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links that join what is close in each bucket; rows come sorted by bucket."""

    def found(part: dict[str, np.ndarray]) -> pa.RecordBatch:
        fp = part["fp"]
        new = np.zeros(len(fp), bool)
        for c in ("choice", "bits", "tile"):
            new[1:] |= part[c][1:] != part[c][:-1]
        label = close_rows(np.cumsum(new), fp.view(np.uint64), radius)
        moved = label != np.arange(len(fp))
        return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[label[moved]])], names=["a", "b"])

    rest = None
    for batch in batches:
        part = {c: np.asarray(batch.column(c)) for c in ("choice", "bits", "tile", "fp")}
        if rest is not None:
            part = {c: np.concatenate([rest[c], part[c]]) for c in part}
        same = np.ones(len(part["fp"]), bool)
        for c in ("choice", "bits", "tile"):
            same &= part[c] == part[c][-1]
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0  # the last bucket may go on
        if cut:
            yield found({c: v[:cut] for c, v in part.items()})
        rest = {c: v[cut:] for c, v in part.items()}
    if rest is not None:
        yield found(rest)


def close_links(values: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Links ``a, b`` between different fingerprints (column ``fp``, distinct) of at most ``radius`` differing bits.

    Not all pairs: in each bucket just enough links to join what is close, so dense groups give few rows.
    """
    choices = F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks(radius, blocks))]))
    rows = values.select("fp", choices.alias("c")).select("c.choice", "c.bits", "fp")
    sizes = rows.groupBy("choice", "bits").count().where(F.col("count") > HOT_ROWS)
    sizes = stage(sizes.withColumn("tiles", F.ceil(F.col("count") / TILE_ROWS).cast("int")).drop("count"), "hot-buckets")
    n_hot = sizes.count()
    if n_hot:
        sizes = F.broadcast(sizes) if n_hot <= KNOWN_ROWS else sizes
        rows = rows.join(sizes, ["choice", "bits"], "left")
        own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
        # Each pair of tiles is compared in one place, so a row goes to one place for each other tile.
        others = F.filter(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: t != own)
        places = F.transform(others, lambda t: F.least(t, own) * F.col("tiles") + F.greatest(t, own))
        rows = rows.select("choice", "bits", F.explode(F.coalesce(places, F.array(F.lit(-1)))).alias("tile"), "fp")
    else:
        rows = rows.withColumn("tile", F.lit(-1))
    rows = rows.repartition("choice", "bits", "tile").sortWithinPartitions("choice", "bits", "tile", "fp")
    return rows.mapInArrow(lambda batches: _links(batches, radius), "a long, b long")


def near_duplicates(
    docs: DataFrame, id_column: str, text_column: str, row: str | None = None, size: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS
) -> DataFrame:
    """``row, id, fp, component_id, first_row`` of each document.

    Texts are lower-cased (A-Z) and cut into words at ASCII white space; a document of fewer than ``size`` words is one
    shingle, one without words (null and empty texts too) has fingerprint zero and links like any other. Two
    fingerprints link if they differ in at most ``radius`` bits; ``component_id`` is the smallest id that links
    lead to, null ids aside (null if all are), and ``first_row`` the row number of one row with it. Rows with
    equal ids or texts each have a row; other columns are ignored; an empty table gives an empty result.

    Equal fingerprints are merged first, so a group of copies costs one row however large it is. ``row`` may name a column of
    written numbers that differ between rows; else rows are numbered here.
    """
    if row is None:
        row = free_name(docs, "_row")
        docs = numbered(docs, row)
    docs = docs.select(F.col(row).alias("row"), F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    id_type = docs.schema["id"].dataType.simpleString()
    prints = stage(docs.mapInArrow(lambda b: _fingerprint(b, size), f"row long, id {id_type}, fp long"), "fingerprints")
    # The smallest id, and of its rows the first; a null id comes last.
    lead = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    values = stage(prints.groupBy("fp").agg(F.min(lead).alias("lead")), "distinct-fingerprints")
    comps = roots(close_links(values.select("fp"), radius, blocks))
    if comps is not None:
        comps = comps.withColumnRenamed("node", "fp")
        values = values.join(comps, "fp", "left").select("fp", "lead", F.coalesce("root", "fp").alias("root"))
        first = values.groupBy("root").agg(F.min("lead").alias("lead"))
        values = values.drop("lead").join(first, "root")
    return prints.join(values.select("fp", F.col("lead.id").alias("component_id"), F.col("lead.row").alias("first_row")), "fp").select(
        "row", "id", "fp", "component_id", "first_row"
    )


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
