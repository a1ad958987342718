"""Benchmark decontamination by a distributed positional inverted index of the training documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffcast.llm.common import ALPHANUMERIC, LOWER, PlacedHash, chunks, expand, numbered, read_table, text_column, word_spans
from staffcast.staging import stage

WINDOW = 10
SHARD_BYTES = 1 << 20  # text of one index shard; a longer document is a shard of its own
HELD_PLACES = 1 << 20
ITEM_WORDS = 2_000_000  # words of items that tasks hold at a time; more items are searched in several rounds

INDEX = "shard long, rows binary, words binary, terms binary, counts binary, positions binary"
SPANS = pa.schema([("row", pa.int64()), ("kind", pa.string()), ("item", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


WORDS = PlacedHash()


def hashed_words(at: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (letters, digits and what is beyond ASCII; A-Z lower-cased); each text's first word."""
    raw = LOWER[raw]
    starts, ends, first = word_spans(at, raw, ALPHANUMERIC)
    return WORDS(raw, starts, ends), first


def _index(batches: Iterator[pa.RecordBatch], terms: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row a shard: its documents, their word counts, and for each term the places in the shard, as gaps.

    A place is the document's number in the shard plus all words before, so that no list runs over
    from one document into the next. Only words that some item has are indexed; no other can be asked for.
    """
    for batch in batches:
        for first, end, at, raw in chunks(batch.column("text"), SHARD_BYTES):
            hashes, heads = hashed_words(at, raw)
            rows = np.asarray(batch.column("row").slice(first, end - first))
            words = np.diff(heads)
            place = np.arange(len(hashes)) + np.repeat(np.arange(len(words)), words)
            term = np.minimum(np.searchsorted(terms, hashes), max(0, len(terms) - 1))
            known = np.flatnonzero(terms[term] == hashes) if len(terms) else np.zeros(0, np.int64)
            order = known[np.argsort(term[known].astype(np.int32), kind="stable")]
            own, counts = np.unique(term[order], return_counts=True)
            gaps = np.diff(place[order], prepend=0)
            heads_of = np.cumsum(counts) - counts
            gaps[heads_of] = place[order][heads_of]
            blobs = (rows.astype("<i8"), words.astype("<i4"), own.astype("<i4"), counts.astype("<i4"), gaps.astype("<u4"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(rows[0])], pa.int64()), *[pa.array([b.tobytes()], pa.binary()) for b in blobs]],
                names=["shard", "rows", "words", "terms", "counts", "positions"],
            )


class Items:
    """Windows of the items: distinct ones, each with its terms and the items that hold it."""

    def __init__(self, ids: np.ndarray, at: np.ndarray, raw: np.ndarray, window: int):
        hashes, first = hashed_words(at, raw)
        self.terms, term = np.unique(hashes, return_inverse=True)
        words = np.diff(first)
        size = np.minimum(words, window)
        counts = np.where(words > 0, words - size + 1, 0)
        heads = expand(first[:-1], counts)
        owner, length = np.repeat(ids, counts), np.repeat(size, counts)
        table = np.full((len(heads), window), -1, np.int32)
        for offset in range(window):
            inside = offset < length
            table[inside, offset] = term[heads[inside] + offset]
        self.windows, which = np.unique(table, axis=0, return_inverse=True) if len(table) else (table, np.zeros(0, np.int64))
        self.length = (self.windows >= 0).sum(1)
        order = np.lexsort((owner, which.ravel()))
        self.items, self.item_of = owner[order], which.ravel()[order]

    def holders(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each window the numbers of its holders in ``items``: first and count."""
        a, b = np.searchsorted(self.item_of, windows), np.searchsorted(self.item_of, windows, "right")
        return a, b - a


class Shard:
    """Postings of one shard, decoded."""

    def __init__(self, row: dict, n_terms: int):
        self.rows, self.words = np.frombuffer(row["rows"], "<i8"), np.frombuffer(row["words"], "<i4").astype(np.int64)
        own, counts = np.frombuffer(row["terms"], "<i4"), np.frombuffer(row["counts"], "<i4")
        self.places = np.frombuffer(row["positions"], "<u4").astype(np.int64)
        heads = np.cumsum(counts) - counts
        sums = np.cumsum(self.places)
        self.places = sums - np.repeat(sums[heads] - self.places[heads], counts) if len(counts) else sums
        self.count, self.head = np.zeros(n_terms + 1, np.int64), np.zeros(n_terms + 1, np.int64)
        self.count[own], self.head[own] = counts, heads
        # The first place of each document; the place after a document's last word holds nothing.
        self.starts = np.cumsum(self.words + 1) - self.words - 1
        self.term_at = np.full(int(self.words.sum()) + len(self.words), -1, np.int32)
        self.term_at[self.places] = np.repeat(own, counts)

    def places_of(self, term: int) -> np.ndarray:
        return self.places[self.head[term] : self.head[term] + self.count[term]]

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, "right") - 1


def phrases(shard: Shard, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """(window, place where it begins) of all exact matches.

    The list of a window's rarest term, moved by its offset, gives the places where it may begin; the
    lists of the other terms, from rare to common, are met at their offsets, so few places reach the common ones.
    """
    windows, length = items.windows, items.length
    sizes = np.where(windows >= 0, shard.count[windows], np.iinfo(np.int64).max)
    rarest = sizes.min(1, initial=np.iinfo(np.int64).max)
    alive = np.flatnonzero((rarest > 0) & (length > 0))
    by_size = np.argsort(sizes[alive], axis=1, kind="stable")
    found = []
    # Some windows at a time, so that the places held don't follow the number of windows.
    cuts = np.searchsorted(np.cumsum(rarest[alive]), np.arange(HELD_PLACES, rarest[alive].sum() + HELD_PLACES, HELD_PLACES))
    for own in np.split(np.arange(len(alive)), np.unique(cuts)):
        which, order = alive[own], by_size[own]
        first = order[:, 0] if len(own) else np.zeros(0, np.int64)
        term = windows[which, first]
        each = np.repeat(np.arange(len(own)), shard.count[term])
        begin = shard.places[expand(shard.head[term], shard.count[term])] - first[each]
        inside = (begin >= 0) & (begin + length[which[each]] <= len(shard.term_at))
        each, begin = each[inside], begin[inside]
        for k in range(1, windows.shape[1]):
            offset = order[each, k]
            want = windows[which[each], offset]
            meets = want < 0
            meets |= shard.term_at[np.where(meets, begin, begin + offset)] == want
            each, begin = each[meets], begin[meets]
        found.append((which[each], begin))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def near(shard: Shard, items: Items, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, place of its rarest term) where all its terms lie within ``slop`` words, in any order, in one document."""
    sizes = np.where(items.windows >= 0, shard.count[items.windows], np.iinfo(np.int64).max)
    found = []
    for w in np.flatnonzero(sizes.min(1, initial=np.iinfo(np.int64).max) > 0).tolist():
        terms = np.unique(items.windows[w][: items.length[w]])
        terms = terms[np.argsort(shard.count[terms], kind="stable")].tolist()
        anchor = shard.places_of(terms[0])
        document = shard.document(anchor)
        low, high = shard.starts[document], shard.starts[document] + shard.words[document]
        kept = np.ones(len(anchor), bool)
        for t in terms[1:]:
            places = shard.places_of(t)
            at = np.searchsorted(places, np.maximum(anchor - slop, low))
            ahead = places[np.minimum(at, len(places) - 1)]
            kept &= (at < len(places)) & (ahead <= anchor + slop) & (ahead < high)
        if kept.any():
            found.append((w, anchor[kept]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.repeat([w for w, _ in found], [len(p) for _, p in found]), np.concatenate([p for _, p in found])


def _matches(batches: Iterator[pa.RecordBatch], items: Items, slop: int | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            shard = Shard({c: batch.column(c)[i].as_py() for c in batch.schema.names}, len(items.terms))
            for kind, (window, place) in (("phrase", phrases(shard, items)), *([("near", near(shard, items, slop))] if slop else [])):
                document = shard.document(place)
                start = place - shard.starts[document]
                first, count = items.holders(window)
                each = np.repeat(np.arange(len(window)), count)
                holder = items.items[expand(first, count)] if len(window) else np.zeros(0, np.int64)
                length = items.length[window] if kind == "phrase" else np.ones(len(window), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.rows[document][each]), pa.array([kind] * len(each)), pa.array(holder, pa.int64()), pa.array(start[each], pa.int64()), pa.array((start + length)[each], pa.int64())],
                    schema=SPANS,
                )


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [np.frombuffer(b, "<i8") for b in batch.column("rows").to_pylist()]
        words = [np.frombuffer(b, "<i4") for b in batch.column("words").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(rows)), pa.array(np.concatenate(words).astype(np.int64))], names=["row", "n_words"])


def _parts(items: DataFrame, most_words: int) -> list[DataFrame]:
    """The items dealt into as many parts as it takes for each to stay within about ``most_words`` words."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + size // (2 * most_words)
    return [items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i) for i in range(n)]


def find_items(
    docs: DataFrame, row: str, text_column: str, items: DataFrame, item_id: str, item_text: str, window: int = WINDOW, slop: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Where words of items occur in documents: word counts (``row, n_words``) and matches.

    ``row`` names a column of numbers that are the same in each read of ``docs`` and differ between rows. Matches are
    ``row, kind, item, start, end`` in words of the document: kind ``phrase`` for each occurrence of ``window``
    consecutive words of an item (an item of fewer words is one window; one without words none), and, if ``slop`` is
    given, kind ``near`` for each place of a window's rarest word with all its other words at most ``slop`` words away in
    the same document, in any order. Words are runs of ASCII letters, lower-cased, digits and characters beyond ASCII.
    Items have numbers; equal ones count as one item, and null ones take no part. Null texts have no words. Repeated rows
    are matched each by itself, other columns are ignored, and empty tables give empty results.

    The index is a table with one row for each few MB of text, so searches need no shuffle: each shard's lists meet in
    its own task. Items go to tasks in rounds of bounded size.
    """
    items = items.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).cast("string").alias("text")).where("item IS NOT NULL")
    text = docs.select(F.col(row).alias("row"), F.col(text_column).cast("string").alias("text"))
    matches, counts = None, None
    for part in _parts(items, ITEM_WORDS):
        table = part.orderBy("item").toArrow().combine_chunks()
        held = Items(np.asarray(table.column("item")), *text_column_of(table), window)
        terms = held.terms
        index = stage(text.mapInArrow(lambda b, terms=terms: _index(b, terms), INDEX), "postings")
        if counts is None:
            counts = index.select("rows", "words").mapInArrow(_word_counts, "row long, n_words long")
        got = index.mapInArrow(lambda b, held=held: _matches(b, held, slop), "row long, kind string, item long, start long, end long")
        matches = got if matches is None else matches.unionAll(got)
    return counts, matches


def text_column_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return text_column(pa.concat_arrays([c.cast(pa.large_string()) for c in table.column("text").chunks] or [pa.array([], pa.large_string())]))


def hits(matches: DataFrame) -> DataFrame:
    """``row, n_hit, items`` of documents with phrase matches: words inside any match, and the items, by number."""
    spans = matches.where("kind = 'phrase'").groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"), F.array_sort(F.collect_set("item")).alias("items")
    )
    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("to"))
    # Spans by start: each adds what lies beyond all before.
    add = lambda s, x: F.struct(
        (s["hit"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], s["to"]))).alias("hit"), F.greatest(s["to"], x["end"]).alias("to")
    )
    return spans.select("row", F.aggregate("spans", start, add)["hit"].alias("n_hit"), "items")


def op9_positional(spark, sf_dir: str) -> DataFrame:
    docs = stage(numbered(read_table(spark, sf_dir, "documents").select("doc_id", "text"), "row"), "documents")
    counts, matches = find_items(docs, "row", "text", read_table(spark, sf_dir, "benchmark"), "item_id", "text")
    out = docs.select("row", "doc_id").join(counts, "row").join(hits(matches), "row", "left")
    texts = F.array_sort(F.transform(F.coalesce("items", F.array().cast("array<long>")), lambda x: x.cast("string")))
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.size(texts).cast("long").alias("n_items"),
        F.sha2(F.array_join(texts, ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
