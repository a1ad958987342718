"""Spelling variants: words one edit apart, found by asymmetric q-chunks, and the commonest form of each."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffcast.llm.common import read_table, text_column
from staffcast.staging import stage

LEAST_LETTERS, LEAST_COUNT = 5, 3
DROP_ONE_IN = 97
PIECE_BYTES = 1 << 20
HELD_WORDS, HELD_BYTES = 400_000, 64 << 20
HOT_ROWS = 4096  # chunks of one key beyond this are dealt over several tasks

# Letters are A-Z, a-z and U+00C0 to U+00FF. Rough runs also hold other characters beyond ASCII.
LETTERS, BREAK = re.compile("[a-zÀ-ÿ]+"), re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]")


def _pieces(text: bytes) -> Iterator[bytes]:
    """``text`` in pieces of about a MB, cut between words."""
    at = 0
    while at < len(text):
        cut = BREAK.search(text, at + PIECE_BYTES)
        to = cut.start() if cut else len(text)
        yield text[at:to]
        at = to


def _shortened(word: bytes, place: int) -> bytes:
    letters = word.decode()
    place %= len(letters)
    return (letters[:place] + letters[place + 1 :]).encode()


def _count(batches: Iterator[pa.RecordBatch], least: int, one_in: int | None) -> Iterator[pa.RecordBatch]:
    """Partial counts of words of ``least`` bytes or more, given away whenever many are held."""
    rough = re.compile(rb"[a-z\x80-\xff]{%d,}" % least)
    held: dict[bytes, int] = {}
    seen = 0

    def part() -> pa.RecordBatch:
        words = pa.array(list(held), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        at, raw = text_column(batch.column("text"))
        for i, row in enumerate(batch.column("id").to_pylist()):
            seed = crc32(f"{'' if row is None else row}:".encode())
            for piece in _pieces(raw[at[i] : at[i + 1]].tobytes()):
                found = Counter(rough.findall(piece.lower()))
                for token in [t for t in found if not t.isascii()]:
                    k = found.pop(token)
                    for word in LETTERS.findall(token.decode(errors="replace")):
                        found[word.encode()] += k
                for word, k in found.items():
                    if one_in and not (h := crc32(word, seed)) % one_in:
                        word = _shortened(word, h)
                    held[word] = held.get(word, 0) + k
                seen += len(piece)
            if len(held) > HELD_WORDS or seen > HELD_BYTES:
                yield part()
                held, seen = {}, 0
    if held:
        yield part()


def word_counts(
    docs: DataFrame, id_column: str, text_column: str, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, drop_one_in: int | None = None
) -> DataFrame:
    """``word, n`` of words with at least ``least_letters`` letters and ``least_count`` occurrences in all texts.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased. With ``drop_one_in``, an occurrence whose
    crc32 of ``id:word`` this number divides loses the letter at crc32 modulo its length (planted misspellings, the same in
    each run). Null and empty texts hold no words, a null id counts as an empty one, repeated rows count each, other
    columns are ignored, and an empty table gives none. Tasks give partial counts, so a very common word is a few rows a task.
    """
    text = docs.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).cast("string").alias("text"))
    parts = text.mapInArrow(lambda b: _count(b, least_letters, drop_one_in), "word string, n long")
    counts = parts.where(F.char_length("word") >= least_letters).groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_count)


def near_words(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``, once for each pair of ``words`` (``word, n``, distinct) that one inserted, deleted or replaced letter parts.

    The shorter word of a pair (of equally long ones either) contributes its two halves as disjoint chunks. One edit touches one
    half only: a half before it keeps its place, one after it moves by the difference of lengths, at most one. The other word
    contributes its positional grams, of the sizes that such halves have and at the places they may come to. As a half of a
    short word is common, its key also holds a half of the rest, which is a word with one edit again and cut in the
    same way. So each pair shares a key, and the join's condition tests it there: no other pair leaves the join, and one that
    shares several keys counts at the first. Keys with many chunks are dealt over several tasks.
    """
    size = F.char_length("word")
    half_of = lambda length: F.floor(length / 2).cast("int")
    piece = lambda start, end: F.col("word").substr(start + 1, end - start)

    def keys(length, moved: int):
        """Keys of a word, as one that comes from a word of ``length`` by an edit that moves what follows by ``moved``."""
        half = half_of(length)
        for first, (start, end) in enumerate(((half, length), (F.lit(0), half))):
            kept = piece(half + moved, length + moved) if first else piece(F.lit(0), half)
            middle = start + half_of(end - start)
            for second, rest in enumerate((piece(start, middle), piece(middle + moved, end + moved))):
                part = length * 4 + 2 * first + second
                yield F.struct(part.cast("int").alias("part"), F.xxhash64(part, kept, rest).alias("key"))

    chunks = words.select(F.explode(F.array(*keys(size, 0))).alias("k"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    grams = words.select(F.explode(F.array(*keys(size, 0), *keys(size - 1, 1))).alias("k"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    chunks, grams = chunks.select("k.*", "a", "a_n"), grams.select("k.*", "b", "b_n")
    hot = chunks.groupBy("part", "key").count().where(F.col("count") > HOT_ROWS)
    hot = stage(hot.select("part", "key", F.ceil(F.col("count") / HOT_ROWS).cast("int").alias("tiles")), "hot-chunks")
    keyed = ["part", "key"]
    if not hot.isEmpty():
        tiles = F.coalesce("tiles", F.lit(1))
        chunks = chunks.join(hot, keyed, "left").withColumn("tile", F.pmod(F.xxhash64("a"), tiles).cast("int")).drop("tiles")
        grams = grams.join(hot, keyed, "left").withColumn("tile", F.explode(F.sequence(F.lit(0), tiles - 1))).drop("tiles")
        keyed.append("tile")
    first, second, half = F.col("part").bitwiseAND(2) == 0, F.col("part").bitwiseAND(1) == 0, half_of(F.char_length("a"))
    same = lambda start, end: F.col("a").substr(start + 1, end - start) == F.col("b").substr(start + 1, end - start)
    start, end = F.when(first, half).otherwise(0), F.when(first, F.char_length("a")).otherwise(half)
    met = chunks.join(grams, keyed)
    return met.where(
        ((F.col("a") < F.col("b")) | (F.char_length("b") > F.char_length("a")))
        & (same(F.lit(0), half) == first) & (same(start, start + half_of(end - start)) == second) & (F.levenshtein("a", "b", 1) == 1)
    ).select("a", "a_n", "b", "b_n")


def spelling_forms(words: DataFrame, times: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each of ``words`` (``word, n``, distinct).

    ``n_near`` counts the words one edit away. The form is the one of them with the largest count (of equal ones the smallest
    in code-point order), if it is at least ``times`` (more than 1) this word's; else null. The root is where forms lead to, the word itself
    without one. Counts grow along forms by that factor, so chains are short, and each round of joins halves them.
    """
    if times <= 1:
        raise ValueError("times must be more than 1, else forms could lead in circles")
    words = stage(words.select("word", "n"), "words")
    row = lambda x, y: F.struct(F.col(x).alias("word"), (-F.col(f"{y}_n")).alias("less"), F.col(y).alias("other"))
    both = near_words(words).select(F.explode(F.array(row("a", "b"), row("b", "a"))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct("less", "other")).alias("best"))
    fits = -F.col("best.less") >= F.lit(times) * F.col("n")
    out = stage(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(fits, F.col("best.other")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    ends = out.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("far"))
        joined = ends.join(further, "root", "left")
        ends = stage(joined.select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "roots")
        if ends.where("moved").isEmpty():
            break
        ends = ends.drop("moved")
    return out.join(ends.drop("moved"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11_q_chunks(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return spelling_forms(word_counts(docs, "doc_id", "text", drop_one_in=DROP_ONE_IN))
