"""Exact top-k search over vectors by MaxScore: dimensions are terms, a shard's columns their postings."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffcast.llm.common import numbered, read_table
from staffcast.staging import stage

SHARD_ROWS = 4096
QUERY_ROWS = 512
HELD_BLOCKS = 16  # query blocks that a task holds
STEP = 8  # dimensions probed between two tests of the bound
MOST = (1 << 63) - 1

PACK = "first long, n int, dims int, ids binary, uids binary, weights binary"
HITS = pa.schema([("query_uid", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("uid", pa.int64()), ("score", pa.int64())])


def weights(vector: Column) -> Column:
    """Each component as ``floor(256 * x)``; null if the vector, or a component, is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(vector.isNotNull() & finite, F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("long")))


def _pack(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows (uid, id, w) as blocks of at most ``size`` rows; shorter vectors are filled with zeros."""
    for whole in batches:
        for at in range(0, whole.num_rows, size):
            b = whole.slice(at, size)
            lists = b.column("w")
            lengths = np.diff(np.asarray(lists.offsets))
            dims = int(lengths.max(initial=0))
            block = np.zeros((b.num_rows, dims), np.int64)
            block[np.arange(dims) < lengths[:, None]] = np.asarray(lists.flatten())
            uids = np.asarray(b.column("uid"))
            yield pa.RecordBatch.from_pydict(
                {
                    "first": pa.array([int(uids[0])], pa.int64()),
                    "n": pa.array([b.num_rows], pa.int32()),
                    "dims": pa.array([dims], pa.int32()),
                    "ids": [np.asarray(b.column("id")).tobytes()],
                    "uids": [uids.tobytes()],
                    "weights": [block.astype("<i8").tobytes()],
                }
            )


def _blocks(vectors: DataFrame, size: int) -> DataFrame:
    return vectors.mapInArrow(lambda batches: _pack(batches, size), PACK)


def _arithmetic(q: np.ndarray, x: np.ndarray):
    """The fastest number type in which every inner product of the two blocks is exact."""
    largest = lambda a: max(int(a.max(initial=0)), -int(a.min(initial=0)))
    bound = largest(q) * largest(x) * max(1, q.shape[1])
    return np.float64 if bound < 1 << 52 else np.int64 if bound < 1 << 61 else object


def search_block(q: np.ndarray, x: np.ndarray, own: np.ndarray, ids: np.ndarray, uids: np.ndarray, k: int):
    """For each query (a row of ``q``) positions and scores of the best ``k`` rows of ``x`` by MaxScore.

    Dimensions are ordered by the largest contribution they can make in this shard. The essential ones,
    which hold most of the bound, are traversed for all rows and queries. The k best partial scores,
    completed, give a threshold; the other dimensions are probed in steps only for rows whose partial
    score plus the bound of what is left still reaches it. Rows equal to the threshold stay.
    ``own`` holds each query's own position in the shard, or -1.
    """
    kind = _arithmetic(q, x)
    q, x = q.astype(kind), x.astype(kind)
    top, low = x.max(0, initial=0), x.min(0, initial=0)
    high = np.maximum(q * top, q * low)
    width = (np.maximum(-(q * top), -(q * low)) + high).max(0, initial=0)
    order = np.argsort(-width.astype(float), kind="stable")
    q, x, high = q[:, order], x[:, order], high[:, order]
    left = np.zeros((len(q), q.shape[1] + 1), kind)
    left[:, :-1] = np.cumsum(high[:, ::-1], axis=1)[:, ::-1]
    reach = np.cumsum(width[order].astype(float))
    essential = int(np.searchsorted(reach, 0.7 * reach[-1])) + 1 if len(reach) else 0
    partial = q[:, :essential] @ x[:, :essential].T if essential else np.zeros((len(q), len(x)), kind)
    for i, scores in enumerate(partial):
        rows = np.arange(len(x))
        if own[i] >= 0:
            rows = np.delete(rows, own[i])
        got = scores[rows]
        if len(rows) > k:
            best = rows[np.argpartition(-got.astype(float), k - 1)[:k]]
            least = (scores[best] + x[best, essential:] @ q[i, essential:]).min()
            done = essential
            while True:
                keep = got + left[i, done] >= least
                rows, got = rows[keep], got[keep]
                if done >= q.shape[1]:
                    break
                to = min(done + STEP, q.shape[1])
                got = got + x[rows, done:to] @ q[i, done:to]
                done = to
        else:
            got = got + x[rows, essential:] @ q[i, essential:]
        exact = np.array([max(-MOST - 1, min(MOST, int(s))) for s in got], np.int64)
        first = np.lexsort((uids[rows], ids[rows], -exact.astype(object) if kind is object else -exact))[:k]
        yield rows[first], exact[first]


def _matrix(row: dict, side: str) -> np.ndarray:
    block = np.frombuffer(row[f"{side}_weights"], "<i8")
    return block.reshape(row[f"{side}_n"], row[f"{side}_dims"])


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            q, x = _matrix(row, "q"), _matrix(row, "x")
            dims = min(q.shape[1], x.shape[1])  # what one side lacks counts as zero
            q_ids, q_uids, ids, uids = (np.frombuffer(row[c], "<i8") for c in ("q_ids", "q_uids", "x_ids", "x_uids"))
            place = {u: i for i, u in enumerate(uids.tolist())}
            own = np.array([place.get(u, -1) for u in q_uids.tolist()])
            found = list(search_block(q[:, :dims], x[:, :dims], own, ids, uids, k))
            counts = [len(r) for r, _ in found]
            hit = np.concatenate([r for r, _ in found]) if found else np.zeros(0, np.int64)
            columns = (
                np.repeat(q_uids, counts), np.repeat(q_ids, counts), ids[hit], uids[hit],
                np.concatenate([s for _, s in found]) if found else np.zeros(0, np.int64),
            )
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=HITS)


def top_k(vectors: DataFrame, id_column: str, vector_column: str, is_query: Column, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` rows with the largest inner product, for each query row.

    Components become ``floor(256 * x)``; scores are exact integers (beyond 64 bits they stay at the limit).
    Ties go to the smaller id. Rows are told apart by themselves and not by id: a repeated row is a candidate
    of its copy, and a query given twice is answered twice. Rows with a null id, and vectors that are null or
    hold null, NaN or infinite components, take no part; components that one of two vectors lacks count as
    zero, so an empty vector has score 0 with all. Other columns are ignored; an empty table gives no rows.

    Vectors and queries become blocks of fixed size. Every pair of a query block and a shard is one row, made in memory by a task
    that holds a few query blocks whatever the sizes are; each gives at most ``k`` rows a query, and a window ranks those of all shards.
    """
    own = vectors.select(
        F.col(id_column).cast("long").alias("id"), weights(F.col(vector_column)).alias("w"), is_query.alias("is_query")
    ).where("id IS NOT NULL AND w IS NOT NULL")
    own = stage(numbered(own, "uid"), "vectors")
    shards = stage(_blocks(own.select("uid", "id", "w"), SHARD_ROWS), "shards")
    queries = stage(_blocks(own.where("is_query").select("uid", "id", "w"), QUERY_ROWS), "query-blocks")
    # A join on numbers of pairs would copy a block for each of its pairs first, and a table that is small as a file would be broadcast
    # with all these copies. Here pairs are made in the tasks: a shard's rows pass by the few query blocks that a task holds.
    n_queries = queries.count()
    parts = max(1, min(n_queries, max(math.ceil(n_queries / HELD_BLOCKS), vectors.sparkSession.sparkContext.defaultParallelism)))
    named = lambda df, side: df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns])
    pairs = named(shards, "x").hint("shuffle_replicate_nl").crossJoin(named(queries.repartition(parts), "q"))
    hits = pairs.mapInArrow(lambda batches: _search(batches, k), "query_uid long, query_id long, vec_id long, uid long, score long")
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id", "uid")
    return (
        hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op7_maxscore(spark, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0)


SQL = """
WITH whole AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    CAST(list_sum([q.w[i] * v.w[i] FOR i IN range(1, 1 + len(q.w))]) AS BIGINT) AS score
  FROM whole q JOIN whole v ON v.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 5
"""
