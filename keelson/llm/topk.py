"""Exact top-k inner-product search with a three-phase uniform threshold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from keelson.llm import textops
from keelson.session import shuffle_width, staged

LISTS = 2
CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 512


def quantise(vector: Column, factor: int = 1024) -> Column:
    """floor(factor * x) per component as longs; NULL for a vector that is NULL or holds a NULL, NaN or
    infinite component."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")).cast("long"))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return F.when(vector.isNotNull() & ~bad, whole)


def _blocks(rows: DataFrame, size: int, extra: str | None = None) -> DataFrame:
    """Rows (id, v) packed into blocks (block, ids, values) of at most ``size`` rows, inside their partitions.

    ``values`` is the flat list of components; ``extra`` names one more long column to carry.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.released(batches):
            for low in range(0, len(batch), size):
                part = batch.slice(low, size)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                values = part.column(1).flatten().to_numpy(zero_copy_only=False)
                more = part.column(2).to_numpy(zero_copy_only=False) if extra else ids[:0]
                # A block's name is drawn from its content, so a retried task names it alike.
                name = int(np.bitwise_xor.reduce((ids + 1) * np.int64(0x9E3779B97F4A7C1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name], pa.int64()), *(textops.list_column(x, np.array([0, len(x)])) for x in (ids, values, more))],
                    names=["block", "ids", "values", "extra"])

    schema = "block long, ids array<long>, `values` array<long>, extra array<long>"
    return rows.select("id", "v", *([extra] if extra else [])).mapInArrow(run, schema)


def _cells(queries: DataFrame, candidates: DataFrame, salts: int) -> DataFrame:
    """Every block of queries beside every block of candidates, spread over the cluster.

    Candidate blocks fall into ``salts`` groups by name; a block of queries is copied once per
    group and meets the group in one equi-join, so a candidate block is copied once per query block.
    """
    q = queries.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).select(
        "salt", F.col("ids").alias("q_ids"), F.col("values").alias("q_values"), F.col("extra").alias("q_cut"))
    c = candidates.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int")).select("salt", "ids", "values")
    return c.join(q, "salt").select("q_ids", "q_values", "q_cut", "ids", "values")


def _parts(q_ids, q_values, ids, values, lists: int) -> np.ndarray:
    """Partial scores (lists x queries x candidates): list j sums the components of slice j.

    Components up to 2^20 in size give exact sums in doubles; larger ones take integer products.
    """
    q, c = q_values.reshape(len(q_ids), -1), values.reshape(len(ids), -1)
    kind = np.float64 if max(np.abs(q).max(initial=0), np.abs(c).max(initial=0)) < 2**20 else np.int64
    edges = np.linspace(0, q.shape[1], lists + 1).astype(int)
    return np.stack([(q[:, a:b].astype(kind) @ c[:, a:b].T.astype(kind)).astype(np.int64) for a, b in zip(edges, edges[1:])])


def _cell_rows(batches, lists):
    for batch in textops.released(batches):
        for i in range(len(batch)):
            q_ids, q_values, q_cut, ids, values = (batch.column(j)[i].values.to_numpy(zero_copy_only=False) for j in range(5))
            for low in range(0, len(q_ids), QUERY_BLOCK):  # at most QUERY_BLOCK x CANDIDATE_BLOCK scores at a time
                high = min(low + QUERY_BLOCK, len(q_ids))
                width = len(q_values) // len(q_ids)
                yield q_ids[low:high], q_cut[low:high], ids, _parts(q_ids[low:high], q_values[low * width:high * width], ids, values, lists)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    return np.argpartition(-scores, k - 1)[:k] if len(scores) > k else np.arange(len(scores))


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    factor: int = 1024, lists: int = LISTS,
) -> DataFrame:
    """The ``k`` highest inner products of every query with all other rows, exactly.

    Components become floor(``factor`` * x). Returns ``query_id, rank`` (from 1), ``vec_id, score``; ties go
    to the smaller id; a query with fewer candidates returns all of them.

    A score is the sum of ``lists`` partial scores, one per slice of components. Phase 1 takes the k
    best of every list per query and block of candidates; the k-th best total among them is a
    safe cutoff. Phase 2 sends, from each list, all entries of at least cutoff / ``lists``: a row
    that no list sends has a total below the cutoff. Phase 3 drops rows whose sum cannot reach
    the cutoff even if every list that did not send them is just below its bound, and
    computes the totals of the rest from their vectors.

    Of rows with equal vectors only the k + 1 smallest ids can be in any result, so the others go
    first; windows cut each task's share of a large group before the shuffle. Queries and
    candidates meet block by block, so the work is queries x rows, as the task asks.

    Vectors that are NULL or hold NULL or non-finite components take no part, neither do NULL
    ids or vectors of another length than the most common one. Rows that repeat an id are one
    row, that of the smallest vector.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantise(F.col(vector_col), factor).alias("v"), is_query.alias("q"))
    rows = rows.where("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    rows = rows.groupBy("id").agg(F.min("v").alias("v"), F.max("q").alias("q"))
    rows = staged(rows, "vectors")
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not length:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = rows.where(F.size("v") == length[0].n)
    same = W.partitionBy("v").orderBy("id")
    candidates = staged(rows.withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1).select("id", "v"), "candidates")
    width = shuffle_width(spark)
    blocks = staged(_blocks(candidates, CANDIDATE_BLOCK), "candidate-blocks")
    queries = rows.where("q").select("id", "v")

    def phase1(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q_ids, _, ids, parts in _cell_rows(batches, lists):
            totals = parts.sum(axis=0)
            out_q, out_c, out_t = [], [], []
            for i, q in enumerate(q_ids):
                other = np.flatnonzero(ids != q)
                top = np.unique(np.concatenate([other[_best(p[i, other], k)] for p in parts]))
                top = top[_best(totals[i, top], k)]
                out_q.append(np.full(len(top), q)), out_c.append(ids[top]), out_t.append(totals[i, top])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_q, out_c, out_t)], names=["query_id", "vec_id", "score"])

    def phase2(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q_ids, cut, ids, parts in _cell_rows(batches, lists):
            sent = (parts * lists >= cut[None, :, None]) & (q_ids[:, None] != ids[None, :])[None]
            j, i, c = np.nonzero(sent)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q_ids[i]), pa.array(ids[c]), pa.array(parts[j, i, c])], names=["query_id", "vec_id", "part"])

    first = _cells(_blocks(queries.withColumn("cut", F.lit(0).cast("long")), QUERY_BLOCK, "cut"), blocks, width)
    gathered = first.mapInArrow(phase1, "query_id long, vec_id long, score long")
    ranked = gathered.withColumn("n", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score")))).where(F.col("n") <= k)
    cutoffs = staged(ranked.groupBy("query_id").agg(
        F.when(F.count("*") == k, F.min("score")).otherwise(F.lit(-(2**62))).alias("cut")), "cutoffs")

    bounded = queries.join(cutoffs, queries.id == cutoffs.query_id).select("id", "v", "cut")
    second = _cells(_blocks(bounded, QUERY_BLOCK, "cut"), blocks, width)
    entries = second.mapInArrow(phase2, "query_id long, vec_id long, part long")
    seen = entries.groupBy("query_id", "vec_id").agg(F.sum("part").alias("sum"), F.count("*").alias("lists")).join(cutoffs, "query_id")
    # An unsent partial score is an integer below cut / lists.
    unsent = F.ceil(F.col("cut").cast("decimal(20,0)") / lists).cast("long") - 1
    open_ = seen.where((F.col("lists") == lists) | (F.col("sum") + (lists - F.col("lists")) * unsent >= F.col("cut")))
    open_ = staged(open_.select("query_id", "vec_id", "sum", "lists"), "open")

    complete = open_.where(F.col("lists") == lists).select("query_id", "vec_id", F.col("sum").alias("score"))
    partial = open_.where(F.col("lists") < lists).select("query_id", "vec_id")
    partial = partial.join(rows.select(F.col("id").alias("vec_id"), F.col("v").alias("a")), "vec_id").join(
        queries.select(F.col("id").alias("query_id"), F.col("v").alias("b")), "query_id")
    dot = F.aggregate(F.zip_with("a", "b", lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)
    scored = complete.unionByName(partial.select("query_id", "vec_id", dot.alias("score")))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
"""
