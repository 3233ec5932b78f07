"""Hard-negative mining over an inverted multi-index with certified windows."""

from __future__ import annotations

import functools
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from keelson.llm import textops
from keelson.llm.topk import quantise
from keelson.session import staged

CENTROIDS = 16
SAMPLE_ROWS = 4096
BLOCK = 2048
ANCHOR_BLOCK = 256
FIRST_CELLS, GROWTH = 16, 4
HIT = "id long, slot int, vec_id long, score long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
Score = Callable[..., tuple[np.ndarray, np.ndarray, np.ndarray]]  # rows, slots and columns of the picked scores


def codebook(points: np.ndarray, n: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """At most ``n`` centroids of the points (Lloyd's method from distinct random starts)."""
    distinct = np.unique(points, axis=0)
    random = np.random.Generator(np.random.PCG64(seed))
    centers = distinct[np.sort(random.permutation(len(distinct))[:n])]
    for _ in range(rounds):
        own = nearest(points, centers)[0]
        for j in range(len(centers)):
            if (own == j).any():
                centers[j] = points[own == j].mean(axis=0)
    return centers


def nearest(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each point and the distance to it."""
    scores = points @ centers.T - 0.5 * (centers * centers).sum(axis=1)
    own = scores.argmax(axis=1)
    return own, np.linalg.norm(points - centers[own], axis=1)


def half_bounds(half: np.ndarray, centers: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """An upper bound of the half score with any row of each half-space cell: centroid score plus norm times
    radius, and a margin for rounding."""
    norm = np.linalg.norm(half)
    reach = norm * (np.linalg.norm(centers, axis=1) + radii)
    return centers @ half + norm * radii + 1e-9 * reach + 1e-6


def multi_sequence(one: np.ndarray, two: np.ndarray, filled: np.ndarray) -> Iterator[tuple[float, int]]:
    """(bound, cell) of the filled cells in descending order of ``one[i] + two[j]``.

    The heap holds the front of the pairs of both sorted lists: a pair enters when its left and its upper
    neighbour have left, so it never holds more than min(len(one), len(two)) entries.
    """
    a, b = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
    x, y = one[a].tolist(), two[b].tolist()
    a, b = a.tolist(), b.tolist()
    width, reached = len(b), [0] * len(a)  # pairs that row i has given so far
    heap = [(-(x[0] + y[0]), 0, 0)] if a and b else []
    while heap:
        bound, i, j = heapq.heappop(heap)
        reached[i] = j + 1
        cell = a[i] * width + b[j]
        if filled[cell]:
            yield -bound, cell
        if j + 1 < width and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if i + 1 < len(a) and reached[i + 1] == j:
            heapq.heappush(heap, (-(x[i + 1] + y[j]), i + 1, j))


class MultiIndex:
    """Two half-space codebooks with radii, and the stored rows of each cell in blocks (cell, part, ids, labels, values)."""

    def __init__(self, rows: DataFrame, width: int, centroids: int, sample_rows: int) -> None:
        self.width, self.half = width, width // 2
        some = rows.orderBy(F.xxhash64("id")).limit(sample_rows).select("v").collect()
        points = np.array([r.v for r in some], dtype=np.float64).reshape(len(some), width)
        self.books = [codebook(points[:, :self.half], centroids), codebook(points[:, self.half:], centroids)]
        wide = len(self.books[1])
        placed = staged(rows.select("id", "label", "v").mapInArrow(
            self._place, "id long, label long, v array<long>, cell int, near_one double, near_two double"), "placed")
        self.radii = [np.zeros(len(b)) for b in self.books]
        self.filled = np.zeros(len(self.books[0]) * wide, dtype=bool)
        parts = np.ones(len(self.filled), dtype=int)
        cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("near_one").alias("one"), F.max("near_two").alias("two"))
        for r in cells.collect():  # a row per cell: at most centroids squared
            self.filled[r.cell], parts[r.cell] = True, -(-r.n // BLOCK)
            i, j = divmod(r.cell, wide)
            self.radii[0][i], self.radii[1][j] = max(self.radii[0][i], r.one), max(self.radii[1][j], r.two)
        self.parts = parts.tolist()
        count = F.element_at(F.array(*map(F.lit, self.parts)), F.col("cell") + 1)
        rows_of = F.sort_array(F.collect_list(F.struct("id", "label", "v")))
        blocks = placed.withColumn("part", F.pmod(F.xxhash64("id"), count).cast("int")).groupBy("cell", "part").agg(rows_of.alias("r"))
        self.blocks = staged(blocks.select(
            "cell", "part", F.col("r.id").alias("ids"), F.col("r.label").alias("labels"), F.flatten("r.v").alias("values")), "cells")

    def __getstate__(self) -> dict:
        """What tasks need: all but the frame of blocks."""
        return {k: v for k, v in self.__dict__.items() if k != "blocks"}

    def _place(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.released(batches):
            v = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(batch), self.width)
            (i, one), (j, two) = (nearest(h, b) for h, b in zip((v[:, :self.half], v[:, self.half:]), self.books))
            cell = (i * len(self.books[1]) + j).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(one), pa.array(two)], names=["id", "label", "v", "cell", "near_one", "near_two"])

    def visits(self, v: np.ndarray, start: int, stop: int) -> tuple[list[int], float]:
        """The cells number ``start`` to ``stop`` that a row visits and the bound of all later ones."""
        halves = (v[:self.half], v[self.half:])
        one, two = (half_bounds(h, b, r) for h, b, r in zip(halves, self.books, self.radii))
        cells, bound = [], float("-inf")
        for n, (reach, cell) in enumerate(multi_sequence(one, two, self.filled)):
            if n >= stop:
                bound = reach
                break
            if n >= start:
                cells.append(cell)
        return cells, bound

    def bounds(self, anchors: DataFrame, stop: int) -> DataFrame:
        """(id, bound): no row of an anchor's cells from number ``stop`` on scores above the bound."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                v = batch.column(1).flatten().to_numpy().reshape(len(batch), self.width).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([self.visits(x, stop, stop)[1] for x in v], pa.float64())], names=["id", "bound"])

        return anchors.select("id", "v").mapInArrow(run, "id long, bound double")

    def meet(self, anchors: DataFrame, start: int, stop: int, score: Score) -> DataFrame:
        """(id, slot, vec_id, score): what ``score`` picks for every anchor in each block of its cells number
        ``start`` to ``stop``. An anchor's row goes once to every block of these cells."""
        kind = pa.list_(pa.int64())
        arrow = pa.schema([("cell", pa.int32()), ("part", pa.int32()), ("a_ids", kind), ("a_labels", kind), ("a_values", kind),
                           ("a_scores", pa.list_(kind))])

        def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for low in range(0, len(batch), ANCHOR_BLOCK):
                    some = batch.slice(low, ANCHOR_BLOCK)
                    ids, labels = some.column(0).to_numpy(), some.column(1).to_numpy()
                    v = some.column(2).flatten().to_numpy().reshape(len(some), self.width)
                    scores, guests = some.column(3).to_pylist(), {}
                    for n in range(len(some)):
                        for c in self.visits(v[n].astype(np.float64), start, stop)[0]:
                            guests.setdefault(c, []).append(n)
                    rows = [(c, p, ids[g], labels[g], v[g].reshape(-1), [scores[n] for n in g])
                            for c, g in guests.items() for p in range(self.parts[c])]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*rows), arrow)], schema=arrow)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in textops.released(batches):
                for i in range(len(batch)):
                    a_ids, a_labels, a_values, ids, labels, values = (
                        batch.column(n)[i].values.to_numpy(zero_copy_only=False) for n in range(6))
                    q, c = a_values.reshape(len(a_ids), -1), values.reshape(len(ids), -1)
                    # Doubles give exact sums of components up to 2^20, larger ones take integer products.
                    kind = np.float64 if max(np.abs(q).max(initial=0), np.abs(c).max(initial=0)) < 2**20 else np.int64
                    table = (q.astype(kind) @ c.astype(kind).T).astype(np.int64)
                    row, slot, col = score(table, a_ids, a_labels, batch.column(6)[i].as_py(), ids, labels)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a_ids[row]), pa.array(slot.astype(np.int32)), pa.array(ids[col]), pa.array(table[row, col])],
                        names=["id", "slot", "vec_id", "score"])

        wanted = anchors.select("id", "label", "v", "scores").mapInArrow(plan, (
            "cell int, part int, a_ids array<long>, a_labels array<long>, a_values array<long>, a_scores array<array<long>>"))
        pairs = wanted.join(self.blocks.hint("shuffle_hash"), ["cell", "part"])  # anchors stream past a cell's rows
        return pairs.select("a_ids", "a_labels", "a_values", "ids", "labels", "values", "a_scores").mapInArrow(run, HIT)


def _ranked(table: np.ndarray, able: np.ndarray) -> np.ndarray:
    """Per row the columns by descending score, those not ``able`` last; equal scores keep their order, that of ids."""
    return np.argsort(~np.where(able, table, np.iinfo(np.int64).min), axis=1, kind="stable")


def same_label(k: int) -> Score:
    """The best k other rows of an anchor's label."""

    def score(table, a_ids, a_labels, _, ids, labels):
        able = (a_labels[:, None] == labels) & (a_ids[:, None] != ids)
        order = _ranked(table, able)[:, :k]
        row, place = np.nonzero(np.arange(order.shape[1]) < able.sum(axis=1)[:, None])
        return row, np.zeros(len(row), dtype=np.int32), order[row, place]

    return score


def in_windows(k: int, low: int, high: int) -> Score:
    """Per positive score p (a slot) the best k rows s of another label with low * p <= 100 * s <= high * p."""

    def score(table, a_ids, a_labels, wanted, ids, labels):
        able = a_labels[:, None] != labels
        order, n = _ranked(table, able), able.sum(axis=1)
        ranked, valid = 100 * np.take_along_axis(table, order, axis=1), np.arange(len(ids)) < n[:, None]
        out = [(np.zeros(0, dtype=np.int64),) * 3]
        for slot in range(max(map(len, wanted), default=0)):
            has = np.array([len(w) > slot for w in wanted])
            goal = np.array([w[slot] if len(w) > slot else 0 for w in wanted], dtype=np.int64)
            first = (valid & (ranked > high * goal[:, None])).sum(axis=1)
            for place in (first + j for j in range(k)):
                row = np.flatnonzero(has & (place < n))
                row = row[ranked[row, place[row]] >= low * goal[row]]
                out.append((row, np.full(len(row), slot), order[row, place[row]]))
        return tuple(np.concatenate(x) for x in zip(*out))

    return score


def _search(index: MultiIndex, anchors: DataFrame, k: int, score: Score, closed: Callable[[Column], Column]) -> DataFrame:
    """(id, slot, rank, vec_id, score): the k best of every slot, in rounds over ever more cells.

    ``closed(best)`` says of a row (id, scores, bound) and the entries (n, worst) of its slots whether no
    later cell can change them. Anchors leave as soon as it holds.
    """
    best = W.partitionBy("id", "slot").orderBy(F.desc("score"), "vec_id")
    waiting, held, done = staged(anchors, "anchors"), None, []
    start, stop, last = 0, FIRST_CELLS, int(index.filled.sum())
    while not waiting.isEmpty():
        hits = index.meet(waiting, start, stop, score)
        hits = hits.unionByName(held) if held is not None else hits
        top = staged(hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "top")
        slots = top.groupBy("id", "slot").agg(F.count("*").alias("n"), F.min("score").alias("worst")).groupBy("id").agg(
            F.map_from_entries(F.collect_list(F.struct("slot", F.struct("n", "worst")))).alias("slots"))  # few slots per anchor
        state = waiting.join(index.bounds(waiting, stop), "id").join(slots, "id", "left")
        state = staged(state.withColumn("closed", F.coalesce(closed(F.col("slots")), F.lit(False)) | F.lit(stop >= last)), "anchors")
        done.append(top.join(state.where("closed").select("id"), "id", "left_semi"))
        waiting = state.where("NOT closed").select(anchors.columns)
        held = top.join(waiting.select("id"), "id", "left_semi").drop("rank")
        start, stop = stop, stop * GROWTH
    return functools.reduce(DataFrame.unionByName, done) if done else anchors.sparkSession.createDataFrame([], HIT + ", rank int")


def mine_hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", factor: int = 256,
    centroids: int = CENTROIDS, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Hard negatives of every anchor and positive, exactly: ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``.

    Components become floor(``factor`` * x); a score is the integer inner product with the anchor, higher
    first, ties to the smaller id. The positives of an anchor are its best ``positives`` other rows of
    its label. Negatives are the best ``negatives`` rows of other labels whose score is from ``low`` to ``high``
    per cent of the positive's (so none beside a negative positive score). Fewer are returned where there are fewer.

    The rows lie in the cells of two codebooks, one per half of the vector, that are fitted on ``sample_rows``
    rows (the least hashes of ids) and have at most ``centroids`` entries each; every row is indexed. An anchor visits
    cells in descending order of the sum of its two half bounds (centroid score plus norm times the radius
    of all rows there), which a heap over the two sorted lists yields. It stops once no later cell can change
    its result: k rows score above the next bound, or the bound is below the window. The
    codebooks so decide how much is read, never what is found.

    Rounds visit 16, then 48, then 192 ... cells. In a round an anchor is sent to the blocks of its cells (at most
    ``BLOCK`` rows on average, however full a cell is); blocks answer with their best k and windows keep the best of all.
    Of rows with equal vector and label only the smallest ids can be in any result, so the others go first.

    NULL ids, labels or vectors and vectors with NULL or non-finite components take no part. Vectors of
    different lengths raise ValueError. Rows that repeat an id are one row, that of the smallest vector and
    label. Labels are whole numbers. An empty table gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
        quantise(F.col(f"`{vector_col}`"), factor).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor")).dropna()
    rows = rows.groupBy("id").agg(F.min(F.struct("v", "label")).alias("r"), F.max("anchor").alias("anchor"))
    rows = staged(rows.select("id", "r.label", "r.v", "anchor"), "vectors")
    size = rows.agg(F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most")).first()
    if size.least is None:
        return spark.createDataFrame([], RESULT)
    if size.least != size.most:
        raise ValueError(f"vectors of {size.least} and of {size.most} components")
    same = W.partitionBy("v", "label").orderBy("id")
    able = rows.withColumn("n", F.row_number().over(same)).where(F.col("n") <= max(positives + 1, negatives)).select("id", "label", "v")
    index = MultiIndex(staged(able, "candidates"), size.least, centroids, sample_rows)

    anchors = rows.where("anchor").select("id", "label", "v", F.array().cast("array<long>").alias("scores"))
    first = F.element_at
    found = _search(index, anchors, positives, same_label(positives), lambda slots: (
        (first(slots, 0)["n"] == positives) & (first(slots, 0)["worst"] > F.col("bound"))))
    found = staged(found.select("id", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # Slot s of an anchor is its positive of rank s + 1; a negative score has an empty window.
    scores = found.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", "positive_score")))["positive_score"].alias("scores"))
    anchors = anchors.drop("scores").join(scores, "id").where(F.exists("scores", lambda p: p >= 0)).select("id", "label", "v", "scores")

    def windows_closed(slots: Column) -> Column:
        def settled(score: Column, place: Column) -> Column:
            own = first(slots, place)
            full = F.coalesce((own["n"] == negatives) & (own["worst"] > F.col("bound")), F.lit(False))
            return full | (F.col("bound") * 100 < score * low) | (score < 0)

        return F.forall(F.transform("scores", settled), lambda x: x)

    mined = _search(index, anchors, negatives, in_windows(negatives, low, high), windows_closed)
    mined = mined.select("id", (F.col("slot") + 1).alias("place"), F.col("rank").alias("nth"), "vec_id", "score")
    both = found.join(mined, (found.id == mined.id) & (found["rank"] == mined.place)).drop(mined.id)
    return both.select(
        F.col("id").alias("anchor_id"), "positive_id", F.col("nth").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


ORACLE = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
             list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank
      FROM p JOIN s USING (anchor_id)
      WHERE NOT same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
