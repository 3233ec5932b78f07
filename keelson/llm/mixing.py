"""Mixing sources to target weights with exact word budgets."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StringType

from keelson.llm.columns import unused
from keelson.session import shuffle_width, staged

WORD = r"[^\x20\x09-\x0D]+"
KEY_DIGITS = 4  # hex digits of the key that name a slice


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), ceiling: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources in code-point order, NULL last, take ``weights`` in turn and share the total size by
    weight. A target stops at ``ceiling`` times its source's size; the excess is shared again by
    weight until no target is above. The end of that process is one water level: with the
    sources in order of ceiling / weight, a prefix is full and the others get the rest by
    weight. Windows run over one row per source, in integers, with one division at the end.
    """
    everything = F.sum("source_size").over(W.partitionBy())
    ordered = sizes.withColumn("_n", F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source"))) - 1)
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), (F.col("_n") % len(weights) + 1).cast("int"))
    ordered = ordered.withColumns({
        "_w": weight, "_cap": F.col("source_size") * ceiling, "_total": everything}).where("_w > 0")
    by_level = W.orderBy(F.col("_cap").cast("double") / F.col("_w"), "_n")
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    level = ordered.withColumns({
        "_left": F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0)),
        "_open": F.sum("_w").over(W.partitionBy()) - F.coalesce(F.sum("_w").over(before), F.lit(0))})
    # A source is full if its ceiling is at most its share of what the sources below it leave over.
    level = level.withColumn("_full", F.col("_cap") * F.col("_open") <= F.col("_w") * F.col("_left"))
    opened = level.withColumn("_first", F.min_by(F.struct("_left", "_open"), F.when(~F.col("_full"), F.struct(
        F.col("_cap").cast("double") / F.col("_w"), "_n"))).over(W.partitionBy()))
    share = F.col("_w").cast("double") * F.col("_first._left") / F.col("_first._open")
    return opened.select("source", "source_size", F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(share).alias("target"))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = (1, 2, 3), ceiling: int = 3, seed: int = 17, row_col: str | None = None,
) -> DataFrame:
    """How many words of each document a mix of sources takes.

    Returns per row of ``docs``: id, ``source``, ``size`` (words), ``source_size``, ``target`` and
    ``taken``, and ``text_hash``. Every source takes exactly the whole part of its target: all of its documents once
    per full epoch, and in the last epoch those whose running total of sizes, in the order of a
    hash of seed and id, stays within what is left; the document on the line gives the words
    that still fit. So ``taken`` is at most ``ceiling`` times ``size``, and reruns agree.

    The running total needs no global sort: keys are uniform hashes, so their first digits cut a
    source into equal slices; totals per slice are summed up first, and each slice is then
    ordered by itself. A hot source is as many tasks as it has slices.

    A NULL text has size 0 and takes nothing, as has any text without words. NULL is a source
    of its own, the last one. Rows that repeat an id count each; equal keys are ordered by
    text hash, and rows equal in both are interchangeable. ``row_col`` names a column that is carried along. If no source has a word, all targets are 0.
    """
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows = staged(docs.select(
        *([F.col(f"`{row_col}`")] if row_col else []), F.col(id_col), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), key.alias("_key"), F.xxhash64(text_col).alias("_tie")), "mix-rows")
    slices = 4 * shuffle_width(docs.sparkSession)
    head = F.conv(F.substring("_key", 1, KEY_DIGITS), 16, 10).cast("long")
    rows = rows.withColumn("_slice", F.floor(head * slices / 16**KEY_DIGITS).cast("int"))

    per_slice = staged(rows.groupBy("source", "_slice").agg(F.sum("size").alias("_in_slice")), "mix-slices")
    targets = source_targets(per_slice.groupBy("source").agg(F.sum("_in_slice").alias("source_size")), weights, ceiling)
    before = F.sum("_in_slice").over(W.partitionBy("source").orderBy("_slice")) - F.col("_in_slice")
    offsets = per_slice.withColumn("_before", before).join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    offsets = staged(offsets.select("_s", F.col("_slice").alias("_at"), "_before", "source_size", "target"), "mix-offsets")

    inner = W.partitionBy("source", "_slice").orderBy("_key", id_col, "_tie")
    running = rows.withColumn("_in", F.sum("size").over(inner.rowsBetween(W.unboundedPreceding, -1)))
    placed = running.join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_slice") == F.col("_at")))
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    left = budget - epochs * F.col("source_size") - F.col("_before") - F.coalesce("_in", F.lit(0))
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return placed.select(
        *([F.col(f"`{row_col}`")] if row_col else []), id_col, "source", "size", "source_size", "target", taken.cast("long").alias("taken"), F.col("_tie").alias("text_hash"))


def _first_words(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for column, counts in texts:
        out = []
        for text, n in zip(column.to_pylist(), counts.to_pylist()):
            ends = (m.end() for m in re.finditer(WORD, text or ""))
            out.append(None if text is None or n is None else text[:next(itertools.islice(ends, max(n - 1, 0), None), 0) if n else 0])
        yield pa.array(out, pa.string())


first_words = F.arrow_udf(_first_words, StringType())


def take_mix(
    docs: DataFrame, mix: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None,
) -> DataFrame:
    """The documents of a mix: a row per started epoch of a document, the columns those of ``docs``.

    In the last epoch a document on its source's line is cut after the words that fit. ``mix`` is the result of
    :func:`mix_sources` on the same rows. With ``row_col``, a column that numbers the rows in both, each row
    takes its own share. Without, rows that are equal in id, source and text are numbered on both sides in one window per
    group of them; as they are interchangeable it does not matter which takes which share.
    """
    row, size, taken, copy, text_hash, nth, source, key = unused(docs.columns, "row", "size", "taken", "copy", "hash", "nth", "source", "key")
    part = mix.where("taken > 0")
    if row_col:
        part = part.select(F.col(f"`{row_col}`").alias(row), F.col("size").alias(size), F.col("taken").alias(taken))
        rows = docs.join(part.hint("shuffle_hash"), F.col(f"`{row_col}`") == F.col(row))
    else:
        number = F.row_number().over(W.partitionBy(id_col, "source", "text_hash").orderBy(F.desc("taken")))
        part = part.select(F.col(id_col).alias(key), F.col("source").alias(source), F.col("text_hash").alias(text_hash),
                           F.col("size").alias(size), F.col("taken").alias(taken), number.alias(row))
        rows = docs.withColumn(text_hash + "_", F.xxhash64(text_col))
        rows = rows.withColumn(nth, F.row_number().over(W.partitionBy(id_col, source_col, text_hash + "_").orderBy(F.lit(0))))
        rows = rows.join(part.hint("shuffle_hash"), (
            F.col(id_col).eqNullSafe(F.col(key)) & F.col(source_col).eqNullSafe(F.col(source)) & (F.col(text_hash + "_") == F.col(text_hash))
            & (F.col(nth) == F.col(row))))
    copies = rows.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col(taken) / F.col(size)).cast("long"))))
    rest = F.col(taken) - (F.col(copy) - 1) * F.col(size)
    cut = first_words(F.when(rest < F.col(size), F.col(text_col)), F.when(rest < F.col(size), rest))
    return copies.withColumn(text_col, F.coalesce(cut, F.col(text_col))).select(*[F.col(f"`{c}`") for c in docs.columns])


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """:func:`mix_sources` and :func:`take_mix` in one: the documents that a mix takes, as often as it takes them.

    Rows are numbered and stored first, so rows that repeat an id or a text take a share each, however many they are.
    """
    row, = unused(docs.columns, "row")
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "mix-documents")
    names = {k: v for k, v in settings.items() if k in ("id_col", "text_col", "source_col")}
    return take_mix(rows, mix_sources(rows, row_col=row, **settings), row_col=row, **names).drop(row)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, md5('17|' || doc_id::varchar) AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
o AS (SELECT *, ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::BIGINT AS w,
             row_number() OVER (ORDER BY source IS NULL, source) AS n, 3 * source_size AS cap,
             (sum(source_size) OVER ())::BIGINT AS total FROM s),
l AS (SELECT *, cap::DOUBLE / w AS lev,
             (total - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS rest,
             (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap::DOUBLE / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS open
      FROM o),
f AS (SELECT rest AS rest1, open AS open1 FROM l WHERE cap * open > w * rest ORDER BY lev, n LIMIT 1),
t AS (SELECT source, source_size,
             CASE WHEN cap * open <= w * rest THEN cap::DOUBLE ELSE w::DOUBLE * rest1 / open1 END AS target
      FROM l LEFT JOIN f ON true),
r AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
             (sum(d.size) OVER (PARTITION BY d.source ORDER BY k, doc_id) - d.size)::BIGINT AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + greatest(0, least(size, budget % source_size - before)) END::BIGINT AS taken
FROM r
"""
