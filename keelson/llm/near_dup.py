"""MinHash near-duplicates: one-permutation hashing, bands, star edges, exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm import textops
from keelson.llm.components import connected_components
from keelson.session import staged, staging

BANDS, ROWS = 32, 6
_ATTEMPTS = np.random.Generator(np.random.PCG64(7)).integers(0, 2**31, (512, 1024))
_BAND = np.random.Generator(np.random.PCG64(11)).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def one_permutation(sets: np.ndarray, offsets: np.ndarray, bins: int) -> np.ndarray:
    """One signature row per set: the smallest hash of each of ``bins`` equal hash ranges.

    An empty bin borrows from the bin that a fixed random sequence of its own names first among
    the filled ones (optimal densification), so two sets borrow alike. Rows of empty sets stay 0.
    """
    n = len(offsets) - 1
    signature = np.zeros((n, bins), dtype=np.uint64)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    cell = owner * bins + (((sets >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.zeros(0, dtype=np.int64)
    filled = np.zeros((n, bins), dtype=bool)
    signature.reshape(-1)[cell[first]] = sets[first]
    filled.reshape(-1)[cell[first]] = True
    row, empty = np.nonzero(~filled & (np.diff(offsets) > 0)[:, None])
    for attempt in _ATTEMPTS:
        if not len(row):
            return signature
        lender = attempt[empty] % bins
        found = filled[row, lender]
        signature[row[found], empty[found]] = signature[row[found], lender[found]]
        row, empty = row[~found], empty[~found]
    for r, e in zip(row, empty):  # a chance of about 1e-3 per set of one shingle: take the next filled bin
        lender = (e + 1 + np.argmax(np.roll(filled[r], -e - 1))) % bins
        signature[r, e] = signature[r, lender]
    return signature


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    cells = signature.reshape(len(signature), bands, rows)
    key = np.zeros((len(signature), bands), dtype=np.uint64)
    for j in range(rows):
        key += cells[:, :, j] * _BAND[j]
    return textops.mix(textops.mix(key) + np.arange(bands, dtype=np.uint64) * _BAND[63]).view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    """(id, n_shingles, two checksums of the set, band keys) in one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.released(batches):
            ids = batch.column(0)
            for low, high, data, offsets in textops.text_runs(batch.column(1)):
                sets, at = textops.shingle_sets(data, offsets)
                n = np.diff(at)
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(sets)))
                other = np.concatenate((np.zeros(1, np.uint64), np.cumsum(textops.mix(sets ^ _BAND[62]))))
                keys = band_keys(one_permutation(sets, at, bands * rows), bands, rows)[n > 0]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(low, high - low), pa.array(n.astype(np.int64)),
                     pa.array((sums[at[1:]] - sums[at[:-1]]).view(np.int64)),
                     pa.array((other[at[1:]] - other[at[:-1]]).view(np.int64)),
                     textops.list_column(keys.reshape(-1), np.concatenate(([0], np.cumsum((n > 0) * bands))))],
                    names=["id", "n_shingles", "sum_a", "sum_b", "keys"])

    schema = "id long, n_shingles long, sum_a long, sum_b long, keys array<long>"
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, schema)


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those with 100 * intersection >= ``percent`` * union on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple = (None, None, None)
        for batch in textops.released(batches):
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            keep = np.zeros(len(a), dtype=bool)
            hub = batch.column(3)
            for low, high, data, offsets in textops.text_runs(batch.column(2)):
                sets, at = textops.shingle_sets(data, offsets)
                for i in range(low, high):
                    if known[0] != b[i] or not hub[i].equals(known[2]):  # rows come sorted by b within a partition
                        one = next(textops.text_runs(hub.slice(i, 1)))
                        known = (b[i], textops.shingle_sets(one[2], one[3])[0], hub[i])
                    mine = sets[at[i - low]:at[i - low + 1]]
                    both = textops.common(mine, known[1])
                    keep[i] = 100 * both >= percent * (len(mine) + len(known[1]) - both)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.hint("shuffle_hash").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _shared(rows: DataFrame) -> DataFrame:
    """The rows (key, id) whose key several ids have, with the number of them."""
    sizes = staged(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    return staged(rows.join(sizes, "key"), "shared-rows")


def _stars(rows: DataFrame, rank: Column) -> DataFrame:
    """(key, id, center): each bucket's rows with the bucket's member of the highest rank."""
    centers = staged(rows.groupBy("key").agg(F.max(F.struct(rank.alias("rank"), (-F.col("id")).alias("id"))).alias("c"))
                     .select("key", (-F.col("c.id")).alias("center")), "centers")
    return rows.select("key", "id").join(centers, "key")


def _shingles(texts: DataFrame) -> DataFrame:
    """(id, component, member, size, shingles): the set of every text, which ``member`` names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.released(batches):
            for low, high, data, offsets in textops.text_runs(batch.column(2)):
                sets, at = textops.shingle_sets(data, offsets)
                own = [batch.column(i).slice(low, high - low) for i in (0, 1, 3)]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(np.diff(at)), textops.list_column(sets.view(np.int64), at)],
                    names=["id", "component", "member", "size", "shingles"])

    rows = texts.select("id", "component", "text", F.xxhash64("id", "text").alias("member"))
    return rows.mapInArrow(run, "id long, component long, member long, size long, shingles array<long>")


def _rest(stars: DataFrame, found: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs that no star has tested, share a bucket's company and may still link two groups.

    A bucket's centre is tested with all its members, so only buckets whose others lie in several groups count.
    With the shingles of their members in ascending order of frequency, two linked sets of size n share one of the first
    n - ceil(t * n) + 1. A shingle of one member alone is shared by none, so a member that has that many of
    those links with nobody and goes. At the first shingle that two sets share, neither may have gone through more than a link
    leaves over. Of the members that share a leading shingle, those of its largest group need not
    meet each other: only the others meet all, and only where sizes allow a link.
    """
    label = found.select(F.col("node").alias("id"), "component")
    others = stars.where("id <> center").select("id", "key").join(label, "id", "left")
    others = others.withColumn("component", F.coalesce("component", "id"))
    open_keys = others.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most")
    open_ids = staged(others.join(open_keys.select("key"), "key", "left_semi").select("id", "component").distinct(), "open-ids")
    rows = staged(_shingles(texts.join(open_ids.hint("shuffle_hash"), "id")), "open-sets").where("size > 0")
    rows = rows.select("id", "component", "member", "size", F.explode("shingles").alias("shingle"))
    often = staged(rows.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1"), "shared-shingles")

    order = F.sort_array(F.collect_list(F.struct("n", "shingle")))  # at most the shingles of one text
    members = rows.join(often, "shingle").groupBy("member").agg(
        F.first("id").alias("id"), F.first("component").alias("component"), F.first("size").alias("size"), order.alias("order"))
    leading = F.col("size") - F.floor((F.col("size") * percent + 99) / 100) + 1 - (F.col("size") - F.size("order"))
    members = members.withColumn("leading", leading.cast("int")).where("leading > 0")
    alone = F.col("size") - F.size("order")  # the shingles of one member alone come first
    heads = staged(members.select("id", "component", "size", alone.alias("alone"), F.posexplode(
        F.slice("order.shingle", F.lit(1), F.col("leading"))).alias("place", "shingle")), "heads")
    heads = heads.withColumn("left", F.col("size") - F.col("alone") - F.col("place")).drop("alone", "place")
    groups = heads.groupBy("shingle", "component").agg(F.count("*").alias("n")).groupBy("shingle").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("groups")).where("groups > 1")
    heads = staged(heads.join(groups.select("shingle", "main"), "shingle"), "open-heads")
    a, b = (heads.select("shingle", "main", F.col("id").alias(x), F.col("component").alias(c), F.col("size").alias(f"size_{x}"),
                         F.col("left").alias(f"left_{x}")) for x, c in (("a", "own"), ("b", "theirs")))
    a = a.where("own <> main").drop("main")
    # At their first common shingle two sets share at most what is left from there on in either.
    near = (100 + percent) * F.least("left_a", "left_b") >= percent * (F.col("size_a") + F.col("size_b"))
    once = (F.col("theirs") == F.col("main")) | (F.col("a") < F.col("b"))
    return a.join(b, "shingle").where((F.col("own") != F.col("theirs")) & once & near).select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80,
    bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """Near-duplicate groups of documents by the Jaccard similarity of five-word shingles.

    Returns one row per row of ``docs``: the id, ``n_shingles``, ``component_id`` (the smallest
    id that links reach) and ``kept`` (the id is that smallest one). Words are runs outside
    ASCII white space, A-Z lower-cased. Documents link when 100 * intersection >= ``percent`` *
    union, checked on the full sets.

    * Equal sets collapse to one representative, the smallest id, before anything is paired.
    * Signatures come from one permutation with ``bands * rows`` bins and optimal densification.
      A pair at similarity s misses all bands with probability (1 - s^rows)^bands: 3e-7 at 0.85.
    * In a bucket only star edges are made: to the member that shares most buckets with others,
      which in a group of edited copies is their origin. So candidate pairs are at most one per
      row and band, however large a group is.
    * The members of buckets that then still span several groups are compared by their rarest shingles
      (a prefix filter, which loses no link), so links do not depend on the choice of centres: a pair is tested
      if it shares one of them, its sizes allow a link and it lies in two groups, of which the largest
      group's members never meet each other.

    NULL, empty and blank texts have no shingle and stay alone; texts under five words are one
    shingle. A NULL id is kept, unlinked. Rows that repeat an id with the same text get the same
    result; of an id with several texts, links of all of them count for the id. Other columns
    are ignored.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sigs = staged(signatures(docs, id_col, text_col, bands, rows), "signatures")
    some = sigs.where("n_shingles > 0 AND id IS NOT NULL")
    same_set = ["n_shingles", "sum_a", "sum_b"]
    classes = staged(some.groupBy(*same_set).agg(F.min("id").alias("rep")), "classes")
    members = some.select("id", *same_set).join(classes, same_set).select("id", "rep").distinct()
    members = staged(members, "members")
    reps = some.join(members.where("id = rep").select("id").distinct(), "id", "left_semi")
    shared = _shared(reps.select("id", F.explode("keys").alias("key")).distinct())

    weight = staged(shared.groupBy("id").agg(F.sum("n").alias("weight")), "weights")
    stars = staged(_stars(shared.join(weight, "id"), F.col("weight")), "stars")
    pairs = staged(stars.select(F.col("id").alias("a"), F.col("center").alias("b")).where("a <> b").distinct(), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    # The ids build the hash tables: texts stream past them and are never sorted. Their copy goes after use.
    with staging(texts.join(wanted.hint("shuffle_hash"), "id", "left_semi").distinct(), "candidates") as candidates:
        links = staged(confirm(pairs, candidates, percent), "links")
        fresh = staged(_rest(stars, connected_components(links), candidates, percent), "pairs")
        links = staged(links.unionByName(confirm(fresh, candidates, percent)), "links")

    # Copies of one set and links between sets make one graph on ids.
    joined = links.unionByName(members.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")))
    final = connected_components(joined)
    result = sigs.select(F.col("id").alias(id_col), "n_shingles").join(
        final.select(F.col("node").alias(id_col), "component"), id_col, "left")
    component = F.coalesce("component", id_col)
    return result.select(id_col, "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col(id_col)).alias("kept"))
