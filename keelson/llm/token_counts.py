"""Token counts that follow edits: segment trees over pre-token runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm import textops
from keelson.llm.token_files import text_encoder
from keelson.session import staged

LEAF = 256
TREE = "struct<leaf_chars: array<long>, sums: array<long>>"
_ARROW_TREE = pa.struct([("leaf_chars", pa.list_(pa.int64())), ("sums", pa.list_(pa.int64()))])


def cut(text: str, size: int = LEAF) -> list[int]:
    """Lengths of the leaves of a text: at least ``size`` characters each but for the last one.

    A leaf begins at a space with no white space before it. A pre-token never runs over such a
    place and what stands on one side of it does not change the pre-tokens of the other.
    """
    lengths, begin = [], 0
    while True:
        at = text.find(" ", begin + size)
        while at > 0 and text[at - 1].isspace():
            at = text.find(" ", at + 1)
        if at < 0:
            return [*lengths, len(text) - begin]
        lengths.append(at - begin)
        begin = at


def sums_of(counts: list[int]) -> list[int]:
    """The implicit tree: node 1 is the root, node i has children 2i and 2i + 1, leaves begin at half."""
    half = 1 << max(0, len(counts) - 1).bit_length()
    sums = [0] * half + counts + [0] * (half - len(counts))
    for i in range(half - 1, 0, -1):
        sums[i] = sums[2 * i] + sums[2 * i + 1]
    return sums


def leaves_of(text: str, size: int = LEAF) -> list[int]:
    """Lengths of the leaves of a renewed stretch: one leaf below twice ``size``, else leaves as :func:`cut` makes them, without
    a short one at the end."""
    if len(text) < 2 * size:
        return [len(text)]
    lengths = cut(text, size)
    if len(lengths) > 1 and lengths[-1] < size:
        lengths[-2:] = [lengths[-2] + lengths[-1]]
    return lengths


def edited(
    text: str, leaf_chars: list[int], sums: list[int], edits: list[tuple[int, int, str]], count, size: int = LEAF,
) -> tuple[str, list[int], list[int], int]:
    """Apply edits (start, removed characters, inserted text) to a text and its tree.

    Positions refer to the text before all edits. Returns the new text, the new tree and how
    many characters were encoded again: the leaves that an edit touches, with the character
    before and after it as context, nothing else. A stretch that has grown is split into leaves again, so leaves stay
    short however many edits follow each other. Where the number of leaves stays, only the sums above the renewed ones change;
    else the tree is put together anew from the leaves' counts.
    """
    n, clean, done = len(text), [], 0
    for start, removed, insert in sorted(edits, key=lambda e: (e[0], e[1])):
        begin = min(max(start, done), n)
        stop = min(max(start + max(removed, 0), begin), n)
        clean.append((begin, stop, insert))
        done = stop
    leaf_chars, sums = list(leaf_chars), list(sums)
    bounds = np.concatenate(([0], np.cumsum(leaf_chars)))
    groups: list[list] = []  # first leaf, last leaf, edits
    for begin, stop, insert in clean:
        low = int(np.searchsorted(bounds, max(begin - 1, 0), side="right")) - 1
        high = int(np.searchsorted(bounds, min(stop, max(n - 1, 0)), side="right")) - 1
        low, high = min(low, len(leaf_chars) - 1), min(high, len(leaf_chars) - 1)
        if groups and low <= groups[-1][1]:
            groups[-1][1] = max(groups[-1][1], high)
            groups[-1][2].append((begin, stop, insert))
        else:
            groups.append([low, high, [(begin, stop, insert)]])
    pieces, at, encoded, half, renewals = [], 0, 0, len(sums) // 2, []
    for low, high, own in groups:
        begin, end = int(bounds[low]), int(bounds[high + 1])
        parts, inner = [], begin
        for a, b, insert in own:
            parts += [text[inner:a], insert]
            inner = b
        renewed = "".join([*parts, text[inner:end]])
        pieces += [text[at:begin], renewed]
        at = end
        encoded += len(renewed)
        lengths, counts, place = leaves_of(renewed, size), [], 0
        for length in lengths:
            counts.append(count(renewed[place:place + length]))
            place += length
        spare = [0] * (high - low + 1 - len(lengths))  # leaves without text keep the others in their places
        renewals.append((low, high, lengths + spare, counts + spare))
    if all(len(lengths) == high - low + 1 for low, high, lengths, _ in renewals):
        for low, high, lengths, counts in renewals:
            for leaf, length, new in zip(range(low, high + 1), lengths, counts):
                leaf_chars[leaf], node = length, half + leaf
                change = new - sums[node]
                while node and change:
                    sums[node] += change
                    node //= 2
    else:
        counts_now = sums[half:half + len(leaf_chars)]
        for low, high, lengths, counts in reversed(renewals):
            leaf_chars[low:high + 1], counts_now[low:high + 1] = lengths, counts
        both = [(c, k) for c, k in zip(leaf_chars, counts_now) if c] or [(0, 0)]
        leaf_chars, sums = [c for c, _ in both], sums_of([k for _, k in both])
    return "".join([*pieces, text[at:]]), leaf_chars, sums, encoded


def count_tree(text: Column, tokenizer: str) -> Column:
    """The segment tree of a text's token counts; its root, ``sums[1]``, is the count of the whole text.

    A NULL or empty text has one empty leaf.
    """
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = text_encoder(tokenizer)
        for texts in textops.released(batches):
            out = []
            for text in texts.to_pylist():
                lengths, leaves, at = cut(text or ""), [], 0
                for size in lengths:
                    leaves.append((text or "")[at:at + size])
                    at += size
                out.append({"leaf_chars": lengths, "sums": sums_of([len(ids) // 2 for ids in encoder.batch(leaves)])})
            yield pa.array(out, _ARROW_TREE)

    return F.arrow_udf(run, TREE)(text.cast("string"))


def apply_edits(text: Column, tree: Column, edits: Column, tokenizer: str) -> Column:
    """A struct of the edited ``text``, its ``tree`` and ``encoded_chars``, the characters encoded again.

    ``edits`` is an array of structs (start, removed, inserted); positions are code points of the text
    before all edits. They are clipped to the text; what an earlier edit of the row has removed is
    not removed twice. NULL edits, starts or texts to insert change nothing.
    """
    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        encoder = text_encoder(tokenizer)
        for texts, trees, changes in textops.released(batches):
            out = []
            for t, tree, change in zip(texts.to_pylist(), trees.to_pylist(), changes.to_pylist()):
                steps = [(e["start"], e["removed"] or 0, e["inserted"] or "") for e in change or [] if e and e["start"] is not None]
                new, lengths, sums, encoded = edited(t or "", tree["leaf_chars"], tree["sums"], steps, lambda x: len(encoder(x)) // 2)
                out.append({"text": new, "tree": {"leaf_chars": lengths, "sums": sums}, "encoded_chars": encoded})
            yield pa.array(out, pa.struct([("text", pa.string()), ("tree", _ARROW_TREE), ("encoded_chars", pa.int64())]))

    return F.arrow_udf(run, f"struct<text: string, tree: {TREE}, encoded_chars: long>")(text.cast("string"), tree, edits)


def attach_edits(docs: DataFrame, edits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with the array ``edits`` from a table (id, start, removed, inserted). The edits of a document
    are part of its row, as its text is."""
    own = edits.groupBy(id_col).agg(F.collect_list(F.struct("start", "removed", "inserted")).alias("edits"))
    return docs.join(own, id_col, "left")


def keep_trees(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored table (id, ``text``, ``tree``): every text encoded once, its tree kept for edits to come."""
    text = F.col(f"`{text_col}`").cast("string")
    return staged(docs.select(F.col(f"`{id_col}`").alias(id_col), text.alias("text"), count_tree(text, tokenizer).alias("tree")), "token-trees")


def edit_kept(kept: DataFrame, edits: DataFrame, tokenizer: str, id_col: str = "doc_id") -> DataFrame:
    """The stored table after a batch of edits (id, start, removed, inserted), with ``encoded_chars``: the result is
    the ``kept`` of the next batch. Documents without edits pass their tree on and encode nothing."""
    rows = attach_edits(kept.select(id_col, "text", "tree"), edits, id_col)
    new = rows.select(id_col, apply_edits(F.col("text"), F.col("tree"), F.col("edits"), tokenizer).alias("new"))
    return staged(new.select(id_col, "new.text", "new.tree", "new.encoded_chars"), "token-trees")


def count_edited(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits",
) -> DataFrame:
    """Per document (id, ``n_tokens`` before, ``n_tokens_edited``, ``n_chars_edited``, ``encoded_chars``).

    Counts come from the segment trees before and after the edits; one pass, no shuffle. Rows
    are independent, repeated rows give repeated results.
    """
    trees = docs.select(F.col(id_col), F.col(text_col).alias("_text"), F.col(edits_col).alias("_edits"),
                        count_tree(F.col(text_col), tokenizer).alias("_tree"))
    after = trees.select(id_col, "_tree", apply_edits(F.col("_text"), F.col("_tree"), F.col("_edits"), tokenizer).alias("_new"))
    return after.select(
        id_col, F.get("_tree.sums", F.lit(1)).alias("n_tokens"), F.get("_new.tree.sums", F.lit(1)).alias("n_tokens_edited"),
        F.length("_new.text").cast("long").alias("n_chars_edited"), F.col("_new.encoded_chars").alias("encoded_chars"))
