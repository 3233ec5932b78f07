"""Benchmark decontamination: q-gram lemma filtering and banded alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import textops
from keelson.session import staged

Q = 8
WINDOW = 100
ERROR = 0.08
CELL = 32
BLOCK_CHARS = 4_000_000
STARTS = 64
LEAKS = "array<struct<item_id: long, start: long, stop: long, edits: long>>"

_FOLD = np.arange(0x110000, dtype=np.uint32)
for _c in range(0x3000):  # lower case where that is one character, all white space alike
    _l = chr(_c).lower()
    _FOLD[_c] = 32 if chr(_c).isspace() else ord(_l) if len(_l) == 1 else _c
_FOLD[0x3000] = 32
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22


def folded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts of a run as folded code points: runs of white space are one blank.

    Returns the code points, the offsets of the texts in them, and the position of each in its own text.
    """
    chars = np.cumsum(np.concatenate(([0], (data & 0xC0) != 0x80)))[offsets]
    points = _FOLD[np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype="<u4")]
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
    inner = chars[(chars > 0) & (chars < len(points))]
    keep[inner] = True
    place = np.flatnonzero(keep)
    at = np.searchsorted(place, chars)
    return points[place], at, place - np.repeat(chars[:-1], np.diff(at))


def grams(points: np.ndarray) -> np.ndarray:
    """All q-grams as 64-bit words of one byte per character. Characters that share a byte can only
    add matches, so the lemma's bound stays a bound."""
    if len(points) < Q:
        return np.zeros(0, dtype=np.uint64)
    small = (points ^ (points >> np.uint32(8)) * np.uint32(31)).astype(np.uint8)
    return np.ndarray((len(points) - Q + 1,), dtype="<u8", buffer=small.tobytes(), strides=(1,)).copy()


def needed(length: int, error: float) -> tuple[int, int]:
    """The edit budget e of a window and the q-grams that it shares at least with any text within e
    edits: length + 1 - Q * (e + 1). The budget shrinks where that would not be positive."""
    e = int(error * length)
    while e and length + 1 - Q * (e + 1) < 1:
        e -= 1
    return e, max(1, length + 1 - Q * (e + 1))


class Index:
    """A block of benchmark items, the size of their windows and where each q-gram stands in the items."""

    def __init__(self, items: list[tuple[int, str]], window: int, error: float) -> None:
        self.ids, self.points, self.sizes, codes, owner, place = [], [], [], [], [], []
        for item, text in items:
            raw = np.frombuffer(text.encode(), dtype=np.uint8)
            points = folded(raw, np.array([0, len(raw)]))[0]
            points = points[1:] if len(points) and points[0] == 32 else points
            points = points[:-1] if len(points) and points[-1] == 32 else points
            if len(points) < Q:
                continue
            g = grams(points)
            codes.append(g)
            owner.append(np.full(len(g), len(self.ids)))
            place.append(np.arange(len(g)))
            self.ids.append(item)
            self.points.append(points)
            self.sizes.append(min(window, len(points)))
        self.budget = [needed(size, error) for size in self.sizes]
        self.least = np.array([n for _, n in self.budget], dtype=np.int64)
        codes = np.concatenate(codes) if codes else np.zeros(0, dtype=np.uint64)
        order = np.argsort(codes, kind="stable")
        self.codes, first = np.unique(codes[order], return_index=True)
        self.first = np.concatenate((first, [len(codes)]))
        self.owner = np.concatenate(owner)[order] if owner else codes.astype(np.int64)
        self.place = np.concatenate(place)[order] if place else codes.astype(np.int64)
        self.maybe = np.zeros(1 << _BITS, dtype=bool)
        self.maybe[((self.codes * _MULTIPLIER) >> np.uint64(64 - _BITS)).astype(np.int64)] = True


def align(pattern: np.ndarray, text: np.ndarray, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place of ``pattern`` in ``text`` with at most ``most`` edits.

    ``text`` is a band of diagonals around the pattern, so each row of the table is a short
    array. The start follows from aligning backwards from the end.
    """
    def ends(p: np.ndarray, t: np.ndarray, free_start: bool) -> np.ndarray:
        columns = np.arange(len(t) + 1)
        row = np.zeros(len(t) + 1, dtype=np.int64) if free_start else columns.copy()
        for i, c in enumerate(p, 1):
            best = np.minimum(row[:-1] + (t != c), row[1:] + 1)
            row = np.minimum.accumulate(np.concatenate(([i], best)) - columns) + columns
            if row.min() > most:
                break
        return row

    row = ends(pattern, text, True)
    end = int(row.argmin())
    if row[end] > most:
        return None
    back = ends(pattern[::-1], text[:end][::-1], False)
    return int(row[end]), end - int(back.argmin()), end


def distance(pattern: list[int], text: list[int]) -> int:
    """The least number of edits between ``pattern`` and any part of ``text``: a column of the table is two bit vectors,
    one bit per character of the pattern, and a character of the text costs a few operations on whole vectors."""
    at: dict[int, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    full, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    up, down, here = full, 0, len(pattern)
    best, find = here, at.get
    for c in text:
        equal = find(c, 0)
        across = (((equal & up) + up) ^ up) | equal
        rise, fall = down | (full & ~(across | up)), up & across
        if rise & top:
            here += 1
        elif fall & top:
            here -= 1
            if here < best:
                best = here
        rise, fall, kept = rise << 1, fall << 1, equal | down
        up = (fall | ~(kept | rise)) & full
        down = rise & kept & full
    return best


def search(index: Index, points: np.ndarray, at: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
    """For each text of a run, (item, start, end, edits) of each region of an item found, in folded positions."""
    parts: list[list[list]] = [[] for _ in range(len(at) - 1)]  # first match, start and end of each part
    g = grams(points)
    if not len(g) or not len(index.ids):
        return parts
    hit = np.flatnonzero(index.maybe[((g * _MULTIPLIER) >> np.uint64(64 - _BITS)).astype(np.int64)])
    code = np.minimum(np.searchsorted(index.codes, g[hit]), len(index.codes) - 1)
    text = np.searchsorted(at, hit, side="right") - 1
    good = (index.codes[code] == g[hit]) & (hit + Q <= at[text + 1])
    hit, code, text = hit[good], code[good], text[good]
    many = index.first[code + 1] - index.first[code]
    source = np.repeat(index.first[code] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
    owner, place = index.owner[source], index.place[source]
    text, pos = np.repeat(text, many), np.repeat(hit - at[text], many)
    # Diagonals in cells; any band of up to CELL + 1 diagonals lies in two neighbouring cells.
    cell = (pos - place) // CELL
    first = int(cell.min()) if len(cell) else 0
    # A free number between two pairs keeps their cells apart. A run has less than 2^20 texts or is one text, so keys stay below 2^63.
    span = int(cell.max()) - first + 2 if len(cell) else 1
    key = (text * len(index.ids) + owner) * span + (cell - first)
    order = np.argsort(key)
    key = key[order]
    start = np.flatnonzero(np.concatenate((key[:1] == key[:1], key[1:] != key[:-1])))
    cells, count = key[start], np.diff(np.concatenate((start, [len(key)])))
    total = count.copy()
    beside = np.flatnonzero(cells[1:] == cells[:-1] + 1)
    total[beside] += count[beside + 1]
    item = cells // span % len(index.ids)
    for j in np.flatnonzero(total >= index.least[item]):
        t, i = int(cells[j]) // span // len(index.ids), int(item[j])
        low = (int(cells[j]) % span + first) * CELL
        stop = start[j] + total[j]
        offsets = np.unique(place[order[start[j]:stop]])  # an edit spoils places of the item, however often the text repeats one
        most, least = index.budget[i]
        doc, size = points[at[t]:at[t + 1]], index.sizes[i]
        # The q-grams in a window change only where one enters or leaves, so the starts that reach the bound are few runs.
        edges = np.unique(np.clip(np.concatenate(([0], offsets - (size - Q), offsets + 1)), 0, len(index.points[i]) - size))
        inside = np.searchsorted(offsets, edges + size - Q, side="right") - np.searchsorted(offsets, edges)
        ends = np.concatenate((edges[1:], [len(index.points[i]) - size + 1]))
        a = reached = 0
        for first_start, after in zip(edges[inside >= least].tolist(), ends[inside >= least].tolist()):
            a = max(a, first_start)
            wide, tested = [], a  # one band around the bands of the starts before ``tested``
            while a < after:
                if a >= tested:
                    tested, left = min(after, a + STARTS), max(0, a + low - most, reached)
                    wide = doc[left:max(left, tested - 1 + size + low + 2 * CELL + most)].tolist()
                # A character less at the front takes away at most one edit, one more at the end none.
                over = distance(index.points[i][a:a + size].tolist(), wide) - most
                if over > 0:
                    a += over
                    continue
                left = max(0, a + low - most, reached)  # what overlaps the last match belongs to its part
                band = doc[left:max(left, a + size + low + 2 * CELL + most)]
                match = align(index.points[i][a:a + size], band, most) if len(band) >= size - most else None
                a += 1
                if match:
                    tested = a
                    begin, reached = left + match[1], left + match[2]
                    part = next((p for p in parts[t] if p[0][0] == index.ids[i] and begin <= p[2] + most and p[1] <= reached + most), None)
                    if part:
                        part[1:] = min(part[1], begin), max(part[2], reached)
                    else:
                        parts[t].append([(index.ids[i], begin, reached, match[0]), begin, reached])
    return [[p[0] for p in own] for own in parts]


def _leak_column(sent, window: int, error: float):
    """The UDF that searches texts for the benchmark items of a broadcast block."""
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "start", "stop", "edits")]))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Index(sent.value, window, error)
        for texts in textops.released(batches):
            out = []
            for _, _, data, offsets in textops.text_runs(texts):
                points, at, place = folded(data, offsets)
                for t, leaks in enumerate(search(index, points, at)):
                    own = place[at[t]:at[t + 1]]
                    out.append([{"item_id": i, "start": int(own[a]), "stop": int(own[z - 1]) + 1, "edits": e} for i, a, z, e in leaks])
            yield pa.array(out, kind)

    return F.arrow_udf(run, LEAKS)


def with_leaks(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, error: float = ERROR, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` with ``leaks``: array of (item_id, start, stop, edits), one entry per part of the text that
    holds a window of a benchmark item; windows that touch are one part, and its first one is given.

    Any ``window`` characters of an item are a window (a shorter item is one window). A text leaks it if some part of it is within ``error`` * window edits of a
    window, case and runs of white space aside. Shared q-grams are counted in overlapping
    bands of diagonals; only bands that reach the q-gram lemma's bound are aligned, within the
    band. ``start`` and ``stop`` are code points of the text as it is.

    A pass over the documents has no shuffle. The benchmark goes to the tasks in blocks of about
    ``block_chars`` characters (more only for one longer item); a benchmark of several blocks
    takes a pass for each, over stored rows.

    NULL and empty texts leak nothing. Items that are NULL, or under eight characters once
    trimmed, are left out; items that repeat an id are searched each, and parts that overlap are reported once. An empty
    benchmark gives empty arrays. A former column ``leaks`` is replaced.
    """
    items = benchmark.where(F.col(item_text_col).isNotNull() & F.col(item_col).isNotNull()).select(
        F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    size = items.agg(F.sum(F.length("text")).alias("n"), F.max(F.length("text")).alias("longest")).first()
    blocks = max(1, -(-(size.n or 0) * 2 // block_chars))
    kept = [f"`{c}`" for c in docs.columns if c != "leaks"]
    out = docs.select(*kept, F.array().cast(LEAKS).alias("leaks"))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        sent = docs.sparkSession.sparkContext.broadcast([(r.item_id, r.text) for r in rows.orderBy("item_id", "text").collect()])
        found = _leak_column(sent, window, error)(F.col(f"`{text_col}`").cast("string"))
        out = out.select(*kept, (F.concat("leaks", found) if blocks > 1 else found).alias("leaks"))
        if b + 1 < blocks:
            out = staged(out, "leaks")
    return out
