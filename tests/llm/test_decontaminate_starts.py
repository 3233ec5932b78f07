"""Starts that the search leaves out against a search that tests every start."""

from __future__ import annotations

import time

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from keelson.llm import decontaminate, textops
from keelson.llm.decontaminate import Index, folded, search
from tests.llm.conftest import prose
from tests.llm.test_decontaminate import ITEM, distance


def found(items, texts, window=100, error=0.08):
    index, out = Index(items, window, error), []
    for _, _, data, offsets in textops.text_runs(pa.array(texts, pa.string())):
        points, at, _ = folded(data, offsets)
        out += search(index, points, at)
    return out


def test_distance_matches_the_table():
    rng = np.random.Generator(np.random.PCG64(6))
    for _ in range(300):
        a = "".join(rng.choice(list("abc"), int(rng.integers(1, 140))))
        b = "".join(rng.choice(list("abc"), int(rng.integers(0, 60))))
        assert decontaminate.distance([*a.encode()], [*b.encode()]) == distance(a, b)


def test_skipping_equals_testing_every_start(monkeypatch):
    rng = np.random.Generator(np.random.PCG64(7))
    long = " ".join(f"{w}{i}" for i, w in enumerate(ITEM.split() * 6))
    items, texts = [(1, long), (2, ITEM), (3, prose(60, 5))], []
    for n in range(60):
        a, size = int(rng.integers(0, len(long) - 300)), int(rng.integers(60, 300))
        part = list(long[a:a + size])
        for _ in range(int(rng.integers(0, 14))):
            at, kind = int(rng.integers(0, len(part))), rng.integers(0, 3)
            part[at:at + (kind != 0)] = [] if kind == 2 else ["#"]
        texts.append(f"{prose(8, n)} {''.join(part)} {long[:int(rng.integers(0, 200))]} {prose(8, n + 1)}")
    calls, align = [], decontaminate.align
    monkeypatch.setattr(decontaminate, "align", lambda *x: calls.append(1) or align(*x))
    fast = found(items, texts)
    few = len(calls)
    monkeypatch.setattr(decontaminate, "distance", lambda pattern, text: 0)
    assert found(items, texts) == fast and any(fast)
    assert len(calls) - few > 10 * few


def test_skipping_equals_testing_every_start_on_the_given_table(monkeypatch, small):
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{small}/benchmark.parquet").to_pylist()]
    texts = pq.read_table(f"{small}/documents.parquet")["text"].to_pylist()
    took = time.process_time()
    fast = found(items, texts)
    took = time.process_time() - took
    monkeypatch.setattr(decontaminate, "distance", lambda pattern, text: 0)
    every = time.process_time()
    assert found(items, texts) == fast and any(fast)
    assert took < time.process_time() - every


def test_a_repeated_phrase_reaches_no_alignment(monkeypatch):
    """A text that repeats a few q-grams of an item pairs them often, which says nothing about the other places of the item."""
    rng, called = np.random.default_rng(5), []
    monkeypatch.setattr(decontaminate, "distance", lambda *x, real=decontaminate.distance: called.append(1) or real(*x))
    other = ["".join(rng.choice(list("bcdfghjk "), 70)) for _ in range(2)]
    item, text = other[0] + "ababab abababab" + other[1], "ab" * 300
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    points, at, _ = folded(raw, np.array([0, len(raw)]))
    assert search(Index([(1, item)], 100, 0.08), points, at) == [[]] and not called
    raw = np.frombuffer((text + item + text).encode(), dtype=np.uint8)
    points, at, _ = folded(raw, np.array([0, len(raw)]))
    assert [x[0] for x in search(Index([(1, item)], 100, 0.08), points, at)[0]] == [1] and called
