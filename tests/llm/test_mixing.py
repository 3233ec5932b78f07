from __future__ import annotations

import hashlib
import math
import re

import pytest

from keelson.llm.mixing import mix_sources, mixed_documents, source_targets, take_mix
from tests.llm.conftest import DOCS, prose, row

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(1, 2, 3), ceiling=3):
    """Share out, stop what is above its ceiling, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, left = set(), sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in full]
        rest = left - sum(ceiling * sizes[s] for s in full)
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if ceiling * sizes[s] <= share[s]}
        if not over:
            return {s: ceiling * sizes[s] if s in full else share[s] for s in order}
        full |= over


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 1, "c": 2, None: 50}, {"a": 10}, {"a": 0, "b": 9}, {"a": 5, "b": 5, "c": 5, "d": 1000, "e": 1}, {"a": 0, "b": 0}])
def test_targets_match_the_process(spark, sizes):
    got = source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    got = {r.source: r.target for r in got.collect()}
    assert got == pytest.approx(targets(sizes))


def taken(rows, seed=17):
    size = {s: 0 for _, s, _ in rows}
    for _, s, n in rows:
        size[s] += n
    goal, out = targets(size), []
    for s in size:
        own = sorted((hashlib.md5(f"{seed}|{'' if i is None else i}".encode()).hexdigest(), i or 0, n, i) for i, x, n in rows if x == s)
        budget = math.floor(goal[s])
        epochs, left = divmod(budget, size[s]) if size[s] else (0, 0)
        for _, _, n, i in own:
            out.append((i, s, n, epochs * n + min(n, left)))
            left -= min(n, left)
    return sorted(out, key=repr)


def test_mix_matches_brute_force(spark):
    rows = [row(i, prose(3 + i % 40, i), source=["a", "a", "a", "b", "c", "d", None][i % 7]) for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS)
    mix = mix_sources(docs)
    got = sorted(((r.doc_id, r.source, r["size"], r.taken) for r in mix.collect()), key=repr)
    assert got == taken([(r[0], r[3], len(WORD.findall(r[1]))) for r in rows])
    assert got == sorted(((r.doc_id, r.source, r["size"], r.taken) for r in mix_sources(docs.repartition(7)).collect()), key=repr)
    out = take_mix(docs, mix).collect()
    words = {}
    for r in out:
        words[r.doc_id] = words.get(r.doc_id, 0) + len(WORD.findall(r.text))
        assert prose(3 + r.doc_id % 40, r.doc_id).startswith(r.text)
    assert words == {i: t for i, _, _, t in got if t}


def test_odd_rows(odd, none):
    got = mix_sources(odd).collect()
    assert len(got) == odd.count() and {r.source for r in got} == {"a", "b", None}
    for s in ("a", "b", None):
        own = [r for r in got if r.source == s]
        assert sum(r.taken for r in own) == math.floor(own[0].target)
        assert all(0 <= r.taken <= 3 * r["size"] for r in own)
    for out in (take_mix(odd, mix_sources(odd)), mixed_documents(odd)):
        assert out.columns == odd.columns
        rows = out.collect()
        for s in ("a", "b", None):
            assert sum(len(WORD.findall(r.text)) for r in rows if r.source == s) == sum(r.taken for r in got if r.source == s)
        assert all(r[5:] == ("clash", 5, *["clash"] * 5) for r in rows)
    assert mix_sources(none).count() == 0 and take_mix(none, mix_sources(none)).count() == mixed_documents(none).count() == 0


def test_repeated_rows_take_a_share_each(spark):
    """Equal rows, rows of one id and rows without an id: words per row as brute force gives them."""
    rows = [row(1, "one two three four")] * 4 + [row(1, "five six")] * 3 + [row(None, "a b c")] * 5 + [row(2, prose(20), "en", "b")] * 3
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    want = {}
    for i, s, n, t in taken([(r[0], r[3], len(WORD.findall(r[1]))) for r in rows]):
        want[s] = want.get(s, 0) + t
    for out in (take_mix(docs, mix_sources(docs)), mixed_documents(docs)):
        got = {}
        for r in out.collect():
            got[r.source] = got.get(r.source, 0) + len(WORD.findall(r.text))
        assert got == want
