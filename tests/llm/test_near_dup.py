from __future__ import annotations

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from keelson.llm import near_dup, textops
from keelson.llm.components import connected_components
from keelson.llm.near_dup import near_duplicates, one_permutation
from tests.llm.conftest import DOCS, prose, row

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def components(texts: dict, percent: int) -> dict:
    sets, group = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                group[y] = x
    return {i: top(i) for i in ids}


def check(spark, texts: dict, percent: int):
    frame = spark.createDataFrame([row(i, t) for i, t in texts.items()], DOCS)
    got = {r.doc_id: r for r in near_duplicates(frame, percent=percent).collect()}
    want = components(texts, percent)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingles(texts[i])) for i, r in got.items())


def test_groups_match_brute_force(spark):
    rng = np.random.Generator(np.random.PCG64(5))
    texts = {}
    for base in range(6):
        words = [f"w{x}" for x in rng.integers(0, 5000, 120)]
        for copy in range(9):
            own = list(words)
            for at in rng.integers(0, 120, rng.integers(0, 5)):
                own[at] = f"n{rng.integers(0, 10**6)}"
            texts[base * 20 + copy] = " ".join(own)
    texts |= {500: texts[0].upper(), 501: texts[0] + "\n", 502: "a b c", 503: "A  b\tc", 504: "a b", 505: "", 506: None}
    check(spark, texts, 85)
    check(spark, texts, 80)


def test_hub_whose_copies_are_not_alike(spark):
    words = [f"w{i}" for i in range(200)]
    texts = {1000: " ".join(words)}
    for c in range(60):  # each copy changes another stretch: near the origin, far from each other
        own = list(words)
        own[3 * c:3 * c + 20] = [f"c{c}_{j}" for j in range(20)]
        texts[c] = " ".join(own)
    check(spark, texts, 85)


def test_texts_of_shared_passages(spark):
    """Texts put together from passages that many others hold too: nothing in a linked pair is its own."""
    rng = np.random.Generator(np.random.PCG64(23))
    passages = [" ".join(f"p{n}_{i}" for i in range(20)) for n in range(22)]
    texts = {i: " ".join(passages[n] for n in sorted(rng.choice(22, 18, replace=False))) for i in range(450)}
    check(spark, texts, 80)


def test_one_foreign_member_adds_a_row_per_member(spark):
    """A bucket of n copies around one centre and a text that is no copy of any: at most n pairs are left to test."""
    words, n = [f"w{i}" for i in range(200)], 150
    texts = {i: " ".join([*words[:199], f"own{i}"]) for i in range(n)}
    texts[n] = " ".join(words[:165] + [f"other{i}" for i in range(35)])
    stars = spark.createDataFrame([(1, i, 0) for i in range(n + 1)], "key long, id long, center long")
    found = spark.createDataFrame([(i, 0) for i in range(n)], "node long, component long")
    frame = spark.createDataFrame(list(texts.items()), "id long, text string")
    for percent, rows in ((65, n - 1), (85, 0)):  # a similarity of 0.70 with all members, of which the centre is done
        pairs = near_dup._rest(stars, found, frame, percent).collect()
        assert len(pairs) == rows and all(n in (p.a, p.b) for p in pairs)
    assert near_dup._rest(stars.where(f"id < {n}"), found, frame, 65).collect() == []


def test_an_id_with_several_texts(spark):
    a, b = prose(80, 3), prose(80, 11)
    rows = [row(1, a), row(1, b), row(2, a + " end"), row(3, "start " + b), row(4, prose(80, 5))]
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, DOCS), percent=85).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_small_driver_table(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.component_id for r in near_duplicates(docs, percent=85).collect()}
    assert got == components(texts, 85)


def test_odd_rows(odd, none):
    got = near_duplicates(odd, percent=85).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [by_id[i].component_id for i in (1, 2, 10, 6, 7)] == [1, 1, 1, 6, 6]
    assert all(by_id[i].n_shingles == 0 and by_id[i].component_id == i for i in (3, 4, 5))
    assert by_id[12].n_shingles == 1 and by_id[8].kept
    lone = next(r for r in got if r.doc_id is None)
    assert lone.component_id is None and lone.kept
    assert near_duplicates(none, percent=85).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab c\n\té ", max_size=40), max_size=6))
def test_shingle_sets(texts):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    sets, at = textops.shingle_sets(data, offsets) if texts else (np.zeros(0), np.zeros(1, int))
    own = [sets[a:b] for a, b in zip(at, at[1:])]
    for i, t in enumerate(texts):
        assert len(own[i]) == len(shingles(t))
        for j, u in enumerate(texts):
            assert textops.common(own[i], own[j]) == len(shingles(t) & shingles(u))


def test_densified_signatures_estimate_similarity():
    rng = np.random.Generator(np.random.PCG64(1))
    for size in (1, 30, 3000):
        pool = rng.integers(0, 2**63, size * 2, dtype=np.uint64)
        a, b = np.unique(pool[:size]), np.unique(pool[size // 10:size + size // 10])
        s = one_permutation(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 192)
        true = textops.common(a, b) / len(np.union1d(a, b))
        assert abs((s[0] == s[1]).mean() - true) < 0.25 and (s != 0).all()


def test_components(spark):
    path = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
