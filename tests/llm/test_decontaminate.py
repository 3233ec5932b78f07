from __future__ import annotations

import numpy as np
import pytest

from keelson.llm.decontaminate import Index, align, folded, needed, search, with_leaks
from keelson.llm.queries import QUERIES
from tests.llm.conftest import DOCS, prose, row

ITEM = "Which of these rivers flows through four capitals on its way from the forest to the sea, and what is the name of its delta?"
BENCH = "item_id long, text string, leaks string"


def distance(a: str, b: str) -> int:
    """Edits from ``a`` to the nearest substring of ``b``."""
    last = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return min(last)


def leaks(spark, texts, items=((1, ITEM, ""),), **more):
    docs = spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], DOCS)
    got = with_leaks(docs, spark.createDataFrame(list(items), BENCH), **more)
    return {r.doc_id: r.leaks for r in got.collect()}


def test_exact_edited_and_clean(spark):
    around = prose(40)
    typo = ITEM.replace("rivers", "rviers").replace("capitals", "capital").replace("forest", "Forrest")
    texts = [around, f"{around} {ITEM} {around}", f"{around}\n{typo}", ITEM.upper().replace(" ", "\n  "), around + ITEM[:100], around + ITEM[:40],
             ITEM[:60] + around[:80] + ITEM[60:], None, "", ITEM[-99:-1]]
    got = leaks(spark, texts)
    assert [bool(got[i]) for i in range(len(texts))] == [False, True, True, True, True, False, False, False, False, True]
    for i in (1, 2, 3, 4):
        hit = got[i][0]
        part = " ".join(texts[i][hit.start:hit.stop].split()).lower()
        assert hit.item_id == 1 and hit.edits == distance(part, ITEM.lower()) and len(part) > 80
    assert got[2][0].edits > 0 == got[1][0].edits


def test_random_edits_match_brute_force(spark):
    rng = np.random.Generator(np.random.PCG64(9))
    window, error = 60, 0.08
    texts = []
    for n in range(60):
        t = list(ITEM[:window])
        for _ in range(n % 9):
            at, kind = int(rng.integers(0, len(t))), rng.integers(0, 3)
            t[at:at + (kind != 0)] = [] if kind == 2 else ["#"]
        texts.append(prose(10) + " " + "".join(t) + " " + prose(10))
    got = leaks(spark, texts, [(1, ITEM[:window], "")], window=window, error=error)
    most, least = needed(window, error)
    assert (most, least) == (4, 21)
    assert [bool(got[i]) for i in range(60)] == [distance(ITEM[:window].lower().strip(), t.lower()) <= most for t in texts]


def test_align():
    a = lambda s: np.frombuffer(s.encode(), dtype=np.uint8)
    assert align(a("abcdef"), a("xxabcdefyy"), 1) == (0, 2, 8)
    assert align(a("abcdef"), a("xxabXdefyy"), 1) == (1, 2, 8)
    assert align(a("abcdef"), a("xxabdefyy"), 1) == (1, 2, 7)
    assert align(a("abcdef"), a("zzzzzz"), 2) is None


@pytest.mark.parametrize("block_chars", [400, 4_000_000])
def test_blocks_and_odd_items(spark, block_chars):
    items = [(1, ITEM, ""), (2, prose(30, 5), ""), (3, None, ""), (None, ITEM, ""), (4, "tiny", ""), (5, "", ""), (2, prose(30, 11), ""), (6, ITEM, "")]
    got = leaks(spark, [ITEM, prose(90, 5), prose(30, 11), "tiny"], items, block_chars=block_chars)
    assert [sorted({x.item_id for x in got[i]}) for i in range(4)] == [[1, 6], [2], [2], []]
    assert all(not v for v in leaks(spark, [ITEM], []).values())


def test_more_text_item_pairs_than_23_bits():
    items = [(i, f"{i:06d} is the number of this item") for i in range(9_000)]
    texts = [f"text {t} quotes: {items[(t * 8) % 9_000][1]}" if t % 50 == 0 else f"text {t}" for t in range(1_100)]
    raw = [t.encode() for t in texts]
    assert len(texts) * len(items) > 1 << 23
    points, at, _ = folded(np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))))
    found = search(Index(items, 100, 0.0), points, at)
    assert [{f[0] for f in hits} for hits in found] == [{(t * 8) % 9_000} if t % 50 == 0 else set() for t in range(1_100)]


def test_quotations_off_the_grid_and_several_places(spark):
    item, around = " ".join(f"{w}{i}" for i, w in enumerate(ITEM.split() * 3)), prose(40)
    texts = [f"{around} {item[a:a + 103]} {around}" for a in (0, 27, 74, 131)]
    texts += [f"{item[:110]} {around} {item[-110:]}", f"{item[20:125]} {around} {item[20:125]}", f"{around} {item}"]
    got = leaks(spark, texts, [(1, item, "")])
    assert [len(got[i]) for i in range(7)] == [1, 1, 1, 1, 2, 2, 1]
    for i in (4, 5):
        first, second = sorted(x.start for x in got[i])
        assert first < 20 and second > len(around)


def test_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(7, "x" * 300, ""), (8, prose(60), "")], BENCH)
    got = with_leaks(odd, bench)
    assert got.columns == [*odd.columns, "leaks"] and got.count() == odd.count()
    assert {r.doc_id for r in got.where("size(leaks) > 0").collect()} >= {1, 2, 10, 12}
    assert with_leaks(none, bench).count() == 0


def test_query_on_given_tables(spark, small):
    fold = lambda t: " ".join(t.lower().split())
    items = {r.item_id: fold(r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()}
    texts = {r.doc_id: fold(r.text or "") for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in QUERIES["op10_decontaminate"](spark, small).collect():
        assert set(r.item_ids) >= {i for i, t in items.items() if t in texts[r.doc_id]}
        for hit in r.leaks:
            assert any(distance(items[hit.item_id][a:a + 100], texts[r.doc_id]) <= 8 for a in range(0, max(1, len(items[hit.item_id]) - 99), 1))
