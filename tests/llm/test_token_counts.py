from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keelson.llm.queries import QUERIES, revision
from keelson.llm.token_counts import attach_edits, count_edited, cut, edit_kept, edited, keep_trees, sums_of
from keelson.llm.token_files import byte_bpe, text_encoder

TEXT = st.text(alphabet="ab'st 1é\n\t  !世", max_size=80)
EDITS = st.lists(st.tuples(st.integers(0, 90), st.integers(0, 9), st.text(alphabet="a '\ns", max_size=5)), max_size=4)


def brute(text, edits):
    done, parts = 0, []
    for start, removed, insert in sorted(edits, key=lambda e: e[:2]):
        a = min(max(start, done), len(text))
        parts += [text[done:a], insert]
        done = min(max(start + removed, a), len(text))
    return "".join([*parts, text[done:]])


def count(text):
    return len(text_encoder(byte_bpe()).library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.lists(EDITS, max_size=3))
def test_counts_after_rounds_of_edits(text, rounds):
    lengths = cut(text, 8)
    at = [sum(lengths[:i]) for i in range(len(lengths) + 1)]
    sums = sums_of([count(text[a:b]) for a, b in zip(at, at[1:])])
    assert at[-1] == len(text) and sums[1] == count(text)
    for edits in rounds:
        want = brute(text, edits)
        text, lengths, sums, encoded = edited(text, lengths, sums, edits, count)
        assert text == want and sums[1] == count(want) and sum(lengths) == len(want)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.lists(st.lists(st.tuples(st.integers(0, 90), st.integers(0, 9), st.text(alphabet="a 's", max_size=40)), max_size=4), max_size=4))
def test_grown_leaves_are_split_again(text, rounds):
    lengths = cut(text, 8)
    at = [sum(lengths[:i]) for i in range(len(lengths) + 1)]
    sums = sums_of([count(text[a:b]) for a, b in zip(at, at[1:])])
    for edits in rounds:
        text, lengths, sums, _ = edited(text, lengths, sums, edits, count, 8)
        assert sums[1] == count(text) and sum(lengths) == len(text) and len(sums) >= 2 * len(lengths)
        at = [sum(lengths[:i]) for i in range(len(lengths) + 1)]
        assert [count(text[a:b]) for a, b in zip(at, at[1:])] == sums[len(sums) // 2:len(sums) // 2 + len(lengths)]


def test_stored_trees_take_several_batches(spark):
    docs = [(i, " ".join(f"word{(i * j) % 997}" for j in range(60 * i))) for i in range(12)] + [(20, None), (21, "")]
    kept = keep_trees(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), byte_bpe())
    now = dict(docs)
    for batch in range(3):
        edits = [(i, 37 * i + batch, 5 * batch, " it's new" * (1 + 90 * (i % 2))) for i in (1, 5, 5 + batch, 11, 21) for _ in (0,)] + [(99, 0, 0, "none")]
        kept = edit_kept(kept, spark.createDataFrame(edits, "doc_id long, start long, removed long, inserted string"), byte_bpe())
        for i in now:
            own = [e[1:] for e in edits if e[0] == i]
            now[i] = brute(now[i] or "", own) if own else now[i]
        rows = {r.doc_id: r for r in kept.collect()}
        assert rows.keys() == now.keys()
        for i, r in rows.items():
            size = sum(len(e[3]) + e[2] for e in edits if e[0] == i)
            assert (r.text or "") == (now[i] or "") and r.tree.sums[1] == count(now[i] or "") and sum(r.tree.leaf_chars) == len(now[i] or "")
            assert r.encoded_chars <= (size + 3 * 2 * 300 if size else 0) and max(r.tree.leaf_chars) < 1000


def test_only_touched_leaves_are_encoded():
    text = " ".join(f"word{i}" for i in range(20_000))
    lengths = cut(text)
    seen = []
    _, _, _, encoded = edited(text, lengths, sums_of([1] * len(lengths)), [(50_000, 3, "x")], lambda t: seen.append(t) or 1)
    assert len(seen) == 1 and encoded < 1000


def test_query_matches_whole_encoding(spark, tiny):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{tiny}/documents.parquet").withColumn("edits", F.array(*revision())).collect()}
    for r in QUERIES["op4_edited_token_counts"](spark, tiny).collect():
        d = docs[r.doc_id]
        new = brute(d.text or "", [(e.start, e.removed, e.inserted) for e in d.edits])
        assert (r.n_tokens, r.n_tokens_edited, r.n_chars_edited) == (count(d.text or ""), count(new), len(new))


def test_odd_rows(spark, odd, none):
    table = spark.createDataFrame([(1, -5, 3, "a"), (1, 10, None, None), (1, None, 1, "z"), (8, 9_999_999, 5, " end"), (99, 0, 0, "b")],
                                  "doc_id long, start long, removed long, inserted string")
    got = count_edited(attach_edits(odd, table), byte_bpe())
    rows = {r.doc_id: r for r in got.collect()}
    assert got.count() == odd.count() and rows[4].n_tokens == rows[3].n_tokens_edited == 0
    text = {r.doc_id: r.text for r in odd.collect()}
    assert rows[8].n_tokens_edited == count(text[8] + " end") and rows[2].n_tokens_edited == rows[2].n_tokens
    assert count_edited(attach_edits(none, table), byte_bpe()).count() == 0
