from __future__ import annotations

import corpus_pipeline as pipeline
import __spark_entry__ as entry
from keelson.llm.near_dup import near_duplicates
from tests.llm.conftest import DOCS, odd_rows, row


def test_stages_on_the_given_table(spark, tiny, tmp_path):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    schema = docs.schema
    bench = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()]
    for name, fn in pipeline.STAGES:
        path = str(tmp_path / name)
        fn(spark, docs, tiny).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if name != "token_files":
            assert docs.schema == schema
        if name == "language":
            assert docs.count() == before.count()  # all of these have letters
        if name == "near_dedup":
            groups = near_duplicates(before, percent=80).collect()
            assert sorted(r.doc_id for r in docs.collect()) == sorted({r.component_id for r in groups})
        if name == "decontaminate":
            texts = [" ".join(r.text.lower().split()) for r in docs.collect()]
            assert 0 < len(texts) < before.count() and not any(b in t for b in bench for t in texts)
        if name == "mix":
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        if name == "token_files":
            rows = docs.orderBy("start").collect()
            assert len(rows) == before.count() and rows[-1].start == sum(r.n_tokens for r in rows[:-1])


def stage(name):
    return dict(pipeline.STAGES)[name]


def test_odd_documents(spark, tiny, tmp_path):
    """What each stage leaves of the odd rows, extra columns and clashing names included."""
    docs, ids = spark.createDataFrame(odd_rows(), DOCS), {}
    for name, fn in pipeline.STAGES[:4]:
        path = str(tmp_path / name)
        fn(spark, docs, tiny).write.parquet(path)
        docs = spark.read.parquet(path)
        ids[name] = sorted((r.doc_id or 0 for r in docs.collect()))
        assert docs.columns == DOCS.replace(" string", "").replace(" long", "").split(", ")
        assert all(r.score == r.key == r._hash == r._copy == r.taken == r["size"] == "clash" for r in docs.collect())
    assert ids["language"] == [0, 1, 2, 6, 7, 8, 9, 9, 10, 11, 11, 12]
    assert ids["near_dedup"] == ids["decontaminate"] == [0, 1, 6, 8, 9, 9, 11, 12]
    assert set(ids["mix"]) <= set(ids["near_dedup"])


def test_rows_that_share_an_id_are_kept_by_their_texts(spark, tiny):
    def text(seed):
        return " ".join(f"w{(i * i + seed * 7919 * (i + 1)) % 9973}" for i in range(150))

    p, q, r, s = (text(n) for n in (1, 2, 3, 4))
    rows = [(1, p), (2, p + " end"), (2, q), (3, r), (3, "start " + q), (3, r), (None, s), (None, s + " end"), (None, text(5)), (4, s), (5, "")]
    docs = spark.createDataFrame([row(i, t) for i, t in rows], DOCS).repartition(3)
    got = sorted(((x.doc_id, x.text) for x in stage("near_dedup")(spark, docs, tiny).collect()), key=repr)
    assert got == sorted([(1, p), (2, q), (3, r), (4, s), (None, text(5)), (5, "")], key=repr)
    mixed = stage("mix")(spark, spark.createDataFrame([row(1, "one two three four five")] * 4, DOCS), tiny).collect()
    assert sum(len(x.text.split()) for x in mixed) == 20  # one source: its words, once


def test_registered(spark):
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) >= {"op2_mix_sources", "op6_warc", "op9_top_k", "op13_hard_negatives"}
