from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from keelson.llm import cross_tokens
from keelson.llm.cross_tokens import Words, align_tokenizers, piece_bpe, tokenizer_pair, tokenizer_spans
from keelson.llm.token_files import byte_bpe

TEXTS = [
    "plain words and more words", "", None, " ", "  two  blanks ", "a ", " a", "\n", "tabs\t and\n lines \n\n end\n", "café 日本語 \U0001F600 x́",
    "lower ▁ one eighth", "<s> x</s> <unk> <|endoftext|> <0x41>", "Ａ   ﻿ \x00\x1f ͸", "x" * 3000, "it's  we'll 12,5%%% ...", "a　b   c",
    "กำแพง \U00020000\U0010FFFF", "trailing blanks   ", "\x1c \x1c a", "word " * 400]


def brute(texts):
    """Straight from the definition, on whole texts."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_lib, b_lib = Tokenizer.from_file(byte_bpe()), SentencePieceProcessor(model_file=piece_bpe())
    a_lib.encode_special_tokens = True
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    sign = {chr(x): x for x in own} | {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in own)}

    def b_bytes(piece):
        return bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x") else piece.replace("▁", " ").encode()

    found, counts = [], Counter()
    for text in texts:
        if not text:
            found.append(None)
            continue
        a = a_lib.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(sign[c] for c in t)) for i, t in zip(a.ids, a.tokens)]
        b = [(i, b_bytes(b_lib.id_to_piece(i))) for i in b_lib.encode(text, return_type=int)]
        if not (b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode()):
            found.append(None)
            continue
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        cuts = sorted({z for _, _, z in spans[0]} & {z for _, _, z in spans[1]})
        groups, x, y = [], 0, 0
        for cut in cuts:
            own = [[], []]
            for side, p in ((0, x), (1, y)):
                while p < len(spans[side]) and spans[side][p][2] <= cut:
                    own[side].append(str(spans[side][p][0]))
                    p += 1
                x, y = (p, y) if side == 0 else (x, p)
            groups.append(",".join(own[0]) + "|" + ",".join(own[1]))
        links, first = [], 0
        for i, p, q in spans[0]:
            while spans[1][first][2] <= p:
                first += 1
            n = first
            while n < len(spans[1]) and spans[1][n][1] < q:
                links.append((i, spans[1][n][0]))
                n += 1
        counts.update(links)
        found.append((spans, groups, links))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    rows = []
    for f in found:
        if f is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
        else:
            spans, groups, links = f
            rows.append((len(spans[0]), len(spans[1]), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
                         sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return rows, counts, [f and f[0] for f in found]


def run(spark, texts, **more):
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], "doc_id long, text string, a string, count string")
    found, links = align_tokenizers(docs.repartition(3), byte_bpe(), piece_bpe(), **more)
    return [tuple(r)[1:] for r in sorted(found.collect())], {(r.a, r.b): r["count"] for r in links.collect()}


@pytest.mark.parametrize("chunk", [1, 2_000, 1 << 23])
def test_matches_brute_force_on_odd_texts(spark, chunk):
    rows, counts, _ = brute(TEXTS)
    assert run(spark, TEXTS, chunk_bytes=chunk) == (rows, dict(counts))
    assert rows[10] == (0, 0, 0, 0, 0, 0, "") and sum(r[0] > 0 for r in rows) == len(TEXTS) - 3


def test_matches_brute_force_on_the_given_table(spark, tiny, monkeypatch):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").orderBy("doc_id").collect()
    found, links = align_tokenizers(spark.read.parquet(f"{tiny}/documents.parquet"), byte_bpe(), piece_bpe(), chunk_bytes=50_000)
    rows, counts, _ = brute([r.text for r in docs])
    assert [tuple(r) for r in sorted(found.collect())] == [(d.doc_id, *r) for d, r in zip(docs, rows)]
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    assert {(r.a, r.b, r["count"], r.best) for r in links.collect()} == {(a, b, n, n == best[b]) for (a, b), n in counts.items()}


def test_words_forgotten_between_chunks(spark, monkeypatch):
    pair, texts = tokenizer_pair(byte_bpe(), piece_bpe()), TEXTS[-6:] + ["one two three"]
    words = Words(pair)
    words.learn(sorted({w for t in texts for w in words.split(t)}))
    assert not words.full() and len(words.tables()) == len(words.groups) == len(words.pool()[1]) - 1 == len(words.number)
    whole = cross_tokens.Pair(byte_bpe(), piece_bpe())
    whole.by_word = False  # as for a vocabulary with pieces across blanks
    monkeypatch.setitem(cross_tokens._pairs, (byte_bpe(), piece_bpe()), whole)
    kept = Words(whole)
    kept.learn([t for t in TEXTS if t])
    rows = brute(TEXTS)[0]
    assert [tuple(kept.tables()[kept.number[t], :4]) for t in TEXTS if t] == [r[:4] for t, r in zip(TEXTS, rows) if t]


def test_spans(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, a string")
    expected = brute(TEXTS)[2]
    for r in tokenizer_spans(docs, byte_bpe(), piece_bpe()).collect():
        if expected[r.doc_id] is None:
            assert r.a == r.b == r.groups == []
        else:
            assert [[tuple(x) for x in r.a], [tuple(x) for x in r.b]] == expected[r.doc_id]
            assert set(r.groups) == {x.stop for x in r.a} & {x.stop for x in r.b}


def test_odd_rows(spark, odd, none):
    found, _ = align_tokenizers(odd, byte_bpe(), piece_bpe())
    texts = [r.text for r in odd.collect()]
    assert sorted(tuple(r)[1:] for r in found.collect()) == sorted(brute(texts)[0])
    assert sorted(r.doc_id or 0 for r in found.collect()) == sorted(r.doc_id or 0 for r in odd.collect())
    found, links = align_tokenizers(none, byte_bpe(), piece_bpe())
    assert found.count() == links.count() == 0 and tokenizer_spans(none, byte_bpe(), piece_bpe()).columns == [*none.columns, "a", "b", "groups"]
