from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keelson.llm import files, range_coder
from keelson.llm.token_files import byte_bpe, read_blocks, read_token_files, text_encoder, token_folder, write_token_files


@pytest.fixture(scope="module")
def library():
    return text_encoder(byte_bpe()).library


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [0]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab'st 1é\n\t \x1f!世", max_size=60))
def test_pieces_equal_the_library(text):
    encoder = text_encoder(byte_bpe())
    assert np.frombuffer(encoder(text), "<u2").tolist() == encoder.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("kind", ["zero", "random", "few", "cycle", "top", "zipf"])
def test_range_coder_round_trip(kind):
    rng, n = np.random.Generator(np.random.PCG64(3)), 3 * range_coder.BLOCK
    ids = {"zero": np.zeros(n), "random": rng.integers(0, 65536, n), "few": rng.integers(0, 3, n), "cycle": np.arange(n) % 50,
           "top": np.full(n, 65535), "zipf": rng.zipf(1.3, n) % 50257}[kind].astype(np.uint16)
    blocks = ids.reshape(3, -1)
    coded = range_coder.encode(blocks)
    assert (range_coder.decode(coded) == blocks).all()
    if kind != "random":
        assert sum(map(len, coded)) < 2 * n
    # A block is coded without the others.
    assert range_coder.encode(blocks[1:2]) == coded[1:2]


def test_round_trip_of_a_table(spark, tiny, library):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    index = write_token_files(docs, token_folder(spark), byte_bpe(), file_ids=50_000)
    assert index.count() > 4
    start = 0
    got = sorted(read_token_files(index).collect())
    for r, d in zip(got, docs.orderBy("doc_id").collect(), strict=True):
        ids = ids_of(library, d.text)
        assert tuple(r) == (d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert sum(r.n_bytes for r in index.collect()) < 2 * start


def test_odd_rows(spark, odd, none, library):
    got = read_token_files(write_token_files(odd, token_folder(spark), byte_bpe())).orderBy("start").collect()
    rows = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode()))
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    assert [r.n_tokens for r in got] == [len(ids_of(library, r.text)) for r in rows]
    assert [r.ids_crc32 for r in got] == [zlib.crc32(np.array(ids_of(library, r.text), "<u4").tobytes()) for r in rows]
    assert read_token_files(write_token_files(none, token_folder(spark), byte_bpe())).count() == 0


def test_texts_with_an_added_token(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(byte_bpe())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|>  y z<|endoftext|>", "a <|endoftext b", "no token here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert 50256 in want[0] and [np.frombuffer(x, "<u2").tolist() for x in text_encoder(byte_bpe()).batch(texts)] == want
    got = read_token_files(write_token_files(docs, token_folder(spark), byte_bpe())).orderBy("start").collect()
    assert [r.n_tokens for r in got] == [len(ids) + 1 for ids in want]
    assert [r.ids_crc32 for r in got] == [zlib.crc32(np.array([*ids, 0], "<u4").tobytes()) for ids in want]


def test_damage_is_found(spark, odd, tmp_path):
    index = write_token_files(odd.limit(3), str(tmp_path / "t"), byte_bpe())
    path = index.first().path
    system, name = files.opened(path)
    raw = bytearray(open(name, "rb").read())
    raw[30] ^= 1
    broken = str(tmp_path / "broken.ids")
    with files.write_stream(broken) as out:
        out.write(bytes(raw))
    with pytest.raises(ValueError, match="checksum"):
        list(read_blocks(broken))
