from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keelson.llm import range_coder, token_files
from keelson.llm.token_files import TextEncoder, _FileWriter, byte_bpe, read_blocks


@pytest.fixture(scope="module")
def encoder():
    return TextEncoder(byte_bpe())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def columns(encoder, texts):
    return [np.frombuffer(x, "<u2").tolist() for x in encoder.column(pa.array(texts, pa.string()))]


TEXTS = st.lists(st.none() | st.text(alphabet="ab'st 1.,é\n\t\r \x0b\x1c\x1f\x85\xa0!世​  　́", max_size=40), max_size=6)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_columns_equal_the_library(encoder, texts):
    assert columns(encoder, texts) == [ids_of(encoder.library, t) for t in texts]


def test_words_signs_and_added_tokens(encoder):
    texts = ["Don't stop. It's\nthe end,\n\n  x\n y \n", None, "", "a <|endoftext|> b.\nc", "<|endoftext|>", "<|endoftext", "|>", "\n", " ",
             "\nHead", "a.\r\nb", "x" * 200 + " y", "naïve café, 世界.\nß!", "ieß ein, großö.\nÜ× 2÷3 a×. b÷, Ж. я's", "the the the"]
    want = [ids_of(encoder.library, t) for t in texts]
    assert columns(encoder, texts) == want and columns(encoder, texts[::-1]) == want[::-1]
    assert columns(encoder, []) == [] and columns(encoder, [None, ""]) == [[], []]


def test_small_runs_and_a_small_store(monkeypatch):
    monkeypatch.setattr(token_files, "RUN_BYTES", 100)
    monkeypatch.setattr(token_files, "CUT_BYTES", 40)
    monkeypatch.setattr(token_files, "KEPT_PIECES", 5)
    monkeypatch.setattr(token_files, "KEPT_BYTES", 4)
    monkeypatch.setattr(token_files, "JOINED", 3)
    encoder = TextEncoder(byte_bpe())
    texts = [f"word{i} of some length, the {i % 3} end.\nThe é{i}" for i in range(30)] * 2
    assert columns(encoder, texts) == [ids_of(encoder.library, t) for t in texts]
    assert len(encoder.kept) <= 40


def test_the_library_sees_each_piece_once():
    """Pieces between signs and line ends are shared by the texts of a task and of later ones."""
    encoder, asked = TextEncoder(byte_bpe()), []

    class Counting:
        def __init__(self, library):
            self.library = library

        def __getattr__(self, name):
            return getattr(self.library, name)

        def encode_batch_fast(self, texts, **how):
            asked.extend(texts)
            return self.library.encode_batch_fast(texts, **how)

    encoder.library = Counting(encoder.library)
    texts = [f"anning{a} reouthö{b}ß.\nErtion, anningß {a}ö\n" for a in "bcdefghijk" for b in "lmnopqrstu"]
    want = [ids_of(encoder.library, t) for t in texts]
    assert columns(encoder, texts) == want
    words = [w for t in asked for w in t.replace("\n", " ").split()]
    assert len([w for w in words if "reouth" in w]) == 10 and len(words) < 60
    asked.clear()
    assert columns(encoder, texts[::-1]) == want[::-1] and asked == []


@pytest.mark.parametrize("lanes", [1, 3, 70])
def test_lanes_do_not_change_a_payload(lanes):
    rng = np.random.Generator(np.random.PCG64(lanes))
    blocks = (rng.zipf(1.2, lanes * range_coder.BLOCK) % 50257).astype(np.uint16).reshape(lanes, -1)
    blocks[0, 1000:3000] = 7  # a long run: ranges stay wide, confidences are full
    coded = range_coder.encode(blocks)
    assert (range_coder.decode(coded) == blocks).all()
    assert [range_coder.encode(blocks[j:j + 1])[0] for j in range(min(lanes, 3))] == coded[:3]


def test_the_blocks_of_a_file_are_coded_side_by_side(monkeypatch, tmp_path):
    """A step of the coder costs about the same for any number of lanes: no file ends with a narrow group."""
    monkeypatch.setattr(range_coder, "LANES", 4)
    widths, encode = [], range_coder.encode
    monkeypatch.setattr(range_coder, "encode", lambda blocks: widths.append(len(blocks)) or encode(blocks))
    ids = np.random.Generator(np.random.PCG64(1)).integers(0, 300, 9 * range_coder.BLOCK + 5).astype("<u2")
    writer = _FileWriter(str(tmp_path))
    for part in np.array_split(ids, 50):
        writer.add(part.tobytes())
    writer.close()
    assert sum(widths) == 10 == writer.blocks and min(widths) >= 3
    assert (np.concatenate(list(read_blocks(writer.path))) == ids).all()
