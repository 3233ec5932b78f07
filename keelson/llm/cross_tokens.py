"""Alignment of two tokenizers: spans in bytes, common groups, links and their counts over a corpus."""

from __future__ import annotations

import hashlib
import io
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import files, textops
from keelson.session import scratch_path, staged

CHUNK_BYTES = 8 << 20
CACHED_WORDS, CACHED_BYTES = 800_000, 128 << 20
JOINED = 2_000
TEXTS = 500
_CUT = re.compile(r"(?<=\S) ")
_SPACES = re.compile(r"\s ")


class Tokens:
    """Ids of a text with the byte each token ends at, and whether the tokens' bytes are those of the text."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, whole: bool) -> None:
        self.ids, self.ends, self.whole = ids, ends, whole


class Vocabulary:
    """The bytes of every id, one after another."""

    def __init__(self, entries: list[bytes]) -> None:
        self.size = np.array([len(e) for e in entries], dtype=np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.size)))
        self.data = np.frombuffer(b"".join(entries), dtype=np.uint8)

    def spans(self, ids: np.ndarray, coarse: np.ndarray, inside: np.ndarray, text: bytes) -> Tokens:
        """Token ends from coarse cuts. Where a cut lies ``inside`` a character, the decoded bytes of the tokens
        since the last clean cut say where the token ends. All ends are then held against the decoded bytes."""
        size = self.size[ids]
        clean = np.flatnonzero(~inside)
        before = np.searchsorted(clean, np.arange(len(ids))) - 1  # the last clean token before each
        total = np.cumsum(size)
        anchor = np.where(before >= 0, clean[before], -1) if len(clean) else np.full(len(ids), -1)
        base = np.where(anchor >= 0, coarse[anchor], 0)
        passed = np.where(anchor >= 0, total[anchor], 0)
        ends = np.where(inside, base + total - passed, coarse)
        whole = bool(len(ids)) and bool((size > 0).all()) and bool(np.array_equal(ends, total)) and int(total[-1]) == len(text)
        if whole:
            place = np.repeat(self.start[ids] - (total - size), size) + np.arange(total[-1])
            whole = self.data[place].tobytes() == text
        return Tokens(ids, ends, whole)


class Pair:
    """Tokenizer A (a byte-level file of the tokenizers library) and B (a sentencepiece model)."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # the strings of special tokens are plain text
        self.b = SentencePieceProcessor(model_file=b_path)
        # The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        sign = {chr(x): x for x in own} | {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in own)}
        if set(sign) != set(ByteLevel.alphabet()):
            raise ValueError(f"{a_path}: unknown byte-level alphabet")
        entries = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            entries[i] = bytes(map(sign.__getitem__, token)) if all(c in sign for c in token) else b""
        self.a_bytes = Vocabulary(entries)
        n = self.b.get_piece_size()
        self.b_byte = np.array([self.b.is_byte(i) for i in range(n)])
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.b_bytes = Vocabulary([bytes([int(p[3:5], 16)]) if byte else b"" if self.b.is_control(i) or self.b.is_unknown(i)
                                   else p.replace("▁", " ").encode() for i, (p, byte) in enumerate(zip(pieces, self.b_byte))])
        # Words can be encoded alone only if no piece goes on past the blank that opens the next word.
        self.by_word = not any(re.search("[^▁]▁", p) for p in pieces)
        self.a_text, self.b_text = ([str(i) for i in range(m)] for m in (len(entries), n))
        self.names = [x + sign for x in (*self.a_text, *self.b_text) for sign in ",|;"]

    def tokens(self, text: str) -> tuple[Tokens, Tokens, bytes]:
        """Both tokenizations of a blank and the text; A sees the blank, B adds it."""
        data = (" " + text).encode()
        found = self.a.encode(" " + text, add_special_tokens=False)
        ids = np.array(found.ids, dtype=np.int64)
        span = np.fromiter(itertools.chain.from_iterable(found.offsets), dtype=np.int64, count=2 * len(ids)).reshape(-1, 2)
        lead = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
        byte_of = np.append(np.flatnonzero(lead), len(data))  # the byte at which each character starts
        inside = np.append(span[1:, 0] < span[:-1, 1], False) if len(ids) else np.zeros(0, dtype=bool)
        a = self.a_bytes.spans(ids, byte_of[span[:, 1]], inside, data)
        pieces = self.b.encode(text, return_type="proto", num_threads=1).pieces
        ids, ends = (np.array(x, dtype=np.int64) for x in ([p.id for p in pieces], [p.end for p in pieces]))
        # All bytes of a character but its last end where the piece before them does.
        inside = self.b_byte[ids] & (ends == np.concatenate(([0], ends[:-1]))) if len(ids) else np.zeros(0, dtype=bool)
        return a, self.b_bytes.spans(ids, ends + 1, inside, data), data


_pairs: dict[tuple[str, str], Pair] = {}


def tokenizer_pair(a_path: str, b_path: str) -> Pair:
    """Loaded once per worker process."""
    if (a_path, b_path) not in _pairs:
        _pairs[a_path, b_path] = Pair(a_path, b_path)
    return _pairs[a_path, b_path]


def align(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The byte ends of the groups (where tokens of both sides end), and for each link its byte end and the numbers of its tokens.

    Between two neighbouring ends of either side lies exactly one A and one B token, and no pair of tokens twice:
    these stretches are the links.
    """
    groups = np.intersect1d(a.ends, b.ends, assume_unique=True)
    stretch = np.union1d(a.ends, b.ends)
    return groups, stretch, np.searchsorted(a.ends, stretch), np.searchsorted(b.ends, stretch)


class Words:
    """Aligned words: tokens, groups and links of a blank and a word, learned once and looked up afterwards.

    A blank after a sign that is no white space opens a token in both tokenizers, so both cut there, and what stands
    between two such blanks is tokenized alike in any text.
    """

    def __init__(self, pair: Pair) -> None:
        self.pair, self.number, self.bytes = pair, {}, 0
        self.groups: list[bytes] = []
        self.counts: list[np.ndarray] = []  # rows of A tokens, B tokens, groups, links, whole
        self.codes: list[np.ndarray] = []

    def split(self, text: str) -> list[str]:
        if not self.pair.by_word:
            return [text]
        return _CUT.split(text) if text[0] == " " or _SPACES.search(text) else text.split(" ")

    def learn(self, words: list[str]) -> None:
        plain = [w for w in words if w and not w[-1].isspace() and "▁" not in w] if self.pair.by_word else []
        for low in range(0, len(plain), JOINED):
            some = plain[low:low + JOINED]
            if not self._add(some, " ".join(some), 0):
                for w in some:
                    self._alone(w)
        for w in words:
            if w not in self.number:
                self._alone(w)

    def _alone(self, word: str) -> None:
        """A word by itself, behind a letter so that an empty one or one of blanks keeps its place."""
        if not (self._add([word], "a " + word, 2) if self.pair.by_word else self._add([word], word, 0)):
            self.number[word] = len(self.groups)
            self.groups.append(b"")
            self.counts.append(np.zeros((1, 5), dtype=np.int64))

    def _add(self, words: list[str], text: str, skip: int) -> bool:
        """Learn words that stand side by side in ``text`` from byte ``skip`` on; False if a token crosses a word's end."""
        a, b, data = self.pair.tokens(text)
        if not (a.whole and b.whole):
            return False
        size = np.fromiter(map(len, map(str.encode, words)), dtype=np.int64, count=len(words))
        edges = skip + np.concatenate(([0], np.cumsum(1 + size)))
        groups, stretch, left, right = align(a, b)
        if edges[-1] != len(data) or not np.isin(edges[1:] if not skip else edges, groups).all():
            return False
        places = [np.searchsorted(ends, edges, side="right") for ends in (a.ends, b.ends, groups, stretch)]
        self.number.update(zip(words, range(len(self.groups), len(self.groups) + len(words))))
        sequence, own = self._sequence(a, b, groups), (places[0] + places[1]).tolist()
        self.groups += ["".join(sequence[x:y])[:-1].encode() for x, y in zip(own, own[1:])]
        self.bytes += 8 * len(data)
        self.counts.append(np.stack([np.diff(p) for p in places] + [np.ones(len(words), dtype=np.int64)], axis=1))
        self.codes.append((a.ids[left] * len(self.pair.b_text) + b.ids[right])[places[3][0]:])
        return True

    def _sequence(self, a: Tokens, b: Tokens, groups: np.ndarray) -> list[str]:
        """The ids of all groups in order, each with the sign that parts it from the next: ``a1,a2|b1;``."""
        place = np.concatenate([2 * np.searchsorted(groups, t.ends) + side for side, t in enumerate((a, b))])
        order = np.argsort(place, kind="stable")
        place, last = place[order], np.append(place[order][1:], -1)
        sign = np.where(place == last, 0, np.where(place & 1, 2, 1))
        number = np.concatenate((a.ids, b.ids + len(self.pair.a_text)))[order]
        return list(map(self.pair.names.__getitem__, (3 * number + sign).tolist()))

    def full(self) -> bool:
        return len(self.groups) > CACHED_WORDS or self.bytes > CACHED_BYTES

    def pool(self) -> tuple[np.ndarray, np.ndarray]:
        """The links of all words as codes, one after another, and where each word's end."""
        if len(self.codes) > 1:
            self.codes = [np.concatenate(self.codes)]
        pool = self.codes[0] if self.codes else np.zeros(0, dtype=np.int64)
        return pool, np.concatenate(([0], np.cumsum(self.tables()[:, 3])))

    def tables(self) -> np.ndarray:
        if len(self.counts) > 1:
            self.counts = [np.concatenate(self.counts)]
        return self.counts[0] if self.counts else np.zeros((0, 5), dtype=np.int64)


_words: dict[tuple[str, str], Words] = {}


def known_words(a_path: str, b_path: str) -> Words:
    """The words that this worker process has learned so far, also in earlier tasks; forgotten once they are too many."""
    key = a_path, b_path
    if key not in _words or _words[key].full() or _words[key].pair is not tokenizer_pair(*key):
        _words[key] = Words(tokenizer_pair(*key))
    return _words[key]


class _Chunk:
    """Documents of a task until they fill a chunk: their words by number and what is known without the corpus."""

    def __init__(self) -> None:
        self.ids: list = []
        self.sums: list[np.ndarray] = []
        self.digests: list[str] = []
        self.words: list[np.ndarray] = []
        self.size: list[np.ndarray] = []
        self.bytes = 0

    def add(self, ids: list, texts: list[str], words: Words) -> None:
        split = [words.split(t) if t else [] for t in texts]
        unseen = set().union(*split).difference(words.number)
        if unseen:
            words.learn(list(unseen))
        table, known, text_of = words.tables(), words.number.__getitem__, words.groups.__getitem__
        for i, parts in zip(ids, split):
            own = np.fromiter(map(known, parts), dtype=np.int64, count=len(parts))
            if len(own) and not table[own, 4].all():
                own = own[:0]
            self.ids.append(i)
            self.sums.append(table[own, :4].sum(axis=0))
            self.digests.append(hashlib.sha256(b";".join(map(text_of, own.tolist()))).hexdigest() if len(own) else "")
            self.words.append(own)
        self.bytes += sum(map(len, texts))

    def close(self, words: Words, folder: str) -> tuple[str, np.ndarray, np.ndarray]:
        """Write the chunk; its path, the codes of its token pairs and their numbers of links."""
        used, place = np.unique(np.concatenate(self.words), return_inverse=True)
        often = np.bincount(place, minlength=len(used))
        pool, ends = words.pool()
        many = ends[used + 1] - ends[used]
        owner = np.repeat(np.arange(len(used)), many)
        codes = pool[np.repeat(ends[used] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(len(owner))]
        pairs, pair = np.unique(codes, return_inverse=True)
        links = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(links, pair, often[owner])
        out = io.BytesIO()
        small = lambda x: x.astype(np.min_scalar_type(int(x.max(initial=0))))
        np.savez(out, sums=np.array(self.sums), words=small(place), size=small(np.array([len(w) for w in self.words])),
                 owner=small(owner), pair=small(pair), digests=np.array(self.digests, dtype="S64"),
                 ids=np.array([i or 0 for i in self.ids], dtype=np.int64), known=np.array([i is not None for i in self.ids]))
        path = files.new_file(folder, ".chunk")
        with files.write_stream(path) as stream:
            stream.write(zstandard.ZstdCompressor(level=3).compress(out.getvalue()))
        return path, pairs, links


def _read_chunk(path: str) -> dict[str, np.ndarray]:
    system, name = files.opened(path)
    with system.open_input_stream(name) as stream:
        return dict(np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(stream.read()))))


def tokenizer_spans(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``a`` and ``b``, arrays of (id, start, stop) in bytes of a blank and the text, and ``groups``, an array of
    the bytes at which tokens of both sides end. All three are empty where :func:`align_tokenizers` finds no tokens."""
    token = pa.list_(pa.struct([("id", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]))
    kind = pa.struct([("a", token), ("b", token), ("groups", pa.list_(pa.int64()))])

    def listed(t: Tokens) -> list[dict]:
        ends = t.ends.tolist()
        return [{"id": i, "start": x, "stop": y} for i, x, y in zip(t.ids.tolist(), [0, *ends], ends)]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pair = tokenizer_pair(a_path, b_path)
        for texts in textops.released(batches):
            out = []
            for text in texts.to_pylist():
                a, b, _ = pair.tokens(text) if text else (None, None, None)
                fits = a is not None and a.whole and b.whole
                out.append({"a": listed(a), "b": listed(b), "groups": align(a, b)[0].tolist()} if fits else {"a": [], "b": [], "groups": []})
            yield pa.array(out, kind)

    span = "array<struct<id: long, start: long, stop: long>>"
    found = F.arrow_udf(run, f"struct<a: {span}, b: {span}, groups: array<long>>")(F.col(f"`{text_col}`").cast("string"))
    names = ("a", "b", "groups")
    kept = [f"`{c}`" for c in docs.columns if c not in names]
    inner = F.struct(*kept) if kept else F.struct(F.lit(0))
    rows = docs.select(inner.alias("row"), found.alias("found"))
    return rows.select(*[F.col("row")[c.strip("`")].alias(c.strip("`")) for c in kept], *[F.col(f"found.{n}") for n in names])


def align_tokenizers(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Align tokenizer A and B on every whole text. Returns documents and links.

    Documents: the id, ``n_a, n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``.
    Links: ``a, b, count, best``, every pair of ids whose tokens overlap somewhere, how many links of the corpus hold it,
    and whether no other pair of its B id has more.

    Both encode a blank and the text (B adds the blank itself), special tokens' strings as plain text. Token
    ends are byte positions: A's character offsets and B's proto spans are the coarse cuts; inside a
    character of several tokens and in byte-fallback runs the decoded bytes refine them. Bytes where
    both sides end cut the tokens into groups; ``groups_sha256`` hashes ``a1,a2|b1;a3|b2,b3``.

    A blank after a sign that is no white space always opens a token, so words are aligned once per worker
    and looked up afterwards (whole texts are encoded where a vocabulary has a piece across such a blank). A
    task writes its documents in chunks of about ``chunk_bytes`` of text (or one longer text) as files of
    its own, which hold word numbers; only the distinct id pairs of a chunk are shuffled, to be summed over the
    corpus, and come back to their chunk. So a pair that every document holds is one row per chunk.

    NULL and empty texts, and those whose tokens' bytes are not those of the text (a literal U+2581),
    have no tokens: zeros and an empty hash. NULL and repeated ids are rows like others; an empty table gives
    empty results; other columns are ignored.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "aligned")
    width = tokenizer_pair(a_path, b_path).b.get_piece_size()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, chunk = known_words(a_path, b_path), _Chunk()

        def close() -> pa.RecordBatch:
            path, pairs, links = chunk.close(words, folder)
            # The last row names the chunk even if it has no pair.
            a, b = (np.append(x, -1) for x in (pairs // width, pairs % width))
            return pa.RecordBatch.from_arrays(
                [pa.array([path] * len(a)), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(np.append(links, 0))],
                names=["chunk", "a", "b", "links"])

        for batch in textops.released(batches):
            ids, texts = batch.column(0), batch.column(1)
            size = texts.fill_null("").cast(pa.large_string())
            low = 0
            for low, high, _, _ in textops.text_runs(size):
                chunk.add(ids.slice(low, high - low).to_pylist(), [t or "" for t in texts.slice(low, high - low).to_pylist()], words)
                if chunk.bytes >= chunk_bytes:
                    yield close()
                    words, chunk = known_words(a_path, b_path), _Chunk()
        if chunk.ids:
            yield close()

    rows = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string"))
    pairs = staged(rows.mapInArrow(read, "chunk string, a int, b int, links long"), "pairs")
    counts = pairs.where("a >= 0").groupBy("a", "b").agg(F.sum("links").alias("count"))
    counts = staged(counts, "counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))  # one row per id of B
    links = staged(counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best")), "links")

    def finish(table: pa.Table) -> pa.Table:
        chunk = _read_chunk(table["chunk"][0].as_py())
        order = np.argsort(table["a"].to_numpy().astype(np.int64) * width + table["b"].to_numpy())
        order = order[np.count_nonzero(table["a"].to_numpy() < 0):]
        n = int(chunk["owner"][-1]) + 1 if len(chunk["owner"]) else 0  # every word of a document has a link
        ends = np.concatenate(([0], np.cumsum(chunk["size"], dtype=np.int64)))
        out = []
        for column in ("best", "count"):
            value = table[column].to_numpy()[order].astype(np.int64)
            per_word = np.zeros(n, dtype=np.int64)
            np.add.at(per_word, chunk["owner"], value[chunk["pair"]])
            total = np.concatenate(([0], np.cumsum(per_word[chunk["words"]])))
            out.append(total[ends[1:]] - total[ends[:-1]])
        return pa.table(
            [pa.array(chunk["ids"], mask=~chunk["known"]), *(pa.array(x) for x in chunk["sums"].T.astype(np.int64)), *map(pa.array, out),
             pa.array([d.decode() for d in chunk["digests"].tolist()], pa.string())],
            names=[id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    back = pairs.join(links, ["a", "b"], "left").select(
        "chunk", "a", "b", F.coalesce("count", F.lit(0)).cast("long").alias("count"), F.coalesce("best", F.lit(False)).cast("long").alias("best"))
    schema = f"`{id_col}` long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return back.groupBy("chunk").applyInArrow(finish, schema), links


def piece_bpe() -> str:
    """The sentencepiece model that queries use by default."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
