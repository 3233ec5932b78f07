"""Token ids of documents as range-coded binary files, and their reader."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from keelson.llm import files, range_coder, textops
from keelson.session import scratch_path, shuffle_width, staged

MAGIC = b"KEELTOK2"
_BLOCK_HEAD = struct.Struct("<IIII")  # ids, payload bytes, crc32 of the payload, crc32 of the ids
FILE_IDS, FILE_DOCS = 1 << 25, 1 << 20
CACHED_PIECES = 250_000
_RUN_OF_SPACES = re.compile(r"\s \s")
RUN_BYTES, CUT_BYTES, KEPT_PIECES, KEPT_BYTES, JOINED = 1 << 24, 1 << 21, 700_000, 64, 1000


def _bytes(*spans: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, dtype=np.uint8)
    for low, high in spans:
        out[low:high + 1] = 1
    return out


_GRAPHIC, _LETTER = _bytes((0x21, 0x7E)), _bytes((0x41, 0x5A), (0x61, 0x7A))
_SIGN = _GRAPHIC & ~(_LETTER | _bytes((0x30, 0x39)))
# Of the last bytes of longer characters those that no Unicode space ends with.
_SOLID = _GRAPHIC | _bytes((0x8B, 0x9E), (0xA1, 0xA7), (0xAA, 0xAE), (0xB0, 0xBF)) & ~_bytes((0x9F, 0x9F))
# First bytes of two: none of these characters is a space, and with some all are letters, but for two signs.
_TWO, _TWO_LETTERS, _TWO_SIGNS = _bytes((0xC3, 0xDF)), _bytes((0xC3, 0xC9), (0xD0, 0xD1)), (0xC397, 0xC3B7)
_LEFT, _RIGHT = _SOLID | _LETTER << 1, _bytes((0x20, 0x20), (0x09, 0x0A), (0x0D, 0x0D)) | _SIGN << 1


class TextEncoder:
    """Ids of texts by the tokenizers library, with a bounded cache of the pieces between spaces.

    The pre-tokenizer of a byte-level vocabulary joins at most one space to the word after it, so
    a text may be cut before any space that has no white space on one of its two sides, and each
    piece encoded alone. A text with another space, or with an added token of the vocabulary, is encoded whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        spaced = [i for t, i in self.library.get_vocab().items() if t.startswith("\u0120")]  # the byte-level sign of a space
        self.opens = np.zeros(max(range_coder.IDS, self.library.get_vocab_size()), dtype=bool)
        self.opens[spaced] = True
        self.pieces: dict[str, bytes] = {}
        self.kept, self.kept_ids = pa.array([], pa.string()), np.zeros(0, dtype="<u2")
        self.kept_at, self.kept_size = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def encode(self, text: str) -> bytes:
        return self._checked(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    @staticmethod
    def _checked(ids: list[int]) -> np.ndarray:
        if ids and max(ids) >= range_coder.IDS:
            raise ValueError("token ids from 65,536 on do not fit the file format")
        return np.array(ids, dtype="<u2")

    def _learn(self, pieces: set[str]) -> None:
        """Encode unseen pieces side by side: the ids that open with a space part them again."""
        if len(self.pieces) + len(pieces) > CACHED_PIECES:
            self.pieces.clear()
        plain = [p for p in pieces if p and not p[0].isspace() and not p[-1].isspace()]
        if plain:
            ids = np.frombuffer(self.encode(" " + " ".join(plain)), dtype="<u2")
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) == len(plain):
                raw, ends = ids.tobytes(), [*(2 * starts[1:]).tolist(), 2 * len(ids)]
                for p, a, z in zip(plain, (2 * starts).tolist(), ends):
                    self.pieces[p] = raw[a:z]
                pieces = pieces.difference(plain)
        for p in pieces:
            self.pieces[p] = self.encode(" " + p)

    def __call__(self, text: str) -> bytes:
        """Little-endian 16-bit ids."""
        return self.batch([text])[0]

    def batch(self, texts: list[str]) -> list[bytes]:
        cut = [t.split(" ") if t and not _RUN_OF_SPACES.search(t) and not (self.added and self.added.search(t)) else None for t in texts]
        unseen = set().union(*(c[1:] for c in cut if c)).difference(self.pieces)
        if unseen:
            self._learn(unseen)
            unseen = set().union(*(c[1:] for c in cut if c)).difference(self.pieces)
            if unseen:  # the cache was emptied on the way
                self._learn(unseen)
        known, out = self.pieces.__getitem__, []
        for t, c in zip(texts, cut):
            if c is None:
                out.append(self.encode(t) if t else b"")
            else:
                out.append((self.encode(c[0]) if c[0] else b"") + b"".join(map(known, c[1:])))
        return out

    def column(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text of a string column (NULL: none), as of :meth:`__call__`.

        Texts are taken in runs of about ``RUN_BYTES`` and cut, by their bytes, into pieces that the pre-tokenizer parts for certain:
        before white space that follows something else, before an ASCII sign that follows a letter, and
        after a single line feed between ASCII signs or letters. The library encodes each distinct piece once; up
        to ``KEPT_PIECES`` short ones are kept for later runs. A text with an added token is one piece.
        """
        texts = texts.fill_null("")
        whole = np.zeros(len(texts), dtype=bool)
        for token in self.library.get_added_tokens_decoder().values():
            whole |= np.asarray(pc.match_substring(texts, token.content))
        cut, taken = [], 0
        for low, high, data, offsets in textops.text_runs(texts, CUT_BYTES):
            if cut and taken + len(data) > RUN_BYTES:
                yield from self._coded(cut)
                cut, taken = [], 0
            cut.append(self._cut(data, offsets, whole[low:high]))
            taken += len(data)
        if cut:
            yield from self._coded(cut)

    def _coded(self, cut: list[tuple[pa.Array, np.ndarray]]) -> Iterator[bytes]:
        """The ids of the texts of a run, from the pieces of its parts."""
        some = [pieces for pieces, _ in cut if len(pieces)]
        firsts = [(len(pieces), first) for pieces, first in cut]
        cut.clear()
        if any(pa.types.is_large_string(pieces.type) for pieces in some):
            some = [pieces.cast(pa.large_string()) for pieces in some]
        coded = pa.chunked_array(some, some[0].type if some else pa.string()).dictionary_encode()
        del some
        chunks = iter(coded.chunks)
        own, begin, size = self._distinct(coded.chunk(0).dictionary) if coded.num_chunks else (None, None, None)
        for n, first in firsts:
            if not n:
                yield from [b""] * (len(first) - 1)
                continue
            code = np.asarray(next(chunks).indices)
            ids, at = gathered(own, begin[code], size[code])
            bounds = (2 * np.append(at, len(ids))[first]).tolist()
            ids = ids.tobytes()
            del code, at
            for a, z in zip(bounds, bounds[1:]):
                yield ids[a:z]

    @staticmethod
    def _cut(data: np.ndarray, offsets: np.ndarray, whole: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The pieces of a run of texts, and for each text the number of its first one."""
        cut = np.zeros(len(data) + 1, dtype=bool)
        raw = bytearray(data)
        left = np.frombuffer(raw.translate(_LEFT.tobytes()), dtype=np.uint8)[:-1]
        right = np.frombuffer(raw.translate(_RIGHT.tobytes()), dtype=np.uint8)[1:]
        second = np.flatnonzero(data[1:-1] & 0xC0 == 0x80) + 1
        first = data[second - 1]
        letter = _TWO_LETTERS[first] & ~np.isin(first.astype(np.uint16) << 8 | data[second], _TWO_SIGNS)
        left[second] |= _TWO[first] | letter << 1
        np.not_equal(left & right, 0, out=cut[1:len(data)])
        line = np.flatnonzero(data[1:-1] == 0x0A) + 1
        cut[line[(_GRAPHIC[data[line - 1]] & _GRAPHIC[data[line + 1]]) > 0] + 1] = True
        for j in np.flatnonzero(whole):
            cut[offsets[j]:offsets[j + 1]] = False
        cut[offsets] = True
        at = np.flatnonzero(cut)
        kind, wide = (pa.large_string(), np.int64) if len(data) >> 31 else (pa.string(), np.int32)
        buffers = [None, pa.py_buffer(at.astype(wide)), pa.py_buffer(np.ascontiguousarray(data))]
        return pa.Array.from_buffers(kind, len(at) - 1, buffers), np.searchsorted(at, offsets)

    def _distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of distinct pieces: ids, and where those of each piece begin and how many they are."""
        found = np.asarray(pc.index_in(pieces, value_set=self.kept.cast(pieces.type)).fill_null(-1)).astype(np.int64)
        unseen = pieces.filter(pa.array(found < 0))
        found[found < 0] = len(self.kept) + np.arange(len(unseen))
        ids, begin, size = self._learned(unseen)
        ids = np.concatenate((self.kept_ids, ids))
        begins, sizes = np.concatenate((self.kept_at, len(self.kept_ids) + begin)), np.concatenate((self.kept_size, size))
        own_at, own_size = begins[found], sizes[found]

        if len(begins) > KEPT_PIECES or len(ids) > KEPT_BYTES * KEPT_PIECES:  # only the short pieces of this run go on
            short = pc.less_equal(pc.binary_length(pieces), KEPT_BYTES)
            self.kept, mask = pieces.filter(short).cast(pa.string()), np.asarray(short)
            self.kept_size = own_size[mask]
            self.kept_ids, self.kept_at = gathered(ids, own_at[mask], self.kept_size)
        elif len(unseen):
            short = pc.less_equal(pc.binary_length(unseen), KEPT_BYTES)
            mask = np.concatenate((np.ones(len(self.kept), dtype=bool), np.asarray(short)))
            self.kept = pa.concat_arrays([self.kept, unseen.filter(short).cast(pa.string())])
            self.kept_ids, self.kept_at, self.kept_size = ids, begins[mask], sizes[mask]
        return ids, own_at, own_size

    def _learned(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of unseen pieces by the library, as :meth:`_distinct` gives them.

        Pieces without white space but for a space before them are encoded many at a time: those with the space
        side by side, as their first ids open with it, the others as lines, as a single line feed between them is
        a token of its own. Where the count of these signs is not that of the pieces, each is encoded alone.
        """
        if not len(pieces):
            return np.zeros(0, dtype="<u2"), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.library.model._resize_cache(0)  # no piece comes twice
        line_end = int.from_bytes(self.encode("\n"), "little")  # more than an id if the vocabulary has no line feed: no id equals it
        spaced = np.asarray(pc.match_substring_regex(pieces, r"^ [^\p{Z}\p{C}]+$"))
        plain = np.asarray(pc.match_substring_regex(pieces, r"^[^\p{Z}\p{C}]+$"))
        alone, names = np.flatnonzero(~(spaced | plain)).tolist(), pieces.to_pylist()
        parts, order, sizes = [], [], []
        for chosen, between in ((spaced, ""), (plain, "\n")):
            chosen = np.flatnonzero(chosen)
            for low in range(0, len(chosen), JOINED):
                group = chosen[low:low + JOINED]
                text = between.join([names[j] for j in group.tolist()])
                found = self._checked(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids)
                signs = np.flatnonzero(found == line_end if between else self.opens[found])
                if len(signs) != len(group) - len(between):
                    alone += group.tolist()
                    continue
                parts.append(np.delete(found, signs) if between else found)
                sizes.append(np.diff(signs, prepend=-1, append=len(found)) - 1 if between else np.diff(signs, append=len(found)))
                order.append(group)
        rest = [self._checked(x.ids) for x in self.library.encode_batch_fast([names[j] for j in alone], add_special_tokens=False)]
        order = np.concatenate([*order, np.array(alone, dtype=np.int64)])
        size = np.concatenate([*sizes, np.array([len(x) for x in rest], dtype=np.int64)])
        begin, n = np.empty(len(pieces), dtype=np.int64), np.empty(len(pieces), dtype=np.int64)
        begin[order], n[order] = np.cumsum(size) - size, size
        return np.concatenate([*parts, *rest, np.zeros(0, dtype="<u2")]), begin, n


def gathered(ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans of ``ids`` one after another, and where each then begins."""
    ends = np.cumsum(size)
    at = ends - size
    shift, out = begin - at, np.empty(int(ends[-1]) if len(ends) else 0, dtype=ids.dtype)
    for low in range(0, len(size), 1 << 16):  # bounds the indexes
        some = slice(low, low + (1 << 16))
        first, end = int(at[low]), int(ends[some][-1])
        where = np.repeat(shift[some], size[some])
        where += np.arange(first, end)
        ids.take(where, out=out[first:end], mode="clip")
    return out, at


_encoders: dict[str, TextEncoder] = {}


def text_encoder(path: str) -> TextEncoder:
    """The encoder of a vocabulary file, loaded once per worker process."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


class _FileWriter:
    """One file: a magic number, then blocks of ``range_coder.BLOCK`` ids, each with its checksums."""

    def __init__(self, folder: str) -> None:
        self.path = files.new_file(folder, ".ids")
        self.stream = files.write_stream(self.path)
        self.stream.write(MAGIC)
        self.size, self.blocks, self.total = len(MAGIC), 0, 0
        self.parts: list[bytes] = []
        self.waiting = 0

    def add(self, ids: bytes) -> None:
        self.parts.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 4 * range_coder.BLOCK * range_coder.LANES:
            self._flush(False)

    def _flush(self, final: bool) -> None:
        ids = np.frombuffer(b"".join(self.parts), dtype="<u2")
        width = range_coder.BLOCK
        n = -(-len(ids) // width) if final else range_coder.LANES
        padded = np.zeros(n * width, dtype=np.uint16)
        padded[:min(len(ids), n * width)] = ids[:n * width]
        groups = -(-n // range_coder.LANES)  # of equal size: many lanes cost little more than few
        for low, high in ((n * g // groups, n * (g + 1) // groups) for g in range(groups)):
            for j, payload in enumerate(range_coder.encode(padded.reshape(n, width)[low:high]), low):
                own = ids[j * width:(j + 1) * width]
                head = _BLOCK_HEAD.pack(len(own), len(payload), zlib.crc32(payload), zlib.crc32(own.tobytes()))
                self.stream.write(head + payload)
                self.size += len(head) + len(payload)
        self.blocks += n
        self.total += min(len(ids), n * width)
        rest = ids[n * width:].tobytes()
        self.parts, self.waiting = [rest], len(rest)

    def close(self) -> None:
        self._flush(True)
        self.stream.close()


def read_blocks(path: str) -> Iterator[np.ndarray]:
    """The ids of a file in order, many blocks at a time; a damaged block raises ValueError."""
    system, name = files.opened(path)
    with system.open_input_stream(name, buffer_size=1 << 20) as stream:
        if stream.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is no token file")
        while True:
            heads, payloads = [], []
            while len(heads) < range_coder.LANES and (head := stream.read(_BLOCK_HEAD.size)):
                heads.append(_BLOCK_HEAD.unpack(head))
                payloads.append(stream.read(heads[-1][1]))
                if zlib.crc32(payloads[-1]) != heads[-1][2]:
                    raise ValueError(f"{path}: block payload does not match its checksum")
            if not heads:
                return
            rows = [row[:head[0]] for row, head in zip(range_coder.decode(payloads), heads)]
            for row, head in zip(rows, heads):
                if zlib.crc32(row.astype("<u2").tobytes()) != head[3]:
                    raise ValueError(f"{path}: decoded ids do not match their checksum")
            yield np.concatenate(rows)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = 0, file_ids: int = FILE_IDS, file_docs: int = FILE_DOCS,
) -> DataFrame:
    """Encode whole texts and write their ids in ascending order of the document id.

    Returns the stored index, one row per file: ``path, part, seq`` (the order of the files),
    ``n_ids, n_blocks, n_bytes`` and, in file order, ``doc_ids`` and ``counts`` (ids of each
    document with the ``end_id`` that closes it). A file ends at a document boundary after about
    ``file_ids`` ids or after ``file_docs`` documents, which bounds an index row.

    Blocks are coded without any state from others and carry a checksum of the payload and of
    the ids. A NULL or empty text has only its end id. Rows that repeat an id are written one
    after another, ordered by text; NULL ids come first. An empty table has no files. Other
    columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = text_encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u2").tobytes()
        writer, seq, ids, counts = None, 0, [], []

        def finish() -> pa.RecordBatch:
            writer.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (writer.path, part, seq, writer.total, writer.blocks, writer.size)]
                + [pa.array([ids], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64()))], schema=arrow)

        for batch in textops.released(batches):
            for doc, found in zip(batch.column(0).to_pylist(), encoder.column(batch.column(1))):
                if writer is None:
                    writer, ids, counts = _FileWriter(folder), [], []
                found += end
                writer.add(found)
                ids.append(doc)
                counts.append(len(found) // 2)
                if writer.total + writer.waiting // 2 >= file_ids or len(ids) >= file_docs:
                    yield finish()
                    writer, seq = None, seq + 1
        if writer is not None:
            yield finish()

    arrow = pa.schema([("path", pa.string()), ("part", pa.int64()), ("seq", pa.int64()), ("n_ids", pa.int64()),
                       ("n_blocks", pa.int64()), ("n_bytes", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
    schema = "path string, part long, seq long, n_ids long, n_blocks long, n_bytes long, doc_ids array<long>, counts array<long>"
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
        # The first characters part rows that share an id, or have none, without a whole text in the ranges' bounds.
        .repartitionByRange(shuffle_width(docs.sparkSession), F.col("_id"), F.substring("_text", 1, 32)).sortWithinPartitions("_id", "_text"))
    return staged(ordered.mapInArrow(run, schema), "token-index")


def read_token_files(index: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Read the files of an index back: id, ``start`` (ids of all documents before), ``n_tokens`` and
    ``ids_crc32``, the unsigned crc32 of the document's ids as little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.released(batches):
            for path, start, ids, counts in zip(*(c.to_pylist() for c in batch.columns)):
                ends = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
                crc, done, seen = np.zeros(len(ids), dtype=np.int64), 0, 0
                pending = np.zeros(0, dtype=np.uint16)
                for block in read_blocks(path):
                    pending = np.concatenate((pending, block))
                    full = int(np.searchsorted(ends, seen + len(pending), side="right")) - 1
                    wide = pending.astype("<u4")
                    for j in range(done, full):
                        crc[j] = zlib.crc32(wide[ends[j] - seen:ends[j + 1] - seen].tobytes())
                    pending, seen, done = pending[ends[full] - seen:], int(ends[full]), full
                if done != len(ids) or len(pending):
                    raise ValueError(f"{path} does not hold the ids that its index counts")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(ends[:-1] + start), pa.array(np.diff(ends)), pa.array(crc)],
                    names=[id_col, "start", "n_tokens", "ids_crc32"])

    # Parts are the tasks of the writer, files are few per part: two small windows, no row of a document in them.
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("_in_part")).select(
        "part", (F.sum("_in_part").over(W.orderBy("part")) - F.col("_in_part")).alias("_before"))
    in_part = F.sum("n_ids").over(W.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    placed = index.withColumn("_in", in_part).join(parts, "part")
    jobs = placed.select("path", (F.col("_before") + F.col("_in")).alias("start"), "doc_ids", "counts")
    width = shuffle_width(index.sparkSession)
    schema = f"`{id_col}` long, start long, n_tokens long, ids_crc32 long"
    return jobs.repartition(width, "path").mapInArrow(run, schema)


def byte_bpe() -> str:
    """The vocabulary file that queries use by default."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_folder(spark) -> str:
    return scratch_path(spark, "tokens")
