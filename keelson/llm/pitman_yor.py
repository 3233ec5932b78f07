"""Hierarchical Pitman-Yor language model: seatings sampled by Gibbs over Spark, averaged predictive probabilities."""

from __future__ import annotations

import io
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm import files, textops
from keelson.session import scratch_path, staged

CONTEXT = 3
BURN_IN, SAMPLES, INNER = 2, 3, 4
CHUNK_BYTES = 16 << 20
BLOCK_BYTES, MANY_BLOCKS = 64 << 20, 16
EVENT_BYTES = 1 << 20
EXACT = 64
SYMBOLS = 257  # bytes, then the start of a word as context or its end as dish
EDGE = 256
# What a row of a block is, unless its code is an event: sums over words, the files of a block, messages between blocks.
TABLES, CUSTOMERS, ONCE, TWICE, STATE, PAIRS, KNOWN, MESSAGE, SINGLES, REPLY = range(-1, -11, -1)
ROWS = "block long, code long, n long, p double, source long, data binary"


def stirling(n: int, discount: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers S(c, t): the weight of all seatings of c customers at t tables."""
    out = np.full((n + 1, n + 1), -np.inf)
    out[0, 0] = 0
    for c in range(1, n + 1):
        t = np.arange(1, c + 1)
        grown = np.log(np.maximum(c - 1 - discount * t, 1e-300)) + out[c - 1, 1:c + 1]
        out[c, 1:c + 1] = np.logaddexp(out[c - 1, :c], grown)
    return out


_stirling: dict[float, np.ndarray] = {}


def draw_tables(customers: np.ndarray, others: np.ndarray, log_parent: np.ndarray, discount: float, theta: float, random) -> np.ndarray:
    """The number of tables of every dish, drawn from its conditional given all else.

    With c customers, ``others`` tables of other dishes in its restaurant and parent probability p, that is
    P(t) ~ S(c, t) * p^t * (theta + discount * others) (theta + discount * (others + 1)) ... (t factors). Up to
    ``EXACT`` customers the draw is from that law. Beyond, tables of given sizes form a Poisson process
    conditioned on c customers, and t is drawn from the normal law with its mean and variance (saddle point), or
    from a Poisson law near 1 and c.
    """
    if discount not in _stirling:
        _stirling[discount] = stirling(EXACT, discount)
    table, out = _stirling[discount], np.minimum(customers, 1)
    for c in np.unique(customers[(customers > 1) & (customers <= EXACT)]).tolist():
        row = np.flatnonzero(customers == c)
        for own in np.array_split(row, max(1, len(row) * c // 2_000_000)):
            t = np.arange(c)
            steps = np.log(theta + discount * (others[own, None] + t)) + log_parent[own, None]
            weight = np.cumsum(steps, axis=1) + table[c, 1:c + 1]
            out[own] = 1 + (weight + random.gumbel(size=weight.shape)).argmax(axis=1)
    row = np.flatnonzero(customers > EXACT)
    if len(row):
        c, a = customers[row].astype(np.float64), np.log(theta + discount * others[row]) + log_parent[row]
        low, high = np.full(len(row), -700.0), np.zeros(len(row))
        for _ in range(60):  # a * (1 - y) * y^(discount - 1) = c, solved for log y
            middle = (low + high) / 2
            above = a + np.log(-np.expm1(middle)) + (discount - 1) * middle > np.log(c)
            low, high = np.where(above, middle, low), np.where(above, high, middle)
        log_y = np.minimum(high, -1e-12)
        x, filled = -np.expm1(log_y), -np.expm1(discount * log_y)
        tables = np.exp(a) / discount * filled
        size = x * discount * np.exp((discount - 1) * log_y) / filled
        square = size + x * x * discount * (1 - discount) * np.exp((discount - 2) * log_y) / filled
        mean, spread = 1 + tables * (1 - 1 / c), np.sqrt(np.maximum(tables * (1 - size * size / square), 0))
        mean, spread = np.clip(np.nan_to_num(mean, nan=1.0), 1, c), np.nan_to_num(spread)
        drawn = np.rint(random.normal(mean, spread))
        few, most = mean - 1 < 20, c - mean < 20  # near either end the law is that of rare events
        drawn = np.where(few, 1 + random.poisson(np.minimum(mean - 1, 20)), drawn)
        drawn = np.where(most & ~few, c - random.poisson(np.minimum(c - mean, 20)), drawn)
        out[row] = np.clip(drawn, 1, customers[row]).astype(out.dtype)
    return out


def events(data: np.ndarray, offsets: np.ndarray, context: int) -> tuple[np.ndarray, np.ndarray]:
    """The spelling events of words, the bytes between ``offsets``: for each byte and the end of a word a code of its last
    ``context`` symbols and itself; and the first event of each word."""
    n = len(offsets) - 1
    size = np.diff(offsets) + 1
    first = np.concatenate(([0], np.cumsum(size)))
    dish = np.full(first[-1], EDGE, dtype=np.int64)
    inside = np.ones(first[-1], dtype=bool)
    inside[first[1:] - 1] = False
    dish[inside] = data
    place = np.arange(first[-1]) - np.repeat(first[:-1], size) if n else np.zeros(0, dtype=np.int64)
    code = np.zeros(first[-1], dtype=np.int64)
    for back in range(context, 0, -1):
        symbol = np.full(first[-1], EDGE, dtype=np.int64)
        symbol[place >= back] = dish[np.flatnonzero(place >= back) - back]
        code = code * SYMBOLS + symbol
    return code * SYMBOLS + dish, first


def event_runs(words: dict[str, np.ndarray], context: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """:func:`events` of the words of a block, for runs of words of about ``EVENT_BYTES``."""
    data, offsets, low = words["data"], words["offsets"], 0
    while low < len(offsets) - 1:
        high = max(int(np.searchsorted(offsets, offsets[low] + EVENT_BYTES, side="right")) - 1, low + 1)
        yield slice(low, high), *events(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low], context)
        low = high


def spelling(codes: np.ndarray, customers: np.ndarray, base: np.ndarray, context: int, discount: float, theta: float, sweeps: int,
             random) -> tuple[np.ndarray, np.ndarray]:
    """Gibbs sweeps over the restaurants of all contexts that end in one symbol.

    ``codes`` are sorted events with their customers (0 for an event that is only asked for). The
    restaurant of a context of k symbols sends a customer to that of its last k - 1 symbols for each of its tables;
    ``base`` is the predictive law of the empty context. Returns the predictive log probability of every
    event and the customers that the empty context gets per dish.
    """
    names, up, rooms, counts = [None] * (context + 1), [None] * (context + 1), [None] * (context + 1), [None] * (context + 1)
    names[context] = codes
    for k in range(context, 0, -1):
        _, rooms[k] = np.unique(names[k] // SYMBOLS, return_inverse=True)
        names[k - 1], up[k] = np.unique(names[k] % SYMBOLS**k, return_inverse=True)
    tables = [None] * (context + 1)
    counts[context] = customers
    for k in range(context, 0, -1):
        tables[k] = np.minimum(counts[k], 1)
        counts[k - 1] = np.bincount(up[k], weights=tables[k], minlength=len(names[k - 1])).astype(np.int64)

    def predictive() -> list[np.ndarray]:
        p = [base[names[0]]]
        for k in range(1, context + 1):
            guests, taken = (np.bincount(rooms[k], weights=x)[rooms[k]] for x in (counts[k], tables[k]))
            p.append((counts[k] - discount * tables[k] + (theta + discount * taken) * p[k - 1][up[k]]) / (theta + guests))
        return p

    for _ in range(sweeps):
        p = predictive()
        for k in range(context, 0, -1):
            others = np.bincount(rooms[k], weights=tables[k])[rooms[k]] - tables[k]
            tables[k] = draw_tables(counts[k], np.maximum(others, 0), np.log(p[k - 1][up[k]]), discount, theta, random)
            counts[k - 1] = np.bincount(up[k], weights=tables[k], minlength=len(names[k - 1])).astype(np.int64)
            if k > 1:  # tables of the parent for its new customers, until they are drawn in their turn
                tables[k - 1] = np.clip(tables[k - 1], np.minimum(counts[k - 1], 1), counts[k - 1])
    sent = np.zeros(SYMBOLS, dtype=np.int64)
    sent[names[0]] = counts[0]
    return np.log(predictive()[context]), sent


def root(customers: np.ndarray, discount: float, theta: float, random, sweeps: int = 20) -> np.ndarray:
    """The predictive law of the empty context over a uniform base; one count per dish."""
    tables = np.minimum(customers, 1)
    uniform = np.full(SYMBOLS, 1 / SYMBOLS)
    for _ in range(sweeps):
        tables = draw_tables(customers, tables.sum() - tables, np.log(uniform), discount, theta, random)
    return (customers - discount * tables + (theta + discount * tables.sum()) * uniform) / (theta + customers.sum())


@dataclass(frozen=True)
class Restaurant:
    """The restaurant of words: ``customers`` are training tokens, or the tables of the restaurants of previous words."""

    customers: int
    tables: int
    discount: float
    theta: float = 1.0

    def predictive(self, customers: np.ndarray, tables: np.ndarray, log_spelled: np.ndarray) -> np.ndarray:
        """Log probability of words: their seats, and a new table with the probability of their spelling."""
        new = np.log(self.theta + self.discount * self.tables) + log_spelled
        with np.errstate(divide="ignore"):
            seated = np.log(customers - self.discount * tables)
        return np.logaddexp(seated, new) - np.log(self.theta + self.customers)


def _save(path: str, **arrays: np.ndarray) -> None:
    out = io.BytesIO()
    np.savez(out, **arrays)
    with files.write_stream(path) as stream:
        stream.write(zstandard.ZstdCompressor(level=3).compress(out.getvalue()))


def _load(path: str) -> dict[str, np.ndarray]:
    system, name = files.opened(path)
    with system.open_input_stream(name) as stream:
        return dict(np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(stream.read()))))


def _small(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def _pack(*arrays: np.ndarray) -> bytes:
    """Flat arrays as the value of one row; those of 64 unsigned bits are sorted and kept as planes of their gaps."""
    heads, parts = [bytes([len(arrays)])], []
    for x in arrays:
        heads.append(struct.pack("<2sQ", x.dtype.str[1:].encode(), len(x)))
        gaps = x.dtype == np.uint64
        parts.append(np.diff(x, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes() if gaps else x.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(heads + parts))


def _unpack(data: bytes) -> list[np.ndarray]:
    raw, out = zstandard.ZstdDecompressor().decompress(data), []
    at = 1 + 10 * raw[0]
    for i in range(raw[0]):
        kind, size = struct.unpack_from("<2sQ", raw, 1 + 10 * i)
        x = np.frombuffer(raw, kind.decode(), size, at)
        at += x.nbytes
        if x.dtype == np.uint64:
            x = np.cumsum(np.frombuffer(x.tobytes(), np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64)
        out.append(x)
    return out


def _rows(block: int | list[int], code, n=None, p=None, source=None, data=None) -> pa.Table:
    blocks = block if isinstance(block, list) else [block] * len(code)
    columns = {"block": (blocks, pa.int64()), "code": (code, pa.int64()), "n": (n, pa.int64()), "p": (p, pa.float64()),
               "source": (source, pa.int64()), "data": (data, pa.binary())}
    return pa.table({k: pa.nulls(len(code), t) if x is None else pa.array(x, t) for k, (x, t) in columns.items()})


def _of(table: pa.Table, code: int) -> tuple[list[int], list[bytes]]:
    """Sources and values of the rows of one kind, in the order of their sources."""
    own = table.filter(pc.equal(table["code"], code)).sort_by("source")
    return own["source"].to_pylist(), own["data"].to_pylist()


def _files(table: pa.Table, code: int) -> list[str]:
    return _of(table, code)[1][0].decode().split(" ")


def _ranges(sorted_hashes: np.ndarray, width: int) -> np.ndarray:
    """Where each of ``width`` equal ranges of 64-bit values begins in a sorted array, and its end."""
    own = (sorted_hashes >> np.uint64(32)) * np.uint64(width) >> np.uint64(32)
    return np.searchsorted(own, np.arange(width + 1, dtype=np.uint64))


def _local_bits(width: int) -> int:
    """Ids of words have 32 bits: their block, and below it their place in the block."""
    return 32 - (width - 1).bit_length()


def _unmixed(y: np.ndarray) -> np.ndarray:
    """The values that :func:`textops.mix` scrambled."""
    y = (y ^ (y >> np.uint64(31)) ^ (y >> np.uint64(62))) * np.uint64(pow(0x94D049BB133111EB, -1, 2**64))
    y = (y ^ (y >> np.uint64(27)) ^ (y >> np.uint64(54))) * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 2**64))
    return y ^ (y >> np.uint64(30)) ^ (y >> np.uint64(60))


def _chunks(docs: DataFrame, folder: str, width: int) -> DataFrame:
    """(block, source, data): the distinct words of every chunk of documents that a block of words holds, and how often the
    chunk's training documents have them.

    The chunk itself, its documents as places in the list of its words by hash, is a file. Place 0 is the end of a document,
    the empty word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.released(batches):
            ids, held = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for low, high, data, offsets in textops.text_runs(batch.column(2), CHUNK_BYTES):
                hashes, spans, size = [np.zeros(1, dtype=np.uint64)], [np.zeros((2, 1), dtype=np.int64)], []
                for a, _, part, at in textops.text_runs(batch.column(2).slice(low, high - low)):
                    starts, ends, first = textops.word_spans(part, at)
                    hashes.append(textops.word_hashes(part, starts, ends))
                    spans.append(np.stack((starts, ends)) + offsets[a])
                    size.append(np.diff(first))
                size, spans = np.concatenate(size), np.concatenate(spans, axis=1)
                names, sample, place = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
                place, learned = place[1:], ~held[low:high]
                n = np.bincount(place, weights=np.repeat(learned, size), minlength=len(sample)).astype(np.int64)
                n[0] += learned.sum()
                raw, own = textops._LOWER[data].tobytes(), spans[:, sample]
                words = [raw[a:z] for a, z in own.T.tolist()]
                name = uuid.uuid4().int >> 66
                key = ids.slice(low, high - low)
                _save(f"{folder}/{name:x}.chunk", place=_small(place), size=_small(size), held=held[low:high],
                      ids=key.fill_null(0).to_numpy(zero_copy_only=False), known=key.is_valid().to_numpy(zero_copy_only=False))
                cuts = _ranges(names, width).tolist()
                full = [b for b in range(width) if cuts[b] < cuts[b + 1]]
                parts = [_pack(np.frombuffer(b"".join(words[a:z]), np.uint8), _small(own[1, a:z] - own[0, a:z]), _small(n[a:z]))
                         for a, z in ((cuts[b], cuts[b + 1]) for b in full)]
                yield from _rows(full, [MESSAGE] * len(full), source=[name] * len(full), data=parts).to_batches()

    return docs.mapInArrow(run, ROWS)


def _blocks(words: DataFrame, folder: str, width: int) -> DataFrame:
    """Gather the words of every block, which go to a file with their training tokens, in order of the alphabet.

    Rows: the files of the block, the tokens (``CUSTOMERS``) and the distinct words among them (``TABLES``), and to every chunk
    the places of its words in the block.
    """
    most = 1 << _local_bits(width)

    def run(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        chunks, parts = _of(table, MESSAGE)
        data, size, n = (np.concatenate(x) for x in zip(*map(_unpack, parts)))
        offsets = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
        coded = pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        order = pc.array_sort_indices(coded.dictionary)
        if len(order) > most:
            raise ValueError("a block has more words than their ids can tell apart")
        rank = np.empty(len(order), dtype=np.uint32)
        rank[order.to_numpy()] = np.arange(len(order))
        local = rank[coded.indices.to_numpy()]
        (_, _, data, offsets), = textops.text_runs(coded.dictionary.take(order), 1 << 62)
        n = np.bincount(local, weights=n, minlength=len(order)).astype(np.int64)
        words, state = (files.new_file(folder, suffix) for suffix in (".words", ".state"))
        _save(words, data=data, offsets=offsets, n=n)
        zeros = np.zeros(len(n), dtype=np.int64)
        _save(state, customers=n, tables=zeros, taken=zeros, fixed=zeros, fixed_taken=zeros, spelled=zeros)
        ends = np.cumsum([len(_unpack(x)[1]) for x in parts]).tolist()
        replies = [_pack(local[a:z]) for a, z in zip([0, *ends], ends)]
        return pa.concat_tables([
            _rows(block, [STATE], data=[f"{words} {state}".encode()]), _rows(block, [CUSTOMERS, TABLES], n=[n.sum(), (n > 0).sum()]),
            _rows(block, [REPLY] * len(chunks), source=chunks, data=replies)])

    return words.groupBy("block").applyInArrow(run, ROWS)


def _pairs_of(chunk: dict[str, np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of neighbours of a chunk as sorted scrambled pairs of ids, the places of both words of each, and the
    pair of every token. The word before a document is the end of another."""
    size = chunk["size"].astype(np.int64) + 1
    place = _places(chunk)
    before = np.concatenate(([0], place[:-1]))
    wide = ids.astype(np.uint64)
    keys, sample, at = np.unique(textops.mix(wide[before] << np.uint64(32) | wide[place]), return_index=True, return_inverse=True)
    return keys, before[sample], place[sample], at


def _places(chunk: dict[str, np.ndarray]) -> np.ndarray:
    """The place of every token of a chunk, ends of documents among them."""
    size = chunk["size"].astype(np.int64) + 1
    out = np.zeros(size.sum(), dtype=np.int64)
    inside = np.ones(len(out), dtype=bool)
    inside[np.cumsum(size) - 1] = False
    out[inside] = chunk["place"]
    return out


def _chunk_pairs(replies: DataFrame, folder: str, bits: int, width: int) -> DataFrame:
    """(block, source, data): the distinct pairs of neighbours of every chunk that a block of pairs holds, and how often the chunk's
    training documents have them."""

    def run(table: pa.Table) -> pa.Table:
        name = table["source"][0].as_py()
        table = table.sort_by("block")
        ids = np.concatenate([np.uint32(b << bits) | _unpack(x)[0] for b, x in zip(table["block"].to_pylist(), table["data"].to_pylist())])
        chunk = _load(f"{folder}/{name:x}.chunk")
        keys, _, _, at = _pairs_of(chunk, ids)
        learned = np.repeat(~chunk["held"], chunk["size"].astype(np.int64) + 1)
        n = np.bincount(at, weights=learned, minlength=len(keys)).astype(np.int64)
        cuts = _ranges(keys, width).tolist()
        full = [b for b in range(width) if cuts[b] < cuts[b + 1]]
        parts = [_pack(keys[cuts[b]:cuts[b + 1]], _small(n[cuts[b]:cuts[b + 1]])) for b in full]
        return _rows(full, [MESSAGE] * len(full), source=[name] * len(full), data=parts)

    return replies.groupBy("source").applyInArrow(run, ROWS)


def _messages(block: int, code: int, bits: int, dish: np.ndarray, dish_n: np.ndarray, context: np.ndarray, context_n: np.ndarray) -> pa.Table:
    """To every block of words the tables of a block of pairs: by word, as customers, and by previous word. Ids are sorted."""
    to = np.union1d(dish >> np.uint64(bits), context >> np.uint64(bits))
    low, parts = np.uint64((1 << bits) - 1), []
    starts = [(np.searchsorted(x, to << np.uint64(bits)), np.searchsorted(x, (to + np.uint64(1)) << np.uint64(bits))) for x in (dish, context)]
    for (a, z), (b, y) in zip(zip(*starts[0]), zip(*starts[1])):
        parts.append(_pack(dish[a:z] & low, _small(dish_n[a:z]), context[b:y] & low, _small(context_n[b:y])))
    return _rows(to.astype(np.int64).tolist(), [code] * len(to), source=[block] * len(to), data=parts)


def _counted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(x, return_counts=True)


def _pair_blocks(pairs: DataFrame, folder: str, bits: int) -> DataFrame:
    """Count the pairs of every block. Those that occur once have one table for good; the others go to a file, with a table each.

    Rows: the files of the block, the pairs seen once and twice, and messages to the blocks of words: ``SINGLES`` for the tables
    that stay, ``MESSAGE`` for the others.
    """

    def run(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        chunks, parts = _of(table, MESSAGE)
        parts = [_unpack(x) for x in parts]
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        c = np.bincount(at, weights=np.concatenate([n for _, n in parts]), minlength=len(keys)).astype(np.int64)
        again = np.flatnonzero(c > 1)
        rank = np.cumsum(c > 1) - 1
        low = np.minimum(c, 2).astype(np.uint8)[at]
        pair = _unmixed(keys[again])
        context, context_at = np.unique(pair >> np.uint64(32), return_inverse=True)
        dish, dish_at = np.unique(pair & np.uint64(0xFFFFFFFF), return_inverse=True)
        entries, fixed, state = (files.new_file(folder, suffix) for suffix in (".entries", ".pairs", ".state"))
        _save(entries, chunks=np.array(chunks), size=np.array([len(k) for k, _ in parts]), low=low, which=rank[at[low == 2]].astype(np.uint32))
        _save(fixed, customers=c[again], context=context, context_at=context_at, dish=dish, dish_at=dish_at)
        ones = np.ones(len(again), dtype=np.int64)
        _save(state, tables=ones, sum=np.zeros(len(again), dtype=np.int64))
        single = _unmixed(keys[c == 1])
        return pa.concat_tables([
            _rows(block, [PAIRS], data=[f"{entries} {fixed} {state}".encode()]), _rows(block, [ONCE, TWICE], n=[(c == 1).sum(), (c == 2).sum()]),
            _messages(block, SINGLES, bits, *_counted(single & np.uint64(0xFFFFFFFF)), *_counted(single >> np.uint64(32))),
            _messages(block, MESSAGE, bits, dish, np.bincount(dish_at, minlength=len(dish)), context, np.bincount(context_at, minlength=len(context)))])

    return pairs.groupBy("block").applyInArrow(run, ROWS)


def _spelled(rows: DataFrame, base: np.ndarray, context: int, discount: float, theta: float, sweep: int) -> DataFrame:
    """(code, p): the predictive log probability of every event; rows below 0 give the customers of the empty context."""

    def run(table: pa.Table) -> pa.Table:
        code, n = table["code"].to_numpy(), table["n"].to_numpy()
        order = np.argsort(code)
        last = int(code[0]) // SYMBOLS % SYMBOLS
        random = np.random.Generator(np.random.PCG64([sweep, last]))
        p, sent = spelling(code[order], n[order], base, context, discount, theta, INNER, random)
        dish = np.flatnonzero(sent)
        return pa.table({"code": np.concatenate((code[order], -1 - dish)), "p": np.concatenate((p, sent[dish].astype(np.float64)))})

    leaves = rows.where("code >= 0").groupBy("code").agg(F.sum("n").alias("n"))
    last = F.pmod(F.floor(F.col("code") / SYMBOLS), F.lit(SYMBOLS))
    return leaves.groupBy(last).applyInArrow(run, "code long, p double")


def _summed(table: pa.Table, code: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The customers and, as previous words, the tables that the blocks of pairs count for the words of a block."""
    parts = [_unpack(x) for x in _of(table, code)[1]]
    out = []
    for i in (0, 2):
        ids, n = (np.concatenate([p[i + j] for p in parts] or [np.zeros(0, dtype=np.int64)]) for j in (0, 1))
        out.append(np.bincount(ids.astype(np.int64), weights=n, minlength=size).astype(np.int64))
    return out[0], out[1]


def _seated(rows: DataFrame, room: Restaurant | None, context: int, folder: str, sweep: int, pairs: bool) -> DataFrame:
    """Draw the tables of every word, from the files of its block and, with ``pairs``, its customers by messages of the blocks of
    pairs. Without ``room`` every word gets its first table.

    Returns the new files, sums, and the spelling events of the block's words, with a customer per table.
    """

    def run(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        path, *old = _files(table, STATE)
        words, state = _load(path), _load(old[0])
        if pairs:
            if room is None:
                state["fixed"], state["fixed_taken"] = _summed(table, SINGLES, len(words["n"]))
            customers, taken = _summed(table, MESSAGE, len(words["n"]))
            state["customers"], state["taken"] = customers + state["fixed"], taken + state["fixed_taken"]
        customers = state["customers"]
        tables = np.clip(state["tables"], np.minimum(customers, 1), customers)
        if room is not None:
            random = np.random.Generator(np.random.PCG64([sweep, block]))
            tables = draw_tables(customers, np.maximum(room.tables - tables, 0), state["spelled"], room.discount, room.theta, random)
        state["tables"] = tables
        new = files.new_file(folder, ".state")
        _save(new, **state)
        parts = []
        for own, code, first in event_runs(words, context):
            names, place = np.unique(code, return_inverse=True)
            parts.append((names, np.bincount(place, weights=np.repeat(tables[own], np.diff(first)), minlength=len(names))))
        names, place = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
        n = np.bincount(place, weights=np.concatenate([x for _, x in parts]), minlength=len(names)).astype(np.int64)
        sums = [tables.sum(), customers.sum(), (customers == 1).sum(), (customers == 2).sum()]
        return pa.concat_tables([_rows(block, [STATE], data=[" ".join((path, new, *old[1:])).encode()]),
                                 _rows(block, [TABLES, CUSTOMERS, ONCE, TWICE], n=sums), _rows(block, names, n=n)])

    return rows.groupBy("block").applyInArrow(run, ROWS)


def _told(rows: DataFrame, room: Restaurant, context: int, folder: str, sample: bool) -> DataFrame:
    """The predictive law of the words from their files and the spelled events (code, p), kept if this state is a sample.

    Every message of a block of pairs is answered by the log probability of its words and the tables of its previous words.
    ``KNOWN`` rows sum the probability of the words seen.
    """

    def run(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        path, old, *samples = _files(table, STATE)
        words, state = _load(path), _load(old)
        back = table.filter(pc.greater_equal(table["code"], 0))
        order = np.argsort(back["code"].to_numpy())
        names, p = back["code"].to_numpy()[order], back["p"].to_numpy()[order]
        state["spelled"] = np.concatenate([np.add.reduceat(p[np.searchsorted(names, code)], first[:-1])
                                           for _, code, first in event_runs(words, context)])
        log_p = room.predictive(state["customers"], state["tables"], state["spelled"])
        if sample:
            samples.append(files.new_file(folder, ".sample"))
            _save(samples[-1], log_p=log_p.astype(np.float32), taken=_small(state["taken"]))
        new = files.new_file(folder, ".state")
        _save(new, **state)
        sources, asked = _of(table, MESSAGE)
        answers = []
        for x in asked:
            dish, _, before, _ = _unpack(x)
            answers.append(_pack(log_p[dish.astype(np.int64)], _small(state["taken"][before.astype(np.int64)])))
        return pa.concat_tables([
            _rows(block, [STATE], data=[" ".join((path, new, *samples)).encode()]), _rows(block, [KNOWN], p=[np.exp(log_p[words["n"] > 0]).sum()]),
            _rows(block, [MESSAGE] * len(sources), source=sources, data=answers)])

    return rows.groupBy("block").applyInArrow(run, ROWS)


def _drawn(rows: DataFrame, discount: float, theta: float, folder: str, bits: int, sweep: int, sample: bool) -> DataFrame:
    """Draw the tables of the pairs that occur more than once, from the files of their block and the answers of the blocks of words.
    Returns the new files and messages as :func:`_pair_blocks` does."""

    def run(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        entries, path, old = _files(table, PAIRS)
        pairs, state = _load(path), _load(old)
        tables, total = state["tables"], state["sum"]
        if sample:
            total = total + tables
        answers = [_unpack(x) for x in _of(table, MESSAGE)[1]]
        if answers:
            log_p, taken = (np.concatenate(x) for x in zip(*answers))
            others = np.maximum(taken.astype(np.int64)[pairs["context_at"]] - tables, 0)
            random = np.random.Generator(np.random.PCG64([sweep, block, 2]))
            tables = draw_tables(pairs["customers"], others, log_p[pairs["dish_at"]], discount, theta, random)
        new = files.new_file(folder, ".state")
        _save(new, tables=tables, sum=total)
        dish_n, context_n = (np.bincount(pairs[f"{x}_at"], weights=tables, minlength=len(pairs[x])).astype(np.int64) for x in ("dish", "context"))
        return pa.concat_tables([_rows(block, [PAIRS], data=[f"{entries} {path} {new}".encode()]),
                                 _messages(block, MESSAGE, bits, pairs["dish"], dish_n, pairs["context"], context_n)])

    return rows.groupBy("block").applyInArrow(run, ROWS)


def _word_answers(rows: DataFrame, bits: int) -> DataFrame:
    """To every chunk, for its words in a block: ids, training tokens, and of every sample log probability and tables as previous words."""

    def run(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        path, _, *samples = _files(table, STATE)
        n, states = _load(path)["n"], [_load(x) for x in samples]
        chunks, asked = _of(table, REPLY)
        out = []
        for x in asked:
            own = _unpack(x)[0]
            out.append(_pack(np.uint32(block << bits) | own, _small(n[own]), *(s[k][own] for s in states for k in ("log_p", "taken"))))
        return _rows(block, [STATE] * len(chunks), source=chunks, data=out)

    return rows.groupBy("block").applyInArrow(run, ROWS)


def _pair_answers(blocks: DataFrame, samples: int) -> DataFrame:
    """To every chunk, for its pairs in a block: training tokens, and tables summed over the samples."""

    def run(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        entries, pairs, state = map(_load, _files(table, PAIRS))
        c, tables = entries["low"].astype(np.int64), entries["low"].astype(np.int64) * samples
        more = entries["low"] == 2
        c[more], tables[more] = pairs["customers"][entries["which"]], state["sum"][entries["which"]]
        chunks, ends = entries["chunks"].tolist(), np.cumsum(entries["size"]).tolist()
        return _rows(block, [PAIRS] * len(chunks), source=chunks, data=[_pack(_small(c[a:z]), _small(tables[a:z])) for a, z in zip([0, *ends], ends)])

    return blocks.groupBy("block").applyInArrow(run, ROWS)


def _words(blocks: DataFrame) -> DataFrame:
    """(word, n, log10_p) of the last state of every block."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("log10_p", pa.float64())])

    def run(table: pa.Table) -> pa.Table:
        path, _, *samples = _files(table, STATE)
        words = _load(path)
        raw, ends = words["data"].tobytes(), words["offsets"].tolist()
        log_p = np.logaddexp.reduce([_load(x)["log_p"].astype(np.float64) for x in samples]) - np.log(len(samples))
        return pa.table([[raw[a:z].decode() for a, z in zip(ends, ends[1:])], words["n"], log_p / np.log(10)], schema=schema)

    return blocks.groupBy("block").applyInArrow(run, "word string, n long, log10_p double")


def _scores(pair_n: np.ndarray | None, pair_tables: np.ndarray | None, before: np.ndarray | None, word: np.ndarray, n: np.ndarray,
            log_p: np.ndarray, taken: np.ndarray, unknown: np.ndarray, discount: float, theta: float) -> tuple[np.ndarray, np.ndarray]:
    """log10 of the averaged predictive probability of words after others, an unseen one as any other word or by its spelling."""
    samples, unseen = len(log_p), n[word] == 0
    new = np.zeros((samples, len(word)))  # the probability that a word comes from the restaurant of words
    total = np.zeros(len(word))
    if before is not None:
        new = np.log((theta + discount * taken[:, before]) / (theta + n[before]))
        total = (pair_n - discount * pair_tables / samples) / (theta + n[before])
    spelled = new + log_p[:, word]
    other = np.logaddexp.reduce(spelled[:, unseen]) - np.log(samples)
    spelled[:, unseen] = (new + np.log(unknown)[:, None])[:, unseen]
    score = np.log10(total + np.exp(spelled).mean(axis=0))
    alone = score.copy()
    alone[unseen] = other / np.log(10)
    return score, alone


def pitman_yor(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", context: int = CONTEXT,
    burn_in: int = BURN_IN, samples: int = SAMPLES, discount: float = 0.5, theta: float = 1.0, order: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """Score whole texts with a hierarchical Pitman-Yor model learned from the documents that are not ``held_out``.

    Returns documents (id, ``held_out, n_tokens, n_known, train_tokens, base_score, score, spelled_score, perplexity``) and words
    (``word, n, log10_p``). Tokens are runs outside ASCII white space with A-Z lower-cased, then one end per document.
    ``base_score`` adds log10((c + 1) / (N + V + 1)) per token: V seen words and, as one outcome, any other. ``score`` adds
    log10 of the model's predictive probability of these V + 1 outcomes, averaged over ``samples`` states of the sampler: a
    word outside the training documents counts as the outcome "another word", with all the probability that the model
    leaves to such words. The words' ``log10_p`` is that of the restaurant of words, whatever comes before. ``spelled_score`` tells them apart by their spelling instead. Perplexity is 10^(-score / n_tokens).

    The model: with ``order`` 2 every word has a restaurant of the words that follow it in training documents (the end of a
    document goes before the next). All of these share the restaurant of words: each of their tables sends it a customer.
    With ``order`` 1 its customers are all training tokens. The restaurant of words lies over a spelling law: each of its
    tables sends a spelled word to the restaurants of byte contexts, a customer per byte (and one for the word's end) in that of the
    last ``context`` symbols, whose tables are customers of the context one symbol shorter, which its sisters share,
    down to the empty context over 257 equal symbols. So any word has a probability, and all of them sum to 1.

    Gibbs sampling on Spark: a sweep draws the table counts of all restaurants, each dish from its conditional given the
    other dishes' tables of the last sweep (:func:`draw_tables`). Contexts that end in one symbol share no restaurant with
    others but the empty one, so they are one group of at most 257^(``context`` + 1) distinct events however large the corpus is. Words
    and pairs of neighbours lie in files of blocks by hash, whose numbers grow with the bytes of the texts, so that a frequent
    previous word is spread over all blocks of pairs. A pair that occurs once always has one table and is counted once; only the
    others are drawn. Between blocks travel distinct events, words and pairs, never tokens. ``burn_in`` sweeps go unused. The discounts of
    words and of pairs are n1 / (n1 + 2 n2) from the numbers with one and two customers at first.

    All documents, words and pairs count, none is capped. Words are told apart by 64-bit hashes inside a chunk of documents and as
    strings across chunks, pairs by ids of their words.

    NULL and empty texts are one end token. A NULL ``held_out`` is no. NULL and repeated ids are rows like others. If no
    document is learned from, the base is 1 per token and the model is the spelling law alone. An empty table gives empty
    results; other columns are ignored.
    """
    if order not in (1, 2):
        raise ValueError("order is 1 or 2")
    spark, pairs = docs.sparkSession, order == 2
    folder = scratch_path(spark, "pitman-yor")
    rows = docs.select(F.col(f"`{id_col}`").cast("long"), F.coalesce(held_out, F.lit(False)), F.col(f"`{text_col}`").cast("string").alias("_text"))
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    wide = max(-(-size // CHUNK_BYTES), 1)
    width = max(min(wide, MANY_BLOCKS), -(-size // BLOCK_BYTES))
    bits = _local_bits(width)

    def sums(frame: DataFrame) -> dict[int, int]:
        return {r.code: r.n for r in frame.where(F.col("code").between(TWICE, TABLES)).groupBy("code").agg(F.sum("n").alias("n")).collect()}

    def estimated(once: int, twice: int) -> float:
        return min(max(once / (once + 2 * twice), 0.1), 0.9) if once else 0.5

    words = staged(_blocks(_chunks(rows, folder, width), folder, width), "words")
    found, replies = sums(words), words.where(F.col("code") == REPLY)
    total, seen = found.get(CUSTOMERS, 0), found.get(TABLES, 0)
    states, mail, own = words.where(F.col("code") == STATE), words.limit(0), 0.5
    if pairs:
        drawn = staged(_pair_blocks(_chunk_pairs(replies, folder, bits, wide), folder, bits), "pairs")
        mail, found = drawn.where(F.col("code").isin(MESSAGE, SINGLES)), sums(drawn)
        own = estimated(found.get(ONCE, 0), found.get(TWICE, 0))
    room, base, unknown = None, np.full(SYMBOLS, 1 / SYMBOLS), []
    for sweep in range(burn_in + samples):
        sample = sweep >= burn_in
        rows = staged(_seated(states.unionByName(mail), room, context, folder, sweep, pairs), "events")
        states, mail, found = rows.where(F.col("code") == STATE), mail.where(F.col("code") == MESSAGE), sums(rows)
        word_discount = room.discount if room else estimated(found.get(ONCE, 0), found.get(TWICE, 0))
        room = Restaurant(found.get(CUSTOMERS, 0), found.get(TABLES, 0), word_discount, theta)
        spelled = staged(_spelled(rows, base, context, discount, theta, sweep), "spelled")
        sent = np.zeros(SYMBOLS, dtype=np.int64)
        for r in spelled.where("code < 0").groupBy("code").agg(F.sum("p").alias("n")).collect():  # a row per symbol
            sent[-1 - r.code] = r.n
        base = root(sent, discount, theta, np.random.Generator(np.random.PCG64(sweep)))
        back = rows.where("code >= 0").select("block", "code").join(spelled, "code")
        told = staged(_told(states.unionByName(mail).unionByName(back, allowMissingColumns=True), room, context, folder, sample), "told")
        states = told.where(F.col("code") == STATE)
        if sample:
            known = told.where(F.col("code") == KNOWN).agg(F.sum("p")).first()[0] or 0.0
            unknown.append(min(max(1 - known, 1e-12), 1.0))
        if pairs:
            answers = told.where(F.col("code") == MESSAGE).select(F.col("source").alias("block"), "code", "n", "p", F.col("block").alias("source"), "data")
            drawn = staged(_drawn(drawn.where(F.col("code") == PAIRS).unionByName(answers), own, theta, folder, bits, sweep, sample), "pairs")
            mail = drawn.where(F.col("code") == MESSAGE)

    def finish(table: pa.Table) -> pa.Table:
        chunk = _load(f"{folder}/{table['source'][0].as_py():x}.chunk")
        table = table.sort_by("block")

        def joined(code: int) -> Iterator[np.ndarray]:
            parts = table.filter(pc.equal(table["code"], code))["data"].to_pylist()
            return (np.concatenate(x) for x in zip(*map(_unpack, parts)))

        ids, n, *laws = joined(STATE)
        n, log_p, taken = n.astype(np.int64), np.array(laws[::2], dtype=np.float64), np.array(laws[1::2], dtype=np.float64)
        place, law = _places(chunk), (n, log_p, taken, np.array(unknown), own, theta)
        if pairs:
            _, before, word, at = _pairs_of(chunk, ids)
            score, alone = _scores(*joined(PAIRS), before, word, *law)
        else:
            score, alone = _scores(None, None, None, np.arange(len(n)), *law)
            at = place
        size = chunk["size"].astype(np.int64) + 1
        doc = np.repeat(np.arange(len(size)), size)

        def summed(x: np.ndarray) -> np.ndarray:
            return np.bincount(doc, weights=x, minlength=len(size))

        unit = np.log10((n + 1) / (total + seen + 1))
        score = summed(score[at])
        return pa.table(
            [pa.array(chunk["ids"], pa.int64(), mask=~chunk["known"]), pa.array(chunk["held"]), pa.array(size), pa.array(summed((n > 0)[place]).astype(np.int64)),
             pa.array(np.full(len(size), total, dtype=np.int64)), pa.array(summed(unit[place])), pa.array(score), pa.array(summed(alone[at])),
             pa.array(10 ** (-score / size))],
            names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "spelled_score", "perplexity"])

    schema = (f"`{id_col}` long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
              "spelled_score double, perplexity double")
    answers = _word_answers(replies.unionByName(states), bits)
    if pairs:
        answers = answers.unionByName(_pair_answers(drawn.where(F.col("code") == PAIRS), samples))
    return answers.groupBy("source").applyInArrow(finish, schema), _words(states)
