from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import pitman_yor as PY
from keelson.llm import textops
from keelson.llm.langid import in_fold
from keelson.llm.pitman_yor import EDGE, SYMBOLS, draw_tables, events, pitman_yor, root, spelling, stirling
from keelson.llm.queries import QUERIES
from tests.llm.conftest import DOCS, prose, row

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or "")) + [""]


def base_scores(docs):
    """(held, tokens, known, N, base) per (id, text)."""
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    count = Counter(t for (_, text), h in zip(docs, held) if not h for t in tokens(text))
    n, v = sum(count.values()), len(count)
    out = []
    for (_, text), h in zip(docs, held):
        own = tokens(text)
        out.append((h, len(own), sum(count[t] > 0 for t in own), n, sum(math.log10((count[t] + 1) / (n + v + 1)) for t in own)))
    return out


def partitions(n):
    """All seatings of customers 0..n-1 as lists of tables."""
    if not n:
        return [[]]
    return [s[:i] + [s[i] + 1] + s[i + 1:] for s in partitions(n - 1) for i in range(len(s))] + [s + [1] for s in partitions(n - 1)]


def test_stirling_counts_seatings():
    d = 0.3
    for n in range(1, 7):
        weight = defaultdict(float)
        for s in partitions(n):
            weight[len(s)] += math.prod(j - d for size in s for j in range(1, size))
        assert [math.exp(x) for x in stirling(n, d)[n, 1:]] == pytest.approx([weight[t] for t in range(1, n + 1)])


@pytest.mark.parametrize("discount", [0.3, 0.5, 0.8])
@pytest.mark.parametrize("customers", [2, 5, 40, 65, 300])
def test_draws_follow_the_conditional(discount, customers):
    rng = np.random.Generator(np.random.PCG64(4))
    others, theta, n = 5000, 1.0, 4000
    table, t = stirling(customers, discount)[customers, 1:], np.arange(1, customers + 1)
    for p in (1e-6, 1e-4, 1e-2, 0.3):
        weight = np.cumsum(np.log(theta + discount * (others + t - 1)) + math.log(p)) + table
        weight = np.exp(weight - weight.max())
        weight /= weight.sum()
        mean = (weight * t).sum()
        spread = math.sqrt((weight * t * t).sum() - mean**2)
        got = draw_tables(np.full(n, customers), np.full(n, others), np.full(n, math.log(p)), discount, theta, rng)
        assert got.min() >= 1 and got.max() <= customers
        assert got.mean() == pytest.approx(mean, rel=0.03, abs=5 * spread / math.sqrt(n) + 0.02)
        assert got.std() == pytest.approx(spread, rel=0.15, abs=0.1)


def test_events_and_laws_sum_to_one():
    raw = "".join(["ab", "", "aé", "b" * 9]).encode()
    offsets = np.cumsum([0, 2, 0, 3, 9])
    code, first = events(np.frombuffer(raw, np.uint8), offsets, 2)
    spelled = []
    for k in range(4):
        word, own = raw[offsets[k]:offsets[k + 1]], []
        for symbol in [*word, EDGE]:
            before = [EDGE, EDGE, *word][len(own):len(own) + 2]
            own.append((before[0] * SYMBOLS + before[1]) * SYMBOLS + symbol)
        spelled.append(own)
    assert code.tolist() == sum(spelled, []) and first.tolist() == np.cumsum([0, *map(len, spelled)]).tolist()
    rng = np.random.Generator(np.random.PCG64(2))
    base = root(rng.integers(0, 9, SYMBOLS), 0.5, 1.0, rng)
    assert base.sum() == pytest.approx(1)
    last, every = ord("b"), np.arange(SYMBOLS)
    codes = np.sort(np.concatenate([(x * SYMBOLS + last) * SYMBOLS + every for x in (ord("a"), ord("c"))]))
    customers = np.where(rng.random(len(codes)) < 0.1, rng.integers(1, 400, len(codes)), 0)
    log_p, sent = spelling(codes, customers, base, 2, 0.5, 1.0, 5, rng)
    assert np.exp(log_p[:SYMBOLS]).sum() == pytest.approx(1) and np.exp(log_p[SYMBOLS:]).sum() == pytest.approx(1)
    assert 0 < sent.sum() <= customers.sum() and set(np.flatnonzero(sent)) == set((codes % SYMBOLS)[customers > 0])


class Seats:
    """A restaurant that seats and unseats one customer at a time."""

    def __init__(self, discount, theta, parent):
        self.d, self.theta, self.parent, self.tables = discount, theta, parent, defaultdict(list)
        self.guests = self.taken = 0

    def p(self, dish):
        own = self.tables.get(dish, [])
        return (sum(own) - self.d * len(own) + (self.theta + self.d * self.taken) * self.parent.p(dish)) / (self.theta + self.guests)

    def add(self, dish):
        own = self.tables[dish]
        at = random.choices(range(len(own) + 1), [n - self.d for n in own] + [(self.theta + self.d * self.taken) * self.parent.p(dish)])[0]
        self.guests += 1
        if at < len(own):
            own[at] += 1
        else:
            own.append(1)
            self.taken += 1
            self.parent.add(dish)

    def remove(self, dish):
        own = self.tables[dish]
        at = random.choices(range(len(own)), own)[0]
        self.guests -= 1
        own[at] -= 1
        if not own[at]:
            del own[at]
            self.taken -= 1
            self.parent.remove(dish)


class Uniform:
    def p(self, _):
        return 1 / SYMBOLS

    def add(self, _):
        pass

    remove = add


class Spelling:
    def __init__(self, context, discount, theta):
        self.k, self.rooms, self.make = context, {}, (discount, theta)

    def room(self, context):
        if context not in self.rooms:
            self.rooms[context] = Seats(*self.make, self.room(context[1:]) if context else Uniform())
        return self.rooms[context]

    def steps(self, word):
        full = (EDGE,) * self.k + tuple(word.encode()) + (EDGE,)
        return [(self.room(full[i:i + self.k]), full[i + self.k]) for i in range(len(full) - self.k)]

    def p(self, word):
        return math.prod(room.p(dish) for room, dish in self.steps(word))

    def add(self, word):
        for room, dish in self.steps(word):
            room.add(dish)

    def remove(self, word):
        for room, dish in self.steps(word):
            room.remove(dish)


def test_close_to_seating_customers_one_by_one(spark):
    random.seed(3)
    stems = ["ka", "lo", "mi", "ter", "an", "s"]
    texts = [" ".join("".join(random.choices(stems, k=random.choice((1, 2, 2, 3)))) for _ in range(40)) for _ in range(40)]
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.spelled_score for r in pitman_yor(frame, in_fold("doc_id", 7, 2), context=2, samples=6)[0].collect()}
    learned = [t for (i, x) in docs if zlib.crc32(str(i).encode()) % 7 != 2 for t in tokens(x)]
    count = Counter(Counter(learned).values())
    room = Seats(min(max(count[1] / (count[1] + 2 * count[2]), 0.1), 0.9), 1.0, Spelling(2, 0.5, 1.0))
    for t in learned:
        room.add(t)
    total, sweeps = Counter(), 6
    for sweep in range(2 + sweeps):
        for t in learned:
            room.remove(t)
            room.add(t)
        if sweep >= 2:
            for t in {t for x in texts for t in tokens(x)}:
                total[t] += room.p(t) / sweeps
    held = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 7 == 2]
    for ids in (held, [i for i, _ in docs]):
        want = sum(math.log10(total[t]) for i in ids for t in tokens(texts[i]))
        assert sum(got[i] for i in ids) == pytest.approx(want, rel=0.01)


def test_given_table(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    found, words = pitman_yor(docs, in_fold("doc_id", 7, 2))
    rows = sorted(found.collect())
    source = sorted((r.doc_id, r.text) for r in docs.collect())
    for r, want in zip(rows, base_scores(source), strict=True):
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[:4] and r.base_score == pytest.approx(want[4])
        assert r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens))
    own = [r for r in rows if r.held_out]
    assert sum(r.score for r in own) > 0.95 * sum(r.base_score for r in own) and own
    law = words.agg(F.sum(F.pow(10.0, "log10_p")).alias("p"), F.count("*").alias("n"), F.countDistinct("word").alias("d")).first()
    assert 0.5 < law.p < 1 and law.n == law.d  # the rest is for words that nobody wrote
    by_word = {r.word: (r.n, r.log10_p) for r in words.collect()}
    other = math.log10(1 - sum(10**p for n, p in by_word.values() if n))
    for r, (_, text) in zip(rows, source):
        assert r.spelled_score == pytest.approx(sum(by_word[t][1] for t in tokens(text)))
        assert r.score == pytest.approx(sum(by_word[t][1] if by_word[t][0] else other for t in tokens(text)))


def test_odd_rows(spark, odd, none):
    found, _ = pitman_yor(odd, in_fold("doc_id", 7, 2))
    want = base_scores([(r.doc_id, r.text) for r in odd.collect()])
    key = lambda x: (x[0], x[1], x[2], round(x[4], 6))
    got = [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found.collect()]
    assert sorted(map(key, got)) == sorted(map(key, want)) and all(
        r.score < 0 and r.spelled_score < 0 and math.isfinite(r.spelled_score) for r in found.collect())
    found, words = pitman_yor(none, in_fold("doc_id", 7, 2))
    assert found.count() == words.count() == 0
    only_held, _ = pitman_yor(spark.createDataFrame([row(1, prose(9)), row(None, None)], DOCS), F.lit(True))
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in only_held.collect()) == [(1, 0, 0, 0.0), (10, 0, 0, 0.0)]


def test_packed_arrays_and_scrambled_pairs_come_back():
    rng = np.random.Generator(np.random.PCG64(1))
    keys = np.sort(rng.integers(0, 2**64 - 1, 1000, dtype=np.uint64, endpoint=True))
    arrays = [keys, np.arange(3, dtype=np.uint8), np.zeros(0, dtype=np.uint64), rng.random(5).astype(np.float32), np.array([70_000], dtype=np.uint32)]
    for x, y in zip(arrays, PY._unpack(PY._pack(*arrays)), strict=True):
        assert x.dtype == y.dtype and x.tolist() == y.tolist()
    assert PY._unmixed(textops.mix(keys)).tolist() == keys.tolist()
    cuts = PY._ranges(keys, 7)
    assert cuts[0] == 0 and cuts[-1] == len(keys) and all(np.diff(cuts) > 0)
    assert [PY._local_bits(n) for n in (1, 2, 3, 4, 5)] == [32, 31, 30, 30, 29]


def neighbours(n=40, size=40, seed=5):
    """Texts in which a word tells much about the next one."""
    pick = random.Random(seed)
    names = ["kalo", "mi", "terka", "ans", "lomi", "s", "anter", "kas"]
    after = {w: pick.sample(names, 3) for w in names}
    out = []
    for _ in range(n):
        text = [pick.choice(names)]
        while len(text) < size:
            text.append(pick.choices([*after.get(text[-1], names[:3]), f"{pick.choice(names)}{pick.choice(names)}"], [6, 3, 2, 2])[0])
        out.append(" ".join(text))
    return list(enumerate(out))


@pytest.mark.parametrize("wide", [False, True])
def test_previous_words_close_to_seating_customers_one_by_one(spark, monkeypatch, wide):
    if wide:  # many blocks of words and of pairs
        monkeypatch.setattr(PY, "CHUNK_BYTES", 1500)
    random.seed(3)
    docs = neighbours()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found, words = pitman_yor(frame, in_fold("doc_id", 7, 2), context=2, samples=6, order=2)
    got = {r.doc_id: r for r in found.collect()}

    def pairs(text):
        own = tokens(text)
        return list(zip(["", *own], own))

    learned = [x for i, text in docs if zlib.crc32(str(i).encode()) % 7 != 2 for x in pairs(text)]
    seen = Counter(learned)
    counts = Counter(seen.values())
    customers = Counter(Counter(w for _, w in seen).values())
    discount, own = (min(max(c[1] / (c[1] + 2 * c[2]), 0.1), 0.9) for c in (counts, customers))
    below = Seats(own, 1.0, Spelling(2, 0.5, 1.0))
    rooms = defaultdict(lambda: Seats(discount, 1.0, below))
    for u, w in learned:
        rooms[u].add(w)
    total, sweeps = Counter(), 6
    every = {x for _, text in docs for x in pairs(text)}
    for sweep in range(2 + sweeps):
        for u, w in learned:
            rooms[u].remove(w)
            rooms[u].add(w)
        if sweep >= 2:
            for u, w in every:
                total[u, w] += rooms[u].p(w) / sweeps
    held = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 7 == 2]
    for ids in (held, [i for i, _ in docs]):
        want = sum(math.log10(total[x]) for i in ids for x in pairs(docs[i][1]))
        assert sum(got[i].spelled_score for i in ids) == pytest.approx(want, rel=0.01)
    for (i, text), want in zip(docs, base_scores(docs), strict=True):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[:4] and r.base_score == pytest.approx(want[4])
    alone = pitman_yor(frame, in_fold("doc_id", 7, 2), context=2)[0].agg(F.sum("score")).first()[0]
    assert sum(r.score for r in got.values()) > 0.8 * alone
    assert words.agg(F.sum(F.pow(10.0, "log10_p"))).first()[0] < 1


def test_query_scores_words_after_their_previous_word(spark, tmp_path):
    """Two held-out documents of the same words, one in the order of the training documents."""
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    common, other = "red apple green pear blue plum", "apple pear plum red green blue"
    rows = [row(i, {held[0]: common, held[1]: other}.get(i, " ".join([common] * 3))) for i in range(60)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in QUERIES["op11_pitman_yor"](spark, str(tmp_path)).collect()}
    assert got[held[0]].base_score == pytest.approx(got[held[1]].base_score)
    assert got[held[0]].score > got[held[1]].score + 3


def test_laws_of_words_after_a_previous_word_sum_to_one():
    rng = np.random.Generator(np.random.PCG64(8))
    n = np.array([7, 5, 0, 9])
    log_p = np.log(rng.dirichlet([1, 1, 1, 1], 3))
    taken = rng.integers(1, 3, (3, 4)) * 1.0
    c = np.array([4, 0, 0, 3])  # after word 0
    taken[:, 0] = [4, 5, 6]
    tables = np.array([8, 0, 0, 7])  # sums over three samples
    assert tables.sum() == taken[:, 0].sum()
    score, alone = PY._scores(c, tables, np.zeros(4, dtype=int), np.arange(4), n, log_p, taken, np.exp(log_p[:, 2]), 0.4, 1.0)
    assert (10**score).sum() == pytest.approx(1) and alone.tolist() == pytest.approx(score.tolist())


def test_odd_rows_after_previous_words(spark, odd, none, monkeypatch):
    want = base_scores([(r.doc_id, r.text) for r in odd.collect()])
    key = lambda x: (x[0], x[1], x[2], round(x[4], 6))
    monkeypatch.setattr(PY, "CHUNK_BYTES", 50_000)
    found = pitman_yor(odd, in_fold("doc_id", 7, 2), order=2)[0].collect()
    got = [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found]
    assert sorted(map(key, got)) == sorted(map(key, want)) and all(r.score < 0 and math.isfinite(r.spelled_score) for r in found)
    found, words = pitman_yor(none, in_fold("doc_id", 7, 2), order=2)
    assert found.count() == words.count() == 0
    only_held, _ = pitman_yor(spark.createDataFrame([row(1, prose(9)), row(None, None)], DOCS), F.lit(True), order=2)
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in only_held.collect()) == [(1, 0, 0, 0.0), (10, 0, 0, 0.0)]


def test_events_of_a_block_come_in_bounded_runs(monkeypatch):
    raw = [w.encode() for w in ("", "a", "longer than a run", "bb", "", "ccc", "d")]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    monkeypatch.setattr(PY, "EVENT_BYTES", 4)
    runs = list(PY.event_runs({"data": data, "offsets": offsets}, 2))
    assert len(runs) > 2 and [i for own, _, _ in runs for i in range(own.start, own.stop)] == list(range(len(raw)))
    whole, first = events(data, offsets, 2)
    assert np.concatenate([code for _, code, _ in runs]).tolist() == whole.tolist()
    assert [len(code) for _, code, _ in runs] == [first[own.stop] - first[own.start] for own, _, _ in runs]
