"""An adaptive context-mixing range coder for blocks of token ids below 65,536.

Blocks are coded side by side, one lane each, so that every step is an array operation over
all lanes. A lane starts from nothing: no model is shared between blocks.

For each id three orders predict. Order 2 and order 1 name the id that last followed the last
two ids and the last id, with a confidence of 0 to 3. Order 0 is the empirical distribution of
the ids of the block so far, brought up to date at fixed positions. An event says which of them
gives the id (or that it is new to the block; then it stands plain behind the coded words). The
probabilities of the four events mix two adaptive counters, one chosen by the confidences and one
by the last three events; the events of a stretch of ids are added to them at its end. The events
and the order-0 intervals drive one range coder per lane.

The coder holds 48 bits of low and range and moves 16 bits at a time. Only the range and the
tables of orders 1 and 2 need a step per id when encoding: what an id adds to low is summed per word
afterwards, and carries run back at the end.
"""

from __future__ import annotations

import numpy as np

BLOCK = 4096
LANES = 1024
IDS = 1 << 16
_U = np.uint64
_ONES = _U(0x0001000100010001)
# The coder's numbers stay below 2^49 and are whole, so doubles hold them exactly and divide faster.
_TOP, _SMALL, _SHIFT = 2.0**48, 2.0**32, 2.0**16
_STEP, _LIMIT = 32, 6000
_LOW15, _BYTE = _U(0x7FFF7FFF7FFF7FFF), 0xFF
_FIRST_BITS, _SECOND_BITS = 10, 11
_ID = 5
_CONTEXTS, _PASTS = 1 << _ID, 64
_REFRESH = tuple(int(64 * 1.6**k) for k in range(24))  # where order 0 takes in the ids so far
_ADAPT = 255  # the most ids between two updates of the counters, see _Counters.learn
_RUN = 32  # ids per lane that the encoder takes at a time


def _stretches(length: int) -> list[tuple[int, int]]:
    """Where the counters take in events: at the places of order 0, and between them in equal parts of at most ``_ADAPT``."""
    cuts = [0, *(n for n in (16, 32, *_REFRESH) if n < length), length]
    cuts = [a + (z - a) * k // parts for a, z in zip(cuts, cuts[1:]) for parts in [-(-(z - a) // _ADAPT)] for k in range(parts)]
    return list(zip(cuts, [*cuts[1:], length]))


class _Followers:
    """Orders 1 and 2 of all lanes: per slot of a context the id that last followed it, above ``_ID`` bits, and its confidence.

    The confidences of order 1 stand at bit 1 and those of order 2 at bit 3, so that the context of both
    and what tells the two ids apart are one exclusive or.
    """

    def __init__(self, lanes: int) -> None:
        lane = np.arange(lanes)
        self.base1, self.base2 = lane << _FIRST_BITS, lane << _SECOND_BITS
        self.one = np.zeros(lanes << _FIRST_BITS, dtype=np.int32)
        self.two = np.zeros(lanes << _SECOND_BITS, dtype=np.int32)
        self.fresh, self.same = np.empty(lanes, dtype=np.int32), np.empty(lanes, dtype=bool)

    def slots(self, last: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slots of contexts given as unsigned 32-bit ids."""
        mixed = last * np.uint32(0x9E3779B1)
        both = before * np.uint32(0x85EBCA77)
        both += mixed
        mixed >>= 32 - _FIRST_BITS
        both >>= 32 - _SECOND_BITS
        return mixed + self.base1, both + self.base2

    def learn(self, at1: np.ndarray, at2: np.ndarray, e1: np.ndarray, e2: np.ndarray, shifted: np.ndarray) -> None:
        """Take in the next ids, shifted by ``_ID`` bits."""
        fresh, same = self.fresh, self.same
        for table, at, e, bit in ((self.one, at1, e1, 1), (self.two, at2, e2, 3)):
            np.bitwise_xor(e, shifted, out=fresh)  # of the same id only the confidence is left
            np.less(fresh, 1 << _ID, out=same)
            np.minimum(fresh, 2 << bit, out=fresh)
            fresh += 1 << bit
            fresh *= same
            fresh += shifted
            table[at] = fresh


class _Counters:
    """Counts of the four events, 16 bits each, by the confidences of both orders and by the last three events."""

    def __init__(self, lanes: int) -> None:
        lane = np.arange(lanes)
        self.base_c, self.base_p = lane * _CONTEXTS, lane * _PASTS
        self.by_confidence = np.full(lanes * _CONTEXTS, 0x0004_0004_0004_0004, dtype=_U)
        self.by_past = np.full(lanes * _PASTS, 0x0004_0004_0004_0004, dtype=_U)

    def contexts(self, e1: np.ndarray, e2: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
        both = e1 ^ e2
        agree = both < _CONTEXTS
        both &= _CONTEXTS - 1
        both += agree
        return np.add(both, self.base_c, out=out)

    def mixed(self, at_c: np.ndarray, at_p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The packed weights of the four events and their packed running sums."""
        w = self.by_confidence.take(at_c, mode="clip")
        w += self.by_past.take(at_p, mode="clip")
        return w, w * _ONES

    def learn(self, seen_c: np.ndarray, seen_p: np.ndarray, event: np.ndarray) -> None:
        """Add the events of a stretch, at most 255 a lane: their numbers are summed as the bytes of one number first."""
        weight = np.array([1.0, 2.0**8, 2.0**16, 2.0**24]).take(event.reshape(-1))
        for table, seen in ((self.by_confidence, seen_c), (self.by_past, seen_p)):
            n = np.bincount(seen.reshape(-1), weight, len(table)).astype(_U)
            at = np.flatnonzero(n)
            n = n[at]
            more = n & _U(_BYTE)
            for k in (1, 2, 3):
                more |= (n & _U(_BYTE << 8 * k)) << _U(8 * k)
            w = table[at] + more * _U(_STEP)
            full = np.flatnonzero(w * _ONES >> _U(48) > _LIMIT)
            halved = w[full]
            w[full] = halved - ((halved >> _U(1)) & _LOW15)
            table[at] = w


def _dense(blocks: np.ndarray) -> tuple[np.ndarray, int]:
    """The rank of every id among the distinct ids of its block (positions x lanes), and the largest number of them."""
    lanes, length = blocks.shape
    bits, most = max(length - 1, 1).bit_length(), 0
    kind = np.uint32 if bits <= 16 else np.uint64
    ranks = np.empty((length, lanes), dtype=np.int32)
    for low in range(0, lanes, 64):
        some = blocks[low:low + 64]
        keys = np.sort((some.astype(kind) << bits) | np.arange(length, dtype=kind), axis=1)
        ids = keys >> bits
        new = np.zeros(some.shape, dtype=bool)
        np.not_equal(ids[:, 1:], ids[:, :-1], out=new[:, 1:])
        order = np.cumsum(new, axis=1, dtype=np.int32)
        most = max(most, int(order[:, -1].max()))
        keys &= (1 << bits) - 1
        at = keys + (np.arange(len(some)) * length)[:, None]
        own = np.empty(some.size, dtype=np.int32)
        own[at.astype(np.int64)] = order
        ranks[:, low:low + 64] = own.reshape(some.shape).T
    return ranks, most + 1


def encode(blocks: np.ndarray) -> list[bytes]:
    """One payload per row of ``blocks`` (lanes x BLOCK, uint16): the number of coded words, these, and the new ids."""
    lanes, length = blocks.shape
    lane = np.arange(lanes)
    followers, counters = _Followers(lanes), _Counters(lanes)
    size = np.full(lanes, _TOP)
    width = 2 * length + 4
    words, used = np.zeros((lanes, width), dtype=np.int64), np.zeros(lanes, dtype=np.int64)
    flat, row = words.reshape(-1), lane * width
    ranks, distinct = _dense(blocks)
    rank_base, counts = lane * distinct, np.zeros((lanes, distinct), dtype=np.int32)
    packed, taken = np.zeros_like(counts), 0  # first place and number of places, 16 bits each
    ids = np.zeros((length + 2, lanes), dtype=np.uint32)
    for a in range(0, lanes, 64):
        ids[2:, a:a + 64] = blocks[a:a + 64].T
    past = np.zeros((3, lanes), dtype=np.int64)  # the last three events
    small, scale = np.empty(lanes, dtype=bool), np.empty(lanes)
    plain = np.zeros((length, lanes), dtype=bool)
    seen = tuple(np.empty((_ADAPT, lanes), dtype=np.int64) for _ in range(3))

    def run(i: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code the ids of all lanes from place i to place end; returns their contexts and events."""
        nonlocal past, used
        span = end - i
        t = ids[i + 2:end + 2].view(np.int32) << _ID
        slots1, slots2 = followers.slots(ids[i + 1:end + 1], ids[i:end])
        e1, e2 = np.empty((span, lanes), dtype=np.int32), np.empty((span, lanes), dtype=np.int32)
        for at1, at2, a, b, own in zip(slots1, slots2, e1, e2, t):
            followers.one.take(at1, out=a, mode="clip")
            followers.two.take(at2, out=b, mode="clip")
            followers.learn(at1, at2, a, b, own)

        at = ranks[i:end] + rank_base
        count = packed.reshape(-1).take(at, mode="clip")
        first = count >> 16
        count &= 0xFFFF
        event = 3 - (count > 0).view(np.int8)
        np.copyto(event, 1, where=(e1 ^ t) < _CONTEXTS)
        np.copyto(event, 0, where=(e2 ^ t) < _CONTEXTS)
        known = event == 2
        plain[i:end] = event == 3
        at_c = counters.contexts(e1, e2)
        past = np.concatenate((past, event))
        at_p = (past[:-3] << 4) + (past[1:-2] << 2) + past[2:-1] + counters.base_p
        past = past[-3:]
        w, cum = counters.mixed(at_c, at_p)
        total = (cum >> _U(48)).astype(np.float64)
        pick = np.arange(0, 4 * span * lanes, 4).reshape(span, lanes) + event
        freq = w.view("<u2").reshape(-1).take(pick).astype(np.float64)
        start = cum.view("<u2").reshape(-1).take(pick) - freq
        places = max(taken, 1)
        share = np.where(known, count, float(places))
        first *= known

        step, part = np.empty((span, lanes)), np.empty((span, lanes))
        moved = np.empty((span, lanes), dtype=np.int64)
        for k in range(span):
            one, two = step[k], part[k]
            np.divide(size, total[k], out=one)
            np.floor(one, out=one)
            np.multiply(one, freq[k], out=size)
            np.divide(size, places, out=two)
            np.floor(two, out=two)
            np.multiply(two, share[k], out=size)
            np.less(size, _SMALL, out=small)
            moved[k] = small
            np.multiply(small, _SHIFT - 1, out=scale)
            np.add(scale, 1, out=scale)
            np.multiply(size, scale, out=size)
            if size.min() < _SMALL:
                again = size < _SMALL
                size[again] *= _SHIFT
                moved[k] += again

        # What the ids add to low: its upper 32 bits reach two words, its lower 16 the third.
        step *= start
        part *= first
        step += part
        high = np.floor(step / _SHIFT)
        step -= high * _SHIFT
        after = np.cumsum(moved, axis=0)
        wide = int(after[-1].max()) + 3
        to = (after - moved + lane * wide).reshape(-1)
        upper = np.bincount(to, high.reshape(-1), lanes * wide).astype(np.int64).reshape(lanes, wide)
        sums = np.bincount(to + 2, step.reshape(-1), lanes * wide).astype(np.int64).reshape(lanes, wide)
        sums += upper >> 16
        sums[:, 1:] += upper[:, :-1] & 0xFFFF
        flat[(row + used)[:, None] + np.arange(wide)] += sums
        used = used + after[-1]
        return at_c, at_p, event

    for i, end in _stretches(length):
        if i in _REFRESH:
            at = ranks[taken:i] + rank_base
            for a in range(0, lanes, 64):
                some = counts[a:a + 64]
                some += np.bincount(at[:, a:a + 64].reshape(-1) - a * distinct, minlength=some.size).reshape(some.shape)
                first = np.cumsum(some, axis=1, dtype=np.int32)
                first -= some
                first <<= 16
                np.bitwise_or(first, some, out=packed[a:a + 64])
            taken = i
        for low in range(i, end, _RUN):
            high = min(low + _RUN, end)
            for whole, found in zip(seen, run(low, high)):
                whole[low - i:high - i] = found
        counters.learn(*(whole[:end - i] for whole in seen))

    # Any number in [low, low + size) will do: the words above the lowest 32 bits suffice, as size >= 2^32.
    flat[row + used + 1] += 0xFFFF
    flat[row + used + 2] += 0xFFFF
    most = int(used.max()) + 3
    for a in range(0, lanes, 64):
        some = words[a:a + 64, :most]
        for _ in range(2):
            carry = some >> 16
            some &= 0xFFFF
            some[:, :-1] += carry[:, 1:]
    lanes_over, over = np.nonzero(words[:, :most] > 0xFFFF)
    at = row[lanes_over] + over
    while len(at):
        carry = flat[at] >> 16
        flat[at] &= 0xFFFF
        flat[at - 1] += carry
        at -= 1
        at = at[flat[at] > 0xFFFF]
    coded = words[:, :most].astype("<u2")
    plain = np.ascontiguousarray(plain.T)
    new, of = blocks[plain].astype("<u2").tobytes(), np.cumsum(plain.sum(axis=1)).tolist()
    return [np.uint16(n).astype("<u2").tobytes() + coded[r, :n].tobytes() + new[2 * a:2 * z]
            for r, (n, a, z) in enumerate(zip((used + 1).tolist(), [0, *of], of))]


def _places(past: np.ndarray) -> np.ndarray:
    """Order 0: for each lane its ids so far in sorted order, an id on as many places as it has occurrences. Each place
    packs the id, its first place and its number of places, 16 bits each."""
    lanes, n = past.shape
    out = np.empty(lanes * n, dtype=_U)
    for low in range(0, lanes, 64):
        ids = np.sort(past[low:low + 64], axis=1).reshape(-1)
        new = np.empty(len(ids), dtype=bool)
        np.not_equal(ids[1:], ids[:-1], out=new[1:])
        new[::n] = True
        at = np.flatnonzero(new)
        count = np.diff(at, append=len(ids))
        out[low * n:low * n + len(ids)] = np.repeat(ids[at].astype(_U) | (at % n).astype(_U) << _U(16) | count.astype(_U) << _U(32), count)
    return out


def decode(payloads: list[bytes], length: int = BLOCK) -> np.ndarray:
    """The blocks (lanes x ``length``, uint16) of payloads that :func:`encode` made."""
    lanes = len(payloads)
    lane = np.arange(lanes)
    followers, counters = _Followers(lanes), _Counters(lanes)
    parts = [np.frombuffer(p, dtype="<u2") for p in payloads]
    coded = [p[1:1 + int(p[0])] for p in parts]
    width = max(map(len, coded)) + 4
    words = np.zeros((lanes, width), dtype=np.uint16)
    for r, p in enumerate(coded):
        words[r, :len(p)] = p
    plain = np.concatenate([*(p[1 + int(p[0]):] for p in parts), np.zeros(1, dtype=np.uint16)]).astype(np.int32)
    own = np.array([len(p) - 1 - int(p[0]) for p in parts])
    next_plain = np.cumsum(own) - own
    flat, next_word = words.reshape(-1), lane * width + 3
    value = (words[:, 0] * _SHIFT + words[:, 1]) * _SHIFT + words[:, 2]
    size = np.full(lanes, _TOP)
    out = np.zeros((length, lanes), dtype=np.uint16)
    places, kept, taken = np.full(lanes, 1 << 32, dtype=_U), 1, 0
    so_far = np.zeros((lanes, length), dtype=np.uint16)
    four = lane * 4
    past = np.zeros(lanes, dtype=np.int64)
    last, before = np.zeros(lanes, dtype=np.uint32), np.zeros(lanes, dtype=np.uint32)
    seen_c, seen_p, events = (np.empty((_ADAPT, lanes), dtype=np.int64) for _ in range(3))
    step, v, total, start, freq, scale, word = (np.empty(lanes) for _ in range(7))
    at = np.empty(lanes, dtype=np.int64)
    v16, pick = np.empty(lanes, dtype=np.uint16), np.empty(lanes, dtype=np.uint16)
    named = np.empty((4, lanes), dtype=np.int32)  # the id that each event stands for
    small = np.empty(lanes, dtype=bool)

    for i, end in _stretches(length):
        if i in _REFRESH:
            so_far[:, taken:i] = out[taken:i].T
            places, kept, taken = _places(so_far[:, :i]), i, i
        place_base = lane * kept
        for k in range(end - i):
            at1, at2 = followers.slots(last, before)
            e1, e2 = followers.one.take(at1, mode="clip"), followers.two.take(at2, mode="clip")
            at_c, at_p, event = counters.contexts(e1, e2, out=seen_c[k]), np.add(counters.base_p, past, out=seen_p[k]), events[k]
            w, cum = counters.mixed(at_c, at_p)
            sums = cum.view("<u2")
            total[:] = sums[3::4]
            np.divide(size, total, out=step)
            np.floor(step, out=step)
            np.divide(value, step, out=v)
            v16[:] = v  # cuts the fraction off
            beyond = v16 >= sums[1::4]
            fresh = v16 >= sums[2::4]
            np.add(v16 >= sums[0::4], fresh, out=event, dtype=np.int64)
            event += beyond
            np.add(four, event, out=at)
            w.view("<u2").take(at, out=pick, mode="clip")
            freq[:] = pick
            sums.take(at, out=pick, mode="clip")
            start[:] = pick
            start -= freq
            start *= step
            value -= start
            np.multiply(step, freq, out=size)

            # The places of order 0; a lane with another event has all of them.
            np.divide(size, kept, out=step)
            np.floor(step, out=step)
            np.divide(value, step, out=v)
            known = beyond > fresh
            v *= known
            at[:] = v
            at += place_base
            found = places.take(at, mode="clip").view("<u2")
            np.multiply(step, found[1::4], out=start)
            value -= start
            np.less_equal(beyond, fresh, out=small)
            np.multiply(small, float(kept), out=v)
            np.maximum(v, found[2::4], out=v)
            np.multiply(step, v, out=size)

            np.right_shift(e2, _ID, out=named[0])
            np.right_shift(e1, _ID, out=named[1])
            named[2] = found[0::4]
            plain.take(next_plain, out=named[3], mode="clip")
            next_plain += fresh
            np.multiply(event, lanes, out=at)
            at += lane
            t = named.take(at, mode="clip")

            np.less(size, _SMALL, out=small)
            np.multiply(small, _SHIFT - 1, out=scale)
            scale += 1
            size *= scale
            value *= scale
            word[:] = flat.take(next_word, mode="clip")
            word *= small
            value += word
            next_word += small
            if size.min() < _SMALL:
                again = np.flatnonzero(size < _SMALL)
                size[again] *= _SHIFT
                value[again] = value[again] * _SHIFT + flat.take(next_word[again], mode="clip")
                next_word[again] += 1

            past <<= 2
            past += event
            past &= _PASTS - 1
            out[i + k] = t
            before, last = last, t.view(np.uint32)
            followers.learn(at1, at2, e1, e2, t << _ID)
        counters.learn(seen_c[:end - i], seen_p[:end - i], events[:end - i])
    so_far[:, taken:] = out[taken:].T
    return so_far
