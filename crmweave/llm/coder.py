"""Adaptive context-mixing range coder for token ids, over many independent blocks in step.

Each block starts from nothing and is coded alone. At every id three models predict, each from what the block has had so
far: the id that last followed the two ids before (order 2), the one that last followed the id before (order 1), and the
frequencies of ids in the block (order 0, renewed whenever the block has doubled up to 512 ids), with an escape to any id. Their
shares of the probability are mixed by how often the order was right of late at its present run of hits, and the mixture
drives a range coder with 48-bit state that emits 16-bit words; carries into words put out are settled at the end. Numpy
works on the same step of all blocks at once; the blocks do not touch each other.

The encoder knows all ids beforehand. What each order expects, whether it is right and its run of hits follow from
sorting a block's steps by context, so that step by step only the trust in the orders and the interval move on.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
ID_BITS = 16
IDS = 1 << ID_BITS  # ids are below
NONE = IDS - 1  # no id yet; a vocabulary must not have it
HASH = np.array([40503, 60493], np.uint16)
ONE_BITS, TWO_BITS = 10, 10
SLOT_BITS = 11  # more slots than ids that order 0 is renewed from, for each has one
SLOTS = 1 << SLOT_BITS
SIZE_BITS = SLOT_BITS + 1
SIZE_MASK = (1 << SIZE_BITS) - 1
RUNS = 4  # a run of hits counts up to RUNS - 1; ids are kept times RUNS, so shifts by 2 below
START, LOW, HIGH, RATE = 4096, 64, 40960, 4
GAIN = np.int32(HIGH - LOW)
CHUNK = 64  # steps whose numbers are made at once; divides the steps at which order 0 is renewed
RENEW = (64, 128, 256, 512)
SORTED = 32  # blocks sorted at once

WHOLE = np.uint64((1 << 48) - 1)
SMALL = np.uint64(1 << 32)  # a smaller interval puts out a word, after which it is not smaller
SIXTEEN, TOP, FOUR = np.uint64(16), np.uint64(32), np.uint64(4)
LOWER = SMALL - np.uint64(1)


class Coder:
    """Low end and size of the interval of every block, narrowed step by step."""

    def __init__(self, blocks: int, length: int):
        room = 2 * length + 8
        self.low, self.range = np.zeros(blocks, np.uint64), np.full(blocks, WHOLE)
        # A word may have a 17th bit: a carry into the words before.
        self.words = np.zeros(blocks * room, np.uint32)
        self.begin = np.arange(blocks) * room
        self.at = self.begin.copy()

    def step(self, parts: np.ndarray) -> None:
        """Narrow every block's interval to parts (low, width) of 2**16; they are overwritten."""
        parts *= self.range >> SIXTEEN
        low, size = parts
        low += self.low
        out = size < SMALL
        word = low >> TOP
        # A block that puts out none is overwritten by its next word.
        self.words[self.at] = word
        self.at += out
        word *= out
        word <<= TOP
        low -= word
        parts <<= out * SIXTEEN
        self.low, self.range = parts

    def step_some(self, which: np.ndarray, low: np.ndarray) -> None:
        """Narrow some blocks' intervals to one of 2**16 parts, which always puts out a word."""
        unit = self.range[which] >> SIXTEEN
        bottom = self.low[which] + unit * low
        at = self.at[which]
        self.words[at] = bottom >> TOP
        self.at[which] = at + 1
        self.low[which] = (bottom & LOWER) << SIXTEEN
        self.range[which] = unit << SIXTEEN

    def finish(self) -> list[bytes]:
        for shift in (TOP, SIXTEEN, np.uint64(0)):
            self.words[self.at] = self.low >> shift
            self.low &= (np.uint64(1) << shift) - np.uint64(1)
            self.at += 1
        self.words[self.at] = 0  # words that were not put out
        over = np.flatnonzero(self.words > 0xFFFF)
        while len(over):
            self.words[over] &= 0xFFFF
            over = over - 1
            self.words[over] += 1
            over = over[self.words[over] > 0xFFFF]
        return [self.words[a:b].astype(np.uint16).tobytes() for a, b in zip(self.begin.tolist(), self.at.tolist(), strict=True)]


class Reader:
    """The same intervals while decoding; ``code`` is what the words say above the low end."""

    def __init__(self, payloads: list[bytes]):
        blocks = len(payloads)
        room = max(map(len, payloads)) // 2 + 8
        self.words = np.zeros(blocks * room + 1, np.uint16)
        for i, p in enumerate(payloads):
            self.words[i * room : i * room + len(p) // 2] = np.frombuffer(p, np.uint16)
        self.at = np.arange(blocks) * room
        code = np.zeros(blocks, np.uint64)
        for _ in range(3):
            code = (code << SIXTEEN) | self.words.take(self.at)
            self.at += 1
        self.state = np.stack([code, np.full(blocks, WHOLE)])

    def value(self) -> np.ndarray:
        """Where in 2**16 the code stands; ``step`` follows."""
        self.unit = self.state[1] >> SIXTEEN
        # Exact in doubles: 48 bits over at most 32, and a quotient of 16 bits.
        at = self.state[0].view(np.int64) / self.unit.view(np.int64)
        return np.minimum(at, IDS - 1, out=at).astype(np.int32)

    def step(self, parts: np.ndarray) -> None:
        """Narrow every block's interval to parts (low, width) of 2**16."""
        state = parts.astype(np.uint64)
        state *= self.unit
        code, size = state
        np.subtract(self.state[0], code, out=code)
        out = size < SMALL
        state <<= out * SIXTEEN
        code |= self.words.take(self.at) * out
        self.at += out
        self.state = state

    def value_of(self, which: np.ndarray) -> np.ndarray:
        """Read one of 2**16 parts in some blocks."""
        code, size = self.state
        unit, own, at = size.take(which) >> SIXTEEN, code.take(which), self.at.take(which)
        got = np.minimum(own // unit, np.uint64(IDS - 1))
        own -= unit * got
        own <<= SIXTEEN
        own |= self.words.take(at)
        code[which], size[which], self.at[which] = own, unit << SIXTEEN, at + 1
        return got.astype(np.int32)


def places(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the contexts of orders 1 and 2, from the id before and the one before it, modulo 2**16."""
    first = one * HASH[0]
    return first >> np.uint16(16 - ONE_BITS), (first + two * HASH[1]) >> np.uint16(16 - TWO_BITS)


def sorting(rows: np.ndarray) -> np.ndarray:
    """The stable order of each row, as places in all rows one after the other."""
    order = np.argsort(rows, axis=1, kind="stable")
    order += np.arange(len(rows))[:, None] * rows.shape[1]
    return order


def forecasts(ids: np.ndarray) -> np.ndarray:
    """For every step, order (1, 2) and block: run of hits of the context so far, plus RUNS where the order is right."""
    blocks, length = ids.shape
    out = np.empty((length, 2, blocks), np.uint8)
    for i in range(0, blocks, SORTED):
        some = ids[i : i + SORTED]
        one, two = np.zeros_like(some), np.zeros_like(some)
        one[:, 1:], two[:, 2:] = some[:, :-1], some[:, :-2]
        for k, context in enumerate(places(one, two)):
            order = sorting(context)
            context, value = context.take(order), some.take(order)
            same = np.zeros(some.shape, bool)
            same[:, 1:] = context[:, 1:] == context[:, :-1]
            hit = same.copy()
            hit[:, 1:] &= value[:, 1:] == value[:, :-1]
            run = hit.astype(np.uint8)  # hits that end here, up to RUNS - 1
            for _ in range(RUNS - 2):
                run[:, 1:] = hit[:, 1:] * (run[:, :-1] + np.uint8(1))
            mark = hit * np.uint8(RUNS)
            mark[:, 1:] += same[:, 1:] * run[:, :-1]
            back = np.empty_like(mark)
            back.ravel()[order] = mark
            out[:, k, i : i + SORTED] = back.T
    return out


class Trust:
    """Shares of 2**16 that orders 1 and 2 of every block get at their present runs of hits."""

    def __init__(self, blocks: int):
        self.runs = np.arange(2 * blocks) * RUNS
        self.table = np.full(2 * blocks * RUNS, START, np.int32)


def shares_of(trust: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of orders 2 and 1, from trust in order 1 and then order 2 along the last axis."""
    blocks = trust.shape[-1] // 2
    two = trust[..., blocks:]
    # Halved, so that the product stays within 32 bits.
    return two, ((IDS - two) >> 1) * (trust[..., :blocks] >> 1) >> 14


class Contexts(Trust):
    """Orders 1 and 2 of all blocks: what followed last, and how far each is to be trusted."""

    def __init__(self, blocks: int):
        super().__init__(blocks)
        self.runs = self.runs.reshape(2, blocks)
        lanes = np.arange(blocks)
        self.lanes = np.stack([lanes << ONE_BITS, (blocks << ONE_BITS) + (lanes << TWO_BITS)])
        # An id and its run of hits in one number: id * RUNS + run.
        self.next = np.full((blocks << ONE_BITS) + (blocks << TWO_BITS), NONE * RUNS, np.int32)
        self.one, self.two = np.zeros(blocks, np.uint16), np.zeros(blocks, np.uint16)
        self.at = np.empty((2, blocks), np.int64)
        # For a hit of order 1, and of order 2: low end and width in 2**16, and the id.
        self.cases = np.zeros((2, 3, blocks), np.int32)

    def predict(self) -> np.ndarray:
        """What orders 1 and 2 expect, with their shares of 2**16."""
        self.at[0], self.at[1] = places(self.one, self.two)
        self.at += self.lanes
        self.n = self.next.take(self.at)
        self.run = self.runs + (self.n & 3)
        self.q = self.table.take(self.run)
        cases = self.cases
        np.right_shift(self.n, 2, out=cases[:, 2])
        cases[1, 1], cases[0, 1] = shares_of(self.q.ravel())
        cases[0, 0] = cases[1, 1]
        return cases

    def learn(self, ids: np.ndarray) -> None:
        fresh = ids << 2
        gap = self.n - fresh  # 0 to RUNS - 1 where it was right, and then the run
        hit = gap.view(np.uint32) < RUNS
        trust = hit * GAIN
        trust += LOW
        trust -= self.q
        trust >>= RATE
        trust += self.q
        self.table[self.run] = trust
        gap += 1
        np.minimum(gap, RUNS - 1, out=gap)
        gap *= hit
        gap += fresh
        self.next[self.at] = gap
        self.two, self.one = self.one, ids.astype(np.uint16)


def slots_of(count: np.ndarray, distinct: np.ndarray, seen: int) -> np.ndarray:
    """Slots of ids that came ``count`` times among ``seen``, in blocks with so many distinct ones; the rest escapes."""
    escape = np.minimum(64 + SLOTS * distinct // (2 * seen), SLOTS // 2)
    return 1 + count * (SLOTS - escape - distinct) // seen


def ranks(ids: np.ndarray) -> tuple[np.ndarray, int]:
    """Rank of every id among the distinct ones of its block (steps x blocks), and how many a block has at most."""
    blocks, length = ids.shape
    out = np.empty((length, blocks), np.uint16)
    for i in range(0, blocks, SORTED):
        some = ids[i : i + SORTED]
        order = sorting(some)
        ordered = some.take(order)
        rank = np.zeros(some.shape, np.uint16)
        np.cumsum(ordered[:, 1:] != ordered[:, :-1], axis=1, out=rank[:, 1:])
        back = np.empty_like(rank)
        back.ravel()[order] = rank
        out[:, i : i + SORTED] = back.T
    return out, int(out.max(initial=0)) + 1


def encode(ids: np.ndarray) -> list[bytes]:
    """Payloads of blocks of one length (blocks x length, at most 2**16 of ids below NONE)."""
    ids = ids.astype(np.uint16)
    blocks, length = ids.shape
    coder, trust = Coder(blocks, length), Trust(blocks)
    marks = forecasts(ids).reshape(length, 2 * blocks)
    rank, width = ranks(ids)
    lanes = np.arange(blocks) * width
    counts = np.zeros(blocks * width, np.int64)
    # First slot and number of slots in one number; the escape has the slots before all ids.
    share = np.zeros(blocks * width, np.int32)
    escape = np.full(blocks, SLOTS, np.int32)
    renewed = 0
    for t in range(0, length, CHUNK):
        if t in RENEW:
            counts += np.bincount((lanes + rank[renewed:t]).ravel(), minlength=len(counts))
            renewed, table = t, counts.reshape(blocks, width)
            distinct = (table > 0).sum(axis=1, dtype=np.int32)
            got = np.where(table > 0, slots_of(table, distinct[:, None], t), 0)
            upto = np.cumsum(got, axis=1, dtype=np.int32)
            escape = (SLOTS - upto[:, -1]).astype(np.int32)
            share = (((upto - got + escape[:, None]) << SIZE_BITS) | got).astype(np.int32).ravel()
            share[got.ravel() == 0] = 0
        mark = marks[t : t + CHUNK]
        place = lanes + rank[t : t + CHUNK]
        x = ids[:, t : t + CHUNK].T
        hits = mark >= RUNS
        run, goal = trust.runs + (mark & 3), hits * GAIN + LOW
        q = np.empty(mark.shape, np.int32)
        for i in range(len(mark)):
            now = q[i]
            trust.table.take(run[i], out=now, mode="clip")
            trust.table[run[i]] = now + ((goal[i] - now) >> RATE)
        share2, share1 = shares_of(q)
        base = share2 + share1
        rest = IDS - base
        both = share.take(place)
        new = both == 0
        a, n = both >> SIZE_BITS, np.where(new, escape, both & SIZE_MASK)
        start = (a * rest) >> SLOT_BITS
        low, wide = base + start, (((a + n) * rest) >> SLOT_BITS) - start
        hit1, hit2 = hits[:, :blocks], hits[:, blocks:]
        low, wide = np.where(hit1, share2, low), np.where(hit1, share1, wide)
        parts = np.empty((len(mark), 2, blocks), np.uint64)
        parts[:, 0], parts[:, 1] = np.where(hit2, 0, low), np.where(hit2, share2, wide)
        step, some = np.nonzero(new & ~hit1 & ~hit2)
        cuts = np.searchsorted(step, np.arange(len(mark) + 1)).tolist()
        free = x[step, some].astype(np.uint64)
        for i in range(len(mark)):
            coder.step(parts[i])
            if cuts[i] < cuts[i + 1]:
                coder.step_some(some[cuts[i] : cuts[i + 1]], free[cuts[i] : cuts[i + 1]])
    return coder.finish()


def decode(payloads: list[bytes], length: int) -> np.ndarray:
    """The ids of blocks of one length."""
    blocks = len(payloads)
    reader, contexts = Reader(payloads), Contexts(blocks)
    lanes = np.arange(blocks)
    out = np.zeros((length, blocks), np.int32)
    # Each slot's place in the block's list of entries, the first of them its escape. An entry has an id, first slot, size.
    first_entry, entries = lanes, np.full(blocks, SLOTS << ID_BITS | NONE)
    slot = np.zeros(blocks * SLOTS, np.uint16)
    lane_slots = lanes * SLOTS
    own, ends = np.empty((3, blocks), np.int32), np.empty((2, blocks), np.int32)
    for t in range(length):
        if t in RENEW:
            seen = np.sort(out[:t].T.astype(np.uint16), axis=1, kind="stable")
            new = np.ones(seen.shape, bool)
            new[:, 1:] = seen[:, 1:] != seen[:, :-1]
            begins = np.flatnonzero(new.ravel())
            owner, distinct = begins // t, new.sum(axis=1, dtype=np.int32)
            count = np.diff(np.append(begins, blocks * t)).astype(np.int32)
            got = slots_of(count, distinct[owner], t)
            cuts = np.concatenate([[0], np.cumsum(distinct)])
            upto = np.concatenate([[0], np.cumsum(got)])
            before = upto[cuts]
            escape = SLOTS - np.diff(before)
            entry = np.arange(len(got)) + owner + 1
            first_entry = cuts[:-1] + lanes
            entries = np.empty(len(got) + blocks, np.int64)
            entries[first_entry] = escape << ID_BITS | NONE
            first = upto[:-1] - before[owner] + escape[owner]
            entries[entry] = ((first << SIZE_BITS | got) << ID_BITS) | seen.ravel()[begins]
            size = (entries >> ID_BITS) & SIZE_MASK
            slot = np.repeat((np.arange(len(entries)) - np.repeat(first_entry, distinct + 1)).astype(np.uint16), size)
        cases = contexts.predict()
        share2 = cases[1, 1]
        base = share2 + cases[0, 1]
        rest = IDS - base
        value = reader.value()
        inner = value - base
        np.maximum(inner, 0, out=inner)
        inner <<= SLOT_BITS
        inner |= SLOTS - 1
        place = (inner / rest).astype(np.int64)  # in doubles, exact as above, and below SLOTS
        place += lane_slots
        row = slot.take(place)
        entry = entries.take(first_entry + row)
        # Low end and width of the entry's slots, and its id.
        np.bitwise_and(entry, IDS - 1, out=own[2], casting="same_kind")
        both = (entry >> ID_BITS).astype(np.int32)
        np.right_shift(both, SIZE_BITS, out=ends[0])
        np.bitwise_and(both, SIZE_MASK, out=ends[1])
        ends[1] += ends[0]
        ends *= rest
        ends >>= SLOT_BITS
        np.add(ends[0], base, out=own[0])
        np.subtract(ends[1], ends[0], out=own[1])
        hit1 = value < base
        np.copyto(own, cases[0], where=hit1)
        np.copyto(own, cases[1], where=value < share2)
        reader.step(own[:2])
        x = own[2]
        free = np.flatnonzero((row == 0) > hit1)
        if len(free):
            x[free] = reader.value_of(free)
        contexts.learn(x)
        out[t] = x
    return np.ascontiguousarray(out.T)
