"""Adaptive context-mixing range coder for token ids, coding many blocks side by side in numpy.

Three predictions drive each id: order 2 and order 1 name the id that last followed the two, or the
one, ids before it in this block, with a confidence; order 0 is the id's frequency in the file.  An
adaptive weight for each combination of confidences mixes them into one distribution, and a 64-bit
range coder without carries writes the id's interval of it.  Every block starts from the same fresh
state, so blocks are coded as lanes of arrays and can be decoded alone.  Blocks of several files, each
with its own order 0, share the lanes: a step costs much the same for a hundred lanes as for a thousand.
"""

from __future__ import annotations

import numpy as np

MIX_BITS, ZERO_BITS, SLOT_BITS = 12, 18, 10
_PAIR_BITS = ZERO_BITS + 1
MIX, ZERO, SLOTS = 1 << MIX_BITS, 1 << ZERO_BITS, 1 << SLOT_BITS
MAX_IDS = 1 << 17
STRIDE = SLOTS + 16      # places of a lane's entries: one slot of all lanes is not in a few sets of the cache
_U = np.uint64
_LOW32, _W32 = _U(0xFFFFFFFF), _U(32)
_MIX_SHIFT, _ZERO_SHIFT = _U(MIX_BITS), _U(ZERO_BITS)
_K1, _K2 = np.uint32(0x1E3779B1), np.uint32(0x42B2AE35)     # only bits 15 to 24 of the products count


class ZeroOrder:
    """Order-0 distribution of one file: ids with their scaled frequencies."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray):
        self.ids, self.freq = ids.astype(np.int64), freq.astype(np.int64)
        ends = np.cumsum(self.freq)
        if len(ids) and (ends[-1] != ZERO or self.freq.min() < 1):
            raise ValueError("frequencies do not fill the order-0 scale")
        # start and width of each id's interval in one number
        self.spans = np.zeros(int(self.ids.max()) + 1 if len(ids) else 1, np.uint64)
        self.spans[self.ids] = ((ends - self.freq) << _PAIR_BITS) + self.freq

    @classmethod
    def of(cls, tokens: np.ndarray) -> ZeroOrder:
        """Frequencies of ``tokens`` scaled to the order-0 total, at least one each."""
        count = np.bincount(tokens)
        ids = np.flatnonzero(count)
        if not len(ids):
            return cls(ids, ids)
        if len(count) > MAX_IDS:
            raise ValueError(f"ids must be below {MAX_IDS}")
        share = count[ids] * ((ZERO - len(ids)) / len(tokens))
        freq = 1 + share.astype(np.int64)
        freq[np.argmax(freq)] += ZERO - freq.sum()
        return cls(ids, freq)

    def lookup(self) -> np.ndarray:
        return np.repeat(self.ids.astype(np.int32), self.freq)


#: Change of an entry (id * 4 + confidence) by confidence and whether the id came true; a wrong entry
#: without confidence is replaced.
_CHANGE = np.array([0, 1, -1, 1, -1, 1, -1, 0], np.int32)


class _Lanes:
    """Adaptive state of all lanes; encoder and decoder step it alike.

    Lanes are in descending order of their blocks' ids, so that those still running come first.  Rows
    of the work arrays are order 2 (0) and order 1 (1).
    """

    def __init__(self, sizes: np.ndarray, zeros: list[ZeroOrder], owner: np.ndarray):
        lanes = len(sizes)
        self.sizes = sizes
        self.table = np.full(2 * lanes * STRIDE, -4, np.int32)         # id * 4 + confidence; -4: none
        self.weights = np.full(lanes << 5, (MIX // 4) * 0x10001, np.int32)  # order 2 | order 1 << 16
        # the files' order-0 intervals one after the other, then "not by order 0": the whole scale
        bases = np.cumsum([0, *(len(z.spans) for z in zeros)])
        self.spans = np.concatenate([*(z.spans for z in zeros), np.array([ZERO], np.uint64)])
        self.whole = len(self.spans) - 1
        self.first = bases[owner]
        self.hash2 = np.zeros(lanes, np.uint32)
        self.low, self.span = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
        lane = np.arange(lanes)
        self.rows = lane << 5
        self.places = np.stack([lane, lane + lanes]) * STRIDE
        self._shape(lanes)

    def _shape(self, n: int) -> None:
        """Only the first ``n`` lanes go on."""
        self.n = n
        self.rows, self.first, self.hash2 = self.rows[:n], self.first[:n], self.hash2[:n]
        self.places, self.low, self.span = np.ascontiguousarray(self.places[:, :n]), self.low[:n], self.span[:n]
        self.slot, self.ctx, self.own = np.empty((2, n), np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
        self.hashes = np.empty((2, n), np.uint32)
        self.cand, self.sure, self.state, self.change, self.p, self.moved = (np.empty((2, n), np.int32) for _ in range(6))
        self.fresh, self.a, self.b = (np.empty(n, np.int32) for _ in range(3))
        self.hit, self.kept = np.empty((2, n), bool), np.empty((2, n), bool)
        self.either, self.flag = np.empty(n, bool), np.empty(n, bool)
        self.unit, self.wide, self.base, self.zero = (np.empty(n, np.uint64) for _ in range(4))
        # bounds of the parts of the span: order 2, order 1, order 0
        self.edges = np.zeros((4, n), np.uint64)
        self.x2, self.x1, self.flat = self.edges[1], self.edges[2], self.edges.ravel()
        self.part, self.at, self.third = np.empty(n, np.int8), np.empty(n, np.int64), 2 * n + np.arange(n)

    def slots(self, before: np.ndarray) -> np.ndarray:
        """Places of both predictors' entries after the ids ``before``."""
        h = self.hashes
        np.multiply(before, _K1, out=h[1])
        np.add(h[1], self.hash2, out=h[0])
        np.multiply(before, _K2, out=self.hash2)
        np.right_shift(h, 15, out=h)
        np.bitwise_and(h, SLOTS - 1, out=h)
        return np.add(self.places, h, out=self.slot)

    def predict(self, slot: np.ndarray) -> None:
        """Candidates (``cand``), and the bounds in the coder's span below which they lie (``x2``, ``x1``)."""
        self.entry = self.table[slot]
        np.bitwise_and(self.entry, 3, out=self.sure)
        np.right_shift(self.entry, 2, out=self.cand)
        a, b = self.a, self.b
        np.left_shift(self.sure[0], 3, out=a)
        np.left_shift(self.sure[1], 1, out=b)
        np.add(a, b, out=a)
        np.equal(self.cand[0], self.cand[1], out=self.flag)
        np.add(a, self.flag, out=a)
        np.add(self.rows, a, out=self.ctx)
        self.weights.take(self.ctx, out=b, mode="clip")
        p2, p1 = self.p
        np.bitwise_and(b, 0xFFFF, out=p2)
        np.right_shift(b, 16, out=p1)
        np.subtract(MIX, p2, out=a)
        np.multiply(a, p1, out=a)
        np.right_shift(a, MIX_BITS, out=a)
        np.maximum(a, 1, out=a)
        np.add(a, p2, out=a)
        np.right_shift(self.span, _MIX_SHIFT, out=self.unit)
        np.multiply(self.unit, p2.view(np.uint32), out=self.x2)
        np.multiply(self.unit, a.view(np.uint32), out=self.x1)

    def narrow(self, by2: np.ndarray, by1: np.ndarray) -> None:
        """``base``, ``unit``: start in the span and unit of order 0's scale; ``by1`` includes ``by2``."""
        np.left_shift(self.unit, _MIX_SHIFT, out=self.edges[3])
        np.add(by1.view(np.int8), by2.view(np.int8), out=self.part)
        np.multiply(self.part, np.int64(-self.n), out=self.at)
        np.add(self.at, self.third, out=self.at)
        self.flat.take(self.at, out=self.base, mode="clip")
        np.add(self.at, self.n, out=self.at)
        self.flat.take(self.at, out=self.wide, mode="clip")
        np.subtract(self.wide, self.base, out=self.wide)
        np.right_shift(self.wide, _ZERO_SHIFT, out=self.unit)

    def take(self, ids: np.ndarray, by1: np.ndarray) -> np.ndarray:
        """The span becomes the ids' part; how far its start moved beyond ``base``."""
        np.add(self.first, ids, out=self.own)
        np.copyto(self.own, self.whole, where=by1)
        self.spans.take(self.own, out=self.zero, mode="clip")
        np.bitwise_and(self.zero, _U((1 << _PAIR_BITS) - 1), out=self.wide)
        np.multiply(self.unit, self.wide, out=self.span)
        np.right_shift(self.zero, _U(_PAIR_BITS), out=self.zero)
        return np.multiply(self.unit, self.zero, out=self.zero)

    def short(self) -> tuple[np.ndarray, np.ndarray]:
        """Lanes whose span has less than a word left, with their lows; both move on by a word."""
        np.less_equal(self.span, _LOW32, out=self.flag)
        k = self.flag.nonzero()[0]
        low = self.low[k]
        if len(k):
            span = self.span[k]
            across = ((low ^ (low + span - _U(1))) > _LOW32).nonzero()[0]
            if len(across):
                span[across] = (_LOW32 - (low[across] & _LOW32)) + _U(1)
            self.low[k], self.span[k] = low << _W32, span << _W32
        return k, low

    def learn(self, ids: np.ndarray, slot: np.ndarray) -> None:
        """``ids`` came; ``hit`` says whether each candidate was right."""
        moved, p, b = self.moved, self.p, self.b
        # weights move down after a miss and up after a hit; that of order 1 only after a miss of order 2
        np.multiply(self.hit, np.int32(MIX - 64), out=moved)
        np.add(moved, 32, out=moved)
        np.subtract(moved, p, out=moved)
        np.right_shift(moved, 4, out=moved)
        np.logical_not(self.hit[0], out=self.flag)
        np.multiply(moved[1], self.flag, out=moved[1])
        np.add(p, moved, out=p)
        np.left_shift(p[1], 16, out=b)
        np.add(p[0], b, out=b)
        self.weights[self.ctx] = b
        state, entry = self.state, self.entry
        np.left_shift(self.sure, 1, out=state)
        np.add(state, self.hit, out=state)
        _CHANGE.take(state, out=self.change, mode="clip")
        np.add(entry, self.change, out=entry)
        np.not_equal(state, 0, out=self.kept)
        np.left_shift(ids, 2, out=self.fresh)
        self.table[slot] = np.where(self.kept, entry, self.fresh)


def _dealt(counts: list[int], block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of each lane, its file, and the lane's place among all files' blocks; longest lanes first."""
    blocks = [-(-n // block) for n in counts]
    owner = np.repeat(np.arange(len(counts)), blocks)
    sizes = np.full(len(owner), block)
    for n, end in zip(counts, np.cumsum(blocks).tolist(), strict=True):
        if n % block:
            sizes[end - 1] = n % block
    order = np.argsort(-sizes, kind="stable")
    return sizes[order], owner[order], order


def encode_files(files: list[tuple[np.ndarray, ZeroOrder]], block: int) -> list[list[bytes]]:
    """Code each file's ids in blocks of ``block`` ids (its last one may be shorter)."""
    sizes, owner, order = _dealt([len(tokens) for tokens, _ in files], block)
    lanes = len(sizes)
    if not lanes:
        return [[] for _ in files]
    longest = int(sizes[0])
    grid = np.zeros((lanes, longest + 16), np.int32)
    rank = np.empty(lanes, np.int64)
    rank[order] = np.arange(lanes)
    at = 0
    for tokens, _ in files:
        for a in range(0, len(tokens), block):
            own = tokens[a:a + block]
            grid[rank[at], :len(own)] = own
            at += 1
    grid = np.ascontiguousarray(grid[:, :longest].T)
    model = _Lanes(sizes, [zero for _, zero in files], owner)
    width = longest + 19
    words = np.zeros(lanes * width, np.uint32)
    used = np.arange(lanes) * width
    ends = np.searchsorted(-sizes, -np.arange(longest), "left")     # lanes with more than t ids
    last = np.zeros(lanes, np.uint64)
    before = np.zeros(lanes, np.uint32)
    for t in range(longest):
        n = int(ends[t])
        if n < model.n:
            last[n:model.n] = model.low[n:]
            model._shape(n)
            before = before[:n]
        ids = grid[t, :n]
        slot = model.slots(before)
        model.predict(slot)
        np.equal(model.cand, ids, out=model.hit)
        hit2, hit1 = model.hit
        by1 = np.logical_or(hit2, hit1, out=model.either)
        model.narrow(hit2, by1)
        moved = model.take(ids, by1)
        model.low += model.base
        model.low += moved
        k, low = model.short()
        if len(k):
            words[used[k]] = (low >> _W32).astype(np.uint32)
            used[k] += 1
        model.learn(ids, slot)
        before = ids.view(np.uint32)
    last[:model.n] = model.low
    words[used] = (last >> _W32).astype(np.uint32)
    words[used + 1] = (last & _LOW32).astype(np.uint32)
    coded = [words[a:b].astype("<u4").tobytes() for a, b in zip((np.arange(lanes) * width).tolist(), (used + 2).tolist(), strict=True)]
    out: list[list[bytes]] = [[] for _ in files]
    for lane in rank.tolist():
        out[owner[lane]].append(coded[lane])
    return out


def decode_files(files: list[tuple[list[bytes], int, ZeroOrder]], block: int) -> list[np.ndarray]:
    """Each file's ids, from its consecutive blocks and their number."""
    for blocks, n, _ in files:
        if len(blocks) != -(-n // block):
            raise ValueError("the number of blocks does not fit the number of ids")
    sizes, owner, order = _dealt([n for _, n, _ in files], block)
    lanes = len(sizes)
    if not lanes:
        return [np.zeros(0, np.int32) for _ in files]
    listed = [b for blocks, _, _ in files for b in blocks]
    listed = [listed[i] for i in order.tolist()]
    held = np.array([len(b) // 4 for b in listed])
    # a damaged block may run out of words: it then reads on in the next one, and its checksum fails
    words = np.frombuffer(b"".join(listed) + bytes(4 * (int(sizes[0]) + 4)), "<u4")
    used = np.cumsum(held) - held
    model = _Lanes(sizes, [zero for _, _, zero in files], owner)
    lookup = np.concatenate([zero.lookup() if n else np.zeros(ZERO, np.int32) for _, n, zero in files])
    scale = owner << ZERO_BITS
    ahead = (words[used].astype(_U) << _W32) | words[used + 1].astype(_U)    # the code beyond the low
    used += 2
    longest = int(sizes[0])
    out = np.zeros((longest, lanes), np.int32)
    ends = np.searchsorted(-sizes, -np.arange(longest), "left")
    before = np.zeros(lanes, np.uint32)
    by2, place, quotient = np.empty(lanes, bool), np.empty(lanes, np.int64), np.empty(lanes, np.uint64)
    for t in range(longest):
        n = int(ends[t])
        if n < model.n:
            model._shape(n)
            before, ahead, used, scale = before[:n], ahead[:n], used[:n], scale[:n]
            by2, place, quotient = by2[:n], place[:n], quotient[:n]
        slot = model.slots(before)
        model.predict(slot)
        by1 = np.less(ahead, model.x1, out=model.either)
        np.less(ahead, model.x2, out=by2)
        model.narrow(by2, by1)
        ahead -= model.base
        model.low += model.base
        np.floor_divide(ahead, model.unit, out=quotient)
        np.minimum(quotient, _U(ZERO - 1), out=quotient)
        np.add(scale, quotient.view(np.int64), out=place)
        ids = out[t, :n]
        lookup.take(place, out=ids, mode="clip")
        np.copyto(ids, model.cand[1], where=by1)
        np.copyto(ids, model.cand[0], where=by2)
        moved = model.take(ids, by1)
        ahead -= moved
        model.low += moved
        k, _ = model.short()
        if len(k):
            ahead[k] = (ahead[k] << _W32) | words.take(used[k], mode="clip")
            used[k] += 1
        np.equal(model.cand, ids, out=model.hit)
        model.learn(ids, slot)
        before = ids.view(np.uint32)
    del model, words, lookup
    back: list[np.ndarray] = []
    rank = np.empty(lanes, np.int64)
    rank[order] = np.arange(lanes)
    at = 0
    for blocks, n, _ in files:
        back.append(out[:, rank[at:at + len(blocks)]].T.ravel()[:n] if len(blocks) else np.zeros(0, np.int32))
        at += len(blocks)
    return back


def encode_blocks(tokens: np.ndarray, block: int, zero: ZeroOrder) -> list[bytes]:
    """Code ``tokens`` in blocks of ``block`` ids (the last one may be shorter)."""
    return encode_files([(tokens, zero)], block)[0]


def decode_blocks(blocks: list[bytes], n: int, block: int, zero: ZeroOrder) -> np.ndarray:
    """The ``n`` ids of consecutive blocks."""
    return decode_files([(blocks, n, zero)], block)[0]
