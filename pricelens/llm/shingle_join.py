"""Similarity join on word shingles with a count-vector R-tree.

Shingles are hashed into groups; a document is the point of its group counts.  A node of the tree keeps
the coordinate-wise maximum of its points, so the sum of coordinate minima with a query point bounds the
overlap with any document below it.  Surviving pairs are verified on the shingle sets themselves.

The trees stand on the executors.  What brings documents together is exact too:

* documents with the same set form one class, and one of them stands for it;
* a link needs an overlap of three quarters of either set, so a class with fewer shingles that occur in
  any other class has no link (one shuffle of 32-bit shingle keys by bucket);
* two linked classes share a number of their rarest shingles, those left when three quarters of a set are
  taken away and a sixteenth more (``least_shared``); classes joined by so many form a block, and a tree is
  built in each block;
* a block of more than ``TILE`` classes is cut into tiles; tiles meet through pivots first, and then every
  class that is still apart from the block's largest group meets all tiles, some at a time.

The result needs components, so a pair already known to be connected is not verified again.  Shingles
are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.arrays import array_sum, by_key, grouped, pack, released, sliced, unpack
from pricelens.llm.components import components
from pricelens.llm.scratch import discard, release_shuffles, written
from pricelens.llm.skew import spread_join
from pricelens.llm.textbatch import byte_slices, shingle_sets, text_words

BUCKET_SHINGLES = 1 << 20
FLUSH_SHINGLES = 1 << 20
SKETCH_BITS = 20
TILE, PIVOTS, LEAF = 1024, 8, 16
PAIRED, SPARE = 32, 16
PASS_SETS = 20_000
_U = np.uint64


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    for i, j, data, off in byte_slices(batch.column(1)):
        yield i, j, shingle_sets(*text_words(data, off))


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def needed(a, b):
    """Smallest overlap that links sets of ``a`` and ``b`` shingles: 100 * I >= 75 * (a + b - I)."""
    return -(-3 * (a + b) // 7)


def set_table(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_key`` (128 bits of the set) of every row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, key = [], []
            for _, _, sets in _sets(batch):
                size += [len(s) for s in sets]
                key += [_digest(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(key, pa.binary())],
                                             names=["doc_id", "n_shingles", "set_key"])

    return docs.mapInArrow(released(read), "doc_id long, n_shingles long, set_key binary")


def shared_shingles(docs: DataFrame, buckets: int) -> DataFrame:
    """``set_hash, shared``: how many of a set's shingles occur in another set (never too few)."""
    width = _U(-(-(1 << 32) // buckets))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, np.ndarray] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            owner = np.array([int.from_bytes(k[:8], "little") for k in held], np.uint64)
            each = np.array([len(s) for s in held.values()])
            every = np.concatenate(list(held.values()))
            doc = np.repeat(np.arange(len(each)), each)
            part = ((every >> _U(32)) // width).astype(np.uint16 if buckets < 65536 else np.int64)
            order = np.argsort(part, kind="stable")
            low, doc = (every[order] & _U(0xFFFFFFFF)).astype(np.uint32), doc[order]
            edges = np.searchsorted(part[order], np.arange(buckets + 1))
            rows, blobs = [], []
            for b in np.flatnonzero(np.diff(edges)).tolist():
                lo, hi = edges[b], edges[b + 1]
                docs_here, runs = np.unique(doc[lo:hi], return_counts=True)
                rows.append(b)
                blobs.append(pack(owner[docs_here], runs.astype(np.uint32), low[lo:hi]))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(blobs, pa.binary())],
                                              names=["part", "payload"])

        for batch in batches:
            for _, _, sets in _sets(batch):
                for s in sets:
                    if len(s):
                        key = _digest(s)
                        if key not in held:
                            held[key] = s
                            size += len(s)
                if size >= FLUSH_SHINGLES:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in grouped(batches):
            pieces = [unpack(p.as_py()) for b in held for p in b.column(1)]
            owner, runs, low = (np.concatenate([p[i] for p in pieces]) for i in range(3))
            sets, owner = np.unique(owner, return_inverse=True)
            pairs = np.unique((low.astype(_U) << _U(32)) | np.repeat(owner, runs).astype(_U))
            low = pairs >> _U(32)
            same = low[1:] == low[:-1]
            again = np.concatenate((same, [False])) | np.concatenate(([False], same))
            shared = np.bincount((pairs[again] & _U(0xFFFFFFFF)).astype(np.int64), minlength=len(sets))
            some = np.flatnonzero(shared)
            sets, shared = sets[some], shared[some]
            to = ((sets >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)      # ascending, as the sets are
            cut = np.searchsorted(to, np.arange(buckets + 1))
            parts = np.flatnonzero(np.diff(cut)).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()),
                 pa.array([pack(sets[cut[k]:cut[k + 1]], shared[cut[k]:cut[k + 1]].astype(np.uint32)) for k in parts],
                          pa.binary())], names=["part", "payload"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in grouped(batches):
            pieces = [unpack(p.as_py()) for b in held for p in b.column(1)]
            sets, at = np.unique(np.concatenate([p[0] for p in pieces]), return_inverse=True)
            total = np.bincount(at, weights=np.concatenate([p[1] for p in pieces]))
            yield pa.RecordBatch.from_arrays([pa.array(sets.view(np.int64)), pa.array(total.astype(np.int64))],
                                             names=["set_hash", "shared"])

    blobs = "part int, payload binary"
    rows = by_key(docs.mapInArrow(released(emit), blobs), "part", buckets).mapInArrow(released(count), blobs)
    return by_key(rows, "part", buckets).mapInArrow(released(add), "set_hash long, shared long")


def _spots(ids: np.ndarray, bits: int) -> np.ndarray:
    h = ids.astype(np.uint64) * _U(0x9E3779B97F4A7C15)
    return np.concatenate([h >> _U(64 - bits), (h * _U(0xD6E8FEB86659FD93)) >> _U(64 - bits)]).astype(np.int64)


def candidate_sets(docs: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """``rep, n, shingles`` of the rows whose id is among ``ids`` (and of a few others, which do no harm).

    The ids are told to the tasks by a bit table of bounded size.
    """
    bits = int(np.clip(np.ceil(np.log2(max(16 * n, 1))), 16, 28))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(1 << bits, bool)
        for batch in batches:
            found[_spots(batch.column(0).to_numpy(zero_copy_only=False), bits)] = True
        planes = np.packbits(found).reshape(16, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(16), pa.int32()), pa.array([p.tobytes() for p in planes], pa.binary())],
                                         names=["part", "payload"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, held in grouped(batches):
            both = np.bitwise_or.reduce([np.frombuffer(p.as_py(), np.uint8) for b in held for p in b.column(1)], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([both.tobytes()], pa.binary())],
                                             names=["part", "payload"])

    parts = by_key(ids.mapInArrow(released(mark), "part int, payload binary"), "part", 16).mapInArrow(released(join), "part int, payload binary").collect()
    table = np.frombuffer(b"".join(bytes(r.payload) for r in sorted(parts, key=lambda r: r.part)), np.uint8)
    wanted = docs.sparkSession.sparkContext.broadcast(np.unpackbits(table).view(bool) if len(table) else np.zeros(1 << bits, bool))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            spots = wanted.value[_spots(ids, bits)].reshape(2, -1)
            batch = batch.filter(pa.array(spots[0] & spots[1] & ~batch.column(0).is_null().to_numpy(zero_copy_only=False)))
            for i, j, sets in _sets(batch):
                some = [k for k, s in enumerate(sets) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).take(pa.array(some, pa.int64())),
                     pa.array([len(sets[k]) for k in some], pa.int64()),
                     pa.array([sets[k].tobytes() for k in some], pa.binary())], names=["rep", "n", "shingles"])

    return docs.mapInArrow(released(read), "rep long, n long, shingles binary")


def shingle_sketch(sets: DataFrame) -> np.ndarray:
    """Occurrences of all shingles of ``sets``, by hash, in a table of fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.float32)
        for batch in batches:
            for blob in batch.column(0):
                s = np.frombuffer(blob.as_py(), np.uint64)
                np.add.at(total, (s >> _U(64 - SKETCH_BITS)).astype(np.int64), 1)
        yield sliced(total)

    total = array_sum(sets.select("shingles").mapInArrow(released(count), "part int, payload binary"), np.float32)
    return total if len(total) else np.zeros(1 << SKETCH_BITS, np.float32)


def rare(n):
    """How many of its rarest shingles a class of ``n`` meets others by.

    Of two linked classes one has its ``rare`` first; what they share beyond lies in its other shingles, so
    they share ``least_shared`` of the rare ones of both, more than a sixteenth of either set.
    """
    return n - (3 * n + 3) // 4 + 1 + n // SPARE


def least_shared(a, b):
    """Least number of rare shingles that linked classes of ``a`` and ``b`` shingles have in common."""
    return needed(a, b) - np.maximum(a - rare(a), b - rare(b))


def block_edges(sets: DataFrame, rank: np.ndarray, buckets: int) -> DataFrame:
    """Edges ``a, b`` that connect all linked classes, between those that share enough of their rarest shingles.

    Rarity is any fixed order of shingles; here by the sketch, then by hash.  A shingle of up to ``PAIRED``
    classes gives their pairs, whose common shingles are counted: a few by chance make no edge, so that a
    block does not grow with the rows of the table.  A shingle of more classes is hot.  A pair may have as
    many hot ones in common as either class has; a class with no more than ``n // SPARE`` needs another one
    for every link, and classes with more are tied to the least of those that share a hot one.  In each task
    a hot shingle's further classes are dealt out by class, not by shingle.
    """
    order = sets.sparkSession.sparkContext.broadcast(rank)

    def part_of(reps: np.ndarray) -> np.ndarray:
        return (((reps.view(_U) * _U(0x9E3779B97F4A7C15)) >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)

    def dealt(part: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, bytes]]:
        by = np.argsort(part, kind="stable")
        part, arrays = part[by], [a[by] for a in arrays]
        cut = np.append(np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))), len(part))
        for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            yield int(part[lo]), pack(*(a[lo:hi] for a in arrays))

    def rows(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.binary())],
                                          names=["part", "payload"])

    def runs(*columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """The distinct rows of ``columns`` in ascending order, and where each value of the first begins."""
        by = np.lexsort(columns[::-1])
        columns = [c[by] for c in columns]
        new = np.zeros(len(by), bool)
        new[:1] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        columns = [c[new] for c in columns]
        first = columns[0]
        return columns, np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        reps: list[int] = []
        sizes: list[int] = []
        size = 0

        def flush() -> pa.RecordBatch:
            each = [len(k) for k in keys]
            (key, rep, n), start = runs(np.concatenate(keys), np.repeat(np.array(reps, np.int64), each),
                                        np.repeat(np.array(sizes, np.uint32), each))
            for held in (keys, reps, sizes):
                held.clear()
            more = np.arange(len(key)) - np.repeat(start, np.diff(np.append(start, len(key)))) > PAIRED
            some = ~more
            found = list(dealt(((key[some] >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64), key[some], rep[some], n[some]))
            if more.any():
                found += dealt(-1 - part_of(rep[more]), key[more], rep[more], n[more])
            return rows(found)

        for batch in batches:
            for rep, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                s = np.frombuffer(blob.as_py(), np.uint64)
                level = order.value[(s >> _U(64 - SKETCH_BITS)).astype(np.int64)]
                keys.append(s[np.lexsort((s, level))[:rare(len(s))]])
                reps.append(rep)
                sizes.append(len(s))
                size += len(keys[-1])
                if size >= FLUSH_SHINGLES:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    def pairs(rep: np.ndarray, n: np.ndarray, start: np.ndarray, many: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Pairs of the classes of each run, and how often each comes, for as many runs at a time as ``FLUSH_SHINGLES`` pairs."""
        made = np.cumsum(many * (many - 1) // 2)
        while len(start):
            upto = max(1, int(np.searchsorted(made, FLUSH_SHINGLES, "right")))
            here, length = start[:upto], many[:upto]
            first = [np.zeros(0, np.int64)]
            second = [np.zeros(0, np.int64)]
            for m in np.unique(length).tolist():
                i, j = np.triu_indices(m, 1)
                first.append((here[length == m][:, None] + i).ravel())
                second.append((here[length == m][:, None] + j).ravel())
            a, b = np.concatenate(first), np.concatenate(second)
            small, large = np.minimum(n[a], n[b]).astype(np.int64), np.maximum(n[a], n[b]).astype(np.int64)
            ok = (4 * small >= 3 * large) & (rep[a] != rep[b])
            a, b = a[ok], b[ok]
            if len(a):
                own, at = np.unique(np.stack([rep, n.astype(np.int64)], axis=1), axis=0, return_inverse=True)
                code, count = np.unique(at.ravel()[a] * len(own) + at.ravel()[b], return_counts=True)
                a, b = own[code // len(own)], own[code % len(own)]
                yield rows(list(dealt(part_of(np.ascontiguousarray(a[:, 0])), a[:, 0], b[:, 0], a[:, 1].astype(np.uint32),
                                      b[:, 1].astype(np.uint32), count.astype(np.uint32))))
            start, many, made = start[upto:], many[upto:], made[upto:] - made[upto - 1]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, held in grouped(batches):
            if part < 0:
                yield rows([(-1 - part, p.as_py()) for b in held for p in b.column(1)])
                continue
            pieces = [unpack(p.as_py()) for b in held for p in b.column(1)]
            (key, rep, n), start = runs(*(np.concatenate([p[i] for p in pieces]) for i in range(3)))
            many = np.diff(np.append(start, len(key)))
            hot = np.repeat(many > PAIRED, many)
            if hot.any():
                yield rows(list(dealt(part_of(rep[hot]), key[hot], rep[hot], n[hot])))
            some = (many > 1) & (many <= PAIRED)
            yield from pairs(rep, n, start[some], many[some])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``kind, a, b, size, number``: edges (0), pairs that need as many hot shingles of ``b`` (1), the
        hot shingles of class ``a`` (2), the least class ``b`` of this task that shares the hot shingle ``a`` (3)."""

        def out(kind: int, a: np.ndarray, b: np.ndarray, size=0, number=0) -> pa.RecordBatch:
            cells = [np.broadcast_to(np.asarray(x).astype(np.int64), len(a)) for x in (a, b, size, number)]
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), *(pa.array(c) for c in cells)],
                                              names=["kind", "a", "b", "size", "number"])

        for _, held in grouped(batches):
            pieces = [unpack(p.as_py()) for b in held for p in b.column(1)]
            join = lambda width, kinds: [np.concatenate([np.zeros(0, k), *(p[i] for p in pieces if len(p) == width)])
                                         for i, k in enumerate(kinds)]
            (key, rep, n), _ = runs(*join(3, (_U, np.int64, np.uint32)))
            a, b, na, nb, count = join(5, (np.int64, np.int64, np.uint32, np.uint32, np.uint32))
            del pieces
            by = np.lexsort((nb, na, b, a))
            a, b, na, nb, count = (x[by].astype(np.int64) for x in (a, b, na, nb, count))
            names = np.unique(np.concatenate([rep, a]))
            own, hot = np.unique(np.searchsorted(names, rep) << 32 | n.astype(np.int64), return_counts=True)
            if len(a):
                new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (na[1:] != na[:-1]) | (nb[1:] != nb[:-1])))
                start = np.flatnonzero(new)
                count = np.add.reduceat(count, start)
                a, b, na, nb = a[start], b[start], na[start], nb[start]
                lack = least_shared(na, nb) - count
                yield out(0, a[lack <= 0], b[lack <= 0])
                if len(own):
                    code = np.searchsorted(names, a) << 32 | na
                    at = np.minimum(np.searchsorted(own, code), len(own) - 1)
                    open_ = (lack > 0) & (own[at] == code) & (hot[at] >= lack)
                    yield out(1, a[open_], b[open_], nb[open_], lack[open_])
            if len(own):
                size = own & 0xFFFFFFFF
                yield out(2, names[own >> 32], 0 * own, size, hot)
                heavy = own[hot > size // SPARE]
                some = np.isin(np.searchsorted(names, rep) << 32 | n.astype(np.int64), heavy)
                key, rep = key[some], rep[some]
                if len(key):
                    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                    least = np.repeat(rep[start], np.diff(np.append(start, len(key))))
                    tied = np.unique(np.stack([least, rep], axis=1)[rep != least], axis=0)
                    yield out(0, tied[:, 0], tied[:, 1])
                    yield out(3, key[start].view(np.int64), rep[start])

    blobs = "part int, payload binary"
    made = sets.select("rep", "shingles").mapInArrow(released(emit), blobs)
    met = by_key(made, "part", buckets).mapInArrow(released(meet), blobs)
    judged = written(by_key(met, "part", buckets).mapInArrow(released(judge), "kind int, a long, b long, size long, number long"),
                     "meetings")
    hot = judged.filter("kind = 2").select(F.col("a").alias("b"), "size", F.col("number").alias("hot"))
    open_ = judged.filter("kind = 1").join(hot, ["b", "size"]).filter("hot >= number").select("a", "b")
    stars = judged.filter("kind = 3").select(F.col("a").alias("key"), "b")
    least = stars.groupBy("key").agg(F.min("b").alias("a"))
    stars = stars.join(least, "key").filter("a <> b").select("a", "b")
    return judged.filter("kind = 0").select("a", "b").union(open_).union(stars).distinct()


class CountTree:
    """R-tree over group counts: leaves of ``LEAF`` points, and nodes of ``LEAF`` nodes above them."""

    def __init__(self, sets: list[np.ndarray], dims: int):
        self.size = np.array([len(s) for s in sets])
        shift = _U(64 - int(dims).bit_length() + 1)
        self.points = np.stack([np.bincount((s >> shift).astype(np.int64), minlength=dims) for s in sets]).astype(np.int32)
        # packed by size, then by the heaviest coordinates: points side by side have like counts
        heavy = np.argsort(-self.points.var(axis=0), kind="stable")[:4]
        self.order = np.lexsort([*(self.points[:, h] for h in heavy[::-1]), self.size])
        self.levels = []
        top, low, high = self.points[self.order], self.size[self.order], self.size[self.order]
        while len(top) > LEAF:
            cut = np.arange(0, len(top), LEAF)
            top, low, high = (np.maximum.reduceat(top, cut, axis=0), np.minimum.reduceat(low, cut),
                              np.maximum.reduceat(high, cut))
            self.levels.append((top, low, high))

    def search(self, point: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the sets that may link with a set of these counts, and the bounds of the overlaps."""
        at = np.arange(len(self.levels[-1][0])) if self.levels else np.arange(len(self.order))
        for k in range(len(self.levels) - 1, -1, -1):
            top, low, high = self.levels[k]
            least = np.maximum(low[at], -(-3 * size // 4))
            ok = (least <= high[at]) & (3 * low[at] <= 4 * size)
            at, least = at[ok], least[ok]
            at = at[np.minimum(top[at], point).sum(axis=1) >= needed(size, least)]
            below = len(self.levels[k - 1][0]) if k else len(self.order)
            at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
            at = at[at < below]
        at = self.order[at]
        at = at[(4 * self.size[at] >= 3 * size) & (3 * self.size[at] <= 4 * size)]
        bound = np.minimum(self.points[at], point).sum(axis=1)
        ok = bound >= needed(size, self.size[at])
        return at[ok], bound[ok]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common shingles of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def tree_links(sets: list[np.ndarray], label: np.ndarray, queries: np.ndarray) -> list[tuple[int, int]]:
    """Verified links, enough to connect what they connect, from ``queries`` to all ``sets``.

    Sets with equal ``label`` count as connected already; ``label`` is updated.
    """
    dims = int(2 ** np.clip(np.round(np.log2(max(np.median([len(s) for s in sets]), 1) / 3)), 4, 8))
    tree = CountTree(sets, dims)
    links = []
    for q in queries.tolist():
        mine = sets[q]
        at, bound = tree.search(tree.points[q], len(mine))
        open_ = label[at] != label[q]
        at, bound = at[open_], bound[open_]
        share = bound / (len(mine) + tree.size[at])
        at = at[np.argsort(-share, kind="stable")]
        while len(at):
            p = int(at[0])
            both = overlap(mine, sets[p])
            if 100 * both >= 75 * (len(mine) + len(sets[p]) - both):
                links.append((q, p))
                label[label == label[p]] = label[q]
                at = at[label[at] != label[q]]
            else:
                at = at[1:]
    return links


def _link_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns ``task, rep, shingles, label, query``: one tree per task, links as ``a, b``."""
    a: list[int] = []
    b: list[int] = []
    for _, held in grouped(batches):
        table = pa.Table.from_batches(held)
        reps = table.column(1).to_numpy()
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column(2)]
        labels = table.column(3).to_pylist()
        names: dict[int, int] = {}
        label = np.array([len(sets) + names.setdefault(x, len(names)) if x is not None else k for k, x in enumerate(labels)])
        queries = np.flatnonzero(table.column(4).to_numpy())
        for q, p in tree_links(sets, label, queries):
            a.append(int(reps[q]))
            b.append(int(reps[p]))
        if len(a) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            a, b = [], []
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def block_links(sets: DataFrame, edges: DataFrame, tile: int = TILE) -> DataFrame:
    """Links ``a, b`` that connect every two linked classes of ``sets``, found block by block."""
    blocks = components(edges).select(F.col("node").alias("rep"), F.col("component").alias("block"))
    size = blocks.groupBy("block").agg(F.count("*").alias("members"))
    placed = spread_join(blocks, size, "block", F.col("rep")).withColumn(
        "tiles", F.ceil(F.col("members") / F.lit(tile)).cast("int")).withColumn(
        "tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    placed = written(placed, "blocks")
    held = written(sets.join(placed, "rep").select("block", "tile", "tiles", "rep", "shingles"), "block-sets")
    task = F.concat_ws("/", "block", "tile")
    none, yes = F.lit(None).cast("long"), F.lit(True)
    rows = held.select(task.alias("task"), "rep", "shingles", none.alias("label"), yes.alias("query"))
    large = held.filter("tiles > 1")
    by_hash = Window.partitionBy("block").orderBy(F.xxhash64("rep"), "rep")
    pivots = (placed.filter("tiles > 1").withColumn("__n", F.row_number().over(by_hash)).filter(F.col("__n") <= PIVOTS)
              .select("rep", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("to"), F.col("tile").alias("home"))
              .filter("to <> home"))
    visiting = large.join(pivots, "rep").select(F.concat_ws("/", "block", "to").alias("task"), "rep", "shingles",
                                                none.alias("label"), yes.alias("query"))
    found = written(by_key(rows.unionByName(visiting), "task").mapInArrow(released(_link_groups), "a long, b long"), "links")
    if placed.filter("tiles > 1").isEmpty():
        return found
    # what the pivots left apart in large blocks meets all of its block
    groups = components(found).withColumnRenamed("node", "rep")
    apart = spread_join(large.withColumn("__rep", F.col("rep")), groups, "rep", F.col("__rep")).select(
        "block", "tile", "tiles", "rep", "shingles", F.coalesce("component", "rep").alias("label"))
    apart = written(apart, "apart")
    count = apart.groupBy("block", "label").agg(F.count("*").alias("n"))
    main = count.groupBy("block").agg(F.max(F.struct("n", "label"))["label"].alias("main"), F.sum("n").alias("all"),
                                      F.max("n").alias("most")).filter(F.col("all") > F.col("most"))
    main = main.select("block", "main", F.ceil((F.col("all") - F.col("most")) / F.lit(tile)).cast("int").alias("rounds"))
    rest = written(spread_join(apart, main, "block", F.col("rep")).filter("main is not null"), "rest")
    others = rest.filter("label <> main").withColumn("round", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("rounds")).cast("int"))
    task = F.concat_ws("/", "block", "tile", "round")
    size, last = rest.agg(F.count("*"), F.coalesce(F.max("rounds"), F.lit(0))).first()
    step = max(1, max(placed.count(), PASS_SETS) // max(1, size))
    for k in range(0, last, step):                  # a pass holds each set about twice on disk, however many tiles there are
        asks = others.filter(F.col("round").between(k, k + step - 1)).withColumn(
            "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        told = rest.filter(F.col("rounds") > k).withColumn(
            "round", F.explode(F.sequence(F.lit(k), F.least(F.col("rounds"), F.lit(k + step)) - 1)))
        more = (asks.select(task.alias("task"), "rep", "shingles", "label", yes.alias("query"))
                .unionByName(told.select(task.alias("task"), "rep", "shingles", "label", F.lit(False).alias("query"))))
        links = by_key(more, "task").mapInArrow(released(_link_groups), "a long, b long")
        found = written(found.unionByName(links), "links")
        release_shuffles(rest.sparkSession)
    return found


def shingle_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    Words are runs of bytes other than white space, lower-cased in A-Z; a set holds the distinct 5-word
    shingles, or the whole sequence of a shorter text.  Rows with 100 * intersection >= 75 * union link;
    ``component_id`` is the smallest id reachable.  Null and empty texts have no shingles and link with
    nothing.  A row without an id links with nothing and has no component.  Repeated rows are returned
    each; rows that share an id are one node.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    table = written(set_table(rows), "sets")
    known = table.filter("n_shingles > 0 and doc_id is not null")
    classes = written(known.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n")), "classes")
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(1, -(-total // BUCKET_SHINGLES))
    shared = shared_shingles(rows, buckets)
    hashed = classes.withColumn("set_hash", _little_endian(F.col("set_key")))
    alive = written(hashed.join(shared, "set_hash").filter("100 * shared >= 75 * n").select("rep").distinct(), "alive")
    n = alive.count()
    release_shuffles(docs.sparkSession)
    node = F.col("rep")
    if n:
        sets = written(candidate_sets(rows, alive, n), "candidates")
        sketch = shingle_sketch(sets)
        rank = np.floor(2 * np.log2(np.maximum(sketch, 1))).astype(np.uint8)
        shingles = int(sketch.sum())
        edges = block_edges(sets, rank, max(1, -(-shingles // (2 * BUCKET_SHINGLES))))
        found = components(block_links(sets, edges, tile)).withColumnRenamed("node", "rep")
        classes = classes.join(found, "rep", "left")
        discard(sets)
    else:
        classes = classes.withColumn("component", F.lit(None).cast("long"))
    keyed = classes.select("set_key", F.coalesce("component", node).alias("component"))
    joined = spread_join(table, keyed, "set_key", F.coalesce("doc_id", F.lit(-1)))
    return joined.select("doc_id", "n_shingles",
                         F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def _little_endian(key):
    """The first eight bytes of a binary as a long, as numpy reads them."""
    hexed = F.hex(key)
    swapped = F.concat(*(F.substring(hexed, 15 - 2 * k, 2) for k in range(8)))
    high = F.conv(F.substring(swapped, 1, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(F.conv(F.substring(swapped, 9, 8), 16, 10).cast("long"))
