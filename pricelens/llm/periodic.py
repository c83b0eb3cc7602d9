"""Maximal periodic runs of words: classes of equal beginnings are united by falling common length.

The suffixes of a text that share their first ``l`` words form a class; the classes of all ``l`` are
built as by Kruskal's algorithm, uniting along the edges between neighbours of the suffix array in
descending order of their longest common prefix (LCP).  Each class keeps its positions in order.  Two
positions that become neighbours when classes are united at LCP ``l`` repeat ``l`` words at their
distance ``p``; no position of the class between them means that ``p`` is the smallest period, so with
``p <= l`` they seed a run, which is maximal if the words before them differ.  LCPs below those of the
shortest run asked for are not visited.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.llm.textbatch import byte_slices

RUN = T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")])
_BLOCK = 1024


class OrderedPositions:
    """A growing sorted set in blocks, so that adding to a large one stays cheap."""

    __slots__ = ("blocks", "tops", "size")

    def __init__(self, items: list[int]):
        self.blocks, self.tops, self.size = [items], [items[-1]], len(items)

    def add(self, x: int) -> None:
        self.size += 1
        k = min(bisect_left(self.tops, x), len(self.tops) - 1)
        block = self.blocks[k]
        insort(block, x)
        if len(block) > _BLOCK:
            half = len(block) // 2
            self.blocks.insert(k + 1, block[half:])
            del block[half:]
            self.tops.insert(k, block[-1])
            k += 1
        self.tops[k] = self.blocks[k][-1]

    def around(self, x: int) -> tuple[int, int]:
        """The neighbours of ``x``, which is not in the set; -1 where there is none."""
        k = bisect_left(self.tops, x)
        if k == len(self.tops):
            return self.tops[-1], -1
        block = self.blocks[k]
        i = bisect_right(block, x)
        before = block[i - 1] if i else (self.tops[k - 1] if k else -1)
        return before, block[i]

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block


def _grams(rank: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``k`` values from each place on (zeros beyond the end)."""
    rng = np.random.Generator(np.random.PCG64(k))
    step = rng.integers(1, 1 << 62, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    values = np.append(rank, np.zeros(k, rank.dtype)).astype(np.uint64) + np.uint64(1)
    values *= np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(29)
    total = values[:len(rank)] * step[0]
    for i in range(1, k):
        total += values[i:len(rank) + i] * step[i]
    return total


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def neighbours(ids: np.ndarray, doc: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours of the suffix array of each text (rising ``doc``) that share ``least`` words or more, and their LCP.

    ``ids`` are at least 1.  Ranks of twice as many words come from pairs of ranks; places whose rank is
    their own are not sorted again.
    """
    n = len(ids)
    order = np.lexsort((ids, doc))
    head = np.ones(n, bool)
    head[1:] = (ids[order[1:]] != ids[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    levels, width = [rank], 1
    last = np.append(np.flatnonzero(doc[1:] != doc[:-1]), n - 1) if n else np.zeros(0, np.int64)
    end = np.repeat(last + 1, np.diff(np.concatenate(([0], last + 1))))
    while True:
        alone = head & np.append(head[1:], True)
        slots = np.flatnonzero(~alone)                         # places of the order that are not settled
        if not len(slots):
            break
        rows = order[slots]
        beyond = rows + width
        ahead = np.where(beyond < end[rows], rank[np.minimum(beyond, n - 1)] + 1, 0)
        group = rank[rows]
        by = np.lexsort((ahead, group))
        rows, group, ahead = rows[by], group[by], ahead[by]
        order[slots] = rows
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (ahead[1:] != ahead[:-1])
        rank = rank.copy()
        rank[rows] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(rows)), 0))]
        head[slots] = fresh
        levels.append(rank)
        width *= 2
    a, b = order[:-1], order[1:]
    lcp = np.zeros(max(n - 1, 0), np.int64)
    live = np.flatnonzero(doc[a] == doc[b]) if n else np.zeros(0, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a[live] + lcp[live], b[live] + lcp[live]
        inside = np.maximum(x, y) < end[a[live]]
        level = levels[k]
        equal = inside & (level[np.minimum(x, n - 1)] == level[np.minimum(y, n - 1)])
        lcp[live[equal]] += 1 << k
    keep = np.flatnonzero(lcp >= least)
    return a[keep], b[keep], lcp[keep]


def runs_of(ids: np.ndarray, doc: np.ndarray, min_length: int, exponent: int) -> list[tuple[int, int, int]]:
    """Start, length and smallest period of every maximal run with ``length >= max(min_length, exponent * period)``.

    Starts count from the beginning of ``ids``; ``doc`` (rising) says which text a word belongs to.
    """
    least = min(max(min_length, exponent * p) - p for p in range(1, min_length + 2))
    # texts in which no `least` words occur twice have no run
    mixed = _grams(ids, least) + doc.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    active = np.zeros(int(doc[-1]) + 1 if len(doc) else 0, bool)
    active[doc[_repeated(mixed)]] = True
    place = np.flatnonzero(active[doc])
    if not len(place):
        return []
    ids, doc = ids[place], doc[place]
    left, right, lcp = neighbours(ids, doc, least)
    words, texts = ids.tolist(), doc.tolist()
    found: list[tuple[int, int, int]] = []

    def seed(i: int, j: int, common: int) -> None:
        period = j - i
        if period > common or period + common < max(min_length, exponent * period):
            return
        if i == 0 or texts[i - 1] != texts[i] or words[i - 1] != words[j - 1]:
            found.append((i, period + common, period))

    parent: dict[int, int] = {}
    members: dict[int, OrderedPositions] = {}
    order = np.argsort(-lcp, kind="stable")
    for i, j, common in zip(left[order].tolist(), right[order].tolist(), lcp[order].tolist(), strict=True):
        roots = []
        for x in (i, j):
            root = x
            while parent.setdefault(root, root) != root:
                parent[root] = root = parent[parent[root]]
            roots.append(root)
        small, large = (members.pop(r, None) or OrderedPositions([r]) for r in roots)
        if small.size > large.size:
            small, large = large, small
            roots.reverse()
        parent[roots[0]] = roots[1]
        gap, joins, prior = None, [], -1
        for x in small:                           # runs of the smaller class that lie in one gap of the larger
            around = large.around(x)
            if around != gap:
                if gap and gap[1] >= 0:
                    joins.append((prior, gap[1]))
                if around[0] >= 0:
                    joins.append((around[0], x))
                gap = around
            prior = x
        if gap[1] >= 0:
            joins.append((prior, gap[1]))
        for x, y in joins:
            seed(x, y, common)
        for x in small:
            large.add(x)
        members[roots[1]] = large
    return [(int(place[i]), length, period) for i, length, period in found]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6,
                  exponent: int = 4) -> DataFrame:
    """``id_col, n_words, runs, collapsed`` of every row's whole text.

    Words are maximal runs of bytes outside 0x20 and 0x09-0x0D.  ``runs`` holds every maximal run (start,
    length, smallest period, in words) of at least ``min_length`` words and ``exponent`` (at least 2)
    periods, by start and period.  ``collapsed`` is the text's words joined by one space without those
    that any run holds after its first period.  Null and empty texts have no words and an empty
    ``collapsed``; a null id and repeated rows are kept; other columns are not read.  A narrow pass
    without a shuffle: memory holds a slice of about 1 MB of texts, or one longer text.
    """
    if exponent < 2 or min_length < 2:
        raise ValueError("a run repeats its period")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in byte_slices(batch.column(1)):
                raw, ends = data.tobytes(), off.tolist()
                texts = [raw[a:b].split() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                known: dict[bytes, int] = {}
                ids = np.array([known.setdefault(w, len(known) + 1) for t in texts for w in t], np.int64)
                sizes = [len(t) for t in texts]
                first = np.concatenate(([0], np.cumsum(sizes)))
                doc = np.repeat(np.arange(len(texts)), sizes)
                runs: list[list[dict]] = [[] for _ in texts]
                cover = np.zeros(len(ids) + 1, np.int64)
                for start, length, period in sorted(runs_of(ids, doc, min_length, exponent), key=lambda r: (r[0], r[2])):
                    k = int(doc[start])
                    runs[k].append({"start": start - int(first[k]), "length": length, "period": period})
                    cover[start + period] += 1
                    cover[start + length] -= 1
                kept = np.cumsum(cover[:-1]) == 0
                collapsed = []
                for k, t in enumerate(texts):
                    if runs[k]:
                        own = kept[first[k]:first[k + 1]].tolist()
                        t = [w for w, keep in zip(t, own, strict=True) if keep]
                    collapsed.append(b" ".join(t))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(sizes, pa.int64()),
                     pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                     pa.array(collapsed, pa.binary()).cast(pa.string())], names=["id", "n_words", "runs", "collapsed"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN)),
                           T.StructField("collapsed", T.StringType())])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(find, schema).withColumnRenamed("id", id_col)
