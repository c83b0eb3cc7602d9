"""Benchmark decontamination: every passage queries a BM25 index of the test items by block-max WAND.

A test item (or a piece of a long one; all its pieces have the same length) is an entry of the index; a term's impact on an entry is divided
by the entry's own score, so a passage scores between 0 and 1: the share of the entry's weight it holds.
Passages are overlapping runs of words, twice as long as the longest entry and one such length apart, so
an entry always lies whole in one of them.  Entries at or above the threshold are all retrieved, then
their question and their answer are compared with the passage by word shingles; those of a long item are
whole, and gathered over the passages of all its pieces that are found in the text.  Case (of any script) and
signs between words do not count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.scratch import written
from pricelens.llm.textbatch import SHINGLE, byte_slices, shingle_sets, text_words

K1, B = 1.2, 0.75
COARSE = 64              # runs of entries with a maximum impact of every term each
THRESHOLD = 0.5
OVERLAP = 0.5
MAX_ENTRY, MIN_STRIDE, POSTINGS_BLOCK = 256, 32, 8
ITEM_BLOCK_BYTES = 16 << 20
_EPS = 1e-9
#: ASCII signs other than letters and digits separate words.
_SIGNS = np.array([b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)], np.uint8)


def folded_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of texts in lower case (of any script) without ASCII signs."""
    for i, j, data, off in byte_slices(pc.utf8_lower(column)):
        yield i, j, _SIGNS[data], off


def entry_begins(n: int) -> list[int]:
    """First words of the entries of an item of ``n`` words; the last piece of a long item overlaps the one before."""
    return [min(s, max(n - MAX_ENTRY, 0)) for s in range(0, n, MAX_ENTRY)]


@dataclass
class Statistics:
    """What BM25 takes from all items, however they are cut into blocks."""

    entries: int
    mean: float              # words of an entry
    longest: int
    df: Callable[[np.ndarray], np.ndarray]       # entries that hold each of the (rising) terms


class ItemIndex:
    """Inverted index of one block of items with impacts, list bounds and block maxima."""

    def __init__(self, items: list[tuple[int, str, str]], of_all: Statistics | None = None):
        """``items``: id, question and answer; an item without words is never found.  ``of_all``: if these are not all."""
        text = pa.array([t for _, q, a in items for t in (q, a)], pa.string())
        halves: list[np.ndarray] = []
        for _, _, data, off in folded_slices(text):
            words, first = text_words(data, off)
            halves += [words[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        self.item: list[int | None] = []          # of each item with words: id, and shingles of both parts
        self.question: list[np.ndarray] = []
        self.answer: list[np.ndarray] = []
        self.owner: list[int] = []                # item of each entry
        self.pieces: list[int] = []               # entries of each item
        entries: list[np.ndarray] = []
        for k, (item, _, _) in enumerate(items):
            q, a = halves[2 * k], halves[2 * k + 1]
            both, cut = np.concatenate([q, a]), len(q)
            if not len(both):
                continue
            # an item is cut where its question ends, or else in the middle
            at = cut if 0 < cut < len(both) else len(both) // 2
            for part, to in ((both[:at], self.question), (both[at:], self.answer)):
                to.append(shingle_sets(part, np.array([0, len(part)]))[0])
            begins = entry_begins(len(both))
            entries += [both[s:s + MAX_ENTRY] for s in begins]
            self.owner += [len(self.item)] * len(begins)
            self.pieces.append(len(begins))
            self.item.append(item)
        n = len(entries)
        size = np.array([len(e) for e in entries], float)
        if of_all is None:
            of_all = Statistics(n, size.mean() if n else 1.0, int(size.max(initial=0)), lambda _: df)
        self.stride = max(MIN_STRIDE, of_all.longest)
        norm = K1 * (1 - B + B * size / of_all.mean)
        all_words = np.concatenate(entries) if n else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(n), size.astype(np.int64))
        self.terms, term = np.unique(all_words, return_inverse=True)
        pair, tf = np.unique(term * max(n, 1) + owner, return_counts=True)
        term, owner = pair // max(n, 1), pair % max(n, 1)
        df = np.bincount(term, minlength=len(self.terms))
        df = of_all.df(self.terms)
        idf = np.log1p((of_all.entries - df + 0.5) / (df + 0.5))
        impact = idf[term] * tf * (K1 + 1) / (tf + norm[owner]) if n else np.zeros(0)
        impact = impact / np.bincount(owner, weights=impact, minlength=n)[owner] if n else impact
        cut = np.searchsorted(term, np.arange(len(self.terms) + 1)).tolist()
        self.entry = [owner[a:b].tolist() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        self.impact = [impact[a:b].tolist() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        self.bound = np.array([max(x) for x in self.impact] + [0.0])
        self.blocks = [[(e[min(i + POSTINGS_BLOCK, len(e)) - 1], max(x[i:i + POSTINGS_BLOCK]))
                        for i in range(0, len(e), POSTINGS_BLOCK)] for e, x in zip(self.entry, self.impact, strict=True)]
        self.coarse = np.zeros((len(self.terms) + 1, COARSE), np.float32)
        np.maximum.at(self.coarse, (term, owner * COARSE // max(n, 1)), impact.astype(np.float32))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.terms >> np.uint64(44)).astype(np.int64)] = True
        self.found: dict[bytes, list[tuple[int, float]]] = {}

    def term_ids(self, words: np.ndarray) -> np.ndarray:
        """Term of every word, or the number of terms for a word in no item."""
        out = np.full(len(words), len(self.terms))
        some = np.flatnonzero(self.maybe[(words >> np.uint64(44)).astype(np.int64)])
        at = np.searchsorted(self.terms, words[some])
        hit = self.terms[np.minimum(at, len(self.terms) - 1)] == words[some] if len(self.terms) else np.zeros(0, bool)
        out[some[hit]] = at[hit]
        return out

    def retrieve(self, terms: list[int], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """All entries that the distinct ``terms`` score at least ``threshold`` on, by block-max WAND."""
        goal = threshold - _EPS
        ended = len(self.owner)
        lists = [(self.entry[t], self.impact[t], self.blocks[t], float(self.bound[t])) for t in terms]
        place = [0] * len(lists)
        now = [e[0] for e, _, _, _ in lists]
        order = list(range(len(lists)))
        out = []

        def advance(k: int, to: int) -> None:
            e, blocks, i = lists[k][0], lists[k][2], place[k]
            block = i // POSTINGS_BLOCK
            while block < len(blocks) and blocks[block][0] < to:
                block += 1
            i = max(i, block * POSTINGS_BLOCK)
            while i < len(e) and e[i] < to:
                i += 1
            place[k] = i
            now[k] = e[i] if i < len(e) else ended

        while True:
            order.sort(key=now.__getitem__)
            total, pivot = 0.0, -1
            for i, k in enumerate(order):
                if now[k] == ended:
                    break
                total += lists[k][3]
                if total >= goal:
                    pivot = i
                    break
            if pivot < 0:
                return out
            target = now[order[pivot]]
            while pivot + 1 < len(order) and now[order[pivot + 1]] == target:
                pivot += 1
            most, turn = 0.0, ended
            for k in order[:pivot + 1]:
                blocks, block = lists[k][2], place[k] // POSTINGS_BLOCK
                while block < len(blocks) and blocks[block][0] < target:
                    block += 1
                if block < len(blocks):
                    most += blocks[block][1]
                    turn = min(turn, blocks[block][0] + 1)
            if most >= goal:
                if now[order[0]] == target:
                    score = 0.0
                    for k in order[:pivot + 1]:
                        score += lists[k][1][place[k]]
                        advance(k, target + 1)
                    if score >= goal:
                        out.append((target, score))
                else:
                    for k in order[:pivot]:
                        if now[k] < target:
                            advance(k, target)
            else:                                  # no entry before the nearest block end can reach the goal
                if pivot + 1 < len(order):
                    turn = min(turn, now[order[pivot + 1]])
                turn = max(turn, target + 1)
                for k in order[:pivot + 1]:
                    if now[k] < turn:
                        advance(k, turn)

    def matches(self, words: np.ndarray, first: np.ndarray, threshold: float = THRESHOLD
                ) -> Iterator[tuple[int, int, int, float, float, float]]:
        """Text, item, first word of the passage, score, and overlaps of question and answer with it.

        An item in one piece is reported for each passage that finds it; one in several pieces once for a
        text, with the best of its passages and the overlaps with all of them together.
        """
        if not len(self.terms):
            return
        terms = self.term_ids(words)
        size = np.diff(first)
        count = np.where(size > 0, np.maximum(-(-size // self.stride) - 1, 1), 0)
        text = np.repeat(np.arange(len(size)), count)
        begin = first[:-1][text] + self.stride * (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count))
        end = np.minimum(begin + 2 * self.stride, first[1:][text])
        long: dict[tuple[int, int], tuple[tuple[float, int], list[np.ndarray]]] = {}
        # no entry can reach the threshold where all list bounds together do not
        most = np.concatenate(([0.0], np.cumsum(self.bound[terms])))
        for p in np.flatnonzero(most[end] - most[begin] >= threshold - 1e-6).tolist():
            own = np.unique(terms[begin[p]:end[p]])
            own = own[own < len(self.terms)]
            # neither by all list bounds of its distinct terms, nor by the maxima of any run of entries
            if self.bound[own].sum() < threshold - 1e-6 or self.coarse[own].sum(axis=0).max() < threshold - 1e-4:
                continue
            key = own.tobytes()
            found = self.found.get(key)
            if found is None:
                if len(self.found) > 10_000:
                    self.found.clear()
                found = self.found[key] = self.retrieve(own.tolist(), threshold)
            if not found:
                continue
            passage = words[begin[p]:end[p]]
            whole = shingle_sets(passage, np.array([0, len(passage)]))[0]
            for entry, score in found:
                k, at = self.owner[entry], int(begin[p] - first[text[p]])
                held = [self._held(part, passage, whole) for part in (self.question[k], self.answer[k])]
                if self.pieces[k] == 1:
                    yield int(text[p]), k, at, score, self._share(held[0]), self._share(held[1])
                    continue
                key = int(text[p]), k
                if key in long:
                    best, before = long[key]
                    long[key] = max(best, (score, -at)), [x | y for x, y in zip(before, held, strict=True)]
                else:
                    long[key] = (score, -at), held
        for (one, k), ((score, at), held) in long.items():
            yield one, k, -at, score, self._share(held[0]), self._share(held[1])

    @staticmethod
    def _held(part: np.ndarray, passage: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Which of a part's shingles the passage has; a part of few words is looked for as a whole."""
        if len(part) == 1 and len(passage) >= SHINGLE:
            for n in range(1, SHINGLE):
                runs = np.arange(len(passage) - n + 1)
                short = np.concatenate([passage[i:i + n] for i in runs])
                if part[0] in np.concatenate(shingle_sets(short, np.arange(0, len(short) + 1, n))):
                    return np.ones(1, bool)
        return np.isin(part, whole, assume_unique=True)

    @staticmethod
    def _share(held: np.ndarray) -> float:
        return float(held.mean()) if len(held) else 1.0


def halves(items: DataFrame) -> DataFrame:
    """``item_id, question, answer``: columns of these names, or the text cut at its middle word."""
    if {"question", "answer"} <= set(items.columns):
        return items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("question", F.lit("")).alias("question"),
                            F.coalesce("answer", F.lit("")).alias("answer"))
    words = F.split(F.trim(F.coalesce(F.col("text"), F.lit(""))), r"\s+")
    middle = F.floor(F.size(words) / 2).cast("int")
    return items.select(F.col("item_id").cast("long").alias("item_id"),
                        F.concat_ws(" ", F.slice(words, F.lit(1), middle)).alias("question"),
                        F.concat_ws(" ", F.slice(words, middle + 1, F.size(words))).alias("answer"))


def item_statistics(cut: DataFrame) -> Statistics:
    """Counts over the entries of all items; the counts of words stay in a written table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.array([t for pair in zip(*(c.to_pylist() for c in batch.columns), strict=True) for t in pair], pa.string())
            found, sizes, held = [], [], np.zeros(0, np.uint64)
            for i, _, data, off in folded_slices(text):
                words, first = text_words(data, off)
                for k, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
                    held = np.concatenate([held, words[a:b]]) if (i + k) % 2 else words[a:b]
                    if (i + k) % 2:                        # question and answer are one text
                        for s in entry_begins(len(held)):
                            found.append(np.unique(held[s:s + MAX_ENTRY]))
                            sizes.append(len(held[s:s + MAX_ENTRY]))
            words, n = np.unique(np.concatenate(found or [held[:0]]), return_counts=True)
            rows = len(words) + 1                          # a first row without a word has the entries' sizes
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(np.uint64(0), words).view(np.int64), mask=np.arange(rows) == 0), pa.array(np.append(len(sizes), n), pa.int64()),
                 pa.array([sum(sizes)] + [0] * len(words), pa.int64()), pa.array([max(sizes, default=0)] + [0] * len(words), pa.int64())],
                names=["word", "n", "total", "longest"])

    counted = cut.select("question", "answer").mapInArrow(count, "word long, n long, total long, longest long")
    held = written(counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("longest").alias("longest")),
                   "item_words")
    sums = held.filter("word IS NULL").first()

    def df(terms: np.ndarray) -> np.ndarray:
        own = held.sparkSession.createDataFrame(pa.table({"word": terms.view(np.int64)}))
        rows = own.join(held, "word").select("word", "n").toArrow()                # one a term of the block
        order = np.argsort(rows["word"].to_numpy().view(np.uint64))
        return rows["n"].to_numpy()[order]

    return Statistics(sums.n or 1, (sums.total or 1) / (sums.n or 1), sums.longest or 0, df)


def item_blocks(items: DataFrame, block_bytes: int = ITEM_BLOCK_BYTES) -> Iterator[ItemIndex]:
    """Indexes of the test items, in blocks of a bounded size; scores do not depend on the blocks."""
    cut = halves(items)
    total = cut.agg(F.coalesce(F.sum(F.octet_length("question") + F.octet_length("answer")), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    of_all = item_statistics(cut) if n > 1 else None
    for k in range(n):
        rows = cut.filter(F.pmod(F.xxhash64("item_id", "question"), F.lit(n)) == k).orderBy("item_id", "question").collect()
        yield ItemIndex([(r.item_id, r.question, r.answer) for r in rows], of_all)


def retrieved_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """Best passage of each row and item at or above the threshold.

    ``doc_id, item_id, first_word, bm25, question_overlap, answer_overlap, leaked``; ``leaked`` asks for
    ``overlap`` of the shingles of both parts, of a long item over all its passages.  Null and empty texts have no passages, items without
    words match nothing, repeated rows are reported each, a null id is kept, and an empty table on
    either side gives no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for index in item_blocks(items):
        shared = spark.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                ids = batch.column(0)
                for i, j, data, off in folded_slices(batch.column(1)):
                    best: dict[tuple[int, int | None], tuple] = {}
                    for text, item, at, score, q, a in index.matches(*text_words(data, off), threshold):
                        key = (text, index.item[item])
                        if key not in best or (min(q, a), score) > (min(best[key][2:]), best[key][1]):
                            best[key] = (at, score, q, a)
                    if best:
                        keys, values = zip(*sorted(best.items(), key=lambda x: (x[0][0], str(x[0][1]))), strict=True)
                        at, score, q, a = zip(*values, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [ids.slice(i, j - i).take(pa.array([k[0] for k in keys])), pa.array([k[1] for k in keys], pa.int64()),
                             pa.array(at, pa.int64()), pa.array(score), pa.array(q), pa.array(a),
                             pa.array([min(x) >= overlap for x in zip(q, a, strict=True)])],
                            names=["doc_id", "item_id", "first_word", "bm25", "question_overlap", "answer_overlap", "leaked"])

        part = rows.mapInArrow(search, "doc_id long, item_id long, first_word long, bm25 double, question_overlap double, "
                                       "answer_overlap double, leaked boolean")
        out = part if out is None else out.unionByName(part)
    return out


def leak_flags(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP):
    """Column function over a text column: whether the text holds a test item's question and answer."""
    spark = docs.sparkSession
    shared = [spark.sparkContext.broadcast(index) for index in item_blocks(items)]

    @F.pandas_udf("boolean")
    def leaks(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            flag = np.zeros(len(s), bool)
            for i, _, data, off in folded_slices(pa.array(s, pa.string(), from_pandas=True)):
                words, first = text_words(data, off)
                for one in shared:
                    for text, _, _, _, q, a in one.value.matches(words, first, threshold):
                        flag[i + text] |= min(q, a) >= overlap
            yield pd.Series(flag)

    return leaks
