"""Hierarchical Pitman-Yor language model with distributed Gibbs sampling.

Restaurants: one for every previous word, keyed by its hash, and one for text starts.  They share one
parent, the unigram restaurant, whose base is uniform over the ``V`` training words and one unknown word.
A dish is a word.  Each sweep redraws, for every dish, the number of tables that serve it in every
restaurant given all other dishes' tables (generalised Stirling numbers give the seatings' weights), then
the tables of the parent.  Draws use generators keyed by bucket and sweep: a task that runs again draws
the same.

Words are cut into buckets by hash; all of a dish's state lies in one.  A flush of texts sends each
bucket its distinct pairs of words with their counts, so a frequent pair is one entry of a flush, and
keeps for every occurrence the number of its word, from which the pairs are numbered again.  After a sweep every bucket sends the tables of its
previous words to the bucket of their hash, which adds them up and answers with the totals: what is
exchanged grows with the previous words, and the driver sees only sums over all of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm.arrays import by_key, grouped, pack, released, unpack
from pricelens.llm.scratch import written
from pricelens.llm.textbatch import byte_slices, text_words

SWEEPS, BURN_IN = 3, 1
STRENGTH = 1.0
BUCKET_TOKENS = 2 << 20
FLUSH_WORDS, FLUSH_DOCS = 1 << 20, 60_000
END = np.uint64(0x5E7D0FD0C)     # stands for the end of a text
START = np.uint64(0x57A27F10A7)  # stands for its start, as a previous word
EXACT = 64               # counts up to this use the exact conditional of the tables


def token_stream(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and end signs of all texts in order, and the number of tokens of each text."""
    words, first = text_words(data, off)
    n = np.diff(first) + 1
    out = np.full(len(words) + len(n), END, np.uint64)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(n) - 1] = False
    out[keep] = words
    return out, n


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n``: counts of the training tokens, combined in each task before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            words, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["word", "n"])

        for batch in batches:
            train = batch.column(1).to_numpy(zero_copy_only=False)
            for i, j, data, off in byte_slices(batch.column(2)):
                tokens, n = token_stream(data, off)
                held.append(tokens[np.repeat(train[i:j], n)])
                size += len(held[-1])
                if size >= FLUSH_WORDS:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    return docs.mapInArrow(released(count), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def bucket_of(words: np.ndarray, buckets: int) -> np.ndarray:
    return (((words >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)


def distinct_pairs(words: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and contexts of the distinct pairs, sorted by them, and the pair of each occurrence."""
    order = np.lexsort((contexts, words))
    w, ctx = words[order], contexts[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (ctx[1:] != ctx[:-1])
    pair = np.empty(len(w), np.uint32)
    pair[order] = np.cumsum(new) - 1
    return w[new], ctx[new], pair


def numbered_words(words: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The occurrences' words by number, frequent ones first; each number's place by hash; the place of ``START``.

    ``words`` has the word of each distinct pair in order.  The numbers pack better than those of the pairs.
    """
    new = np.ones(len(words), bool)
    new[1:] = words[1:] != words[:-1]
    place = (np.cumsum(new) - 1)[pair]
    by_count = np.argsort(-np.bincount(place, minlength=int(new.sum())), kind="stable")
    number = np.empty(len(by_count), np.uint32)
    number[by_count] = np.arange(len(by_count))
    own = words[new]
    start = int(np.searchsorted(own, START))
    return number[place], by_count.astype(np.uint32), np.array([2 * start + int(start < len(own) and own[start] == START)])


def numbered_pairs(number: np.ndarray, by_count: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The pair of each occurrence, as ``distinct_pairs`` numbers them, from ``numbered_words`` of texts of ``n`` tokens."""
    place = by_count[number].astype(np.int64)
    before = np.empty_like(place)
    before[1:] = 2 * place[:-1] + 1
    before[np.cumsum(n) - n] = start
    return np.unique(place * (2 * len(by_count) + 2) + before, return_inverse=True)[1]


def steps_of(values: np.ndarray) -> np.ndarray:
    """Differences that ``np.cumsum`` undoes; those of sorted values pack well."""
    out = values.copy()
    out[1:] -= values[:-1]
    return out


def occurrences(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows ``part, flush, payload``: a flush's distinct pairs by bucket (``part`` below ``buckets``), and its texts.

    The texts' rows hold ids, training flags, token counts and the word of every occurrence.
    """

    def emit(part: list[int], flush: str, payload: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([flush] * len(part)),
                                           pa.array(payload, pa.binary())], names=["part", "flush", "payload"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, name = 0, f"{TaskContext.get().partitionId()}"       # the same if the task runs again
        ids, train, sizes, words, contexts = [], [], [], [], []
        n_words = n_docs = 0

        def flush() -> pa.RecordBatch:
            n, key, learns = np.concatenate(sizes), pa.concat_arrays(ids), np.concatenate(train)
            w, ctx, pair = distinct_pairs(np.concatenate(words), np.concatenate(contexts))
            count = np.bincount(pair, weights=np.repeat(learns, n), minlength=len(w)).astype(np.int64)
            edges = np.searchsorted(bucket_of(w, buckets), np.arange(buckets + 1))
            rows, blobs = [], []
            for b in np.flatnonzero(np.diff(edges)).tolist():
                at = slice(edges[b], edges[b + 1])
                own, per = np.unique(w[at], return_counts=True)
                before, place = np.unique(ctx[at], return_inverse=True)
                rows.append(b)
                blobs.append(pack(steps_of(own), per.astype(np.uint32), steps_of(before), place.astype(np.uint32), count[at]))
            here = f"{name}-{seq}"
            rows.append(buckets + zlib.crc32(here.encode()) % buckets)
            blobs.append(pack(
                key.fill_null(0).to_numpy(zero_copy_only=False), key.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
                learns.astype(np.uint8), n.astype(np.int64), *numbered_words(w, pair)))
            for x in (ids, train, sizes, words, contexts):
                x.clear()
            return emit(rows, here, blobs)

        for batch in batches:
            learns = batch.column(1).to_numpy(zero_copy_only=False)
            for i, j, data, off in byte_slices(batch.column(2)):
                for a in range(i, j, FLUSH_DOCS):                 # a slice of very many tiny texts
                    b = min(j, a + FLUSH_DOCS)
                    if n_docs and n_docs + b - a > FLUSH_DOCS:
                        yield flush()
                        seq, n_words, n_docs = seq + 1, 0, 0
                    lo, hi = off[a - i], off[b - i]
                    tokens, n = token_stream(data[lo:hi], off[a - i:b - i + 1] - lo)
                    before = np.empty_like(tokens)
                    before[1:] = tokens[:-1]
                    before[np.cumsum(n) - n] = START
                    ids.append(batch.column(0).slice(a, b - a))
                    train.append(learns[a:b])
                    sizes.append(n)
                    words.append(tokens)
                    contexts.append(before)
                    n_words, n_docs = n_words + len(tokens), n_docs + b - a
                    if n_words >= FLUSH_WORDS:
                        yield flush()
                        seq, n_words, n_docs = seq + 1, 0, 0
        if n_docs:
            yield flush()

    return docs.mapInArrow(released(read), "part int, flush string, payload binary")


def bucket_tables(rows: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket of words, and the texts' rows as they are.

    ``part, flush, pairs, contexts, uses``: ``pairs`` has the number of pairs of each word, and every
    pair's context and training count; ``contexts`` has the contexts' hashes in order; ``uses`` has the
    pairs of each flush, in the flush's own order.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(part: int, flush: str, pairs: bytes | None, contexts: bytes | None, uses: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([flush]), *(pa.array([x], pa.binary()) for x in (pairs, contexts, uses))],
                names=["part", "flush", "pairs", "contexts", "uses"])

        for part, held in grouped(batches):
            flushes = [f for b in held for f in b.column(1).to_pylist()]
            blobs = (p.as_py() for b in held for p in b.column(2))
            if part >= buckets:
                for name, blob in zip(flushes, blobs, strict=True):
                    yield row(part, name, None, None, blob)
                continue
            order = np.argsort(flushes)                       # the same row whatever order blobs came in
            pieces = [unpack(p) for p in blobs]
            pieces = [pieces[i] for i in order]
            names = "\n".join(flushes[i] for i in order).encode()
            sizes = np.array([len(p[3]) for p in pieces], np.int64)
            n = np.concatenate([p[4] for p in pieces])
            w, ctx, use = distinct_pairs(
                np.concatenate([np.repeat(np.cumsum(p[0], dtype=np.uint64), p[1]) for p in pieces]),
                np.concatenate([np.cumsum(p[2], dtype=np.uint64)[p[3]] for p in pieces]))
            del pieces
            count = np.bincount(use, weights=n, minlength=len(w)).astype(np.int64)
            per = np.unique(w, return_counts=True)[1]
            contexts, at = np.unique(ctx, return_inverse=True)
            yield row(part, "", pack(per.astype(np.uint32), at.astype(np.uint32), count), pack(steps_of(contexts)),
                      pack(steps_of(use), sizes, np.frombuffer(names, np.uint8)))

    return by_key(rows, "part", 2 * buckets).mapInArrow(released(build), "part int, flush string, pairs binary, contexts binary, uses binary")


def log_stirling(discount: float, size: int = EXACT) -> np.ndarray:
    """Log generalised Stirling numbers: weights of seating ``c`` customers at ``t`` tables."""
    out = np.full((size + 1, size + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(size):
        t = np.arange(size + 1)
        stay = np.log(np.maximum(c - discount * t, 1e-300)) + out[c]
        stay[(c - discount * t) <= 0] = -np.inf
        new = np.concatenate(([-np.inf], out[c, :-1]))
        out[c + 1] = np.logaddexp(stay, new)
    return out


def draw_tables(count: np.ndarray, weight: np.ndarray, discount: float, stirling: np.ndarray,
                rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes with ``count`` customers; ``weight`` is the weight of a new table, (theta + d T) P.

    Up to ``EXACT`` customers are drawn from the exact conditional; further ones are seated in binomial
    batches of an eighth of those already there, which is not a Gibbs draw.
    """
    tables = np.ones(len(count), np.int64)
    some = np.flatnonzero(count >= 2)
    base = np.minimum(count[some], EXACT)
    log_w = np.log(weight[some])
    u = rng.random(len(some))
    order = np.argsort(base, kind="stable")
    edges = np.searchsorted(base[order], np.arange(2, EXACT + 2))
    for c in range(2, EXACT + 1):
        a, b = edges[c - 2], edges[c - 1]
        for lo in range(a, b, 1 << 17):
            k = order[lo:min(b, lo + (1 << 17))]
            score = stirling[c, 1:c + 1] + np.arange(1, c + 1) * log_w[k][:, None]
            p = np.exp(score - score.max(axis=1, keepdims=True)).cumsum(axis=1)
            tables[some[k]] = 1 + (p < (u[k] * p[:, -1])[:, None]).sum(axis=1)
    many = np.flatnonzero(count > EXACT)
    seated = np.full(len(many), EXACT, np.int64)
    while len(many):
        more = np.minimum(np.maximum(seated // 8, 1), count[many] - seated)
        w = weight[many]
        tables[many] += rng.binomial(more, w / (w + np.maximum(seated - discount * tables[many], 1e-9)))
        seated += more
        left = seated < count[many]
        many, seated = many[left], seated[left]
    return np.minimum(tables, np.maximum(count, 1))


@dataclass
class Totals:
    """What restaurants exchange after a sweep: tables of each context, and the parent's customers and tables."""

    tables: np.ndarray
    parent_customers: float
    parent_tables: float


@dataclass
class Model:
    """Sizes and the totals of every sweep so far; enough to redo any word's draws."""

    contexts: int
    vocabulary: int
    tokens: int
    customers: np.ndarray = field(default_factory=lambda: np.zeros(0))
    discount: float = 0.5
    parent_discount: float = 0.5
    strength: float = STRENGTH
    history: list[Totals] = field(default_factory=list)

    def parent(self, totals: Totals, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Unigram probability of words with these customers and tables at the parent."""
        base = (self.strength + self.parent_discount * totals.parent_tables) / (self.vocabulary + 1)
        return (customers - self.parent_discount * tables + base) / (self.strength + totals.parent_customers)

    def states(self, part: int, per: np.ndarray, ctx: np.ndarray, count: np.ndarray, sweeps: int
               ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Tables of each pair, and each word's parent customers and tables, after 0, 1, ... sweeps."""
        owner = np.repeat(np.arange(len(per)), per)
        tables = (count > 0).astype(np.int64)
        customers = np.bincount(owner, weights=tables, minlength=len(per)).astype(np.int64)
        parent_tables = (customers > 0).astype(np.int64)
        yield tables, customers, parent_tables
        child, root = log_stirling(self.discount), log_stirling(self.parent_discount)
        seen = np.flatnonzero(count > 0)
        for s in range(sweeps):
            totals, rng = self.history[s], np.random.Generator(np.random.Philox(key=[part, s]))
            p = self.parent(totals, customers, parent_tables)
            k = ctx[seen]
            tables = np.zeros(len(count), np.int64)
            tables[seen] = draw_tables(count[seen], (self.strength + self.discount * totals.tables[k]) * p[owner[seen]],
                                       self.discount, child, rng)
            customers = np.bincount(owner, weights=tables, minlength=len(per)).astype(np.int64)
            known = np.flatnonzero(customers > 0)
            new = (self.strength + self.parent_discount * totals.parent_tables) / (self.vocabulary + 1)
            parent_tables = np.zeros(len(per), np.int64)
            parent_tables[known] = draw_tables(customers[known], np.full(len(known), new), self.parent_discount, root, rng)
            yield tables, customers, parent_tables

    def predict(self, part: int, per: np.ndarray, ctx: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Probability of every pair's word in its context, averaged over the kept sweeps."""
        owner = np.repeat(np.arange(len(per)), per)
        total, kept = np.zeros(len(count)), 0
        full = self.strength + self.customers[ctx]
        for s, (tables, customers, parent_tables) in enumerate(self.states(part, per, ctx, count, len(self.history) - 1)):
            if s <= BURN_IN and s < len(self.history) - 1:
                continue
            totals = self.history[s]
            p = self.parent(totals, customers, parent_tables)[owner]
            own = count - self.discount * tables
            total += (own + (self.strength + self.discount * totals.tables[ctx]) * p) / full
            kept += 1
        return total / kept


def with_totals(tables: DataFrame, totals: list[DataFrame], buckets: int, uses: bool = False) -> DataFrame:
    """A bucket's row and the totals of its contexts after each sweep so far, side by side."""
    own = tables.filter(F.col("part") < buckets).select(
        "part", F.lit(-1).alias("sweep"), F.lit(-1).alias("bucket"), F.col("pairs").alias("payload"), "contexts",
        (F.col("uses") if uses else F.lit(None).cast("binary")).alias("uses"))
    if not totals:
        return own
    for t in totals:
        own = own.unionByName(t.select("part", "sweep", "bucket", "payload", F.lit(None).cast("binary").alias("contexts"),
                                       F.lit(None).cast("binary").alias("uses")))
    return by_key(own, "part", buckets)


def bucket_state(held: list[pa.RecordBatch], model: Model, parents: list[tuple[float, float]]
                 ) -> tuple[Model, list[np.ndarray], np.ndarray, bytes | None]:
    """The model as a bucket's contexts see it, the bucket's pairs, its contexts and its uses."""
    rows = sorted((r for b in held for r in zip(*(b.column(k).to_pylist() for k in range(1, 6)), strict=True)),
                  key=lambda r: r[:2])
    (_, _, pairs, contexts, uses), told = rows[0], [(r[0], unpack(r[2])) for r in rows[1:]]
    # a bucket's contexts are sorted by hash, hence by the bucket that added them up
    local = replace(model, history=[
        Totals(np.concatenate([x[0] for sweep, x in told if sweep == s]).astype(np.float64), *parent)
        for s, parent in enumerate(parents)])
    if told:
        local.customers = np.concatenate([x[1] for sweep, x in told if sweep == 0]).astype(np.float64)
    return local, unpack(pairs), np.cumsum(unpack(contexts)[0], dtype=np.uint64), uses


def _sum_totals(tables: DataFrame, totals: list[DataFrame], model: Model, parents: list[tuple[float, float]], buckets: int
                ) -> tuple[DataFrame, np.ndarray]:
    """Totals of each context after the next sweep, for each bucket that has it, and six sums over all.

    The sums are the parent's customers and tables, and the counts of counts (pairs; parents).
    """
    sweep = len(totals)
    names = [f"r{k}" for k in range(6)]
    kind = "payload binary, " + ", ".join(f"{x} double" for x in names)

    def batch_of(keys: list[tuple[str, list[int]]], payload: list[bytes], rest: np.ndarray) -> pa.RecordBatch:
        sums = [pa.array([x] + [0.0] * (len(payload) - 1)) for x in rest.tolist()]          # once, with the first row
        return pa.RecordBatch.from_arrays([*(pa.array(v, pa.int32()) for _, v in keys), pa.array(payload, pa.binary()), *sums],
                                          names=[*(k for k, _ in keys), "payload", *names])

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, held in grouped(batches):
            local, (per, ctx, count), contexts, _ = bucket_state(held, model, parents)
            for state in local.states(part, per, ctx, count, sweep):
                pass
            t, c, u = state
            rest = np.array([c.sum(), u.sum(), (count == 1).sum(), (count == 2).sum(), (c == 1).sum(), (c == 2).sum()], float)
            sent = [np.bincount(ctx, weights=x, minlength=len(contexts)).astype(np.int64)
                    for x in ((t, count) if sweep == 0 else (t,))]
            edges = np.searchsorted(bucket_of(contexts, buckets), np.arange(buckets + 1))
            to = np.flatnonzero(np.diff(edges)).tolist()
            blobs = [pack(steps_of(contexts[edges[k]:edges[k + 1]]), *(x[edges[k]:edges[k + 1]] for x in sent)) for k in to]
            yield batch_of([("bucket", to), ("part", [part] * len(to))], blobs, rest)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, held in grouped(batches):
            parts = [x for b in held for x in b.column(1).to_pylist()]
            pieces = [unpack(x.as_py()) for b in held for x in b.column(2)]
            rest = np.array([[x for b in held for x in b.column(3 + k).to_pylist()] for k in range(6)]).sum(axis=1)
            at = np.unique(np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in pieces]), return_inverse=True)[1]
            total = [np.bincount(at, weights=np.concatenate([p[k] for p in pieces])).astype(np.int64)
                     for k in range(1, len(pieces[0]))]
            edges = np.cumsum([0, *(len(p[0]) for p in pieces)])
            blobs = [pack(*(x[at[a:b]] for x in total)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
            n = len(parts)
            yield batch_of([("part", parts), ("sweep", [sweep] * n), ("bucket", [bucket] * n)], blobs, rest)

    told = with_totals(tables, totals, buckets).mapInArrow(released(tell), f"bucket int, part int, {kind}")
    added = written(by_key(told, "bucket", buckets).mapInArrow(released(add), f"part int, sweep int, bucket int, {kind}"), f"totals{sweep}")
    sums = added.agg(*(F.coalesce(F.sum(x), F.lit(0.0)).alias(x) for x in names)).first()
    return added, np.array(sums, float)


def _discount(ones: float, twos: float) -> float:
    return float(np.clip(ones / max(ones + 2 * twos, 1.0), 0.05, 0.95))


@dataclass
class Fitted:
    """A fitted model: the word tables it was fitted on, and the totals of every sweep."""

    tables: DataFrame
    buckets: int
    model: Model
    totals: list[DataFrame]
    parents: list[tuple[float, float]]      # the parent's customers and tables after each sweep


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train=None, sweeps: int = SWEEPS) -> Fitted:
    """Read all texts, learn from the rows that ``train`` (a Column) marks, and run the sampler.

    Every training token is counted, in the restaurant of its own previous word.
    """
    train = F.lit(True) if train is None else train
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(train, F.lit(False)).alias("train"),
                       F.col(text_col).alias("text"))
    size = vocabulary(rows).agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    buckets = max(1, -(-size.n * 5 // (4 * BUCKET_TOKENS)))
    tables = written(bucket_tables(occurrences(rows, buckets), buckets), "occurrences")
    model = Model(0, size.v, size.n)
    totals: list[DataFrame] = []
    parents: list[tuple[float, float]] = []
    for s in range(sweeps + 1):
        added, rest = _sum_totals(tables, totals, model, parents, buckets)
        if s == 0:
            model.discount, model.parent_discount = _discount(rest[2], rest[3]), _discount(rest[4], rest[5])
        totals.append(added)
        parents.append((float(rest[0]), float(rest[1])))
    return Fitted(tables, buckets, model, totals, parents)


def score(spark: SparkSession, fitted: Fitted) -> DataFrame:
    """One row per text: ``doc_id, trained, n_tokens, n_known, base_score, score`` (log10)."""
    model, buckets, parents = fitted.model, fitted.buckets, fitted.parents
    floor = model.tokens + 0.5 * (model.vocabulary + 1)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, held in grouped(batches):
            local, (per, ctx, count), _, uses = bucket_state(held, model, parents)
            steps, sizes, names = unpack(uses)
            use = np.cumsum(steps, dtype=np.uint32)
            p = np.log10(local.predict(part, per, ctx, count)).astype(np.float32)
            owner = np.repeat(np.arange(len(per)), per)
            c = np.bincount(owner, weights=count, minlength=len(per)).astype(np.int64)[owner]
            edges = np.concatenate(([0], np.cumsum(sizes)))
            for flush, a, b in zip(names.tobytes().decode().split("\n"), edges[:-1], edges[1:], strict=True):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([flush]), pa.array([part], pa.int32()), pa.array([pack(p[use[a:b]], c[use[a:b]])], pa.binary())],
                    names=["flush", "part", "payload"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in grouped(batches):
            # the texts first, then the flush's pairs in order
            rows = sorted((r for b in held for r in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)),
                          key=lambda r: r[0])
            ids, null, learns, n, *numbers = unpack(rows[0][1])
            pair = numbered_pairs(*numbers, n)
            pieces = [unpack(x) for _, x in rows[1:]]
            p, c = (np.concatenate([x[k] for x in pieces]) for k in range(2))
            base = np.log10((c + 0.5) / floor)
            doc = np.repeat(np.arange(len(n)), n)
            known = np.bincount(doc, weights=(c > 0)[pair], minlength=len(n)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=null > 0), pa.array(learns > 0), pa.array(n), pa.array(known),
                 pa.array(np.bincount(doc, weights=base[pair], minlength=len(n))),
                 pa.array(np.bincount(doc, weights=p[pair], minlength=len(n)))],
                names=["doc_id", "trained", "n_tokens", "n_known", "base_score", "score"])

    scored = with_totals(fitted.tables, fitted.totals, buckets, uses=True).mapInArrow(released(predicted), "flush string, part int, payload binary")
    texts = fitted.tables.filter(F.col("part") >= buckets).select(
        "flush", F.lit(-1).alias("part"), F.col("uses").alias("payload"))
    return by_key(scored.unionByName(texts), "flush").mapInArrow(released(gather), "doc_id long, trained boolean, n_tokens long, n_known long, base_score double, score double")


def language_model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fit on the rows whose crc32(id as text) mod 5 is not 1 and score every row's whole text.

    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity``.  A null or empty
    text is its end alone; a row without an id is held out and scored; repeated rows are scored (and
    learned from) each; an empty table gives no rows.  Other columns are not read.
    """
    train = F.crc32(F.col(id_col).cast("string")) % 5 != 1
    fitted = fit(docs, id_col, text_col, train)
    scored = score(docs.sparkSession, fitted)
    return scored.select(
        "doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known",
        F.lit(fitted.model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
