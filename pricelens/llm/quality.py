"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters of eight bytes slide over the text in steps of four, and each
filter is max-pooled over overlapping chunks of 512 bytes (every 256) that cover the whole document.
The chunks' pooled values are combined, by their mean and their maximum, into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.textbatch import string_column

DIM, FILTERS, STRIDE, SEGMENT = 8, 24, 4, 256
WINDOWS = SEGMENT // STRIDE
#: Bound of the training sample: labelled rows, and bytes read of each (in evenly spread segments).
MAX_TRAIN_ROWS = 3000
MAX_TRAIN_BYTES = 8192
THRESHOLD = 0.7
SLICE = 1 << 19


@dataclass
class ByteCNN:
    """Weights: byte embedding, filters over eight bytes, and the layer over pooled chunks."""

    embed: np.ndarray        # 256 x DIM
    filters: np.ndarray      # 2 * STRIDE * DIM x FILTERS
    bias: np.ndarray         # FILTERS
    mean_w: np.ndarray       # FILTERS
    max_w: np.ndarray        # FILTERS
    offset: np.ndarray       # 1

    @classmethod
    def fresh(cls, seed: int) -> ByteCNN:
        r = np.random.default_rng(seed)
        f = lambda *shape, s: (r.standard_normal(shape) * s).astype(np.float32)
        return cls(f(256, DIM, s=0.5), f(2 * STRIDE * DIM, FILTERS, s=0.2), np.zeros(FILTERS, np.float32),
                   f(FILTERS, s=0.2), f(FILTERS, s=0.2), np.zeros(1, np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.mean_w, self.max_w, self.offset]

    def _responses(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embedded half windows, and every filter's response to every window of whole segments."""
        half = self.embed[data].reshape(-1, STRIDE * DIM)
        k = STRIDE * DIM
        both = half @ np.concatenate([self.filters[:k], self.filters[k:]], axis=1)
        out = both[:, :FILTERS]
        out[:-1] += both[1:, FILTERS:]
        out += self.bias
        return half, out.reshape(-1, WINDOWS, FILTERS)

    def chunk_values(self, data: np.ndarray, segments: np.ndarray) -> tuple[np.ndarray, ...]:
        """Pooled chunks of padded texts: values, argmax segment, argmax window, chunk offsets, half windows.

        ``segments`` holds the first segment of each text and the total; chunk ``i`` of a text covers
        its segments ``i`` and ``i + 1`` (only one, if the text has one).
        """
        half, out = self._responses(data)
        best = out.argmax(axis=1)
        seg = np.take_along_axis(out, best[:, None, :], axis=1)[:, 0, :]
        n = np.diff(segments)
        last = np.zeros(len(seg), bool)
        last[segments[1:] - 1] = True
        alone = np.zeros(len(seg), bool)
        alone[segments[:-1][n == 1]] = True
        lead = np.flatnonzero(~last | alone)
        mate = np.where(alone[lead], lead, np.minimum(lead + 1, len(seg) - 1))
        later = seg[mate] > seg[lead]
        which = np.where(later, mate[:, None], lead[:, None])
        value = np.where(later, seg[mate], seg[lead])
        first = np.concatenate(([0], np.cumsum(np.maximum(n - 1, 1))))
        return np.maximum(value, 0), which, np.take_along_axis(best, which, axis=0), first, half

    def logits(self, data: np.ndarray, segments: np.ndarray) -> np.ndarray:
        value, _, _, first, _ = self.chunk_values(data, segments)
        mean = np.add.reduceat(value, first[:-1], axis=0) / np.diff(first)[:, None]
        top = np.maximum.reduceat(value, first[:-1], axis=0)
        return mean @ self.mean_w + top @ self.max_w + self.offset[0]

    def gradients(self, data: np.ndarray, segments: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean log loss, through the pooled windows only."""
        value, which, window, first, half = self.chunk_values(data, segments)
        count = np.diff(first)
        doc = np.repeat(np.arange(len(count)), count)
        mean = np.add.reduceat(value, first[:-1], axis=0) / count[:, None]
        top = np.maximum.reduceat(value, first[:-1], axis=0)
        p = 1 / (1 + np.exp(-(mean @ self.mean_w + top @ self.max_w + self.offset[0])))
        d = ((p - labels) / len(labels)).astype(np.float32)
        is_top = value == top[doc]
        is_top = is_top & (np.cumsum(is_top, axis=0) - np.concatenate(
            [np.zeros((1, FILTERS), np.int64), np.cumsum(is_top, axis=0)])[first[:-1]][doc] == 1)
        dv = d[doc][:, None] * (self.mean_w / count[doc][:, None] + self.max_w * is_top) * (value > 0)
        rows, f = np.nonzero(dv)
        dv = dv[rows, f].astype(np.float32)
        at = which[rows, f] * WINDOWS + window[rows, f]
        after = np.minimum(at + 1, len(half) - 1)
        k = STRIDE * DIM
        d_filters = np.zeros_like(self.filters)
        d_half = np.zeros_like(half)
        for j in range(FILTERS):
            mine = f == j
            a, b, g = at[mine], after[mine], dv[mine]
            d_filters[:k, j] = g @ half[a]
            d_filters[k:, j] = g @ half[b]
            np.add.at(d_half, a, g[:, None] * self.filters[:k, j])
            np.add.at(d_half, b, g[:, None] * self.filters[k:, j])
        flat = d_half.reshape(-1, DIM)
        d_embed = np.stack([np.bincount(data, weights=flat[:, c], minlength=256) for c in range(DIM)], axis=1)
        return [d_embed.astype(np.float32), d_filters, np.bincount(f, weights=dv, minlength=FILTERS).astype(np.float32),
                d @ mean, d @ top, np.array([d.sum()], np.float32)]


def padded(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts laid out in whole segments, each followed by at least one window of zero bytes."""
    size = np.diff(off)
    n = (size + 2 * STRIDE + SEGMENT - 1) // SEGMENT
    segments = np.concatenate(([0], np.cumsum(n)))
    out = np.zeros(int(segments[-1]) * SEGMENT, np.uint8)
    shift = segments[:-1] * SEGMENT - off[:-1]
    out[np.arange(len(data)) + np.repeat(shift, size)] = data
    return out, segments


def train(texts: list[bytes], labels: np.ndarray, epochs: int = 12, batch: int = 64, seed: int = 7) -> ByteCNN:
    """Fit the network with Adam on a bounded sample (see ``labelled_sample``)."""
    net = ByteCNN.fresh(seed)
    if not texts:
        return net
    rate = np.clip(labels.mean(), 0.01, 0.99)
    net.offset[0] = np.log(rate / (1 - rate))
    rng = np.random.default_rng(seed)
    m = [np.zeros_like(w) for w in net.parts()]
    v = [np.zeros_like(w) for w in net.parts()]
    step, total = 0, epochs * -(-len(texts) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), batch):
            chosen = order[a:a + batch]
            sizes = np.concatenate(([0], np.cumsum([len(texts[i]) for i in chosen])))
            data, segments = padded(np.frombuffer(b"".join(texts[i] for i in chosen), np.uint8), sizes)
            step += 1
            lr = 0.01 * (1 - step / (total + 1))
            for k, (w, g) in enumerate(zip(net.parts(), net.gradients(data, segments, labels[chosen]), strict=True)):
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                w -= lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-7)
    return net


def score_batch(net: ByteCNN, column: pa.Array) -> np.ndarray:
    """Probability of label 1 for each whole text."""
    data, off = string_column(column)
    out = np.empty(len(off) - 1)
    i = 0
    while i < len(out):
        j = max(i + 1, int(np.searchsorted(off, off[i] + SLICE, "right")) - 1)
        if off[j] - off[i] > 8 * SLICE:
            out[i] = _score_long(net, data[off[i]:off[j]])
        else:
            out[i:j] = net.logits(*padded(data[off[i]:off[j]], off[i:j + 1] - off[i]))
        i = j
    return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def _score_long(net: ByteCNN, text: np.ndarray) -> float:
    """Logit of one very long text, taken in runs of segments that overlap by one segment."""
    segments = (len(text) + 2 * STRIDE + SEGMENT - 1) // SEGMENT
    run = SLICE // SEGMENT
    total, top, chunks = np.zeros(FILTERS), np.zeros(FILTERS, np.float32), segments - 1
    for a in range(0, segments - 1, run):
        b = min(segments, a + run + 1)
        piece = np.zeros((b - a) * SEGMENT + SEGMENT, np.uint8)       # one more segment feeds the last window
        part = text[a * SEGMENT:(b + 1) * SEGMENT]
        piece[:len(part)] = part
        _, out = net._responses(piece)
        seg = np.maximum(out[:b - a].max(axis=1), 0)
        value = np.maximum(seg[:-1], seg[1:])
        total += value.sum(axis=0)
        top = np.maximum(top, value.max(axis=0))
    return float(total / chunks @ net.mean_w + top @ net.max_w + net.offset[0])


def sampled_bytes(text: str | None, limit: int) -> bytes:
    """The text's bytes, or evenly spread segments of them if it is longer than ``limit``."""
    raw = (text or "").encode("utf-8")
    if len(raw) <= limit:
        return raw
    n = limit // SEGMENT
    return b"".join(raw[a:a + SEGMENT] for a in np.linspace(0, len(raw) - SEGMENT, n).astype(int).tolist())


def held_out(id_col: Column) -> Column:
    """Rows whose crc32(id as text) mod 4 is 2 teach nothing; a row without an id neither."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS,
                    max_bytes: int = MAX_TRAIN_BYTES) -> tuple[list[bytes], np.ndarray]:
    """A bounded sample of labelled texts, spread by a hash of the id; never a held-out row.

    A document labelled more than once takes the larger half of its labels (a tie counts as 1); null
    labels are left out.  At most ``max_rows`` ids are broadcast and as many texts of at most
    ``max_bytes`` bytes reach the driver.
    """
    picked = (labels.select(F.col("doc_id"), F.col("quality").cast("double").alias("label"))
              .filter(~held_out(F.col("doc_id")) & F.col("label").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("double").alias("label"))
              .orderBy(F.crc32(F.concat(F.lit("train"), F.col("doc_id").cast("string"))), "doc_id").limit(max_rows))
    cut = F.pandas_udf(lambda s: s.map(lambda t: sampled_bytes(t, max_bytes)), "binary")
    rows = (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
            .select("doc_id", "label", cut("text").alias("raw")).dropDuplicates(["doc_id"]).orderBy("doc_id").collect())
    return [bytes(r.raw) for r in rows], np.array([r.label for r in rows], np.float32)


def scorer(net: ByteCNN):
    """Column function: the probability that a text (null: empty) is of good quality."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(score_batch(net, pa.array(s, pa.string(), from_pandas=True)))

    return score


def fit(docs: DataFrame, labels: DataFrame, **bounds: int) -> ByteCNN:
    """Train on the labelled rows of ``docs`` that are not held out."""
    texts, y = labelled_sample(docs, labels, **bounds)
    return train(texts, y)


def quality_scores(docs: DataFrame, net: ByteCNN, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, in one narrow pass.

    Null and empty texts score as a text without bytes; repeated rows are scored alike; a null id is
    kept.  Only id and text are read.
    """
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scorer(net)(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
