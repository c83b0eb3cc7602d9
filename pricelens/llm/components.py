"""Connected components of a graph whose edges are rows, by contraction rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.scratch import discard, written


TASK_EDGES = 200_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges ``a, b`` to every node ``b`` of a run of edges from the least node it is connected with in that run."""

    def runs() -> Iterator[pa.Table]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 2 * TASK_EDGES:
                yield pa.Table.from_batches(held)
                held, size = [], 0
        if size:
            yield pa.Table.from_batches(held)

    for table in runs():
        ends = np.stack([table.column(0).to_numpy(), table.column(1).to_numpy()])
        nodes, at = np.unique(ends, return_inverse=True)
        a, b = at.reshape(2, -1)
        label = np.arange(len(nodes))
        while True:
            least = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, label[a], least)
            np.minimum.at(label, label[b], least)
            np.minimum.at(label, a, least)
            np.minimum.at(label, b, least)
            label = label[label]
            if (label == before).all():
                break
        some = np.flatnonzero(label != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[label[some]]), pa.array(nodes[some])], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b`` (long); ``component`` is its smallest node.

    In each round every node moves to the least of itself and its neighbours in an order drawn anew by
    hash, which keeps long paths short, and edges follow their ends; a round removes a fixed share of
    the nodes on average.  Edges that meet in one task are first replaced by fewer with the same
    components.  Rows are two longs, and the joins of a hub's edges are plain equi-joins, which Spark
    splits where a key is skewed.  Each round is a written table, so a lost executor repeats one round
    at most.
    """
    edges = written(edges.filter("a <> b"), "all-edges")
    tasks = -(-edges.count() // TASK_EDGES)
    edges = written(edges.repartition(max(1, tasks), "a").mapInArrow(_forest, "a long, b long"), "edges")
    if tasks <= 1:                                  # one run held all edges: its forest is the answer
        roots = edges.select("a").distinct().select(F.col("a").alias("node"), F.col("a").alias("component"))
        return roots.union(edges.select("b", "a"))
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = written(nodes.select("node", F.col("node").alias("label")), "labels")
    turn = 0
    while not edges.isEmpty():
        order = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("n"))
        both = edges.select(F.col("a").alias("label"), F.col("b").alias("other")).union(edges.select("b", "a"))
        least = both.groupBy("label").agg(F.min(order("other")).alias("best"))
        moves = written(least.select("label", F.least(F.col("best"), order("label")).alias("best"))
                        .select("label", F.col("best")["n"].alias("to")), "moves")
        moved = edges.withColumnRenamed("a", "label").join(moves, "label").select(F.col("to").alias("a"), F.col("b").alias("label"))
        moved = moved.join(moves, "label").select("a", F.col("to").alias("b"))
        next_edges = written(moved.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                             .distinct(), "edges")
        next_labels = written(labels.join(moves, "label", "left").select(
            "node", F.coalesce("to", "label").alias("label")), "labels")
        discard(edges, labels, moves)
        edges, labels, turn = next_edges, next_labels, turn + 1
    least = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(least, "label").select("node", "component")
