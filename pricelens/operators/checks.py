"""Invariants of the derived tables as distributed jobs that return the violating rows.

Row rules are counted by ``Dataset.observe`` while the checked table is
written, so a sound table costs no further pass; only when a count is not
zero its rows are read again for the violating ones.  Rules about groups
(ranks of a store, repeated keys) are grouped aggregates.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.session import work_path

# Per report: (value that must be > 0, "before" column that must be set,
# sign rule "after < before" or "after > before").
_RULES = {
    "list_price_increases": ("pct_increase", "prev_list_price", "current_list_price", ">"),
    "list_price_decreases": ("pct_decrease", "prev_list_price", "current_list_price", "<"),
    "discounts": ("pct_decrease", "prev_price", "current_price", "<"),
    "avg_deals_30d": ("pct_discount", "avg_price_30d", "current_price", "<"),
}

VIOLATION_COLUMNS = ["report", "store", "product_id", "rank", "rule"]
VIOLATIONS = T.StructType([T.StructField(c, T.IntegerType() if c == "rank" else T.StringType()) for c in VIOLATION_COLUMNS])


def _observed(table: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """The table written to the shared scratch folder, and how many of its rows break each rule, in one pass."""
    watch = Observation(f"checks-{uuid.uuid4().hex}")
    counts = [F.count_if(F.coalesce(broken, F.lit(True))).alias(name) for name, broken in rules.items()]
    path = work_path(table.sparkSession, "checks", uuid.uuid4().hex)
    table.observe(watch, F.count(F.lit(1)).alias("__rows"), *counts).write.parquet(path)
    held = table.sparkSession.read.schema(table.schema).parquet(path)
    return held, {name: watch.get[name] for name in rules}


def _broken_rows(held: DataFrame, kind: str, rules: dict[str, Column], counts: dict[str, int]) -> DataFrame:
    """One row for each row of ``held`` and each rule that it breaks; no scan if the counts are zero.

    A rule that cannot be evaluated (NULL) counts as broken.
    """
    fired = [F.when(F.coalesce(rules[name], F.lit(True)), F.lit(name)) for name, n in counts.items() if n]
    if not fired:
        return held.sparkSession.createDataFrame([], VIOLATIONS)
    rank = F.col("rank").cast("int") if "rank" in held.columns else F.lit(None).cast("int")
    return held.select(F.lit(kind).alias("report"), "store", "product_id", rank.alias("rank"),
                       F.explode(F.array_compact(F.array(*fired))).alias("rule"))


def _group_rows(groups: DataFrame, kind: str, rule: str) -> DataFrame:
    rank = F.col("rank").cast("int") if "rank" in groups.columns else F.lit(None).cast("int")
    key = F.col("product_id") if "product_id" in groups.columns else F.lit(None).cast("string")
    return groups.select(F.lit(kind).alias("report"), "store", key.alias("product_id"), rank.alias("rank"),
                         F.lit(rule).alias("rule"))


def report_violations(report: DataFrame, kind: str, k: int = 20) -> DataFrame:
    """Rows breaking an invariant of report ``kind``; empty when the report is sound.

    Row rules: rank within 1..k, positive percentage, a previous value
    present, the sign of the change.  Group rules: the ranks of a store
    are 1..n without gap or repeat (``rank_gap``, one row a store), and no
    rank has a greater percentage than the rank before it (``rank_order``,
    one row a rank).  Both read partial aggregates by (store, rank), so a
    store of any size is combined in its map tasks.
    """
    pct, before, after, sign = _RULES[kind]
    moved = F.col(after) > F.col(before) if sign == ">" else F.col(after) < F.col(before)
    rules = {
        "rank_out_of_range": (F.col("rank") < 1) | (F.col("rank") > k),
        "non_positive_pct": ~(F.col(pct) > 0),
        "missing_before": F.col(before).isNull(),
        "wrong_direction": ~moved,
    }
    held, counts = _observed(report, rules)
    places = held.groupBy("store", "rank").agg(F.count(F.lit(1)).alias("n"), F.max(pct).alias("most"), F.min(pct).alias("least"))
    gaps = (places.groupBy("store").agg(F.sum("n").alias("n"), F.max("rank").alias("mx"), F.count("rank").alias("nd"))
            .where((F.col("mx") != F.col("n")) | (F.col("nd") != F.col("n"))))
    ahead = places.select("store", (F.col("rank") + 1).alias("rank"), F.col("least").alias("least_before"))
    disorder = places.join(ahead, ["store", "rank"]).where(F.col("most") > F.col("least_before"))
    return reduce(DataFrame.unionByName, [_broken_rows(held, kind, rules, counts), _group_rows(gaps, kind, "rank_gap"),
                                          _group_rows(disorder, kind, "rank_order")])


def change_violations(changes: DataFrame, latest) -> DataFrame:
    """Rows breaking an invariant of ``price_changes`` (its kind is ``price_changes``; it has no rank).

    Row rules: only the snapshot date ``latest``, available, both previous
    prices positive, and a change in one of the two prices.  Group rule:
    one row a (store, product_id) (``repeated_key``).
    """
    rules = {
        "not_latest_date": ~(F.col("scrape_date") == F.lit(latest)),
        "not_available": ~F.col("is_available"),
        "missing_previous": ~((F.col("prev_list_price") > 0) & (F.col("prev_price") > 0)),
        "unchanged": ~((F.col("list_price") != F.col("prev_list_price")) | (F.col("price") != F.col("prev_price"))),
    }
    held, counts = _observed(changes, rules)
    repeated = held.groupBy("store", "product_id").count().where("count > 1")
    return _broken_rows(held, "price_changes", rules, counts).unionByName(_group_rows(repeated, "price_changes", "repeated_key"))
