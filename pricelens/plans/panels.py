"""Products panels derived (by Spark) from the benchmark tables.

Panel A (``events``): real daily observations.  A product is a user, a
store is an event type, a snapshot is a calendar day; the sale price is
the value of the day's last event, the list price the day's largest value.

Panel B (``part`` x supplying regions x 6 weekly snapshots): full weekly
snapshots with deterministic price moves.  A part is sold in the regions
of the suppliers that ship it (``lineitem`` -> ``supplier`` -> ``nation``
-> ``region``), so the panel is an equi-join of the given tables and its
size grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Fixed values of panel B: first snapshot date, number of weekly snapshots.
PANEL_B_START = "2026-01-06"
PANEL_B_WEEKS = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def panel_a(spark: SparkSession, sf_dir: str, pick: str = "last") -> DataFrame:
    """Daily panel from ``events`` (one row per user, event type and day).

    ``pick="first"`` takes the day's first event as the sale price: the
    morning snapshot that a later same-day scrape replaces.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    daily = (ev.withColumn("scrape_date", F.col("ts").cast("date"))
             .groupBy("user_id", "event_type", "scrape_date")
             .agg((F.max_by if pick == "last" else F.min_by)(
                      "value", F.struct("ts", "event_id")).alias("price"),
                  F.max("value").alias("list_price")))
    pid = F.col("user_id").cast("string")
    return daily.select(
        pid.alias("product_id"),
        F.col("event_type").alias("store"),
        "scrape_date",
        F.concat(F.lit("product "), pid).alias("name"),
        F.concat(F.lit("brand-"), (F.col("user_id") % 7).cast("string")).alias("brand"),
        F.col("event_type").alias("maincat"),
        F.lit(None).cast("string").alias("cat"),
        F.lit(None).cast("string").alias("subcat"),
        F.lit(None).cast("string").alias("catid"),
        F.concat(F.lit("https://img.example.com/"), pid, F.lit(".jpg")).alias("image"),
        "price",
        F.col("list_price").alias("pricewithoutdiscount"),
        "list_price",
        (F.col("user_id") % 10 != 0).alias("is_available"),
        F.concat(F.lit("https://shop.example.com/"), F.col("event_type"), F.lit("/"), pid).alias("link"),
        F.col("event_type").alias("maincatid"),
    )


def supplying_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (partkey, regionkey, region name) of parts shipped by each region's suppliers."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    reg = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    pairs = (li.join(sup, li.l_suppkey == sup.s_suppkey)
             .join(nat, F.col("s_nationkey") == nat.n_nationkey)
             .select(F.col("l_partkey").alias("p_partkey"), F.col("n_regionkey").alias("r_regionkey"))
             .distinct())
    return pairs.join(reg, "r_regionkey")


def panel_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly full-snapshot panel: part x supplying region x PANEL_B_WEEKS weeks."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type",
                                               "p_size", "p_retailprice")
    base = (supplying_regions(spark, sf_dir).join(part, "p_partkey")
            .withColumn("week", F.explode(F.sequence(F.lit(0), F.lit(PANEL_B_WEEKS - 1)))))
    k, r, w = F.col("p_partkey"), F.col("r_regionkey"), F.col("week")
    list_price = F.floor(F.col("p_retailprice") * (100 + ((k * 7 + r * 11 + w * 13) % 21) - 10) + 0.5) / 100
    priced = base.withColumn("list_price", list_price).withColumn(
        "price", F.floor(F.col("list_price") * (100 - ((k * 5 + r * 17 + w * 19) % 23)) + 0.5) / 100)
    pid = k.cast("string")
    store = F.lower(F.col("r_name"))
    return priced.select(
        pid.alias("product_id"),
        store.alias("store"),
        F.date_add(F.lit(PANEL_B_START).cast("date"), w * 7).alias("scrape_date"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("maincat"),
        F.col("p_brand").alias("cat"),
        F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("subcat"),
        F.concat(F.lit("/"), F.lower(F.col("p_type")), F.lit("/"), F.col("p_size").cast("string"),
                 F.lit("/")).alias("catid"),
        F.concat(F.lit("https://img.example.com/p/"), pid, F.lit(".jpg")).alias("image"),
        "price",
        F.col("list_price").alias("pricewithoutdiscount"),
        "list_price",
        ((k + r * 3 + w) % 17 != 0).alias("is_available"),
        F.concat(F.lit("https://shop.example.com/"), F.replace(store, F.lit(" "), F.lit("-")),
                 F.lit("/p/"), pid).alias("link"),
        F.lower(F.col("p_type")).alias("maincatid"),
    )
