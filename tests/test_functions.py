"""Column helpers and the normaliser registry."""

import json

from pyspark.sql import functions as F

from pricelens.functions import (
    exact_avg, first_segment, format_money, format_pct, last_segment, lenient_bool, pct_change, round2,
    safe_get, slug_to_name, url_path,
)
from pricelens.sources import normalise as N


def test_column_helpers(spark):
    df = spark.createDataFrame([("/a/b/c/", "https://x.example/en/12?q=1", "vinos-y-licores", "TRUE", 2.345)],
                               "p string, u string, slug string, flag string, x double")
    r = df.select(first_segment("p").alias("f"), last_segment("p").alias("l"), url_path("u").alias("up"),
                  slug_to_name("slug").alias("n"), lenient_bool("flag").alias("b"),
                  round2("x").alias("r"), format_pct("x").alias("fp"), format_money("x").alias("fm"),
                  safe_get(F.array(F.lit(1)), 3).alias("g"),
                  pct_change(F.lit(3.0), F.lit(0.0)).alias("pz")).collect()[0]
    assert (r.f, r.l, r.up, r.n, r.b) == ("a", "c", "/en/12", "Vinos Y Licores", True)
    assert (r.r, r.fp, r.fm, r.g, r.pz) == (2.35, "2.3", "2.35", None, None)


def test_exact_avg_is_order_independent(spark):
    vals = [0.1, 0.2, 0.3, 19.99, 5.05, None]
    a = spark.createDataFrame([(v,) for v in vals], "x double").agg(exact_avg("x").alias("a")).first().a
    b = spark.createDataFrame([(v,) for v in reversed(vals)], "x double").repartition(3) \
        .agg(exact_avg("x").alias("a")).first().a
    assert a == b == sum(round(v * 10000) for v in vals if v is not None) / 10000 / 5


def test_register_new_format(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("sku", T.StringType()), T.StructField("cents", T.LongType())])
    N.register("flat_c", schema, lambda docs, store, **kw: docs.select(
        F.col("doc.sku").alias("product_id"), F.lit(store).alias("store"),
        (F.col("doc.cents") / 100).alias("price")))
    df = spark.createDataFrame([(json.dumps({"sku": "s1", "cents": 250}),)], "json string")
    r = N.normalise(df, "flat_c", "sc", json_col="json").collect()[0]
    assert (r.product_id, r.store, r.price) == ("s1", "sc", 2.5)
    del N.NORMALISERS["flat_c"]
