"""Helpers for nested (struct / array) payload columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_get(arr, i: int) -> Column:
    """Array element or NULL when the array is NULL or too short."""
    c = F.col(arr) if isinstance(arr, str) else arr
    return F.get(c, i)


def fold_prices(prices) -> Column:
    """Ordered fold over price entries -> struct(price, pricewithoutdiscount, list_price).

    A ``PRICE`` entry sets all three; an ``OFFER_PRICE`` entry sets only
    ``price``.  Order matters: a later ``PRICE`` resets an earlier offer.
    Runs as a higher-order function inside codegen, no Python.
    """
    c = F.col(prices) if isinstance(prices, str) else prices
    init = F.struct(F.lit(None).cast("double").alias("price"),
                    F.lit(None).cast("double").alias("pricewithoutdiscount"),
                    F.lit(None).cast("double").alias("list_price"))

    def step(acc, p):
        amount = p["value"]["centUnitAmount"]
        return (F.when(p["id"] == "PRICE",
                       F.struct(amount.alias("price"), amount.alias("pricewithoutdiscount"),
                                amount.alias("list_price")))
                .when(p["id"] == "OFFER_PRICE",
                      F.struct(amount.alias("price"),
                               acc["pricewithoutdiscount"].alias("pricewithoutdiscount"),
                               acc["list_price"].alias("list_price")))
                .otherwise(acc))

    return F.aggregate(F.coalesce(c, F.array().cast("array<struct<id:string,value:struct<centUnitAmount:double>>>")),
                       init, step)
