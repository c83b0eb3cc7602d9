"""Joins on keys of which one may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64


def spread_join(rows: DataFrame, keyed: DataFrame, key: str, by: Column, salts: int = SALTS) -> DataFrame:
    """Left join of ``rows`` to ``keyed`` (at most one row a key) without gathering a hot key.

    ``keyed`` first meets the distinct (key, salt) pairs, at most ``salts`` a key and combined before
    they are shuffled; the rows then join on (key, salt), so a key's rows lie in ``salts`` tasks.
    ``by`` gives each row's salt; rows without a key match nothing.
    """
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    pairs = salted.select(key, "__salt").distinct()
    found = pairs.join(keyed, key)
    return salted.join(found, [key, "__salt"], "left").drop("__salt")
