"""Declared-domain encodings."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .calendar import col


def one_hot(c, levels, prefix: str, drop_first: bool = False) -> list[Column]:
    """F8: dummies over a fixed level list; a value outside it gives all zeros."""
    lv = list(levels)[1:] if drop_first else list(levels)
    return [(col(c) == F.lit(v)).cast("int").alias(f"{prefix}_{str(v).replace('-', '_')}") for v in lv]


def segment_signature(county="county", is_business="is_business", product_type="product_type") -> Column:
    """``county-is_business-product_type`` with the flag as 0/1."""
    return F.concat_ws("-", col(county).cast("string"), col(is_business).cast("int").cast("string"),
                       col(product_type).cast("string"))


def segment_domain(df: DataFrame) -> DataFrame:
    """cross product of the distinct values of the three segment keys."""
    # each key has a small declared domain: gather the three value sets into one
    # row (partial aggregation, no shuffle of rows) and expand them by explode
    sets = df.agg(F.collect_set("county").alias("c"), F.collect_set("is_business").alias("b"),
                  F.collect_set("product_type").alias("p"))
    return (sets.select(F.explode("c").alias("county"), "b", "p")
            .select("county", F.explode("b").alias("is_business"), "p")
            .select("county", "is_business", F.explode("p").alias("product_type"))
            .select("county", "is_business", "product_type",
                    segment_signature().alias("signature")))


def location(lat="latitude", lon="longitude") -> Column:
    """``lat,lon`` string."""
    return F.concat_ws(",", col(lat).cast("string"), col(lon).cast("string"))
