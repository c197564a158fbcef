"""Nested product hierarchy and row deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten_hierarchy(df: DataFrame, key: str, leaves: dict[str, str]) -> DataFrame:
    """Flat columns from a nested hierarchy, one row per key.

    ``leaves`` maps an output name to the path of a nested field; only these are
    read from a columnar file. A missing level gives a null and keeps the product.
    Of several rows of a key the one with the highest values counts.
    """
    flat = df.select(key, *[F.col(path).alias(name) for name, path in leaves.items()])
    return dedupe(flat, [key], [F.col(name) for name in leaves])


def nest_hierarchy(products: DataFrame) -> DataFrame:
    """The given flat products in the nested shape of a product master."""
    top = F.struct(F.lit("ALL").alias("name"))
    recap = F.struct(F.lit("STORE").alias("name"), top.alias("department"))
    primary = F.struct(F.col("department").alias("name"), recap.alias("recapDepartment"))
    tree = F.struct(F.struct(F.col("commodity").alias("name")).alias("commodity"),
                    F.struct(F.col("sub_commodity").alias("name")).alias("subCommodity"),
                    primary.alias("primaryDepartment"))
    return products.select("upc", "product_name", tree.alias("familyTree"),
                           F.struct("size", "price_cents").alias("facts"))


def dedupe(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the one with the highest order.

    A maximum instead of a numbered window: the choice is made before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_b")
    return df.groupBy(*keys).agg(best).select(*keys, "_b.*")
