"""Product lists: which products belong to which audience."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.functions.predicates import exclude_categories, like_any, regex_match
from hearthline.functions.timeline import weeks_back
from hearthline.operators.skew import lookup_join


def definitions_frame(spark: SparkSession, definitions: dict[str, dict]) -> DataFrame:
    """Category definitions as rows: segment, level, value, weeks."""
    rows = [(name, level, value, int(spec["weeks"]))
            for name, spec in definitions.items()
            for level, key in (("commodity", "commodities"), ("sub_commodity", "sub_commodities"))
            for value in spec.get(key, [])]
    return spark.createDataFrame(rows, "segment string, level string, value string, weeks int")


def category_members(products: DataFrame, definitions: DataFrame) -> DataFrame:
    """Products of each segment by commodity or sub-commodity, one row per pair."""
    levels = products.select("upc", F.explode(F.array(
        F.struct(F.lit("commodity").alias("level"), F.col("commodity").alias("value")),
        F.struct(F.lit("sub_commodity").alias("level"), F.col("sub_commodity").alias("value")),
    )).alias("_l")).select("upc", "_l.level", "_l.value")
    return levels.join(definitions, ["level", "value"]).select("segment", "upc", "weeks").distinct()


def sold_weeks(tx: DataFrame, end: dt.date) -> DataFrame:
    """Most recent week (counted back from ``end``) in which each product was sold."""
    return tx.groupBy("upc").agg(weeks_back(F.max("trn_date"), end).alias("week"))


def category_upc_lists(tx: DataFrame, products: DataFrame, definitions: DataFrame,
                       end: dt.date) -> DataFrame:
    """Product lists of all segments: listed, and sold in the segment's last weeks.

    A product was sold in the last ``n`` weeks exactly when its latest sale was,
    so one row per product replaces the product-week pairs.
    """
    sold = sold_weeks(tx.where(F.col("trn_date") <= F.lit(end)), end)
    members = category_members(products, definitions)
    return members.join(sold, "upc").where(F.col("week") <= F.col("weeks")).select("segment", "upc")


def segment_reach(tx: DataFrame, upc_lists: DataFrame) -> DataFrame:
    """Distinct buying households per segment."""
    return (lookup_join(tx.select("hh_id", "upc"), upc_lists, ["upc"], "hh_id")
            .groupBy("segment").agg(F.count_distinct("hh_id").alias("households")))


def regex_upc_lists(products: DataFrame, specs: dict[str, dict], fields: list[str]) -> DataFrame:
    """Product lists of all pattern specifications in one scan.

    Composite names (``composes``) come out as further segments that hold the
    union of their parts.
    """
    tags = []
    for name, spec in specs.items():
        names = sorted({name, spec.get("composes", name)})
        tags.append(F.when(regex_match(fields, spec), F.array(*[F.lit(n) for n in names])))
    tags = [F.coalesce(t, F.array().cast("array<string>")) for t in tags]
    segments = F.array_distinct(F.flatten(F.array(*tags)))
    return products.select("upc", F.explode(segments).alias("segment"))


def like_upc_list(products: DataFrame, fields: list[str], pattern: str,
                  banned: dict[str, list]) -> DataFrame:
    """Products whose text matches a pattern, without the banned categories."""
    return products.where(like_any(fields, pattern) & exclude_categories(banned)).select("upc")


def exclude_by_lookup(products: DataFrame, lookup: DataFrame, on: list[str]) -> DataFrame:
    """Drop products of restricted categories held in a table."""
    return products.join(lookup, on, "left_anti")
