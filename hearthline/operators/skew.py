"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.session import cut_lineage

ROWS_PER_TASK = 1_000_000
BROADCAST_ROWS = 1_000_000
COPIES = 32


def lookup_join(facts: DataFrame, lookup: DataFrame, on: list[str], spread: str, how: str = "inner",
                computed: bool = True, max_rows: int = BROADCAST_ROWS, copies: int = COPIES) -> DataFrame:
    """Join items to a list or dimension without shuffling the items by its key.

    The lookup is counted first. Up to ``max_rows`` narrow rows it is broadcast;
    beyond that it is copied under ``copies`` salts and the facts are spread over
    them by the hash of ``spread``, so one very popular key is met by many tasks.
    The copies are merged: Spark takes them for no larger than the lookup itself and
    would send them all through the driver. A ``computed`` lookup is written once
    before it is counted; a plain scan is counted where it lies.
    """
    stored = cut_lineage(lookup) if computed else lookup
    if stored.count() <= max_rows:
        return facts.join(F.broadcast(stored), on, how)
    salts = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(copies)).cast("int"))
    copied = stored.withColumn("_salt", salts).hint("merge")
    return salted.join(copied, [*on, "_salt"], how).drop("_salt")


def salted_lookup(facts: DataFrame, lookup: DataFrame, keys: list[str], spread: str,
                  weight: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Inner join of facts to a lookup that knows how many facts each key has.

    Keys with more than ``rows_per_task`` facts are split into that many salted
    copies. At most ``facts / rows_per_task`` keys can be that heavy, so the list
    of heavy keys is small by construction and is the only thing broadcast.
    """
    copies = F.ceil(F.col(weight) / F.lit(rows_per_task)).cast("int")
    heavy = lookup.where(F.col(weight) > rows_per_task).select(*keys, copies.alias("_copies"))
    salted_facts = (
        facts.join(F.broadcast(heavy), keys, "left")
        .withColumn("_salt", F.when(F.col("_copies").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(spread), F.col("_copies")).cast("int")))
        .drop("_copies")
    )
    salted_lookup_rows = (
        lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1))).drop(weight)
    )
    return salted_facts.join(salted_lookup_rows, [*keys, "_salt"]).drop("_salt")
