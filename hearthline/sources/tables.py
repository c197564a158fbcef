"""Table scans, the scanned-item view, snapshots and partition ranges."""

from __future__ import annotations

import datetime as dt
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthline.operators.skew import lookup_join


def read_table(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan reduced to the named columns."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal rows out over all cores when a scan has fewer splits than there are cores.

    Meant for small inputs in few files ahead of work that is heavy per row. A
    large table has more splits than cores and passes through unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def net_cents() -> Column:
    """Net spend as whole cents, so that sums do not depend on row order."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return F.round(net * 100).cast("long")


LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                "l_returnflag"]


def transactions(spark: SparkSession, folder: str, start: dt.date | None = None,
                 end: dt.date | None = None, stores: bool = False) -> DataFrame:
    """Scanned items between two dates, one row per item.

    The date bounds are literals on ``orders`` and reach its scan. The store
    dimension is joined only when asked for.
    """
    baskets = read_table(spark, folder, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    if start is not None:
        baskets = baskets.where(F.col("o_orderdate") >= F.lit(dt.datetime.combine(start, dt.time())))
    if end is not None:
        after = dt.datetime.combine(end + dt.timedelta(days=1), dt.time())
        baskets = baskets.where(F.col("o_orderdate") < F.lit(after))
    items = read_table(spark, folder, "lineitem", LINE_COLUMNS).join(
        baskets, F.col("l_orderkey") == F.col("o_orderkey"))
    columns = [
        F.col("o_custkey").alias("hh_id"), F.col("l_partkey").alias("upc"),
        F.col("l_orderkey").alias("basket_id"), F.to_date("o_orderdate").alias("trn_date"),
        F.col("l_quantity").cast("long").alias("units"), net_cents().alias("net_cents"),
        (F.col("l_returnflag") == "R").alias("is_return"), F.col("l_suppkey").alias("store_id"),
    ]
    if stores:
        dimension = read_table(spark, folder, "supplier", ["s_suppkey", "s_nationkey"])
        items = items.join(dimension, F.col("l_suppkey") == F.col("s_suppkey"))
        columns.append(F.col("s_nationkey").alias("div_no"))
    return items.select(*columns)


def date_bounds(spark: SparkSession, folder: str) -> tuple[dt.date, dt.date]:
    """First and last basket date: two scalars from one column."""
    row = read_table(spark, folder, "orders", ["o_orderdate"]).agg(
        F.to_date(F.min("o_orderdate")), F.to_date(F.max("o_orderdate"))).first()
    return row[0], row[1]


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Flat product hierarchy: department, commodity, sub-commodity, name."""
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("upc"), F.col("p_type").alias("department"),
        F.col("p_brand").alias("commodity"),
        F.concat_ws("|", "p_brand", F.col("p_size").cast("string")).alias("sub_commodity"),
        F.col("p_name").alias("product_name"), F.col("p_size").alias("size"),
        F.round(F.col("p_retailprice") * 100).cast("long").alias("price_cents"),
    )


def with_products(tx: DataFrame, hierarchy: DataFrame, columns: list[str]) -> DataFrame:
    """Items with columns of their product; the hierarchy is a scan, one row per product."""
    return lookup_join(tx, hierarchy.select("upc", *columns), ["upc"], "basket_id", computed=False)


def store_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Store, division and a position derived from the store number."""
    return read_table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("store_id"), F.col("s_nationkey").alias("div_no"),
        (F.lit(25) + (F.col("s_suppkey") * 7919 % 2500) / 100.0).alias("lat"),
        (F.lit(-125) + (F.col("s_suppkey") * 104729 % 5800) / 100.0).alias("lon"),
    )


def exclude(tx: DataFrame, households: DataFrame | None = None,
            items: DataFrame | None = None) -> DataFrame:
    """Apply exclusion tables: households and products that must not be counted."""
    if households is not None:
        tx = tx.join(households, "hh_id", "left_anti")
    if items is not None:
        tx = lookup_join(tx, items.distinct(), ["upc"], "basket_id", "left_anti")
    return tx


def sift(df: DataFrame, keys: DataFrame, on: list[str], method: str, spread: str | None = None) -> DataFrame:
    """Keep (``include``) or drop (``exclude``) the rows whose key is listed, each once however often it is.

    With ``spread``, a column to spread them by, rows of a very frequent key are not brought together.
    """
    modes = {"include": "left_semi", "exclude": "left_anti"}
    if method not in modes:
        raise ValueError(f"method must be one of {sorted(modes)}")
    if spread is not None:
        return lookup_join(df, keys.select(*on).distinct(), on, spread, modes[method])
    return df.join(keys, on, modes[method])


def kpi_aggregate(tx: DataFrame, keys: list[str], product_list: DataFrame | None = None,
                  mode: str = "group") -> DataFrame:
    """Sales, visits and units by arbitrary keys, optionally for one product list.

    ``mode`` is ``group``, ``rollup`` or ``cube``. Items are first summed per
    basket, which needs no distinct step and shrinks a heavy key before it moves.
    For the coarser sets of keys one row of each basket and set is marked while the
    rows lie together by basket, so that visits add up like sales and no row moves
    once per set.
    """
    if product_list is not None:
        tx = lookup_join(tx, product_list.select("upc"), ["upc"], "basket_id", "left_semi")
    per_basket = tx.groupBy(*keys, "basket_id").agg(
        F.sum("net_cents").alias("net_cents"), F.sum("units").alias("units"))
    grouped = {"group": DataFrame.groupBy, "rollup": DataFrame.rollup, "cube": DataFrame.cube}
    if mode not in grouped:
        raise ValueError(f"mode must be one of {sorted(grouped)}")
    coarser = {"group": [], "rollup": [keys[:n] for n in range(len(keys))],
               "cube": [list(c) for n in range(len(keys)) for c in combinations(keys, n)]}
    visits = F.count(F.lit(1) if mode == "group" else F.col("basket_id"))
    for n, kept in enumerate(coarser[mode]):
        rest = [k for k in keys if k not in kept]
        first = F.row_number().over(Window.partitionBy("basket_id", *kept).orderBy(*rest)) == 1
        per_basket = per_basket.withColumn(f"_visit_{n}", F.when(first, F.col("basket_id")))
        # The bits of grouping_id() are the keys left out, the last key at the lowest bit.
        left_out = sum(2 ** i for i, k in enumerate(reversed(keys)) if k in rest)
        visits = F.when(F.grouping_id() == left_out, F.count(f"_visit_{n}")).otherwise(visits)
    return grouped[mode](per_basket, *keys).agg(
        F.sum("net_cents").alias("sales_cents"), visits.alias("visits"), F.sum("units").alias("units"))


def latest_snapshot(df: DataFrame, column: str, n: int = 1) -> DataFrame:
    """Rows of the n-th latest snapshot.

    The snapshot values are read first and the chosen one becomes a literal, so a
    dataset partitioned by ``column`` is pruned to one partition.
    """
    values = df.select(column).distinct().orderBy(F.desc(column)).limit(n).collect()
    if len(values) < n:
        return df.where(F.lit(False))
    return df.where(F.col(column) == F.lit(values[n - 1][0]))


def as_of_snapshot(df: DataFrame, column: str, as_of) -> DataFrame:
    """Rows of the newest snapshot that is not later than ``as_of``."""
    newest = df.where(F.col(column) <= F.lit(as_of)).agg(F.max(column)).first()[0]
    return df.where(F.lit(False)) if newest is None else df.where(F.col(column) == F.lit(newest))


def as_of_rows(df: DataFrame, key: str, order: list[str], values: list[str], as_of_column: str,
               as_of) -> DataFrame:
    """Newest values per key that are not later than ``as_of``."""
    picked = F.max_by(F.struct(*values), F.struct(*order)).alias("_v")
    return (df.where(F.col(as_of_column) <= F.lit(as_of)).groupBy(key).agg(picked)
            .select(key, *[F.col(f"_v.{v}").alias(v) for v in values]))


def read_partitions(spark: SparkSession, path: str, column: str, start=None, end=None,
                    values: list | None = None, merge_schema: bool = False) -> DataFrame:
    """All partitions, a range of them, or a list; others are never opened."""
    df = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end))
    if values is not None:
        df = df.where(F.col(column).isin(list(values)))
    return df


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = "|") -> DataFrame:
    """Delimited text with a header; the schema is given, not inferred."""
    return spark.read.csv(path, schema=schema, header=True, sep=sep)
