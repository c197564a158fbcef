"""Reports on products, audiences and their eligibility."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthline.functions.predicates import any_flag
from hearthline.operators.skew import lookup_join
from hearthline.operators.text import joined_by_group, sample_per_group, top_words


def duplicate_report(df: DataFrame, key: str) -> DataFrame:
    """One row: all rows, distinct rows, distinct keys, keys with several payloads."""
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    keys = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_payloads"), F.sum("_copies").alias("_rows"))
    return keys.agg(
        F.sum("_rows").alias("total_rows"), F.sum("_payloads").alias("distinct_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.sum(F.when(F.col("_payloads") > 1, 1).otherwise(0)).alias("conflicting_keys"))


def null_pattern(df: DataFrame, columns: list[str]) -> DataFrame:
    """How often each combination of missing columns occurs."""
    return df.groupBy(*[F.col(c).isNull().alias(f"{c}_null") for c in columns]).agg(
        F.count(F.lit(1)).alias("rows"))


def threshold_counts(df: DataFrame, column: str, thresholds: list[int]) -> DataFrame:
    """One row: how many values exceed each threshold."""
    return df.agg(*[F.sum(F.when(F.col(column) > t, 1).otherwise(0)).alias(f"num_over_{t}")
                    for t in thresholds])


def histogram_bins(df: DataFrame, column: str, low: int, high: int, bins: int) -> DataFrame:
    """Rows per equal-width bin; values outside the range fall into bin 0 or bins + 1."""
    bucket = F.expr(f"width_bucket({column}, {float(low)}, {float(high)}, {bins})")
    return df.groupBy(bucket.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("rows"))


def product_popularity(tx: DataFrame) -> DataFrame:
    """Item rows, rows with a household, and distinct households per product."""
    per_household = tx.groupBy("upc", "hh_id").agg(F.count(F.lit(1)).alias("_rows"))
    return per_household.groupBy("upc").agg(
        F.sum("_rows").alias("item_rows"),
        F.sum(F.when(F.col("hh_id").isNotNull(), F.col("_rows")).otherwise(0)).alias("household_rows"),
        F.count("hh_id").alias("households"))


def proportion_matching(df: DataFrame, category: str, flag: str) -> DataFrame:
    """Flagged rows, all rows and their ratio per category."""
    matches = F.sum(F.col(flag).cast("int"))
    return df.groupBy(category).agg(
        F.coalesce(matches, F.lit(0)).alias("num_matches"), F.count(F.lit(1)).alias("total_num")
    ).withColumn("prop_match", F.round(F.col("num_matches") / F.col("total_num"), 6))


def top_products(upc_lists: DataFrame, popularity: DataFrame, valid: DataFrame, n: int = 10) -> DataFrame:
    """Most bought products of each audience that are in a valid list."""
    ranked = Window.partitionBy("segment").orderBy(F.desc("item_rows"), "upc")
    return (upc_lists.join(popularity, "upc").join(valid, "upc", "left_semi")
            .withColumn("position", F.row_number().over(ranked)).where(F.col("position") <= n)
            .select("segment", "upc", "item_rows", "position"))


def segment_eligibility(audience: DataFrame, flags: DataFrame, registered: DataFrame,
                        onsite: list[str], offsite: list[str], overall: list[str]) -> DataFrame:
    """Households per segment and period: total, onsite, offsite and overall eligible.

    Only labels used in production count. Households without flags are not
    eligible anywhere.
    """
    production = registered.select(
        F.col("audience").alias("segment"), "frontend_name", "type",
        F.explode("propensities").alias("propensity"))
    eligible = flags.select("hh_id", any_flag(onsite).cast("int").alias("_on"),
                            any_flag(offsite).cast("int").alias("_off"),
                            any_flag(overall).cast("int").alias("_any"))
    labelled = lookup_join(audience, production, ["segment", "propensity"], "hh_id")
    return (labelled.join(eligible, "hh_id", "left")
            .groupBy("segment", "period")
            .agg(F.count("hh_id").alias("total_households"),
                 F.max("frontend_name").alias("frontend_name"), F.max("type").alias("type"),
                 F.coalesce(F.sum("_on"), F.lit(0)).alias("onsite_households"),
                 F.coalesce(F.sum("_off"), F.lit(0)).alias("offsite_households"),
                 F.coalesce(F.sum("_any"), F.lit(0)).alias("overall_households")))


def hierarchy_report(tx: DataFrame, products: DataFrame, flags: DataFrame, levels: list[str],
                     onsite: list[str], offsite: list[str], words: int = 100,
                     samples: int = 30) -> DataFrame:
    """Reach, eligible reach, top words and a product sample for each hierarchy node."""
    eligible = flags.select("hh_id", any_flag(onsite).alias("_on"), any_flag(offsite).alias("_off"))
    buyers = (lookup_join(tx.select("hh_id", "upc"), products.select("upc", *levels), ["upc"], "hh_id",
                          computed=False)
              .select("hh_id", *levels).distinct().join(eligible, "hh_id", "left"))
    reach = buyers.groupBy(*levels).agg(
        F.count("hh_id").alias("households"),
        F.sum(F.when(F.col("_on"), 1).otherwise(0)).alias("onsite_households"),
        F.sum(F.when(F.col("_off"), 1).otherwise(0)).alias("offsite_households"))
    text = top_words(products, levels, "product_name", words).withColumnRenamed("words", "top_words")
    sample = joined_by_group(
        sample_per_group(products, levels, "upc", samples), levels, "position", "product_name",
        "product_sample")
    return reach.join(text, levels).join(sample, levels)


def segment_describe(upc_lists: DataFrame, products: DataFrame, columns: list[str], words: int = 100,
                     samples: int = 30) -> DataFrame:
    """Top words and sample texts of every audience, for each text column."""
    reports = []
    listed = upc_lists.join(products, "upc")
    for column in columns:
        texts = listed.where(F.col(column).isNotNull() & (F.col(column) != "")).select(
            "segment", "upc", column)
        report = top_words(texts, ["segment"], column, words).withColumnRenamed("words", "top_words")
        sample = joined_by_group(sample_per_group(texts, ["segment"], "upc", samples), ["segment"],
                                 "position", column, "samples")
        reports.append(report.join(sample, "segment").withColumn("source", F.lit(column)))
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


def reconcile(audience_sizes: DataFrame, upc_lists: DataFrame, tx: DataFrame) -> DataFrame:
    """Audience size against what its products show in the transactions.

    ``summed_households`` adds the buyers of each product, so a household counts
    once per product; ``distinct_households`` counts it once.
    """
    bought = tx.groupBy("upc", "hh_id").agg(F.count(F.lit(1)).alias("_rows"))
    per_pair = (lookup_join(bought, upc_lists, ["upc"], "hh_id")
                .groupBy("segment", "hh_id").agg(F.sum("_rows").alias("_rows"),
                                                 F.count(F.lit(1)).alias("_products")))
    found = per_pair.groupBy("segment").agg(
        F.sum("_rows").alias("item_rows"), F.sum("_products").alias("summed_households"),
        F.count("hh_id").alias("distinct_households"))
    return (audience_sizes.join(found, "segment", "left").fillna(0)
            .withColumn("difference", F.col("households") - F.col("distinct_households")))


def cycle_household_counts(tx: DataFrame, versions: DataFrame, category: str) -> DataFrame:
    """Distinct households per category, each sale classified by the dimension valid then.

    ``versions`` has upc, the category, ``valid_from`` and ``valid_to``
    (exclusive; null for the current version).
    """
    valid = (F.col("trn_date") >= F.col("valid_from")) & (
        F.col("valid_to").isNull() | (F.col("trn_date") < F.col("valid_to")))
    daily = tx.select("upc", "hh_id", "trn_date").distinct()
    return (lookup_join(daily, versions, ["upc"], "hh_id", computed=False).where(valid).groupBy(category)
            .agg(F.count_distinct("hh_id").alias("households")))
