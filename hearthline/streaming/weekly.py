"""Weekly increment of household vintages and sales, safe to run again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearthline.functions import timeline
from hearthline.functions.calendar import Calendar
from hearthline.operators.behavior import daily_kpis, household_vintage, weekly_kpis
from hearthline.session import cut_lineage, exists
from hearthline.sources.sinks import replace_partition
from hearthline.sources.tables import read_partitions


def update_vintage(spark: SparkSession, daily: DataFrame, weekly: DataFrame, week: str,
                   vintage_path: str, sales_path: str, calendar: Calendar | None = None) -> None:
    """Add one fiscal week to the vintage and sales datasets.

    ``daily`` and ``weekly`` are the KPIs of that week. Known households are the
    vintages of earlier weeks, so replaying a week replaces its two partitions
    with the same rows. A household that a replay finds earlier than before loses
    its later vintage, and its later sales take the new one.
    """
    seen = household_vintage(daily) if calendar is None else household_vintage(daily, calendar)
    if exists(spark, vintage_path):
        stored = read_partitions(spark, vintage_path, "vintage_week").withColumn(
            "vintage_week", F.col("vintage_week").cast("string"))
    else:
        stored = spark.createDataFrame([], seen.schema)
    known = stored.where(F.col("vintage_week") < week)
    first_seen = cut_lineage(seen.join(known.select("hh_id"), "hh_id", "left_anti"))
    moved = cut_lineage(stored.where(F.col("vintage_week") > week).join(first_seen.select("hh_id"), "hh_id", "left_semi"))
    for later in [r[0] for r in moved.select("vintage_week").distinct().collect()]:
        kept = stored.where(F.col("vintage_week") == later).join(moved.select("hh_id"), "hh_id", "left_anti")
        replace_partition(kept, vintage_path, {"vintage_week": later})
    replace_partition(first_seen, vintage_path, {"vintage_week": week})
    replace_partition(weekly.join(known.unionByName(first_seen), "hh_id"), sales_path, {"fiscal_week": week})
    if not moved.isEmpty():
        _carry_vintage(spark, first_seen.join(moved.select("hh_id"), "hh_id", "left_semi"), week, sales_path)


def _carry_vintage(spark: SparkSession, vintages: DataFrame, week: str, sales_path: str) -> None:
    """Give the later sales of these households their new vintage; other rows stay."""
    sales = read_partitions(spark, sales_path, "fiscal_week").withColumn(
        "fiscal_week", F.col("fiscal_week").cast("string")).where(F.col("fiscal_week") > week)
    changed = [c for c in vintages.columns if c != "hh_id"]
    weeks = sales.join(vintages.select("hh_id"), "hh_id", "left_semi").select("fiscal_week").distinct().collect()
    for later in [r[0] for r in weeks]:
        own = sales.where(F.col("fiscal_week") == later)
        new = own.drop(*changed).join(vintages, "hh_id").select(*own.columns)
        kept = own.join(vintages.select("hh_id"), "hh_id", "left_anti")
        replace_partition(kept.unionByName(new), sales_path, {"fiscal_week": later})


def run_arrivals(spark: SparkSession, inbox: str, schema: StructType | str, checkpoint: str, vintage_path: str,
                 sales_path: str, product_list: DataFrame | None = None, calendar: Calendar | None = None) -> None:
    """Bring both datasets up to date with the files that have arrived since the last run, then end.

    ``inbox`` holds parquet files of item rows in the shape of
    :func:`hearthline.sources.tables.transactions`; a file is never changed once it is there. A
    stream notes in ``checkpoint`` which files it has seen. For each week that a new file touches,
    oldest first, the week's KPIs are computed again from all files, and
    :func:`update_vintage` replaces its partitions. A run that dies anywhere repeats its
    files in the next run, which gives the same tables. Only the weeks of new files pass the driver.
    """
    dates = calendar or timeline

    def step(batch: DataFrame, number: int) -> None:
        week_of = calendar.week_of if calendar is not None else timeline.date_week
        days = [r[0] for r in batch.select("trn_date").where("trn_date is not null").distinct().collect()]
        items = spark.read.schema(schema).parquet(inbox)
        for week in sorted({week_of(d) for d in days}):
            first, last = dates.week_dates(week)
            own = cut_lineage(items.where(F.col("trn_date").between(F.lit(first), F.lit(last))))
            daily, weekly = daily_kpis(own, product_list), weekly_kpis(own, product_list, calendar)
            update_vintage(spark, daily, weekly, week, vintage_path, sales_path, calendar)

    (spark.readStream.schema(schema).parquet(inbox).writeStream.foreachBatch(step)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def pending_periods(facts: DataFrame, receipts: DataFrame, period: str) -> DataFrame:
    """Periods that have facts but no receipt yet."""
    return facts.select(period).distinct().join(receipts.select(period).distinct(), period, "left_anti")
