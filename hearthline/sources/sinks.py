"""Dataset writers: per run, per partition, and single small exports."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.session import cut_lineage, delete, discard, exists


def write_dataset(df: DataFrame, root: str, name: str, run_date: str) -> str:
    """Overwrite the dataset of one audience and run date; returns its path."""
    path = f"{root}/{name}/{name}_{run_date}"
    df.write.mode("overwrite").parquet(path)
    return path


def replace_partitions(df: DataFrame, path: str, columns: list[str]) -> None:
    """Replace only the partitions present in ``df``; others stay untouched.

    The rebalance gathers each partition's rows, so it gets few files, and splits
    a partition that is too large for one task.
    """
    (df.hint("rebalance", *[F.col(c) for c in columns]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path))


def replace_partition(df: DataFrame, path: str, values: dict[str, str]) -> None:
    """Replace one named partition, also by no rows at all.

    Spark names the folder. A dynamic overwrite only touches partitions that receive
    a row; for a run without rows the partition's files are looked up and deleted.
    """
    spark = df.sparkSession
    rows = cut_lineage(df.drop(*values).withColumns({c: F.lit(str(v)) for c, v in values.items()}))
    if not rows.isEmpty():
        replace_partitions(rows, path, list(values))
    elif exists(spark, path):
        kinds = T.StructType([T.StructField(c, T.StringType()) for c in values])
        old = spark.read.schema(kinds).parquet(path)
        for column, value in values.items():
            old = old.where(F.col(column) == str(value))
        for row in old.select("_metadata.file_path").distinct().collect():
            delete(spark, unquote(row["file_path"]))
    discard(rows)


def write_run(df: DataFrame, path: str, mode: str, modality: str, end_week: str, run_week: str,
              columns: list[str]) -> None:
    """Store one run's rows with its constant columns, in a fixed column order.

    ``overwrite`` replaces the (modality, run week) partition, ``append`` adds.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be append or overwrite")
    rows = df.withColumns({"modality": F.lit(modality), "end_week": F.lit(end_week),
                           "run_week": F.lit(run_week)}).select(*columns)
    if mode == "overwrite":
        replace_partition(rows, path, {"modality": modality, "run_week": run_week})
    else:
        rows.write.mode("append").partitionBy("modality", "run_week").parquet(path)


def append_period(df: DataFrame, path: str, period: str = "period") -> None:
    """Append the facts of new periods, one partition each."""
    df.write.mode("append").partitionBy(period).parquet(path)


def export_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """One delimited file with a header, for results a person will open.

    The rows pass through a single task: use it on counts and reports only.
    """
    df.repartition(1).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
