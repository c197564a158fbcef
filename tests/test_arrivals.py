import datetime as dt

import pytest
from pyspark.sql import functions as F

from hearthline.functions import timeline as C
from hearthline.operators import behavior as B
from hearthline.streaming import weekly as W

TX = "hh_id long, upc long, basket_id long, trn_date date, units long, net_cents long, is_return boolean, store_id long, div_no int"


def rows(spark, items):
    """Rows of (household, product, day number)."""
    return spark.createDataFrame([(h, u, 100 * h + d, C.ANCHOR + dt.timedelta(days=d), 1, 50 * u, False, 1, h % 3)
                                  for h, u, d in items], TX)


FILES = [[(1, 1, 0), (2, 1, 3), (1, 2, 8)], [(3, 1, 9), (2, 2, 20)], [(3, 1, 2), (4, 1, 21), (4, 9, 0)]]


def tables(spark, folder):
    vintage = spark.read.parquet(f"{folder}/vintage").select("hh_id", F.col("vintage_week").cast("string"), "vintage_div")
    sales = spark.read.parquet(f"{folder}/sales").select(
        "hh_id", F.col("fiscal_week").cast("string"), "weekly_sales", F.col("vintage_week").cast("string"))
    return {tuple(r) for r in vintage.collect()}, sorted(tuple(r) for r in sales.collect())


def expected(spark, files, listed):
    tx = rows(spark, [i for f in files for i in f])
    vintage = B.household_vintage(B.daily_kpis(tx, listed)).select("hh_id", "vintage_week", "vintage_div")
    weekly = B.weekly_kpis(tx, listed).join(vintage, "hh_id").select("hh_id", "fiscal_week", "weekly_sales", "vintage_week")
    return {tuple(r) for r in vintage.collect()}, sorted(tuple(r) for r in weekly.collect())


@pytest.mark.parametrize("dies_at", [None, 1, 2, 4])
def test_arriving_files(spark, tmp_path, monkeypatch, dies_at):
    """Each run takes the new files; one that dies between two writes is made good by the next."""
    folder = str(tmp_path)
    listed = spark.createDataFrame([(1,), (2,)], "upc long")
    run = lambda: W.run_arrivals(spark, f"{folder}/inbox", TX, f"{folder}/seen", f"{folder}/vintage", f"{folder}/sales", listed)
    for k, items in enumerate(FILES):
        rows(spark, items).coalesce(1).write.mode("append").parquet(f"{folder}/inbox")
        if k == 1 and dies_at is not None:
            write, count = W.replace_partition, [0]

            def dying(*args):
                count[0] += 1
                if count[0] == dies_at:
                    raise RuntimeError("gone")
                return write(*args)
            monkeypatch.setattr(W, "replace_partition", dying)
            with pytest.raises(Exception, match="gone"):
                run()
            monkeypatch.undo()
        run()
        assert tables(spark, folder) == expected(spark, FILES[:k + 1], listed)
    before = tables(spark, folder)
    run()
    assert tables(spark, folder) == before
