"""Edge cases of audiences, behaviour, calendar, sinks and delivery."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hearthline.functions import timeline as C
from hearthline.operators import behavior as B
from hearthline.operators import geo as G
from hearthline.operators import lists as L
from hearthline.operators import propensity as P
from hearthline.plans import load
from hearthline.session import scratch_path, shared_dir
from hearthline.sources import egress as E
from hearthline.sources import sinks as K
from hearthline.sources import tables as S
from hearthline.sources.hierarchy import flatten_hierarchy
from hearthline.streaming import weekly as weekly_module
from hearthline.streaming.weekly import update_vintage

TX = "hh_id long, upc long, basket_id long, trn_date date, units long, net_cents long, is_return boolean, store_id long, div_no int"


def tx(spark, rows):
    """Rows of (household, product, basket, day number, cents)."""
    return spark.createDataFrame(
        [(h, u, b, C.ANCHOR + dt.timedelta(days=d), 1, c, False, 1, 7) for h, u, b, d, c in rows], TX)


def test_fiscal_week_round_trip():
    for index in (0, 3, 4, 51, 52, 343):
        code = C.week_code(index)
        assert C.week_index(code) == index and len(code) == 8
    assert C.weeks_ago("19960101", 1) == "19951304"
    assert C.week_dates("19950101") == (dt.date(1995, 1, 1), dt.date(1995, 1, 7))


def test_fiscal_columns_agree_with_driver_side(spark):
    rows = C.fiscal_calendar(spark, dt.date(1995, 1, 1), dt.date(1997, 1, 5)).collect()
    assert all(r["fiscal_week"] == C.date_week(r["trn_date"]) for r in rows)
    assert [r["fiscal_week"] for r in rows] == sorted(r["fiscal_week"] for r in rows)


def test_lookback_is_whole_weeks():
    start, end = C.lookback_window(dt.date(2023, 11, 15), 52)
    assert (start, end) == (dt.date(2022, 11, 14), dt.date(2023, 11, 12))


def test_end_date_is_week_zero(spark):
    end = dt.date(2001, 8, 1)
    df = spark.createDataFrame([(end,), (end - dt.timedelta(days=1),), (end - dt.timedelta(days=8),)], "d date")
    assert [r[0] for r in df.select(C.weeks_back("d", end)).collect()] == [0, 1, 2]


def test_holiday_lead_days_cross_a_week(spark):
    days = spark.createDataFrame([("x", dt.date(1995, 1, 8))], "holiday string, date date")
    assert {r["week"] for r in C.holiday_weeks(days, C.ANCHOR).collect()} == {0, 1}


def test_ties_at_the_cut_are_medium(spark):
    df = spark.createDataFrame([("s", h, 10) for h in range(9)], "segment string, hh_id long, spend_cents long")
    assert {r["propensity"] for r in P.label_by_quantiles(df, ["segment"], "spend_cents").collect()} == {"M"}


def test_single_household_is_medium(spark):
    lists = spark.createDataFrame([("s", 1)], "segment string, upc long")
    rows = P.percentile_propensity(tx(spark, [(1, 1, 1, 0, 500)]), lists).collect()
    assert [(r["hh_id"], r["propensity"]) for r in rows] == [(1, "M")]


def test_returns_only_and_empty_lists(spark):
    items = tx(spark, [(1, 1, 1, 0, 500)]).withColumn("is_return", F.lit(True))
    lists = spark.createDataFrame([("s", 1)], "segment string, upc long")
    assert P.percentile_propensity(items, lists).count() == 0
    empty = spark.createDataFrame([], "segment string, upc long")
    assert P.buyers_audience(items, empty).count() == 0
    none = L.definitions_frame(spark, {"x": {"commodities": [], "sub_commodities": [], "weeks": 4}})
    assert none.count() == 0


def test_sizing_takes_a_prefix_of_h_m_l(spark):
    sizes = spark.createDataFrame([("a", "H", 5), ("a", "M", 5), ("a", "L", 5), ("b", "L", 1), ("b", "H", 90)],
                                  "segment string, propensity string, households long")
    got = {}
    for r in P.select_propensities(sizes, 6).collect():
        got.setdefault(r["segment"], set()).add(r["propensity"])
    assert got == {"a": {"H", "M"}, "b": {"H"}}


def test_missing_label_fails(spark):
    people = spark.createDataFrame([(1, "X")], "hh_id long, label string")
    with pytest.raises(ValueError, match="Y"):
        P.label_audience(people, people.select("hh_id"), "label", {"X": "x", "Y": "y"})


def pillars(spark, rows):
    return spark.createDataFrame(rows, "hh_id long, quarter int, sales long, units long, enterprise_units long, unit_penetration long")


def test_cut_labels_equal_percentile_labels(spark):
    rows = [(h, q, (h * 37 * q) % 19, 1, 2, 10_000 if h % 11 == 0 else (h * 13) % 7 * 1000)
            for h in range(80) for q in (1, 2)] + [(1, 3, 5, 1, 1, 200)]
    columns = ["hh_id", "quarter", "spend_rank", "penetration_rank"]
    by_rank = sorted(map(tuple, B.rank_pillars(pillars(spark, rows)).select(columns).collect()))
    by_cut = sorted(map(tuple, B.rank_labels(pillars(spark, rows)).select(columns).collect()))
    assert by_rank == by_cut
    # The only household of a quarter has percentile 0.
    assert (1, 3, "L", "L") in by_cut


def test_points_matrix(spark):
    df = spark.createDataFrame([(s, p, m) for s in "HML" for p in "HML" for m in ("existing", "new market")],
                               "spend_rank string, penetration_rank string, market string")
    got = {(r[0] + r[1], r[2]): r[3] for r in B.quarter_points(df, "market").collect()}
    for pair, points in {"HH": 3, "HM": 3, "MH": 3, "MM": 2, "LH": 2, "HL": 2, "ML": 1, "LM": 1, "LL": 1}.items():
        assert got[pair, "existing"] == points
        assert got[pair, "new market"] == {"H": 3, "M": 2, "L": 1}[pair[0]]


def behaviour_items(spark):
    rows, basket = [], 0
    for hh in range(40):
        for day in range(hh % 13, 700, 9 + hh % 17):
            basket += 1
            rows.append((hh, (hh + day) % 6, basket, day, 100 + (hh * day) % 900))
    return tx(spark, rows)


def test_one_pass_weeks_equal_separate_kpis(spark):
    items = behaviour_items(spark)
    listed = spark.createDataFrame([(0,), (1,)], "upc long")
    weeks = B.household_weeks(items, listed)
    columns = ["hh_id", "fiscal_week", "weekly_sales", "weekly_units", "weekly_visits"]
    rows = lambda df, *c: sorted(map(tuple, df.select(*c).collect()))
    assert rows(weeks.where("weekly_visits > 0"), *columns) == rows(B.weekly_kpis(items, listed), *columns)
    assert rows(weeks, "hh_id", "fiscal_week", "all_units") == rows(
        B.weekly_kpis(items), "hh_id", "fiscal_week", "weekly_units")
    vintage = B.household_vintage(B.daily_kpis(items, listed))
    assert rows(B.vintage_of_weeks(weeks), *vintage.columns) == rows(vintage, *vintage.columns)


def test_every_household_has_one_label(spark):
    items = behaviour_items(spark)
    listed = spark.createDataFrame([(0,), (1,)], "upc long")
    weekly, everything = B.weekly_kpis(items, listed), B.weekly_kpis(items)
    vintage = B.household_vintage(B.daily_kpis(items, listed))
    start, end = C.week_code(40), C.week_code(91)
    got = B.household_segments(weekly, vintage, everything, start, end, min_visits=3)
    rows = got.collect()
    assert len(rows) == len({r["hh_id"] for r in rows})
    assert {r["segment"] for r in rows} <= {"new", "lapsed", "inconsistent", "H", "M", "L"}
    # Restating an end week does not look at later weeks.
    early = weekly.where(F.col("fiscal_week") <= end)
    again = B.household_segments(early, vintage, everything, start, end, min_visits=3)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again.collect()))


def test_week_by_week_equals_full_build(spark):
    items = behaviour_items(spark).where(F.col("trn_date") < C.ANCHOR + dt.timedelta(days=56))
    listed = spark.createDataFrame([(0,), (1,)], "upc long")
    daily = B.daily_kpis(items, listed).withColumn("week", C.fiscal_columns("trn_date")["fiscal_week"]).cache()
    weekly = B.weekly_kpis(items, listed).cache()
    vintage_path, sales_path = scratch_path(spark, "v"), scratch_path(spark, "s")
    K.replace_partitions(B.household_vintage(daily.where(F.col("week") <= C.week_code(0))), vintage_path, ["vintage_week"])
    for index in (1, 2, 3, 4, 5, 6, 7, 7, 3):
        week = C.week_code(index)
        update_vintage(spark, daily.where(F.col("week") == week), weekly.where(F.col("fiscal_week") == week),
                       week, vintage_path, sales_path)
    full = B.household_vintage(daily)
    columns = ["hh_id", F.col("vintage_week").cast("string"), "vintage_div"]
    read = lambda df: sorted(map(tuple, df.select(*columns).collect()))
    assert read(spark.read.parquet(vintage_path)) == read(full)


def test_write_run_replaces_only_its_partition(spark):
    path = scratch_path(spark, "run")
    columns = ["hh_id", "modality", "end_week", "run_week", "segment"]
    rows = lambda *h: spark.createDataFrame([(x, "H") for x in h], "hh_id long, segment string")
    K.write_run(rows(1, 2), path, "overwrite", "keto", "w1", "w2", columns)
    K.write_run(rows(3), path, "overwrite", "vegan", "w1", "w2", columns)
    K.write_run(rows(4), path, "overwrite", "keto", "w1", "w2", columns)
    K.write_run(rows(5), path, "append", "vegan", "w1", "w2", columns)
    got = {(r["modality"], r["hh_id"]) for r in spark.read.parquet(path).collect()}
    assert got == {("keto", 4), ("vegan", 3), ("vegan", 5)}
    with pytest.raises(ValueError):
        K.write_run(rows(1), path, "merge", "keto", "w1", "w2", columns)


def test_latest_snapshot_prunes_partitions(spark):
    path = scratch_path(spark, "snapshots")
    K.append_period(spark.createDataFrame([(1, 20240101), (2, 20240201), (3, 20240301)], "x int, period int"), path)
    stored = spark.read.parquet(path)
    assert [r["x"] for r in S.latest_snapshot(stored, "period").collect()] == [3]
    assert [r["x"] for r in S.latest_snapshot(stored, "period", 2).collect()] == [2]
    assert S.latest_snapshot(stored, "period", 9).count() == 0
    assert [r["x"] for r in S.as_of_snapshot(stored, "period", 20240215).collect()] == [2]
    assert len(S.latest_snapshot(stored, "period").inputFiles()) >= 1


def test_missing_hierarchy_level_keeps_the_product(spark):
    schema = ("upc long, product_name string, familyTree struct<commodity:struct<name:string>,subCommodity:struct<name:string>,"
              "primaryDepartment:struct<name:string,recapDepartment:struct<name:string,department:struct<name:string>>>>")
    df = spark.createDataFrame([(1, "a", (("C",), None, ("D", None)))], schema)
    row = flatten_hierarchy(df, "upc", {
        "commodity": "familyTree.commodity.name", "sub_commodity": "familyTree.subCommodity.name",
        "department": "familyTree.primaryDepartment.name",
        "micro_department": "familyTree.primaryDepartment.recapDepartment.department.name"}).first()
    assert (row["commodity"], row["sub_commodity"], row["department"], row["micro_department"]) == ("C", None, "D", None)


def registry(spark, kind="percentile"):
    return spark.createDataFrame([("a", "A", kind, "regex", "Purchase", ["H"], ["t"])],
                                 "audience string, frontend_name string, type string, list_type string, "
                                 "segment_type string, propensities array<string>, tags array<string>")


def test_unknown_audience_type_and_name(spark):
    with pytest.raises(Exception, match="unknown audience type"):
        E.registry(registry(spark, "mystery"), {"percentile": "/r/{audience}"}, {}).collect()
    found = E.registry(registry(spark), {"percentile": "/r/{audience}"}, {"regex": "/lists/{audience}/all"})
    with pytest.raises(ValueError, match="b"):
        E.select_audiences(found, ["a", "b"])
    assert (found.first()["location"], found.first()["list_location"]) == ("/r/a", "/lists/a/all")
    assert E.registry(registry(spark), {"percentile": "/r"}, {}).first()["list_location"] is None


def test_audience_below_the_gate_is_not_written(spark):
    people = spark.createDataFrame([("a", h, "H" if h < 3 else "L") for h in range(10)],
                                   "segment string, hh_id long, propensity string")
    path = scratch_path(spark, "out")
    receipt = E.egress(people, registry(spark), path, "20240101", min_households=3).first()
    assert receipt["households"] == 3 and receipt["filepath"].endswith("audience=a")
    assert spark.read.parquet(path).count() == 10
    held = E.egress(people, registry(spark), scratch_path(spark, "out"), "20240101", min_households=4).first()
    assert held["filepath"] is None
    with pytest.raises(ValueError, match="already delivered"):
        E.egress(people, registry(spark), path, "20240101", min_households=3)
    E.egress(people, registry(spark), path, "20240102", min_households=3)


def test_egress_computes_the_audiences_once(spark):
    computed = spark.sparkContext.accumulator(0)

    def counted(row):
        computed.add(1)
        return row

    rows = [("a", 1, "H"), ("a", 1, "H"), ("a", None, "L"), ("a", 2, None), (None, 3, "H"), ("b", 4, "H")]
    people = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(counted),
                                   "segment string, hh_id long, propensity string")
    path = scratch_path(spark, "out")
    receipt = E.egress(people, registry(spark), path, "20240101", min_households=2).first()
    assert computed.value == len(rows)
    assert receipt["households"] == 2
    written = spark.read.parquet(path).select("audience", "hh_id", "segment").collect()
    assert sorted(map(str, map(tuple, written))) == sorted(str(r) for r in rows if r[0] == "a")


@pytest.mark.parametrize("mode", ["cube", "rollup"])
def test_visits_of_all_sets_of_keys_without_a_shuffle_per_set(spark, mode):
    rows = [("d", 1, 1, 5, 1), ("d", 2, 1, 5, 1), ("e", 1, 1, 5, 1), ("e", 1, 1, 5, 1), ("d", 1, 2, 7, 2),
            (None, 1, 2, 1, 1), (None, None, 3, 1, 1), ("d", None, None, 4, 1), ("e", 2, None, None, None),
            ("d", None, 3, 1, 1), (None, 1, 2, 1, 1)]
    rows += [("d", i % 3, 9, 1, 1) for i in range(50)]
    items = spark.createDataFrame(rows, "department string, division int, basket_id long, net_cents long, units long")
    keys = ["department", "division"]
    direct = getattr(items, mode)(*keys).agg(
        F.sum("net_cents"), F.count_distinct("basket_id"), F.sum("units"))
    got = S.kpi_aggregate(items, keys, mode=mode)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, direct.collect())))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange" in x and "spark_grouping_id" in x and "basket_id" in x]
    assert S.kpi_aggregate(items.limit(0), keys, mode=mode).count() == getattr(items.limit(0), mode)(*keys).count().count()


def test_held_back_audiences_end_in_an_error(spark):
    receipt = spark.createDataFrame([("a", 5, "/x"), ("b", 2, None), ("c", 0, None)],
                                    "audience string, households long, filepath string")
    with pytest.raises(ValueError, match=r"b \(2\), c \(0\)"):
        E.require_delivered(receipt)
    E.require_delivered(receipt.where("audience = 'a'"))


@pytest.mark.parametrize("name", ["Pack Sizes", "a+b&c", "crème", "x/y=z", "0012"])
def test_replaced_partition_holds_one_run(spark, name):
    path = scratch_path(spark, "runs")
    columns = ["household", "modality", "end_week", "run_week"]
    rows = spark.range(3).select(F.col("id").alias("household"))
    K.write_run(rows, path, "append", name, "1", "20010801", columns)
    K.write_run(rows, path, "append", "other", "1", "20010801", columns)
    K.write_run(rows, path, "overwrite", name, "1", "20010801", columns)
    kinds = "household long, end_week string, modality string, run_week string"
    assert spark.read.schema(kinds).parquet(path).where(F.col("modality") == name).count() == 3
    K.write_run(rows.limit(0), path, "overwrite", name, "1", "20010801", columns)
    left = spark.read.schema(kinds).parquet(path).collect()
    assert len(left) == 3 and {r["modality"] for r in left} == {"other"}


def test_scan_sees_a_changed_schema(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    assert S.read_table(spark, str(tmp_path), "t").columns == ["id"]
    spark.range(3).selectExpr("id", "id AS more").write.mode("overwrite").parquet(str(tmp_path / "t.parquet"))
    assert S.read_table(spark, str(tmp_path), "t").columns == ["id", "more"]


def test_sparse_codes_share_documents(spark):
    lists = spark.createDataFrame([("s", 10**12 + 7_919_000_003 * u) for u in range(1_000)], "segment string, upc long")
    docs = E.list_documents(lists, "a", "b", codes_per_part=400).orderBy("part").collect()
    assert [(d["part"], d["products"]) for d in docs] == [(0, 400), (1, 400), (2, 200)]


def test_replay_moves_a_vintage_forward(spark):
    vintage_path, sales_path = scratch_path(spark, "vintage"), scratch_path(spark, "sales")

    def week(name, households):
        daily = spark.createDataFrame([(h, 1, name, dt.date(1995, 1, 2), 100, 1) for h in households],
                                      "hh_id long, div_no int, week string, trn_date date, sales_cents long, visits long")
        return daily, name

    def run(name, households):
        daily, _ = week(name, households)
        vintage = household_vintage_of(daily)
        weekly = daily.select("hh_id", F.lit(name).alias("fiscal_week"), F.col("sales_cents").alias("weekly_sales"))
        with_vintage(spark, vintage, weekly, name, vintage_path, sales_path)

    def household_vintage_of(daily):
        return daily.select("hh_id", F.col("week").alias("vintage_week"), F.col("div_no").alias("vintage_div"))

    def with_vintage(spark, vintage, weekly, name, a, b):
        original = weekly_module.household_vintage
        weekly_module.household_vintage = lambda daily: daily
        try:
            weekly_module.update_vintage(spark, vintage, weekly, name, a, b)
        finally:
            weekly_module.household_vintage = original

    spark.createDataFrame([(1, 1, "19950102")], "hh_id long, vintage_div int, vintage_week string").write.partitionBy(
        "vintage_week").parquet(vintage_path)
    run("19950109", [1, 2])
    run("19950116", [2, 3])
    run("19950109", [1, 2, 3])
    vintages = {(r["hh_id"], str(r["vintage_week"])) for r in spark.read.parquet(vintage_path).collect()}
    assert vintages == {(1, "19950102"), (2, "19950109"), (3, "19950109")}
    sales = {(r["hh_id"], str(r["fiscal_week"]), str(r["vintage_week"])) for r in spark.read.parquet(sales_path).collect()}
    assert sales == {(1, "19950109", "19950102"), (2, "19950109", "19950109"), (3, "19950109", "19950109"),
                     (2, "19950116", "19950109"), (3, "19950116", "19950109")}


def test_list_documents_are_whole(spark):
    lists = spark.createDataFrame([("s", u) for u in range(250)], "segment string, upc long")
    docs = E.list_documents(lists, "2024-01-01", "2024-12-30", codes_per_part=100).collect()
    assert sorted(d["products"] for d in docs) == [50, 100, 100]


def test_travellers_far_and_near(spark):
    stores = spark.createDataFrame([(1, 40.0, -84.0), (2, 40.1, -84.0), (3, 45.0, -70.0), (4, 30.0, -120.0)],
                                   "store_id long, lat double, lon double")
    rows = [(1, 1, 100, 1), (1, 2, 101, 3), (1, 3, 102, 4), (2, 1, 103, 1), (2, 2, 104, 2), (3, 1, 105, 1), (3, 2, 106, 3)]
    visits = spark.createDataFrame([(h, b, s) for h, _, b, s in rows], "hh_id long, basket_id long, store_id long")
    home = G.preferred_store(visits)
    assert {r["hh_id"]: r["pref_store_id"] for r in home.collect()} == {1: 1, 2: 1, 3: 1}
    trips = G.significant_trips(visits, home, stores, km=250)
    assert {r["hh_id"]: r["segment"] for r in G.travelers(trips, None).collect()} == {1: "H", 3: "M"}


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    else:
        assert shared_dir(spark) == shared_dir(spark)


def test_broken_delivery_can_be_repeated(spark, tmp_path, monkeypatch):
    people = spark.createDataFrame([(i, "a", "H") for i in range(5)], "hh_id long, segment string, propensity string")
    found = registry(spark)
    path = str(tmp_path / "out")
    # A run of old that died while it wrote into the day's folder.
    (tmp_path / "out" / "run_date=20240101" / "_temporary" / "0").mkdir(parents=True)
    assert not E.delivered(spark, path, "20240101")
    # A run that dies before it publishes leaves no day.
    monkeypatch.setattr(E, "rename", lambda *a: False)
    with pytest.raises(ValueError, match="could not be published"):
        E.egress(people, found, path, "20240102", 3)
    assert not E.delivered(spark, path, "20240102") and not E.exists(spark, f"{path}/run_date=20240102")
    monkeypatch.undo()
    for day in ("20240101", "20240102"):
        E.egress(people, found, path, day, 3)
        assert E.delivered(spark, path, day) and spark.read.parquet(f"{path}/run_date={day}").count() == 5
        with pytest.raises(ValueError, match="already delivered"):
            E.egress(people, found, path, day, 3)


def test_unreadable_audiences_are_named(spark, tmp_path):
    good, other = str(tmp_path / "good"), str(tmp_path / "other")
    spark.createDataFrame([(1, "H", 7)], "hh_id int, propensity string, more int").write.parquet(good)
    spark.createDataFrame([(1,)], "hh_id long").write.parquet(other)
    wanted = {"hh_id": "long", "propensity": "string"}
    found, skipped = E.read_audiences(spark, {"a": good, "b": other, "c": str(tmp_path / "none")}, wanted)
    assert [tuple(r) for r in found.collect()] == [("a", 1, "H")] and found.schema["hh_id"].dataType.simpleString() == "bigint"
    assert skipped["b"] == "no column propensity" and "PATH" in skipped["c"]
    assert E.read_audiences(spark, {"c": str(tmp_path / "none")}, wanted)[0] is None
    receipt = spark.createDataFrame([("a", 3, None), ("d", 9, "x")], "audience string, households long, filepath string")
    with pytest.raises(ValueError, match=r"not delivered: a \(3\); not read: b \(no column propensity\), c"):
        E.require_delivered(receipt, skipped)
    E.require_delivered(receipt.where("filepath is not null"), {})


def test_sift_keeps_rows_once(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "upc long, basket_id string")
    keys = spark.createDataFrame([(1,), (1,), (3,)], "upc long")
    for spread in (None, "basket_id"):
        assert sorted(r.basket_id for r in S.sift(rows, keys, ["upc"], "include", spread).collect()) == ["a", "b"]
        assert sorted(r.basket_id for r in S.sift(rows, keys, ["upc"], "exclude", spread).collect()) == ["c", "d"]


def test_history_joins_the_items_once(spark, folder):
    """Weeks, weekly and annual ranks all come from one table of daily sums."""
    for name in ("h05_holiday_movers", "h06_history_export", "h09_recurring_holiday_items", "h10_outliers_by_quantile"):
        plan = load().QUERIES[name](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
        assert "l_orderkey" not in plan and "p_partkey" not in plan
