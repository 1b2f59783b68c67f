import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tillcast.config import ForecastConfig
from tillcast.operators import calendar as cal_ops
from tillcast.operators import dims, quality, splits
from tillcast.operators.features import build_feature_table, gap_check
from tillcast.sources import testbed as tb

CFG = ForecastConfig()


def cal(spark):
    return cal_ops.prepare_calendar(tb.fiscal_calendar(spark))


def begins(spark, n):
    return [r["BeginningDate"] for r in tb.fiscal_calendar(spark).orderBy("BeginningDate").limit(n).collect()]


@pytest.fixture(scope="module")
def sales(spark):
    days = begins(spark, 16)
    data = [("A", d, 100.0 + i, 10.0 + i) for i, d in enumerate(days[:3])]
    data += [("B", d, 200.0 + i, None) for i, d in enumerate(days[:15]) if i != 5]  # one gap
    data += [("364001", days[0], 1.0, 1.0), ("0364002 ", days[0], 1.0, 1.0)]
    return spark.createDataFrame(data, "store_number string, event_date date, total_net_sales double, total_advertising double")


def test_calendar_shape(spark):
    c = cal(spark)
    assert c.count() == 104
    five = c.where("is_5w = 1").collect()
    assert [(r["fiscal_year"], r["fiscal_period"], r["days_in_period"]) for r in five] == [(1998, 13, 35)]
    assert cal_ops.daily_calendar(c).select("event_date").distinct().count() == 104 * 28 + 7


def test_five_week_sources(spark):
    base = spark.createDataFrame([(2001, 1, 5, 28), (2001, 2, 4, 35)], "Year int, Period int, weeks_in_period int, days_in_period int")
    assert rows(cal_ops.prepare_calendar(base).select("fiscal_period", "is_5w")) == [(1, 1), (2, 0)]
    assert rows(cal_ops.prepare_calendar(base.drop("weeks_in_period")).select("fiscal_period", "is_5w")) == [(1, 0), (2, 1)]
    assert rows(cal_ops.prepare_calendar(base.select("Year", "Period")).select("fiscal_period", "is_5w")) == [(1, 0), (2, 0)]
    days = spark.createDataFrame([(31,), (32,), (35,), (38,)], "d int").select(cal_ops.rounded_weeks("d"))
    assert [r[0] for r in days.collect()] == [4, 5, 5, 5]


def test_date_lookup_equals_between(spark):
    c = cal(spark)
    days = spark.range(0, 900).select(F.date_add(F.lit("1994-12-01"), F.col("id").cast("int")).alias("event_date"))
    got = cal_ops.map_dates(days, c)
    want = days.join(
        c.select("fiscal_year", "fiscal_period", "BeginningDate", "EndingDate"),
        F.col("event_date").between(F.col("BeginningDate"), F.col("EndingDate")), "left",
    ).select("event_date", "fiscal_year", "fiscal_period")
    assert rows(got) == rows(want)
    assert got.where("fiscal_year IS NULL").count() == 31


def test_feature_table_lags_gap_and_exclusion(spark, sales):
    out = build_feature_table(sales, tb.fiscal_calendar(spark), CFG)
    got = {(r["store_number"], r["fiscal_period"], r["fiscal_year"]): r for r in out.collect()}
    assert {k[0] for k in got} == {"A", "B"}
    assert len(got) == 2 + 13  # the first row of each store has no lag
    assert got[("A", 2, 1995)]["total_net_sales_m1"] == 100.0 and got[("A", 2, 1995)]["adv_m1"] == 10.0
    assert got[("B", 7, 1995)]["total_net_sales_m1"] == 204.0  # positional: period 6 is missing
    assert got[("B", 7, 1995)]["adv_m1"] == 0.0
    assert out.columns[:5] == ["store_number", "event_date", "fiscal_year", "fiscal_period", "total_net_sales"]
    assert all(got[k]["Super Bowl"] == 0.0 and got[k]["CPI_m1"] == 0.0 for k in got)
    placed = cal_ops.map_dates(sales, cal(spark))
    assert rows(gap_check(placed)) == [("B", 1995, 7, 1)]


def test_feature_table_keeps_given_lags_and_alias(spark, sales):
    cfg = ForecastConfig(feature_list=("total_net_sales_m1", "Super_Bowl"))
    given = sales.withColumn("total_net_sales_m1", F.lit(7.0)).withColumn("Super Bowl", F.lit(1))
    out = build_feature_table(given, tb.fiscal_calendar(spark), cfg)
    assert out.count() == 17 and out.select("Super_Bowl", "total_net_sales_m1").distinct().collect() == [(1.0, 7.0)]


def test_events_do_not_fan_out(spark, sales):
    day = begins(spark, 2)[1]
    ev = spark.createDataFrame([(day, 1), (day, 0)], "event_date date, `Super Bowl` int")
    out = build_feature_table(sales, tb.fiscal_calendar(spark), CFG, events=ev)
    assert out.count() == 15
    assert rows(out.where("`Super Bowl` = 1").select("store_number", "event_date")) == [("A", day), ("B", day)]
    per_store = ev.withColumn("store_number", F.lit("A"))
    out = build_feature_table(sales, tb.fiscal_calendar(spark), CFG, events=per_store)
    assert rows(out.where("`Super Bowl` = 1").select("store_number")) == [("A",)]
    by_period = spark.createDataFrame([(1995, 2, 1)], "fiscal_year int, fiscal_period int, super_bowl int")
    out = build_feature_table(sales, tb.fiscal_calendar(spark), CFG, events=by_period)
    assert out.where("`Super Bowl` = 1").count() == 2
    lifted = dims.events_by_period(ev.withColumn("event_date", F.date_add("event_date", 3)), cal(spark), ["Super Bowl"])
    assert rows(lifted.select("event_date", "Super Bowl")) == [(day, 1)]
    with pytest.raises(KeyError):
        dims.super_bowl_flags(ev.withColumnRenamed("Super Bowl", "x"), cal(spark))


def test_cpi_fill_is_chronological(spark):
    wide = spark.createDataFrame([(1995, None, 10.0, None), (1996, 12.0, None, 13.0)], "Year int, Jan double, Feb double, Mar double")
    monthly = {r["cal_month"]: r["CPI"] for r in dims.cpi_monthly(wide).collect()}
    assert monthly == {
        dt.date(1995, 1, 31): 10.0, dt.date(1995, 2, 28): 10.0, dt.date(1995, 3, 31): 10.0,
        dt.date(1996, 1, 31): 12.0, dt.date(1996, 2, 29): 12.0, dt.date(1996, 3, 31): 13.0,
    }
    fiscal = dims.cpi_by_period(wide, cal(spark)).where("CPI IS NOT NULL")
    assert (1996, 1, 12.0) in rows(fiscal)
    assert dims.cpi_by_period(fiscal, cal(spark)).count() == fiscal.count()


def test_states(spark):
    df = spark.createDataFrame([("1", "Ohio"), ("1", "Iowa"), ("2", None), ("3", "b"), ("3", "b"), ("3", "a")], "store_number string, my_state string")
    assert rows(dims.state_of_store(df)) == [("1", "Iowa"), ("3", "b")]
    fc = spark.createDataFrame([("1",), ("2",)], "store_number string")
    assert rows(dims.attach_state(fc, df)) == [("1", "Iowa"), ("2", "Unknown")]
    s = spark.createDataFrame([(" new KANAS ",), ("alabma",)], "s string").select(dims.clean_state("s"))
    assert [r[0] for r in s.collect()] == ["New Kansas", "Alabama"]


def test_crosswalk_prefers_mapped_pairs(spark):
    geo = spark.createDataFrame([("91", "1", "x"), ("90.0", "91", "x"), (None, "5", "x")], "`Store_Number ` string, Heatmap_Store_Number string, State string")
    mapping = dims.key_map(geo)
    assert rows(mapping) == [("1", "1"), ("90", "91"), ("91", "1")]
    df = spark.createDataFrame([("91",), ("S-7",)], "store_number string")
    assert rows(dims.attach_hm_key(df, mapping)) == [("91", "1"), ("S-7", "7")]
    with pytest.raises(KeyError):
        dims.key_map(geo.drop("State").toDF("a", "b"))


def test_misalignment(spark):
    b = spark.createDataFrame([("1", "1995-01-28", 1995), ("1", "1995-01-29", 1995)], "s string, endingdate string, year int")
    assert rows(cal_ops.misaligned(b, cal(spark), "endingdate")) == [("1", "1995-01-29", 1995)]
    assert rows(cal_ops.year_pairs(b, cal(spark), "endingdate", "year")) == [(1995, 1995, 1)]


def test_splits(spark):
    data = [(s, dt.date(2000, 1, 1) + dt.timedelta(days=28 * i), 2000 + i // 13, i % 13 + 1) for s, n in (("a", 11), ("b", 12), ("c", 18)) for i in range(n)]
    df = spark.createDataFrame(data, "store_number string, event_date date, fiscal_year int, fiscal_period int")
    count = lambda d: rows(d.groupBy("store_number", "split").count())
    assert count(splits.split_last_k(df)) == [("a", None, 11), ("b", None, 6), ("b", "train", 6), ("c", "train", 12), ("c", "valid", 6)]
    assert count(splits.split_last_k(df, train_rest=True)) == [("a", None, 11), ("b", "train", 12), ("c", "train", 12), ("c", "valid", 6)]
    assert count(splits.split_last_k(df, k=0, train_rest=True)) == [("a", None, 11), ("b", "train", 12), ("c", "train", 18)]
    assert rows(splits.history_cohorts(df.unionByName(df))) == [("a", 11, "short"), ("b", 12, "short"), ("c", 18, "long")]
    assert rows(splits.last_axis(df)) == [(2000, 13), (2001, 1), (2001, 2), (2001, 3), (2001, 4), (2001, 5)]
    assert rows(splits.last_row(df).select("store_number", "fiscal_period")) == [("a", 11), ("b", 12), ("c", 5)]
    with pytest.raises(ValueError):
        splits.last_axis(df, 40, required=True)
    assert rows(splits.history_length(df.unionByName(df))) == [("a", 22, 11), ("b", 24, 12), ("c", 36, 18)]


def test_quality(spark):
    df = spark.createDataFrame([(1995, 1, 2.0), (1995, 1, None), (1995, 2, None), (None, None, 1.0)], "fiscal_year int, fiscal_period int, v double")
    assert rows(quality.column_health(df, ["v"])) == [("v", 4, 2, "1.0", "2.0")]
    assert rows(quality.periods_per_year(df, "v")) == [(1995, 2, 1)]
    assert quality.assert_complete(df.where("v IS NOT NULL"), "v").count() == 2
    with pytest.raises(Exception, match="v is missing"):
        quality.assert_complete(df, "v").collect()
