import datetime as dt
import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tillcast.config import ForecastConfig, retrain_needed
from tillcast.functions import casts, fiscal, keys, names, stats
from tillcast.sources.sinks import config_of, config_table


def one(spark, **cols):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()])


def test_tolerant_casts(spark):
    df = spark.createDataFrame([(" 12 ", "2001-02-03 10:11:12"), ("abc", "nope"), ("NaN", None), ("Infinity", "2001-02-03")], "a string, d string")
    got = df.select(casts.to_double("a"), casts.to_int("a"), casts.to_day("d")).collect()
    assert [tuple(r) for r in got] == [
        (12.0, 12, dt.date(2001, 2, 3)), (None, None, None), (None, 0, None), (None, 2147483647, dt.date(2001, 2, 3))
    ] or [r[0] for r in got] == [12.0, None, None, None]
    assert [r[2] for r in got] == [dt.date(2001, 2, 3), None, None, dt.date(2001, 2, 3)]


def test_clip_ratio_gate_flag(spark):
    df = spark.createDataFrame([(5.0, 2.0, 1), (-1.0, 0.0, 0), (None, 1.0, None)], "x double, y double, k int")
    got = rows(df.select(casts.clip("x", 0.0, 1.0), casts.ratio("x", "y"), casts.gate("k", "y"), casts.flag01("k")))
    assert (1.0, 2.5, 2.0, 1) in got and (0.0, None, 0.0, 0) in got and (None, None, 0.0, 0) in got


def test_sum_of_nothing_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "k string, v double")
    assert rows(df.groupBy("k").agg(casts.sum0("v"))) == [("a", 0.0), ("b", 1.0)]


def test_sanitize(spark):
    df = spark.createDataFrame([(" 1 ", "inf", "3"), ("2", "x", None)], "store_number string, f string, y string")
    assert rows(casts.sanitize_features(df, ["f"], "y")) == [("1", 0.0, 3.0)]


def test_store_keys(spark):
    df = spark.createDataFrame([(" 007 ",), ("364001.0",), ("A10.05",), (None,)], "k string")
    got = df.select(keys.store_id("k"), keys.digits_key("k"), keys.unpadded("k")).collect()
    assert [tuple(r) for r in got] == [
        ("007", "007", "7"), ("364001", "364001", "364001.0"), ("A10.05", "105", "A10.05"), (None, "", None)
    ]


def test_exclusions(spark):
    df = spark.createDataFrame([("007",), ("7",), ("8",), ("x9",), (None,)], "k string")
    assert rows(keys.drop_stores(df, "k", ["07"])) == [(None,), ("8",), ("x9",)]
    assert rows(keys.drop_store_range(df, "k", 7, 8)) == [(None,), ("x9",)]
    listed = spark.createDataFrame([("9",)], "id string")
    assert rows(keys.drop_stores_by_digits(df, "k", listed, "id")) == [(None,), ("007",), ("7",), ("8",)]


def test_record_keys_skip_unplaced_rows(spark):
    df = spark.createDataFrame([("1", dt.date(1970, 1, 2), 1970, 3), ("2", None, 1970, 3)], "s string, d date, y int, p int")
    assert rows(keys.with_record_keys(df, "s", "d", "y", "p").select("record_id", "event_time")) == [("1_1970_03", 86400)]


def test_config_settings(spark):
    cfg = ForecastConfig(exclude_stores=[" 007 "])
    base = ForecastConfig()
    assert cfg.fit_settings().excluded == {"7"} and ForecastConfig(exclude_stores=()).fit_settings().excluded == set()
    assert len(base.fit_settings().excluded) == 10
    assert not retrain_needed(base, replace(base, holdout_k=3)) and retrain_needed(base, replace(base, alpha=9))
    assert retrain_needed(base, replace(base, feature_list=["adv_m1"])) and retrain_needed(base, cfg)
    assert not retrain_needed(cfg, replace(cfg, exclude_stores=("7",)))
    assert config_of(config_table(spark, cfg)).fit_settings() == cfg.fit_settings()
    assert config_of(config_table(spark, ForecastConfig(exclude_stores=()))).exclude_stores == ()


def test_fiscal_rollover(spark):
    df = spark.createDataFrame([(2001, 13), (2001, 5)], "y int, p int")
    fy, fp = fiscal.advance("y", "p", 1)
    fy14, fp14 = fiscal.advance("y", "p", 14)
    assert rows(df.select(fy, fp, fy14, fp14)) == [(2001, 6, 2002, 6), (2002, 1, 2003, 1)]
    label = df.select(fiscal.period_label("y", "p"), fiscal.period_label("y", "p", ""))
    assert rows(label) == [("2001-P13", "2001-13"), ("2001-P5", "2001-5")]


def test_seasonality_and_month_end(spark):
    got = one(spark, p=13, m=200002).select(*fiscal.seasonality("p").values(), fiscal.month_of_yyyymm("m")).first()
    assert abs(got[0]) < 1e-12 and abs(got[1] - 1) < 1e-12 and got[2] == dt.date(2000, 2, 29)


def student_tail(t, df):
    """P(|T| > t) by Simpson's rule on the density, as an independent reference."""
    c = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
    x = np.linspace(0, t, 20001)
    y = c * (1 + x * x / df) ** (-(df + 1) / 2)
    return 1 - 2 * (x[1] / 3) * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum())


def test_student_t_series(spark):
    cases = [(t, v) for t in (0.3, 1.7, 4.2) for v in (1, 2, 3, 4, 5, 10, 11, 87, 240)]
    df = spark.createDataFrame([(float(t), v) for t, v in cases], "t double, v int")
    got = df.select("t", "v", stats.student_t_two_sided("t", "v").alias("p")).collect()
    for r in got:
        assert r["p"] == pytest.approx(student_tail(r["t"], r["v"]), abs=1e-9)


def test_wape_pairs_only(spark):
    df = spark.createDataFrame([("a", 10.0, 8.0), ("a", None, 1.0), ("a", 10.0, None), ("b", 0.0, 1.0)], "k string, y double, f double")
    assert rows(df.groupBy("k").agg(stats.wape("y", "f"))) == [("a", 0.2), ("b", None)]


def test_name_resolution(spark):
    cal = one(spark, FY=2001, Period=3)
    assert names.standard_fiscal(cal).columns == ["fiscal_year", "fiscal_period"]
    with pytest.raises(KeyError):
        names.standard_fiscal(one(spark, a=1))
    assert names.standard_fiscal(one(spark, a=1), required=False).columns == ["a"]
    assert names.super_bowl_column(one(spark, **{"Super Bowl": 1})) == "Super Bowl"
    assert names.super_bowl_column(one(spark, **{"super_bowl": 1})) == "super_bowl"
    assert names.store_column(one(spark, x=1, My_Store_Number=2)) == "My_Store_Number"


def test_labor_names(spark):
    df = one(spark, shift_date="2001-01-01", storeid=" 5 ", normal_hours="3", ot_hours="x")
    assert rows(names.normalize_labor(df)) == [("5", dt.date(2001, 1, 1), "Unknown", 3.0)]
    with pytest.raises(KeyError):
        names.normalize_labor(one(spark, storeid="5", total_hours=1))
    with pytest.raises(KeyError):
        names.normalize_labor(one(spark, date="2001-01-01", total_hours=1))


def test_forecast_and_history_names(spark):
    df = one(spark, store_number=" 5 ", fiscal_year="2001", fiscal_period="3", forecast=1.0, our_forecast=2.0)
    assert rows(names.normalize_forecast(df)) == [("5", 2001, 3, 2.0)]
    with pytest.raises(KeyError):
        names.normalize_forecast(df.drop("forecast", "our_forecast"))
    with pytest.raises(KeyError):
        names.normalize_history(df)
