import datetime as dt
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import rows
from catalog import REGISTRY
from catalog.base import period_events
from tillcast.plans.feature_batch import run_batch
from tillcast.plans.run import run_forecast, run_pooled_ridge
from tillcast.sources import sinks, staging, tables
from tillcast.sources import testbed as tb

SF = "/root/testdata/sf0.001"
TABLES = "nation supplier part orders lineitem"


def test_first_table_of_a_folder(spark, tmp_path):
    (tmp_path / "b.csv").write_text("x,y\n1,2\n")
    (tmp_path / "a.CSV").write_text("x,y\n3,4\n")
    (tmp_path / "notes.txt").write_text("no")
    assert rows(tables.read_first_table(spark, str(tmp_path))) == [("3", "4")]
    assert rows(tables.read_first_table(spark, str(tmp_path / "b.csv"), "x int, y int")) == [(1, 2)]
    assert tables.read_first_table(spark, None, "x int").count() == 0
    with pytest.raises(ValueError):
        tables.read_any(spark, "table.xlsx")
    with pytest.raises(ValueError):
        tables.read_any(spark, "table.json")
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(ValueError):
        tables.read_first_table(spark, str(empty))


def test_header_and_store_column(spark):
    df = spark.createDataFrame([(0, "Store", " State "), (1, "5", "Ohio")], "i int, a string, b string")
    out = tables.promote_header(df, "i")
    assert out.columns == ["Store", "State"] and rows(out) == [("5", "Ohio")]
    feats = spark.createDataFrame([("5",)], "Heatmap_Store_Number string")
    assert tables.read_features(spark, feats).columns == ["store_number"]


def test_feature_store_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 1.0, 2000, 1), ("a", 3, 3.0, 2000, 2), ("b", 2, 2.0, 2001, 1)], "id string, t int, v double, fiscal_year int, fiscal_period int")
    sinks.append_features(df, str(tmp_path / "fs"))
    sinks.append_features(df.withColumn("t", F.col("t") + 10), str(tmp_path / "fs"))
    stored = spark.read.parquet(str(tmp_path / "fs"))
    assert stored.count() == 6
    assert rows(sinks.latest_per_key(stored, "id", ["t"]).select("id", "t", "v")) == [("a", 13, 3.0), ("b", 12, 2.0)]
    assert sinks.feature_definitions(df, "id", "t") == [("id", "String"), ("t", "Fractional"), ("v", "Fractional"), ("fiscal_year", "Integral"), ("fiscal_period", "Integral")]
    sinks.write_report(df, str(tmp_path / "csv"), ["id", "t"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == df.columns


def test_feature_batch(spark, tmp_path):
    out = run_batch(
        tb.sales_period(spark, SF), tb.fiscal_calendar(spark), str(tmp_path / "f"), str(tmp_path / "s"),
        tb.CFG, period_events(spark), tb.cpi_wide(spark),
    )
    assert out.count() == out.select("record_id").distinct().count() > 0
    assert spark.read.parquet(str(tmp_path / "s")).count() == out.count()
    assert os.path.exists(tmp_path / "f" / "fiscal_year=1996")
    with pytest.raises(ValueError):
        run_batch(tb.sales_period(spark, SF), tb.fiscal_calendar(spark).limit(0), str(tmp_path / "g"))


def test_whole_run(spark):
    sales = tb.sales_period(spark, SF, extra=True)
    run = run_forecast(
        sales, tb.fiscal_calendar(spark), tb.hierarchy(spark, SF), tb.CFG, tb.cpi_wide(spark), period_events(spark),
        tb.budget(spark, SF), tb.labor(spark, SF),
    )
    fc = run.forecasts
    assert fc.count() > 0 and fc.select("store_number", "fiscal_year", "fiscal_period").distinct().count() == fc.count()
    total = fc.agg(F.sum("our_forecast")).first()[0]
    assert run.by_state.agg(F.sum("forecast")).first()[0] == pytest.approx(total)
    assert run.by_period.agg(F.sum("forecast")).first()[0] == pytest.approx(total)
    assert run.gap_totals.agg(F.sum("total_forecast")).first()[0] == pytest.approx(total)
    assert run.labor_cost.count() == fc.count() and run.labor_hours.count() == fc.count()
    hours = run.labor_hours.agg(F.sum("hours_forecast")).first()[0]
    assert run.labor_hours_dept.agg(F.sum("hours_forecast_dept")).first()[0] == pytest.approx(hours)
    assert run.labor_totals.agg(F.sum("total_hours")).first()[0] == pytest.approx(hours)
    assert {r[0] for r in run.assigned.select("assigned_model").distinct().collect()} <= {"pooled", "peer"}


def test_short_feature_list_without_events(spark):
    out, feats, model = run_pooled_ridge(tb.sales_period(spark, SF), tb.fiscal_calendar(spark), horizon=2)
    assert "CPI_m1" not in feats.columns and "Super Bowl" not in feats.columns
    assert sorted({r["h"] for r in out.collect()}) == [1, 2]


def test_staging_uses_the_shared_folder(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    df = staging.staged(spark.range(3).toDF("x"))
    assert df.inputFiles()[0].replace("file://", "").startswith(root) and df.count() == 3


@pytest.mark.parametrize("name", ["feature_table", "ridge_fit", "recursive_fixed_actual", "driver_event", "dept_shares", "peers_long"])
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = REGISTRY[name].run(spark, SF)
    res = con.execute(REGISTRY[name].sql)
    assert [d[0] for d in res.description] == got.columns
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    want = sorted(res.fetchall(), key=key)
    assert sorted([tuple(r) for r in got.collect()], key=key) == want


def test_plans_push_down_and_never_pair(spark, capsys):
    REGISTRY["feature_table"].run(spark, SF).explain()
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_discount:double,l_shipdate:timestamp_ntz>" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_dates_are_days(spark):
    assert tb.fiscal_calendar(spark).first()["BeginningDate"] == dt.date(1995, 1, 1)
