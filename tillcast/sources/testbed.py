"""Domain tables as views over a star schema (lineitem, supplier, nation, part).

Suppliers stand for stores, ship dates for sales dates. Money is added up in whole 1/10000 units:
long sums are exact, do not depend on the order of rows, and are cheaper than decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.config import MONTHS, ForecastConfig

FIRST_DAY = "1995-01-01"
N_PERIODS = 104  # FY1995 to FY2002
LONG_PERIOD = 51  # FY1998 P13 lasts five weeks
SHORT_BELOW = 89  # periods of history; 87 to 90 of them have sales, so about a tenth of the stores are short
LABOR_ID_BASE = 10**12  # labor systems number stores apart from sales systems
CFG = ForecastConfig(exclude_stores=("1", "2"))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fiscal_calendar(spark: SparkSession) -> DataFrame:
    """Year, Period, BeginningDate, EndingDate; 28 days each except the five-week one."""
    return spark.range(0, N_PERIODS, 1, 1).selectExpr(
        "CAST(1995 + id DIV 13 AS INT) AS Year",
        "CAST(id % 13 + 1 AS INT) AS Period",
        f"date_add(DATE'{FIRST_DAY}', CAST(id * 28 + IF(id > {LONG_PERIOD}, 7, 0) AS INT)) AS BeginningDate",
        f"date_add(DATE'{FIRST_DAY}', CAST(id * 28 + 27 + IF(id >= {LONG_PERIOD}, 7, 0) AS INT)) AS EndingDate",
    )


def daily_periods(spark: SparkSession) -> DataFrame:
    cal = fiscal_calendar(spark)
    return cal.select(
        F.col("Year").alias("fiscal_year"),
        F.col("Period").alias("fiscal_period"),
        F.col("BeginningDate").alias("event_date"),
        F.explode(F.sequence("BeginningDate", "EndingDate")).alias("_day"),
    )


def _units(c: str, scale: int) -> Column:
    """Nearest whole number of units; floor on doubles is cheap, rounding them goes through decimals."""
    return F.floor(F.col(c) * scale + 0.5)


def store_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Sales lines with their day."""
    return table(spark, sf, "lineitem").withColumn("_day", F.to_date("l_shipdate"))


def sales_period(spark: SparkSession, sf: str, extra: bool = False) -> DataFrame:
    """One row per store and fiscal period; `extra` adds delivery, food and labor cost.

    The daily calendar is a few thousand rows, so the period lookup is a broadcast hash join inside
    the scan stage and the only shuffle carries partial sums, whatever store is hot.
    """
    price, disc = _units("l_extendedprice", 100), _units("l_discount", 100)
    sums = {
        "total_net_sales": (price * (100 - disc), 10000.0),
        "total_advertising": (price * disc, 10000.0),
    }
    lines = store_lines(spark, sf)
    if extra:
        part = table(spark, sf, "part").select("p_partkey", "p_retailprice")
        lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        qty = F.col("l_quantity").cast("bigint")
        sums["total_delivery"] = (price * _units("l_tax", 100), 10000.0)
        sums["total_food_cost"] = (qty * _units("p_retailprice", 100), 10000.0)
        sums["total_labor_cost"] = (qty * 20, 1.0)
    keys = ["event_date", "fiscal_year", "fiscal_period"]
    summed = (
        lines.join(F.broadcast(daily_periods(spark)), "_day")
        .groupBy("l_suppkey", *keys)
        .agg(*[(F.sum(x) / F.lit(d)).alias(n) for n, (x, d) in sums.items()])
    )
    return summed.select(F.col("l_suppkey").cast("string").alias("store_number"), *keys, *sums)


def hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    sup, nation = table(spark, sf, "supplier"), table(spark, sf, "nation")
    return sup.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        (F.col("s_suppkey") + LABOR_ID_BASE).cast("string").alias("Store_Number"),
        F.col("s_suppkey").cast("string").alias("Heatmap_Store_Number"),
        F.col("n_name").alias("State"),
    )


def cpi_wide(spark: SparkSession) -> DataFrame:
    """1995 to 2001, one column per month, the last four months not yet published."""
    level = [
        f"CASE WHEN (id - 1995) * 12 + {m} < 80 THEN 150D + 0.4D * ((id - 1995) * 12 + {m}) END AS {name}"
        for m, name in enumerate(MONTHS)
    ]
    return spark.range(1995, 2002, 1, 1).selectExpr("CAST(id AS INT) AS Year", *level)


def events(spark: SparkSession) -> DataFrame:
    """One row per event date with a 0/1 column per event; a zero row shares the bowl's period."""
    bowl = "next_day(date_sub(make_date(CAST(id AS INT), 2, 1), 1), 'Sun')"
    thanks = "date_add(next_day(date_sub(make_date(CAST(id AS INT), 11, 1), 1), 'Thu'), 20)"
    rows = (
        f"inline(array(struct({bowl}, 1, 0), struct(date_add({bowl}, 1), 0, 0), struct({thanks}, 0, 1)))"
        " AS (event_date, `Super Bowl`, `Thanksgiving Eve`)"
    )
    return spark.range(1995, 2003, 1, 1).selectExpr(rows)


def weather_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Date as YYYYMM and one temperature column per state."""
    names = [r["n_name"] for r in table(spark, sf, "nation").orderBy("n_nationkey").collect()]
    temp = "CAST(50 + {j} + (id % 12 - 6) * (6 - id % 12) * 0.75D AS DOUBLE) AS {name}"
    return spark.range(0, 84, 1, 1).selectExpr(
        "CAST((id DIV 12 + 1995) * 100 + id % 12 + 1 AS INT) AS Date",
        *[temp.format(j=j, name=n) for j, n in enumerate(names)],
    )


def budget(spark: SparkSession, sf: str) -> DataFrame:
    """Sales of the fiscal year before, plus 3%; there is none for FY2001 and later."""
    sales = sales_period(spark, sf).where(F.col("fiscal_year") < 2000)
    cal = fiscal_calendar(spark).select(
        F.col("Year").alias("year"),
        F.col("Period").alias("period_number"),
        F.col("EndingDate").alias("endingdate"),
    )
    return sales.select(
        "store_number",
        (F.col("fiscal_year") + 1).alias("year"),
        F.col("fiscal_period").alias("period_number"),
        (F.col("total_net_sales") * 1.03).alias("total_net_sales"),
    ).join(F.broadcast(cal), ["year", "period_number"])


def labor(spark: SparkSession, sf: str) -> DataFrame:
    """One row per sales line, under the store's other id."""
    return store_lines(spark, sf).select(
        (F.col("l_suppkey") + LABOR_ID_BASE).cast("string").alias("Labor_Store_Number"),
        F.col("_day").alias("work_date"),
        F.col("l_returnflag").alias("dept"),
        (F.col("l_quantity") * 0.1).alias("total_hours"),
    )
