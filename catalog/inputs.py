"""Feature table, cleaning, dimensions, splits and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import CFG, calendar, features, history, period_events, query
from tillcast.functions import casts, fiscal, keys, names
from tillcast.operators import calendar as cal_ops
from tillcast.operators import dims, peers, quality, splits
from tillcast.operators.features import gap_check
from tillcast.sources import sinks, tables
from tillcast.sources import testbed as tb
from tillcast.sources.staging import scratch, staged

STORE_PERIOD = "store_number:s fiscal_year:i fiscal_period:i"


@query(
    "feature_table",
    f"{STORE_PERIOD} event_date:d total_net_sales:4 total_net_sales_m1:4 adv_m1:4 CPI_m1:4 p13_sin:8 p13_cos:8 is_5w:1 super_bowl:1",
    """SELECT store_number, fiscal_year, fiscal_period, event_date, sales AS total_net_sales, sales_m1 AS total_net_sales_m1,
              adv_m1, cpi_m1 AS "CPI_m1", p13_sin, p13_cos, is_5w, sb AS super_bowl FROM feats""",
    "feats",
)
def feature_table(spark, sf):
    return features(spark, sf).withColumnRenamed("Super Bowl", "super_bowl")


@query(
    "excluded_stores",
    "store_number:s rows:b",
    """SELECT store_number, count(*) AS rows FROM sales
       WHERE ltrim(trim(store_number), '0') NOT IN ('1', '2') AND NOT (CAST(store_number AS INTEGER) BETWEEN 3 AND 5)
       AND store_number NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal < 0) GROUP BY 1""",
    "sales",
)
def excluded_stores(spark, sf):
    """Config list, numeric range, and a table-driven list matched on digits."""
    sales = tb.sales_period(spark, sf)
    kept = keys.drop_store_range(keys.drop_stores(sales, "store_number", CFG.exclude_stores), "store_number", 3, 5)
    listed = tb.table(spark, sf, "supplier").where("s_acctbal < 0")
    kept = keys.drop_stores_by_digits(kept, "store_number", listed, "s_suppkey")
    return kept.groupBy("store_number").agg(F.count("*").alias("rows"))


@query(
    "key_crosswalk",
    "store_number:s hm_key:s",
    """SELECT store_number, coalesce(hm, store_number) AS hm_key FROM (
         SELECT DISTINCT CAST(l_suppkey + 1000000000000 AS VARCHAR) AS store_number FROM lineitem
         UNION SELECT DISTINCT CAST(l_suppkey AS VARCHAR) FROM lineitem) x
       LEFT JOIN (SELECT k, min_by(hm, rk * 1000000000 + CAST(hm AS BIGINT)) AS hm FROM (
         SELECT CAST(s_suppkey + 1000000000000 AS VARCHAR) AS k, CAST(s_suppkey AS VARCHAR) AS hm, 0 AS rk FROM supplier
         UNION ALL SELECT CAST(s_suppkey AS VARCHAR), CAST(s_suppkey AS VARCHAR), 1 FROM supplier) GROUP BY k) m ON m.k = x.store_number""",
)
def key_crosswalk(spark, sf):
    li = tb.table(spark, sf, "lineitem")
    plain = li.select(F.col("l_suppkey").cast("string").alias("store_number")).distinct()
    prefixed = plain.select((F.col("store_number").cast("bigint") + tb.LABOR_ID_BASE).cast("string").alias("store_number"))
    mapping = dims.key_map(tb.hierarchy(spark, sf))
    return dims.attach_hm_key(prefixed.unionByName(plain).distinct(), mapping)


@query(
    "record_keys",
    "record_id:s event_time:b total_net_sales:4",
    """SELECT store_number || '_' || lpad(CAST(fiscal_year AS VARCHAR), 4, '0') || '_' || lpad(CAST(fiscal_period AS VARCHAR), 2, '0') AS record_id,
              epoch(event_date) AS event_time, sales AS total_net_sales FROM sales""",
    "sales",
)
def record_keys(spark, sf):
    return keys.with_record_keys(tb.sales_period(spark, sf), "store_number", "event_date", "fiscal_year", "fiscal_period")


@query(
    "header_promotion",
    "Store_Number:s Heatmap_Store_Number:s State:s",
    """SELECT CAST(s_suppkey + 1000000000000 AS VARCHAR) AS "Store_Number", CAST(s_suppkey AS VARCHAR) AS "Heatmap_Store_Number", n_name AS "State"
       FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def header_promotion(spark, sf):
    """A table that arrives with its column names as the first data row."""
    body = tb.hierarchy(spark, sf).select(
        F.col("Heatmap_Store_Number").cast("bigint").alias("_row"),
        F.col("Store_Number").alias("c0"), F.col("Heatmap_Store_Number").alias("c1"), F.col("State").alias("c2"),
    )
    header = spark.createDataFrame([(-1, "Store_Number", " Heatmap_Store_Number", "State")], body.schema)
    return tables.promote_header(header.unionByName(body), "_row")


@query(
    "column_aliases",
    "source:s store:s fiscal_year:i fiscal_period:i value:6",
    """SELECT 'budget' AS source, store_number AS store, fiscal_year + 1 AS fiscal_year, fiscal_period, sales * CAST(1.03 AS DOUBLE) AS value FROM sales WHERE fiscal_year < 2000
       UNION ALL SELECT 'forecast', store_number, fiscal_year, fiscal_period, sales FROM sales
       UNION ALL SELECT 'labor', CAST(l_suppkey + 1000000000000 AS VARCHAR), year(d), month(d), sum(l_quantity * CAST(0.1 AS DOUBLE)) FROM lines GROUP BY 1, 2, 3, 4""",
    "sales lines",
)
def column_aliases(spark, sf):
    """Budget, forecast and labor tables brought to standard names, whatever their own."""
    b = names.normalize_budget(tb.budget(spark, sf), keys.digits_key).selectExpr(
        "'budget' AS source", "store_key AS store", "fiscal_year", "fiscal_period", "budget_total_net_sales AS value"
    )
    f = names.normalize_forecast(
        tb.sales_period(spark, sf).withColumnRenamed("total_net_sales", "our_forecast")
    ).selectExpr("'forecast' AS source", "store_number AS store", "fiscal_year", "fiscal_period", "sales_forecast AS value")
    days = names.normalize_labor(tb.labor(spark, sf))
    lab = days.groupBy("store_number", F.year("event_date").alias("y"), F.month("event_date").alias("m")).agg(
        F.sum("hours").alias("value")
    ).selectExpr("'labor' AS source", "store_number AS store", "y AS fiscal_year", "m AS fiscal_period", "value")
    return b.unionByName(f).unionByName(lab)


@query(
    "latest_per_key",
    "l_suppkey:b l_partkey:b l_orderkey:b l_linenumber:i",
    """SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber FROM (
         SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS r FROM lineitem) WHERE r = 1""",
)
def latest_per_key(spark, sf):
    li = tb.table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber", "l_shipdate")
    return sinks.latest_per_key(li, "l_suppkey", ["l_shipdate", "l_orderkey", "l_linenumber"])


_KEYED = """SELECT store_number || '_' || lpad(CAST(fiscal_year AS VARCHAR), 4, '0') || '_' || lpad(CAST(fiscal_period AS VARCHAR), 2, '0') AS record_id,
              {0} AS event_time, fiscal_year, fiscal_period, {1} AS total_net_sales FROM sales"""


def _keyed(spark, sf):
    keyed = keys.with_record_keys(tb.sales_period(spark, sf), "store_number", "event_date", "fiscal_year", "fiscal_period")
    return keyed.select("record_id", "event_time", "fiscal_year", "fiscal_period", "total_net_sales")


@query(
    "feature_upsert",
    "record_id:s event_time:b fiscal_year:i fiscal_period:i total_net_sales:4",
    _KEYED.format(
        "epoch(event_date) + CASE WHEN fiscal_year >= 2000 AND fiscal_period > 6 THEN 60 ELSE 0 END",
        "CASE WHEN fiscal_year >= 2000 AND fiscal_period > 6 THEN 1.1 ELSE 1 END * sales",
    ),
    "sales",
)
def feature_upsert(spark, sf):
    """All records, a later correction of some, the same correction again, and an older batch that changes nothing."""
    path = scratch(spark, "features")
    all_rows = staged(_keyed(spark, sf))
    sinks.upsert_features(all_rows, path)
    fixed = all_rows.where("fiscal_year >= 2000 AND fiscal_period > 6").withColumns(
        {"event_time": F.col("event_time") + 60, "total_net_sales": F.col("total_net_sales") * 1.1}
    )
    stale = all_rows.where("fiscal_year >= 2001").withColumns({"event_time": F.col("event_time") - 60, "total_net_sales": F.lit(0.0)})
    for batch in (fixed, fixed.unionByName(fixed), stale):
        sinks.upsert_features(batch, path)
    return spark.read.schema(all_rows.schema).parquet(path)


@query(
    "feature_files",
    "store_number:s fiscal_year:i fiscal_period:i total_net_sales:4",
    "SELECT store_number, fiscal_year, fiscal_period, sales AS total_net_sales FROM sales",
    "sales",
)
def feature_files(spark, sf):
    """The Parquet feature sink, read back as engineered features whose store column has another name."""
    path = scratch(spark, "sales") + ".parquet"
    sinks.write_features(tb.sales_period(spark, sf).withColumnRenamed("store_number", "Store Number"), path)
    return tables.read_features(spark, path)


@query(
    "report_file",
    "store_number:s fiscal_year:i fiscal_period:i total_net_sales:4",
    "SELECT store_number, fiscal_year, fiscal_period, sales AS total_net_sales FROM sales",
    "sales",
)
def report_file(spark, sf):
    """A sorted CSV report, read back."""
    path = scratch(spark, "report")
    report = tb.sales_period(spark, sf).select("store_number", "fiscal_year", "fiscal_period", "total_net_sales")
    sinks.write_report(report, path, ["store_number", "fiscal_year", "fiscal_period"])
    return tables.read_any(spark, path + "/*.csv", "store_number string, fiscal_year int, fiscal_period int, total_net_sales double")


@query(
    "feature_definitions",
    "feature:s feature_type:s rows:b",
    """SELECT feature, feature_type, (SELECT count(*) FROM lineitem) AS rows FROM (VALUES
        ('l_orderkey', 'Integral'), ('l_partkey', 'Integral'), ('l_suppkey', 'String'), ('l_linenumber', 'Integral'),
        ('l_quantity', 'Fractional'), ('l_extendedprice', 'Fractional'), ('l_discount', 'Fractional'), ('l_tax', 'Fractional'),
        ('l_returnflag', 'String'), ('l_linestatus', 'String'), ('l_shipdate', 'Fractional')) v(feature, feature_type)""",
)
def feature_definitions(spark, sf):
    li = tb.table(spark, sf, "lineitem")
    defs = sinks.feature_definitions(li, "l_suppkey", "l_shipdate")
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(t).alias("feature_type")) for n, t in defs])
    return li.agg(F.count("*").alias("rows")).select("rows", F.inline(cells))


@query(
    "event_period_flags",
    "fiscal_year:i fiscal_period:i event_date:d super_bowl:i thanksgiving_eve:i store_rows:b",
    """SELECT e.fiscal_year, e.fiscal_period, e.beg AS event_date, e.sb AS super_bowl, e.te AS thanksgiving_eve, count(*) AS store_rows
       FROM evp e JOIN sales s ON s.event_date = e.beg GROUP BY 1, 2, 3, 4, 5""",
    "evp sales",
)
def event_period_flags(spark, sf):
    flags = period_events(spark).withColumnsRenamed({"Super Bowl": "super_bowl", "Thanksgiving Eve": "thanksgiving_eve"})
    counts = tb.sales_period(spark, sf).groupBy("event_date").agg(F.count("*").alias("store_rows"))
    return flags.join(counts, "event_date")


@query(
    "event_store_flags",
    f"{STORE_PERIOD} super_bowl:i",
    """SELECT store_number, s.fiscal_year, s.fiscal_period, coalesce(e.sb, 0) AS super_bowl FROM sales s LEFT JOIN evp e ON e.beg = s.event_date""",
    "sales evp",
)
def event_store_flags(spark, sf):
    """Events keyed by store and date, with repeats that must not fan out."""
    sales = tb.sales_period(spark, sf)
    per_store = sales.select("store_number", "event_date").join(period_events(spark), "event_date", "left")
    repeated = per_store.unionByName(per_store.withColumn("Super Bowl", F.lit(0)))
    flags, on = dims.super_bowl_flags(repeated, calendar(spark))
    return dims.attach_event_flags(sales, flags, on).withColumnRenamed("Super Bowl", "super_bowl")


@query(
    "cpi_fiscal",
    "fiscal_year:i fiscal_period:i CPI:4 stores:b total:4",
    """SELECT f.fiscal_year, f.fiscal_period, f.cpi AS "CPI", count(*) AS stores, sum(s.sales) / f.cpi AS total
       FROM cpif f JOIN sales s ON s.fiscal_year = f.fiscal_year AND s.fiscal_period = f.fiscal_period GROUP BY 1, 2, 3""",
    "cpif sales",
)
def cpi_fiscal(spark, sf):
    """Sales of each period in units of its price index."""
    cpi = dims.cpi_by_period(tb.cpi_wide(spark), calendar(spark))
    sums = tb.sales_period(spark, sf).groupBy("fiscal_year", "fiscal_period").agg(
        F.count("*").alias("stores"), F.sum("total_net_sales").alias("s")
    )
    return sums.join(cpi, ["fiscal_year", "fiscal_period"]).withColumn("total", F.col("s") / F.col("CPI"))


@query(
    "cpi_ffill_lag",
    f"{STORE_PERIOD} CPI_m1:4",
    """SELECT store_number, fiscal_year, fiscal_period, cpi_m1 AS "CPI_m1" FROM (
         SELECT s.*, last_value(CASE WHEN s.fiscal_period % 4 <> 0 THEN f.cpi END IGNORE NULLS) OVER (PARTITION BY store_number ORDER BY event_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cpi_m1
         FROM sales s JOIN cpif f ON s.fiscal_year = f.fiscal_year AND s.fiscal_period = f.fiscal_period)""",
    "sales cpif",
)
def cpi_ffill_lag(spark, sf):
    """Forward fill before the lag, with every fourth period's index missing."""
    from tillcast.operators.features import last_known_before, store_window

    cpi = dims.cpi_by_period(tb.cpi_wide(spark), calendar(spark)).withColumn(
        "CPI", F.when(F.col("fiscal_period") % 4 != 0, F.col("CPI"))
    )
    rows = tb.sales_period(spark, sf).join(F.broadcast(cpi), ["fiscal_year", "fiscal_period"])
    return rows.withColumn("CPI_m1", last_known_before("CPI", store_window(CFG)))


@query(
    "weather_long_join",
    f"{STORE_PERIOD} State:s avg_temp:4",
    """SELECT s.store_number, s.fiscal_year, s.fiscal_period, CASE WHEN st.state IS NULL THEN NULL ELSE 'Nation_' || substr(st.state, 8) END AS "State",
              arg_max(CAST(50 + n.n_nationkey + (k % 12 - 6) * (6 - k % 12) * 0.75 AS DOUBLE), k) AS avg_temp
       FROM sales s LEFT JOIN states st ON st.store_number = s.store_number
       LEFT JOIN nation n ON n.n_name = st.state
       LEFT JOIN cal c ON c.fiscal_year = s.fiscal_year AND c.fiscal_period = s.fiscal_period
       LEFT JOIN range(0, 84) t(k) ON last_day(make_date(1995 + k // 12, k % 12 + 1, 1)) BETWEEN c.beg AND c.fin
       GROUP BY 1, 2, 3, 4""",
    "sales states cal",
)
def weather_long_join(spark, sf):
    placed = dims.attach_state(tb.sales_period(spark, sf), tb.hierarchy(spark, sf), default=None)
    return dims.attach_weather(placed, dims.weather_by_period(tb.weather_wide(spark, sf), calendar(spark)))


@query(
    "interval_lookup",
    "o_orderkey:b fiscal_year:i fiscal_period:i",
    """SELECT o_orderkey, c.fiscal_year, c.fiscal_period FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders) o
       LEFT JOIN cal c ON o.d BETWEEN c.beg AND c.fin AND c.fiscal_year <> 1997""",
    "cal",
)
def interval_lookup(spark, sf):
    """Fiscal period of each order date; FY1997 is cut out so some dates have none."""
    orders = tb.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("event_date"))
    return cal_ops.map_dates(orders, calendar(spark).where("fiscal_year <> 1997"))


@query(
    "unmapped_dates",
    "o_orderstatus:s rows:b",
    """SELECT o_orderstatus, count(*) AS rows FROM orders o LEFT JOIN cal c ON CAST(o.o_orderdate AS DATE) BETWEEN c.beg AND c.fin AND c.fiscal_year <> 1997
       WHERE c.fiscal_year IS NULL GROUP BY 1""",
    "cal",
)
def unmapped_dates(spark, sf):
    orders = tb.table(spark, sf, "orders").select("o_orderstatus", F.to_date("o_orderdate").alias("event_date"))
    return quality.unmapped(cal_ops.map_dates(orders, calendar(spark).where("fiscal_year <> 1997")), "o_orderstatus")


@query(
    "calendar_misalignment",
    "store_number:s endingdate:d year:i",
    """SELECT store_number, c.fin - CASE WHEN c.fiscal_period = 4 THEN 1 ELSE 0 END AS endingdate, s.fiscal_year + 1 AS year
       FROM sales s JOIN cal c ON c.fiscal_year = s.fiscal_year + 1 AND c.fiscal_period = s.fiscal_period
       WHERE s.fiscal_year < 2000 AND c.fiscal_period = 4""",
    "sales cal",
)
def calendar_misalignment(spark, sf):
    """Budget rows whose end date is no period end; period 4 is shifted by a day to have some."""
    return cal_ops.misaligned(_shifted_budget(spark, sf), calendar(spark), "endingdate")


@query(
    "year_pairs",
    "year:i fiscal_year:i rows:b",
    """SELECT s.fiscal_year + 1 AS year, c.fiscal_year, count(*) AS rows FROM sales s
       JOIN cal c ON c.fiscal_year = s.fiscal_year + 1 AND c.fiscal_period = s.fiscal_period
       WHERE s.fiscal_year < 2000 AND c.fiscal_period <> 4 GROUP BY 1, 2""",
    "sales cal",
)
def year_pairs(spark, sf):
    return cal_ops.year_pairs(_shifted_budget(spark, sf), calendar(spark), "endingdate", "year")


def _shifted_budget(spark, sf):
    moved = F.when(F.col("period_number") == 4, F.date_sub("endingdate", 1)).otherwise(F.col("endingdate"))
    return tb.budget(spark, sf).withColumn("endingdate", moved)


@query(
    "data_quality",
    "column:s rows:b nulls:b low:s high:s",
    """SELECT 'event_date' AS "column", count(*) AS rows, count(*) - count(event_date) AS nulls, CAST(min(event_date) AS VARCHAR) AS low, CAST(max(event_date) AS VARCHAR) AS high FROM sales
       UNION ALL SELECT 'fiscal_year', count(*), count(*) - count(fiscal_year), CAST(min(fiscal_year) AS VARCHAR), CAST(max(fiscal_year) AS VARCHAR) FROM sales
       UNION ALL SELECT 'fiscal_period', count(*), count(*) - count(fiscal_period), CAST(min(fiscal_period) AS VARCHAR), CAST(max(fiscal_period) AS VARCHAR) FROM sales
       UNION ALL SELECT 'store_number', count(*), count(*) - count(store_number), min(store_number), max(store_number) FROM sales""",
    "sales",
)
def data_quality(spark, sf):
    return quality.column_health(tb.sales_period(spark, sf), ["event_date", "fiscal_year", "fiscal_period", "store_number"])


@query(
    "periods_per_year",
    "fiscal_year:i periods:b with_value:b",
    """SELECT fiscal_year, count(DISTINCT fiscal_period) AS periods, count(DISTINCT CASE WHEN fiscal_period <> 7 THEN fiscal_period END) AS with_value FROM sales GROUP BY 1""",
    "sales",
)
def periods_per_year(spark, sf):
    rows = tb.sales_period(spark, sf).withColumn("v", F.when(F.col("fiscal_period") != 7, F.col("total_net_sales")))
    return quality.periods_per_year(rows, "v")


@query(
    "value_counts",
    "o_orderstatus:s o_orderpriority:s rows:b",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS rows FROM orders GROUP BY 1, 2",
)
def value_counts(spark, sf):
    from tillcast.operators.rollups import value_counts as counts

    return counts(tb.table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@query(
    "store_profile",
    "store_number:s avg_net_sales:2 std_net_sales:2 cv_net_sales:6 log_avg_net_sales:6 n_periods:b State:s",
    """SELECT s.store_number, avg(sales) AS avg_net_sales, stddev_samp(sales) AS std_net_sales, stddev_samp(sales) / nullif(avg(sales), 0) AS cv_net_sales,
              ln(1 + avg(sales)) AS log_avg_net_sales, count(*) AS n_periods, min(state) AS "State" FROM sales s LEFT JOIN states USING (store_number) GROUP BY 1""",
    "sales states",
)
def store_profile(spark, sf):
    return peers.store_profile(dims.attach_state(tb.sales_period(spark, sf), tb.hierarchy(spark, sf), default=None))


@query(
    "state_mode",
    "store_number:s State:s",
    """SELECT store_number, state AS "State" FROM (
         SELECT CAST(l_suppkey AS VARCHAR) AS store_number, l_returnflag AS state, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_returnflag) AS r
         FROM lineitem GROUP BY l_suppkey, l_returnflag) WHERE r = 1""",
)
def state_mode(spark, sf):
    """Most frequent value of a state-like column per store, ties to the smallest."""
    li = tb.table(spark, sf, "lineitem")
    return dims.state_of_store(li.select(F.col("l_suppkey").alias("store_number"), F.col("l_returnflag").alias("state_name")))


@query(
    "history_cohorts",
    "store_number:s n_hist_periods:b cohort:s n_rows:b fiscal_duration:b",
    """SELECT c.*, n_rows, fiscal_duration FROM cohorts c JOIN (SELECT store_number, count(*) AS n_rows, count(DISTINCT event_date) AS fiscal_duration FROM hist GROUP BY 1) USING (store_number)""",
    "cohorts",
)
def history_cohorts(spark, sf):
    hist = history(spark, sf)
    return splits.history_cohorts(hist, tb.SHORT_BELOW).join(splits.history_length(hist), "store_number")


@query(
    "eval_coverage",
    "store_number:s n_eval_periods:b",
    """SELECT store_number, count(actual) AS n_eval_periods FROM (SELECT store_number, fiscal_year, fiscal_period, CASE WHEN actual > 300000 THEN actual END AS actual FROM hist)
       JOIN axis USING (fiscal_year, fiscal_period) GROUP BY 1 HAVING count(actual) > 0""",
    "hist axis",
)
def eval_coverage(spark, sf):
    """Actuals per store on the last six periods, with low sales blanked so counts differ."""
    hist = history(spark, sf).withColumn("actual", F.when(F.col("actual") > 300000, F.col("actual")))
    return splits.eval_coverage(hist, splits.last_axis(features(spark, sf)))


@query(
    "axis_last6",
    "fiscal_year:i fiscal_period:i label:s",
    """SELECT fiscal_year, fiscal_period, CAST(fiscal_year AS VARCHAR) || '-P' || CAST(fiscal_period AS VARCHAR) AS label FROM axis""",
    "axis",
)
def axis_last6(spark, sf):
    axis = splits.last_axis(features(spark, sf))
    return axis.withColumn("label", fiscal.period_label("fiscal_year", "fiscal_period"))


@query(
    "split_two_tier",
    f"{STORE_PERIOD} split:s",
    """SELECT store_number, fiscal_year, fiscal_period, CASE WHEN r > n - 6 AND n >= 18 THEN 'valid' WHEN r <= n - 6 AND n >= 12 THEN 'train' END AS split FROM ranked""",
    "ranked",
)
def split_two_tier(spark, sf):
    return splits.split_last_k(features(spark, sf), CFG)


@query(
    "holdout_last_k",
    f"{STORE_PERIOD} split:s",
    """SELECT store_number, fiscal_year, fiscal_period, CASE WHEN n >= 18 AND r > n - 6 THEN 'valid' WHEN n >= 12 THEN 'train' END AS split FROM ranked""",
    "ranked",
)
def holdout_last_k(spark, sf):
    return splits.split_last_k(features(spark, sf), CFG, train_rest=True)


@query(
    "origin_stability_split",
    "holdout:i split:s rows:b stores:b",
    """SELECT holdout, CASE WHEN r > n - holdout AND n >= 18 THEN 'valid' WHEN r <= n - holdout AND n >= 12 THEN 'train' END AS split, count(*) AS rows, count(DISTINCT store_number) AS stores
       FROM ranked, (VALUES (5), (6)) v(holdout) GROUP BY 1, 2""",
    "ranked",
)
def origin_stability_split(spark, sf):
    rows = splits.split_origins(features(spark, sf), [6, 5], CFG)
    per_store = rows.groupBy("holdout", "split", "store_number").agg(F.count("*").alias("n"))
    return per_store.groupBy("holdout", "split").agg(F.sum("n").alias("rows"), F.count("*").alias("stores"))


@query(
    "gap_check",
    f"{STORE_PERIOD} missing_periods:i",
    """SELECT store_number, fiscal_year, fiscal_period, m AS missing_periods FROM (
         SELECT *, fiscal_year * 13 + fiscal_period - lag(fiscal_year * 13 + fiscal_period) OVER (PARTITION BY store_number ORDER BY event_date) - 1 AS m
         FROM sales) WHERE m > 0""",
    "sales",
)
def gaps(spark, sf):
    """Stores without sales in a period: the positional lag skips it."""
    return gap_check(tb.sales_period(spark, sf), CFG)


@query(
    "sanitized_features",
    "store_number:s sales:4 ratio:6 share:6",
    """SELECT store_number, sales, coalesce(CASE WHEN adv = 0 THEN NULL ELSE sales / adv END, 0) AS ratio, coalesce(least(1, greatest(0, adv / nullif(sales, 0))), 0) AS share FROM sales""",
    "sales",
)
def sanitized_features(spark, sf):
    raw = tb.sales_period(spark, sf).selectExpr(
        "concat(' ', store_number, ' ') AS store_number", "CAST(total_net_sales AS STRING) AS sales",
        "IF(total_advertising = 0, double('Infinity'), total_net_sales / total_advertising) AS ratio",
        "total_advertising AS a", "total_net_sales AS s",
    ).withColumn("share", casts.clip(casts.ratio("a", "s"), 0.0, 1.0))
    return casts.sanitize_features(raw, ["ratio", "share"], "sales")


@query(
    "five_week_rules",
    f"{STORE_PERIOD} days_in_period:i is_5w:i weeks:i",
    """SELECT store_number, fiscal_year, fiscal_period, days AS days_in_period, is_5w, CAST(round_even(days / 7.0, 0) AS INTEGER) AS weeks FROM sales JOIN cal USING (fiscal_year, fiscal_period)""",
    "sales cal",
)
def five_week_rules(spark, sf):
    """Both five-week rules side by side on every store-period."""
    cal = calendar(spark).withColumn("weeks", cal_ops.rounded_weeks("days_in_period"))
    return cal_ops.attach_period_attributes(tb.sales_period(spark, sf), cal, "days_in_period", "is_5w", "weeks")
