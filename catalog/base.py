"""Registry, output shaping, and the shared SQL views of the check queries.

A column spec such as "store_number:s fiscal_year:i sales:4" names, types and rounds the output the
same way on both sides: s text, i integer, b bigint, d date, a digit a double with so many decimals.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.config import FEATURES
from tillcast.functions.names import normalize_history
from tillcast.operators import dims
from tillcast.operators.calendar import prepare_calendar
from tillcast.operators.features import build_feature_table
from tillcast.sources import testbed as tb
from tillcast.sources.staging import staged

CFG = tb.CFG


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}

_SPARK_TYPES = {"s": "string", "i": "int", "b": "bigint", "d": "date"}
_SQL_TYPES = {"s": "VARCHAR", "i": "INTEGER", "b": "BIGINT", "d": "DATE"}


def _columns(spec: str) -> list[tuple[str, str]]:
    return [tuple(part.rsplit(":", 1)) for part in spec.split()]


def shaped(df: DataFrame, spec: str) -> DataFrame:
    out = [
        f"CAST(`{c}` AS {_SPARK_TYPES[t]}) AS `{c}`" if t in _SPARK_TYPES
        else f"round(CAST(`{c}` AS DOUBLE), {t}) AS `{c}`"
        for c, t in _columns(spec)
    ]
    return df.selectExpr(*out)


def shaped_sql(body: str, spec: str, views: str) -> str:
    def cell(c: str, t: str) -> str:
        if t in _SQL_TYPES:
            return f'CAST("{c}" AS {_SQL_TYPES[t]}) AS "{c}"'
        r = f'round(CAST("{c}" AS DOUBLE), {t})'
        return f'CASE WHEN {r} = 0 THEN CAST(0 AS DOUBLE) ELSE {r} END AS "{c}"'

    cells = ", ".join(cell(c, t) for c, t in _columns(spec))
    return f"{with_views(views)} SELECT {cells} FROM ({body}) AS _q"


def query(name: str, spec: str, sql: str | None = None, views: str = ""):
    """Registers a function; `views` lists the shared SQL views its check uses."""

    def add(fn):
        text = shaped_sql(sql, spec, views) if sql is not None else None
        REGISTRY[name] = Query(lambda spark, sf: shaped(fn(spark, sf), spec), text)
        return fn

    return add


# ---- shared inputs on the Spark side ---------------------------------------------------------

def calendar(spark: SparkSession) -> DataFrame:
    return prepare_calendar(tb.fiscal_calendar(spark))


def period_events(spark: SparkSession) -> DataFrame:
    return dims.events_by_period(tb.events(spark), calendar(spark), ["Super Bowl", "Thanksgiving Eve"])


def features(spark: SparkSession, sf: str, keep: tuple[str, ...] = (), cfg=CFG, sales: DataFrame | None = None) -> DataFrame:
    """From `sales` where a query has staged them for other steps as well."""
    return build_feature_table(
        tb.sales_period(spark, sf) if sales is None else sales, tb.fiscal_calendar(spark), cfg, period_events(spark), tb.cpi_wide(spark), keep=keep
    )


def stored_features(spark: SparkSession, sf: str, sales: DataFrame | None = None) -> DataFrame:
    """The feature table written once, for queries that fit and score."""
    return staged(features(spark, sf, sales=sales))


def history(spark: SparkSession, sf: str, sales: DataFrame | None = None) -> DataFrame:
    """Observed sales of the stores that are not excluded."""
    return normalize_history(tb.sales_period(spark, sf) if sales is None else sales).where(~F.col("store_number").isin("1", "2"))


# ---- shared views on the SQL side ------------------------------------------------------------

FEATURE_SQL = ["sales_m1", "adv_m1", "cpi_m1", "p13_sin", "p13_cos", "is_5w", "sb"]
assert len(FEATURE_SQL) == len(FEATURES)

_MONEY = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_DISC = "CAST(round(l_discount * 100) AS BIGINT)"

VIEWS: dict[str, tuple[str, str]] = {
    "cal": ("", """
        SELECT CAST(1995 + i // 13 AS INTEGER) AS fiscal_year, CAST(i % 13 + 1 AS INTEGER) AS fiscal_period,
               CAST(DATE '1995-01-01' + CAST(28 * i + CASE WHEN i > 51 THEN 7 ELSE 0 END AS INTEGER) AS DATE) AS beg,
               CAST(DATE '1995-01-01' + CAST(28 * i + 27 + CASE WHEN i >= 51 THEN 7 ELSE 0 END AS INTEGER) AS DATE) AS fin,
               CASE WHEN i = 51 THEN 35 ELSE 28 END AS days, CASE WHEN i = 51 THEN 1 ELSE 0 END AS is_5w, i
        FROM range(0, 104) t(i)"""),
    "lines": ("", """
        SELECT *, CAST(l_shipdate AS DATE) AS d FROM lineitem"""),
    "sales": ("cal lines", f"""
        SELECT CAST(l_suppkey AS VARCHAR) AS store_number, c.beg AS event_date, c.fiscal_year, c.fiscal_period,
               CAST(sum({_MONEY} * (100 - {_DISC})) AS DOUBLE) / CAST(10000 AS DOUBLE) AS sales,
               CAST(sum({_MONEY} * {_DISC}) AS DOUBLE) / CAST(10000 AS DOUBLE) AS adv
        FROM lines JOIN cal c ON d BETWEEN c.beg AND c.fin GROUP BY 1, 2, 3, 4"""),
    "salesx": ("cal lines", f"""
        SELECT CAST(l_suppkey AS VARCHAR) AS store_number, c.beg AS event_date, c.fiscal_year, c.fiscal_period,
               CAST(sum({_MONEY} * (100 - {_DISC})) AS DOUBLE) / CAST(10000 AS DOUBLE) AS sales,
               CAST(sum({_MONEY} * {_DISC}) AS DOUBLE) / CAST(10000 AS DOUBLE) AS adv,
               CAST(sum({_MONEY} * CAST(round(l_tax * 100) AS BIGINT)) AS DOUBLE) / CAST(10000 AS DOUBLE) AS dlv,
               CAST(sum(CAST(l_quantity AS BIGINT) * CAST(round(p_retailprice * 100) AS BIGINT)) AS DOUBLE) / CAST(10000 AS DOUBLE) AS food,
               CAST(sum(CAST(l_quantity AS BIGINT) * 20) AS DOUBLE) AS labor
        FROM lines JOIN cal c ON d BETWEEN c.beg AND c.fin JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3, 4"""),
    "ev": ("", """
        SELECT event_date, sb, te FROM (
          SELECT y, CAST(f + CAST((7 - dayofweek(f)) % 7 AS INTEGER) AS DATE) AS bowl, CAST(n + CAST((11 - dayofweek(n)) % 7 + 20 AS INTEGER) AS DATE) AS thanks
          FROM (SELECT y, make_date(y, 2, 1) AS f, make_date(y, 11, 1) AS n FROM range(1995, 2003) t(y)))
        , LATERAL (VALUES (bowl, 1, 0), (CAST(bowl + 1 AS DATE), 0, 0), (thanks, 0, 1)) v(event_date, sb, te)"""),
    "evp": ("cal ev", """
        SELECT c.fiscal_year, c.fiscal_period, c.beg, max(sb) AS sb, max(te) AS te
        FROM ev JOIN cal c ON ev.event_date BETWEEN c.beg AND c.fin GROUP BY 1, 2, 3"""),
    "cpim": ("", """
        SELECT last_day(make_date(1995 + k // 12, k % 12 + 1, 1)) AS cal_month,
               coalesce(last_value(v IGNORE NULLS) OVER (ORDER BY k), first_value(v IGNORE NULLS) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS cpi
        FROM (SELECT k, CASE WHEN k < 80 THEN CAST(150 AS DOUBLE) + CAST(0.4 AS DOUBLE) * k END AS v FROM range(0, 84) t(k))"""),
    "cpif": ("cal cpim", """
        SELECT c.fiscal_year, c.fiscal_period, m.cpi FROM cal c LEFT JOIN cpim m ON m.cal_month = last_day(c.fin)"""),
    "kept": ("sales", "SELECT * FROM sales WHERE store_number NOT IN ('1', '2')"),
    "feats0": ("kept cal evp cpif", """
        SELECT s.store_number, s.event_date, s.fiscal_year, s.fiscal_period, s.sales, s.adv, f.cpi,
               lag(s.sales) OVER w AS sales_m1, coalesce(lag(s.adv) OVER w, 0) AS adv_m1,
               coalesce(last_value(f.cpi IGNORE NULLS) OVER (PARTITION BY s.store_number ORDER BY s.event_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cpi_m1,
               sin(2 * pi() * s.fiscal_period / 13) AS p13_sin, cos(2 * pi() * s.fiscal_period / 13) AS p13_cos,
               CAST(c.is_5w AS DOUBLE) AS is_5w, CAST(coalesce(e.sb, 0) AS DOUBLE) AS sb, CAST(coalesce(e.te, 0) AS DOUBLE) AS te
        FROM kept s JOIN cal c USING (fiscal_year, fiscal_period)
        LEFT JOIN evp e ON e.beg = s.event_date LEFT JOIN cpif f ON f.fiscal_year = s.fiscal_year AND f.fiscal_period = s.fiscal_period
        WINDOW w AS (PARTITION BY s.store_number ORDER BY s.event_date)"""),
    "feats": ("feats0", "SELECT * FROM feats0 WHERE sales IS NOT NULL AND sales_m1 IS NOT NULL"),
    "states": ("", "SELECT CAST(s_suppkey AS VARCHAR) AS store_number, n_name AS state FROM supplier JOIN nation ON s_nationkey = n_nationkey"),
    "hist": ("kept", "SELECT store_number, event_date, fiscal_year, fiscal_period, sales AS actual FROM kept"),
    "cohorts": ("hist", f"""
        SELECT store_number, count(DISTINCT fiscal_year * 100 + fiscal_period) AS n_hist_periods,
               CASE WHEN count(DISTINCT fiscal_year * 100 + fiscal_period) >= {tb.SHORT_BELOW} THEN 'long' ELSE 'short' END AS cohort
        FROM hist GROUP BY 1"""),
    "axis": ("feats", "SELECT DISTINCT fiscal_year, fiscal_period FROM feats ORDER BY fiscal_year DESC, fiscal_period DESC LIMIT 6"),
    "ranked": ("feats", """
        SELECT *, row_number() OVER (PARTITION BY store_number ORDER BY event_date) AS r, count(*) OVER (PARTITION BY store_number) AS n FROM feats"""),
}


def with_views(names: str) -> str:
    """WITH clause of the named views and everything they need, in order."""
    done: dict[str, str] = {}

    def need(name: str) -> None:
        if name not in done:
            deps, body = VIEWS[name]
            for d in deps.split():
                need(d)
            done[name] = body

    for n in names.split():
        need(n)
    if not done:
        return ""
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({b})" for n, b in done.items())


def view(name: str, deps: str, body: str) -> str:
    VIEWS[name] = (deps, body)
    return name


def _elimination(name: str, p: int, key: str = "") -> None:
    """View <name>_t: solution list t of the augmented matrix in <name>_a (Gauss-Jordan), per key if given."""
    k, by = (f"{key}, ", f" GROUP BY {key}") if key else ("", "")
    view(f"{name}_m", f"{name}_a", f"SELECT {k}list(r ORDER BY j) AS m FROM (SELECT {k}j, list(v ORDER BY k) AS r FROM {name}_a GROUP BY {k}j){by}")
    view(f"{name}_e", f"{name}_m", f"""
        SELECT {k}1 AS k, m FROM {name}_m UNION ALL
        SELECT {k}k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / r[k])
            ELSE list_transform(r, lambda v, c: v - r[k] * m[k][c] / m[k][k]) END)
        FROM {name}_e WHERE k <= {p + 1}""")
    view(f"{name}_t", f"{name}_e", f"SELECT {k}list_transform(m, lambda r: r[{p + 2}]) AS t FROM {name}_e WHERE k = {p + 2}")


def _products(name: str, rows: str, cols: list[str], where: str) -> None:
    """Views <name>_z (inputs as a list) and <name>_g (sums of products per store)."""
    p = len(cols)
    z = ", ".join(["CAST(1 AS DOUBLE)", *cols, "sales"])
    view(f"{name}_z", rows, f"SELECT store_number, [{z}] AS z FROM {rows} WHERE {where}")
    view(f"{name}_g", f"{name}_z", f"""
        SELECT store_number, j, k, sum(z[j] * z[k]) AS q
        FROM {name}_z, range(1, {p + 3}) a(j), range(1, {p + 3}) b(k) GROUP BY 1, 2, 3""")


def solo_ridge_views(name: str, rows: str, cols: list[str], alpha: float, where: str = "TRUE") -> str:
    """View <name>_t: each store's own ridge."""
    p = len(cols)
    _products(name, rows, cols, where)
    view(f"{name}_a", f"{name}_g", f"""
        SELECT store_number, j, k, q + CASE WHEN j = k AND j > 1 THEN {alpha} ELSE 0 END AS v FROM {name}_g WHERE j <= {p + 1}""")
    _elimination(name, p, "store_number")
    return f"{name}_t"


def ridge_views(
    name: str, rows: str, cols: list[str], alpha: float, where: str = "TRUE", standardized: bool = False
) -> str:
    """Views <name>_t (solution) and <name>_d (store effects) of a pooled ridge, by elimination in SQL."""
    p = len(cols)
    _products(name, rows, cols, where)
    total = f"(SELECT count(*) FROM {name}_z)"
    shrink = f"{alpha} * n.s / {total} * (1 - n.s / {total})" if standardized else f"{alpha}"
    penalty = f"{alpha} * max(v.sd2)" if standardized else f"{alpha}"
    view(f"{name}_s", f"{name}_g", f"SELECT store_number, k, q AS s FROM {name}_g WHERE j = 1")
    view(f"{name}_v", f"{name}_z", f"SELECT j, var_pop(z[j]) AS sd2 FROM {name}_z, range(1, {p + 3}) a(j) GROUP BY 1")
    view(f"{name}_a", f"{name}_s {name}_v", f"""
        SELECT g.j, g.k, sum(g.q - CASE WHEN g.store_number <> (SELECT min(store_number) FROM {name}_z)
                 THEN sj.s * sk.s / (n.s + {shrink}) ELSE 0 END)
               + CASE WHEN g.j = g.k AND g.j BETWEEN 2 AND {p + 1} THEN {penalty} ELSE 0 END AS v
        FROM {name}_g g JOIN {name}_s sj ON sj.store_number = g.store_number AND sj.k = g.j
        JOIN {name}_s sk ON sk.store_number = g.store_number AND sk.k = g.k
        JOIN {name}_s n ON n.store_number = g.store_number AND n.k = 1 JOIN {name}_v v ON v.j = g.j
        WHERE g.j <= {p + 1} GROUP BY g.j, g.k""")
    _elimination(name, p)
    view(f"{name}_d", f"{name}_t {name}_s", f"""
        SELECT n.store_number, n.s AS n,
               CASE WHEN n.store_number = (SELECT min(store_number) FROM {name}_z) THEN 0
                    ELSE (SELECT max(CASE WHEN s.k = {p + 2} THEN s.s END) - sum(CASE WHEN s.k <= {p + 1} THEN s.s * t[s.k] ELSE 0 END)
                          FROM {name}_s s WHERE s.store_number = n.store_number) / (n.s + {shrink}) END AS effect
        FROM {name}_s n, {name}_t WHERE n.k = 1""")
    return f"{name}_t {name}_d"


def ridge_line(name: str, cols: list[str], skip: tuple[str, ...] = ()) -> str:
    """SQL text: prediction without the store effect, from the solution list t."""
    parts = ["t[1]"] + [f"t[{i + 2}] * {c}" for i, c in enumerate(cols) if c not in skip]
    return " + ".join(parts)
