"""Future design rows, recursive forecasts and scenarios."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.config import SALES_LAG, ForecastConfig
from tillcast.functions.casts import col
from tillcast.functions.fiscal import advance, seasonality
from tillcast.operators.calendar import attach_period_attributes
from tillcast.operators.ridge import RidgeModel
from tillcast.operators.splits import last_row


def future_grid(
    history: DataFrame,
    cal: DataFrame,
    cfg: ForecastConfig = ForecastConfig(),
    horizon: int = 6,
    seed: str = "actual",
    carry: str = "lag",
    events: DataFrame | None = None,
    by_period: bool = False,
    min_rows: int = 0,
) -> DataFrame:
    """One design row per store (with min_rows of history) and step 1..horizon after its last row.

    seed   'actual' starts the sales lag at the last observed sales, 'lag' at that row's own lag.
    carry  'lag' keeps the last row's adv_m1 and CPI_m1; 'current' takes its advertising and CPI.
    events optional period flags; without them future event flags are 0.

    The steps are exploded per store after the only shuffle, so the rows stay placed by store.
    """
    last = last_row(history, cfg, by_period, min_rows)
    sources = {
        SALES_LAG: cfg.target if seed == "actual" else SALES_LAG,
        "adv_m1": "total_advertising" if carry == "current" else "adv_m1",
        "CPI_m1": "CPI" if carry == "current" else "CPI_m1",
    }
    picked = [
        (F.coalesce(col(src).cast("double"), F.lit(0.0)) if src in last.columns else F.lit(0.0)).alias(out)
        for out, src in sources.items()
    ]
    steps = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h")
    rows = last.select(cfg.store_col, F.col(cfg.fy).alias("_fy"), F.col(cfg.fp).alias("_fp"), *picked, steps)
    fy, fp = advance("_fy", "_fp", "h")
    rows = rows.withColumns({cfg.fy: fy, cfg.fp: fp}).drop("_fy", "_fp")
    rows = attach_period_attributes(rows, cal, "is_5w", "BeginningDate")
    rows = rows.withColumns({"is_5w": F.coalesce("is_5w", F.lit(0)), **seasonality(cfg.fp)})
    rows = rows.withColumnRenamed("BeginningDate", cfg.date_col)
    if events is not None:
        flags = [c for c in events.columns if c in cfg.feature_list]
        dim = events.groupBy(cfg.fy, cfg.fp).agg(*[F.max(col(f)).alias(f) for f in flags])
        rows = rows.join(F.broadcast(dim), [cfg.fy, cfg.fp], "left")
        rows = rows.withColumns({f: F.coalesce(col(f), F.lit(0)) for f in flags})
    return rows.withColumns({f: F.lit(0.0) for f in cfg.feature_list if f not in rows.columns})


def next_period_rows(history: DataFrame, cal: DataFrame, cfg: ForecastConfig = ForecastConfig(), **how) -> DataFrame:
    """The design row of the next period only."""
    grid = future_grid(history, cal, cfg, 1, **how)
    return grid.select(cfg.store_col, cfg.fy, cfg.fp, cfg.date_col, *[col(f) for f in cfg.feature_list])


def recursive_forecast(
    model: RidgeModel,
    grid: DataFrame,
    cfg: ForecastConfig = ForecastConfig(),
    update: bool = True,
    by: Sequence[str] = (),
) -> DataFrame:
    """Rolls a linear model along the grid: step h uses the forecast of step h-1 as its sales lag.

    Everything but the sales lag is known beforehand, so a step is base_h + w * previous. The steps
    of a store form one short array that is folded in place; the grid is already placed by store.
    With update=False the first lag is used for every step.
    """
    w = F.lit(model.weight(SALES_LAG))
    based = model.attach_effects(grid)
    base = model.linear(skip=[SALES_LAG]) + F.col("_effect")
    step = F.struct("h", cfg.fy, cfg.fp, base.alias("base"), col(SALES_LAG).cast("double").alias("seed"))
    keys = [cfg.store_col, *by]
    arrays = based.select(*keys, step.alias("s")).groupBy(*keys).agg(
        F.array_sort(F.collect_list("s")).alias("steps")
    )

    def roll(acc: Column, s: Column) -> Column:
        lag = F.coalesce(F.try_element_at(acc, F.lit(-1))["forecast"], s["seed"]) if update else s["seed"]
        out = F.struct(
            s["h"].alias("h"),
            s[cfg.fy].alias(cfg.fy),
            s[cfg.fp].alias(cfg.fp),
            (s["base"] + w * lag).alias("forecast"),
        )
        return F.concat(acc, F.array(out))

    empty = F.array().cast(f"array<struct<h:int,{cfg.fy}:int,{cfg.fp}:int,forecast:double>>")
    return arrays.select(*keys, F.inline(F.aggregate("steps", empty, roll)))


# ---- scenarios -------------------------------------------------------------------------------

@dataclass(frozen=True)
class Scenario:
    name: str
    sigmas: float  # CPI step = mean step + sigmas * its standard deviation
    ads: float  # multiplier on the advertising lag
    floor: bool = False  # keep the CPI step above minus the size of the mean step


# The three planning scenarios and the CPI look-back windows.
SCENARIOS = (
    Scenario("Baseline_MidCPI_FlatAds", 0.0, 1.00),
    Scenario("LowCPI_Ads-5%", -0.5, 0.95, floor=True),
    Scenario("HighCPI_Ads+10%", 0.5, 1.10),
)
MEAN_STEPS, SD_STEPS = 12, 24


def cpi_steps(df: DataFrame) -> DataFrame:
    """One row: mean of the last 12 CPI changes, sample deviation of the last 24, last level.

    Distinct periods first; what the window sees is as long as the calendar.
    """
    periods = df.where(F.col("CPI").isNotNull()).groupBy("fiscal_year", "fiscal_period").agg(F.max("CPI").alias("CPI"))
    order = ["fiscal_year", "fiscal_period"]
    up = Window.partitionBy(F.lit(1)).orderBy(*order)
    down = Window.partitionBy(F.lit(1)).orderBy(*[F.col(c).desc() for c in order])
    steps = periods.withColumns({"d": F.col("CPI") - F.lag("CPI").over(up), "back": F.row_number().over(down)})
    return steps.agg(
        F.avg(F.when(F.col("back") <= MEAN_STEPS, F.col("d"))).alias("mu"),
        F.stddev_samp(F.when(F.col("back") <= SD_STEPS, F.col("d"))).alias("sigma"),
        F.max(F.when(F.col("back") == 1, F.col("CPI"))).alias("last_cpi"),
    )


def cpi_paths(df: DataFrame, horizon: int = 6, scenarios: Sequence[Scenario] = SCENARIOS) -> DataFrame:
    """(scenario, h, CPI, CPI_m1, ad_multiplier): straight CPI paths from the last level."""
    mu, sigma = F.col("mu"), F.coalesce("sigma", F.lit(0.0))

    def step(s: Scenario) -> Column:
        raw = mu + s.sigmas * sigma if s.sigmas else mu
        return F.greatest(raw, -F.abs(mu)) if s.floor else raw

    rows = F.array(*[
        F.struct(F.lit(s.name).alias("scenario"), step(s).alias("step"), F.lit(s.ads).alias("ad_multiplier"))
        for s in scenarios
    ])
    hs = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h")
    each = cpi_steps(df).select("last_cpi", F.inline(rows)).select("*", hs)
    return each.select(
        "scenario",
        "h",
        (F.col("last_cpi") + F.col("h") * F.col("step")).alias("CPI"),
        (F.col("last_cpi") + (F.col("h") - 1) * F.col("step")).alias("CPI_m1"),
        "ad_multiplier",
    )


def scenario_grid(grid: DataFrame, paths: DataFrame) -> DataFrame:
    """Every grid row once per scenario, with the scenario's CPI lag and scaled advertising."""
    return (
        grid.drop("CPI_m1")
        .join(F.broadcast(paths.drop("CPI")), "h")
        .withColumn("adv_m1", F.col("adv_m1") * F.col("ad_multiplier"))
        .drop("ad_multiplier")
    )


def scenario_forecast(
    model: RidgeModel, grid: DataFrame, paths: DataFrame, cfg: ForecastConfig = ForecastConfig()
) -> DataFrame:
    return recursive_forecast(model, scenario_grid(grid, paths), cfg, by=["scenario"])
