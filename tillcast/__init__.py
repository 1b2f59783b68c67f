"""tillcast: multi-store sales forecasting and planning as Spark DataFrame jobs."""

from tillcast.config import ForecastConfig

__all__ = ["ForecastConfig"]
