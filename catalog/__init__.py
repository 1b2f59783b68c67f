"""Queries over the star-schema testbed, each with the same question in plain SQL as its check."""

from catalog.base import REGISTRY
from catalog import inputs, models, planning  # noqa: F401  (they fill the registry)

__all__ = ["REGISTRY"]
