"""Retail order analytics as composable Spark DataFrame operators."""

from orderlens.params import Params
from orderlens.sources.tables import Shop

__all__ = ["Params", "Shop"]
