"""Readers, writers, and the mapping of input tables to retail entities."""

from orderlens.sources.commerce import SALES_PARAMS, shop_from_sales_tables
from orderlens.sources.scratch import run_folder, shared_folder, written
from orderlens.sources.tables import (
    RAW_SCHEMAS,
    Shop,
    latest_version,
    read_shop,
    read_table,
    write_bucketed,
    write_table,
)

__all__ = [
    "RAW_SCHEMAS",
    "SALES_PARAMS",
    "Shop",
    "latest_version",
    "read_shop",
    "read_table",
    "run_folder",
    "shared_folder",
    "shop_from_sales_tables",
    "write_bucketed",
    "write_table",
    "written",
]
