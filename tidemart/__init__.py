"""Change-data-capture and warehouse building on Spark DataFrames."""

from tidemart.operators import asof_join, latest_per_key, upsert
from tidemart.plans import (
    Pipeline,
    open_table,
    order_items_fact,
    product_dimension,
    publish,
    qualifying_sales,
    run_gold,
    run_hour,
    run_late,
    run_merge,
    run_snapshot,
    sales_report,
)
from tidemart.registry import SHOP_TABLES, TableSpec, load_registry
from tidemart.session import build_session
from tidemart.slices import Slice, resolve_slice

__all__ = [
    "SHOP_TABLES",
    "Pipeline",
    "Slice",
    "TableSpec",
    "asof_join",
    "build_session",
    "latest_per_key",
    "load_registry",
    "open_table",
    "order_items_fact",
    "product_dimension",
    "publish",
    "qualifying_sales",
    "resolve_slice",
    "run_gold",
    "run_hour",
    "run_late",
    "run_merge",
    "run_snapshot",
    "sales_report",
    "upsert",
]
