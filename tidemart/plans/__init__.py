from tidemart.plans.jobs import Pipeline, run_gold, run_hour, run_merge, run_snapshot
from tidemart.plans.late import run_late
from tidemart.plans.layers import open_table, publish
from tidemart.plans.marts import order_items_fact, product_dimension, qualifying_sales, sales_report

__all__ = [
    "Pipeline",
    "open_table",
    "order_items_fact",
    "product_dimension",
    "publish",
    "qualifying_sales",
    "run_gold",
    "run_hour",
    "run_late",
    "run_merge",
    "run_snapshot",
    "sales_report",
]
