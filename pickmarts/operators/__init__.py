"""Jobs on DataFrames: calendar, curation, and the data marts.

Every function takes DataFrames and returns a DataFrame; nothing is written here,
and nothing but the bounded cuts of hot orders (``positions.hot_cuts``) is collected.
"""

from pickmarts.operators.calendar_dim import create_d_date
from pickmarts.operators.common import DRILL_DOWNS
from pickmarts.operators.curation import (
    curate_pick_data,
    d_product_details,
    d_warehouse_section,
    duplicate_products,
    enrich,
    order_picks_fact,
    pick_errors_fact,
    returns_fact,
    with_order_key,
    with_position_key,
)
from pickmarts.operators.distribution import binned_order_volume, weekly_zscore_distribution, zscore_outliers
from pickmarts.operators.errors import pick_errors
from pickmarts.operators.families import (
    orders_processed_family,
    pick_errors_family,
    pick_volume_family,
    throughput_family,
    top_products_family,
)
from pickmarts.operators.orders import avg_products_picked_per_order, order_count_by_type, order_mix
from pickmarts.operators.positions import hot_cuts, running_position
from pickmarts.operators.throughput import pick_throughput_hourly, pick_throughput_weekly
from pickmarts.operators.top_products import top_n_products_weekly
from pickmarts.operators.utilization import warehouse_utilization_per_section
from pickmarts.operators.volume import total_orders_processed, total_pick_volume

__all__ = [
    "DRILL_DOWNS",
    "avg_products_picked_per_order",
    "binned_order_volume",
    "create_d_date",
    "curate_pick_data",
    "d_product_details",
    "d_warehouse_section",
    "duplicate_products",
    "enrich",
    "hot_cuts",
    "order_count_by_type",
    "order_mix",
    "order_picks_fact",
    "orders_processed_family",
    "pick_errors",
    "pick_errors_family",
    "pick_errors_fact",
    "pick_throughput_hourly",
    "pick_throughput_weekly",
    "pick_volume_family",
    "returns_fact",
    "running_position",
    "throughput_family",
    "top_n_products_weekly",
    "top_products_family",
    "total_orders_processed",
    "total_pick_volume",
    "warehouse_utilization_per_section",
    "weekly_zscore_distribution",
    "with_order_key",
    "with_position_key",
    "zscore_outliers",
]
