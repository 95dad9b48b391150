"""Sources and sinks: raw CSV staging, the driver-table adapter, Parquet layers."""

from pickmarts.sources.layers import CURATION, DATA_MART, STAGING, layer_path, read_table, write_table
from pickmarts.sources.staging import (
    read_pick_data,
    read_product_details,
    read_raw_csv,
    read_warehouse_sections,
    stage_pick_data,
    stage_product_details,
    stage_warehouse_sections,
)
from pickmarts.sources.tpch_adapter import picks_from_lineitem, products_from_part

__all__ = [
    "CURATION",
    "DATA_MART",
    "STAGING",
    "layer_path",
    "picks_from_lineitem",
    "products_from_part",
    "read_pick_data",
    "read_product_details",
    "read_raw_csv",
    "read_table",
    "read_warehouse_sections",
    "stage_pick_data",
    "stage_product_details",
    "stage_warehouse_sections",
    "write_table",
]
