"""Registry of mart jobs (X2): one spec per output table.

A spec names the mart, its output family (sub-folder), the inputs it reads
and a builder ``(facts) -> DataFrame``. The full run and the driver queries
both iterate over this list, so a mart is defined once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from pickmarts.operators.common import DRILL_DOWNS
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
from pickmarts.operators.throughput import pick_throughput_hourly, pick_throughput_weekly
from pickmarts.operators.top_products import top_n_products_weekly
from pickmarts.operators.utilization import warehouse_utilization_per_section
from pickmarts.operators.volume import total_orders_processed, total_pick_volume


@dataclass(frozen=True)
class Facts:
    """Inputs of the marts: enriched picks, enriched errors, calendar."""

    f_order_picks: DataFrame
    f_pick_errors: DataFrame | None
    d_date: DataFrame


@dataclass(frozen=True)
class MartSpec:
    name: str
    family: str
    build: Callable[[Facts], DataFrame]
    # Reads product attributes (product_group): needs the enriched facts.
    needs_products: bool = False
    needs_errors: bool = False
    drill_down: str | None = None
    # Order of rows when a sorted file is asked for: column names, ascending
    # unless followed by " desc"; NULLs last.
    sort_by: tuple[str, ...] = field(default_factory=tuple)
    # Name of the written table where it differs from the mart's own.
    published: str | None = None
    # Shared pre-aggregated input a full run feeds it from
    # (``pickmarts.operators.mart_inputs``), or "facts".
    source: str = "facts"
    # Drill-down family (``FAMILIES``) it is a member of, if any.
    member_of: str | None = None

    @property
    def table(self) -> str:
        return self.published or self.name


# Drill-down families: all members from one pass, (facts, members) -> DataFrame.
FAMILIES: dict[str, Callable[[Facts, tuple], DataFrame]] = {
    "total_pick_volume": lambda f, m: pick_volume_family(f.f_order_picks, f.d_date, m),
    "total_orders_processed": lambda f, m: orders_processed_family(f.f_order_picks, f.d_date, m),
    "pick_errors": lambda f, m: pick_errors_family(f.f_order_picks, f.f_pick_errors, f.d_date, m),
    "top_n_products_weekly": lambda f, m: top_products_family(f.f_order_picks, f.d_date, m),
    "pick_throughput_weekly": lambda f, m: throughput_family(f.f_order_picks, f.d_date, m),
}


def _family(base: str, g: str | None) -> str:
    return base if g is None else f"{base}_{g}"


def _specs() -> list[MartSpec]:
    specs: list[MartSpec] = []
    for g in (None, *DRILL_DOWNS):
        gk = () if g is None else (g,)
        needs = g == "product_group"
        specs += [
            MartSpec(
                _family("total_pick_volume", g),
                "total_pick_volume",
                lambda f, g=g: total_pick_volume(f.f_order_picks, f.d_date, g),
                needs,
                sort_by=("date", *gk),
                member_of="total_pick_volume",
                drill_down=g,
                source="hourly_volume",
            ),
            MartSpec(
                _family("total_orders_processed", g),
                "total_orders_processed",
                lambda f, g=g: total_orders_processed(f.f_order_picks, f.d_date, g),
                needs,
                sort_by=("date", *gk),
                member_of="total_orders_processed",
                drill_down=g,
                source="order_days",
            ),
            MartSpec(
                _family("pick_errors", g),
                "pick_errors",
                lambda f, g=g: pick_errors(f.f_order_picks, f.f_pick_errors, f.d_date, g),
                needs,
                needs_errors=True,
                drill_down=g,
                sort_by=("date", *gk),
                member_of="pick_errors",
                source="hourly_volume",
            ),
            MartSpec(
                _family("top_n_products_weekly", g),
                "top_n_products_weekly",
                lambda f, g=g: top_n_products_weekly(f.f_order_picks, f.d_date, g),
                needs,
                sort_by=("week", *gk, "product_id"),
                member_of="top_n_products_weekly",
                drill_down=g,
                source="product_counts",
            ),
            MartSpec(
                _family("pick_throughput_weekly", g),
                "pick_throughput",
                lambda f, g=g: pick_throughput_weekly(f.f_order_picks, f.d_date, g),
                needs,
                sort_by=("week", *gk),
                member_of="pick_throughput_weekly",
                drill_down=g,
                source="hourly_volume",
                published=_family("pick_throughput", g) if g else None,
            ),
        ]
    specs += [
        MartSpec(
            "pick_throughput_hourly",
            "pick_throughput",
            lambda f: pick_throughput_hourly(f.f_order_picks),
            sort_by=("pick_date", "pick_hour"),
            source="hourly_volume",
            published="pick_throughput",
        ),
        MartSpec(
            "order_mix",
            "order_mix",
            lambda f: order_mix(f.f_order_picks),
            sort_by=("sk_order_id",),
            source="order_days",
        ),
        MartSpec(
            "avg_products_picked_per_order",
            "avg_products_picked_per_order",
            lambda f: avg_products_picked_per_order(f.f_order_picks, f.d_date),
            sort_by=("week",),
        ),
        MartSpec(
            "order_count_by_type",
            "order_count_by_type",
            lambda f: order_count_by_type(f.f_order_picks, f.d_date),
            sort_by=("week",),
            source="order_days",
        ),
        MartSpec(
            "warehouse_utilization_per_section",
            "warehouse_utilization_per_section",
            lambda f: warehouse_utilization_per_section(f.d_date, f.f_order_picks),
            sort_by=("week", "warehouse_section desc"),
            source="hourly_volume",
        ),
        MartSpec(
            "binned_order_volume",
            "binned_order_volume",
            lambda f: binned_order_volume(f.f_order_picks, f.d_date),
            sort_by=("date", "bins"),
            source="order_days",
        ),
        MartSpec(
            "weekly_zscore_distribution",
            "weekly_zscore_distribution",
            lambda f: weekly_zscore_distribution(f.f_order_picks, f.d_date),
            sort_by=("week", "sk_order_id"),
            source="order_days",
        ),
        MartSpec(
            "zscore_outliers",
            "weekly_zscore_distribution",
            lambda f: zscore_outliers(weekly_zscore_distribution(f.f_order_picks, f.d_date)),
            sort_by=("week", "sk_order_id"),
            source="order_days",
        ),
    ]
    return specs


MARTS: dict[str, MartSpec] = {s.name: s for s in _specs()}
