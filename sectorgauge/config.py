"""Business parameters of a benchmarking run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# The published sectors and series.
PUBLISHED_SECTORS = ("ALL", "G", "F", "I", "N", "M69", "C")
PUBLISHED_KPIS = (
    "total_growth_lastyear",
    "positive_cash_flow_monthly",
    "positive_cash_flow_position",
    "d2c_30d_mean",
)


@dataclass(frozen=True)
class Settings:
    """One run. ``as_of`` stands for "today"; no operator reads the clock."""

    as_of: dt.date

    # ledger
    entry_from: str = "1984-01-01"
    entry_before: str = "2025-01-01"
    oldest_month: str = "2010-01"
    older_label: str = "2009-12"
    closing_type: str = "310"
    customer_code_min: int = 7
    model_code_min: int = 10
    levels: tuple[int, ...] = (4, 7)
    bad_codes: tuple[str, ...] = ("BVrd", "BLimKas")
    negative_limit: float = -0.1

    # invoices
    payment_method: str = "B"
    term_days: tuple[int, ...] = (30, 14)
    term_tolerance: int = 3

    # company KPIs and outliers
    kpi_start: str = "2012-01"
    min_group: int = 75
    low_quantile: float = 0.25
    high_quantile: float = 0.75
    inner_fence: float = 1.5
    outer_fence: float = 3.0
    lambda_limit: float = 64.0
    lambda_steps_per_unit: int = 20

    # peer groups above this many rows are ranked slice by slice
    hot_group_rows: int = 2_000_000
    rank_slices: int = 64

    # statement elements
    element_start: str = "2016-12"
    fin_year_max: int | None = 2019

    # peer medians of the ratios: by counts, or a sketch that combines in one pass
    exact_median: bool = False

    # sector aggregation
    cash_position_floor: float = 10000.0
    aggregate_lag_months: int = 1
    publish_lag_months: int = 3

    # series
    series_history: int = 60
    series_output: int = 39
    series_min_points: int = 24
    moving_season: bool = False
    trading_days: bool = False

    # serving
    sectors: tuple[str, ...] = PUBLISHED_SECTORS
    kpis: tuple[str, ...] = PUBLISHED_KPIS
    min_population: int = 75
    serve_history_months: int = 36
    serve_lag_months: int = 2
    recent_points: int = 12

    def month(self, offset: int = 0) -> str:
        """``yyyy-MM`` of ``as_of`` shifted by ``offset`` months."""
        n = self.as_of.year * 12 + self.as_of.month - 1 + offset
        return f"{n // 12:04d}-{n % 12 + 1:02d}"

    @property
    def element_last(self) -> str:
        """Last month of the element window: December of the ``as_of`` year."""
        return f"{self.as_of.year:04d}-12"
