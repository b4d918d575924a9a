"""Model parameters, passed into plans as literals (never as a joined row)."""

from __future__ import annotations

from dataclasses import dataclass, field

# Statuses excluded from revenue, and the allowed status vocabulary.
EXCLUDED_STATUSES = ("canceled", "unavailable")
ALLOWED_STATUSES = (
    "delivered", "shipped", "canceled", "unavailable",
    "invoiced", "processing", "approved", "created",
)


@dataclass(frozen=True)
class InventoryParams:
    """Defaults of the inventory decision engine."""

    lead_time_months: float = 2.0
    z_service_level: float = 1.65
    coverage_months: float = 4.0
    overstock_multiple: float = 3.0
    dead_demand_threshold: float = 1.0
    margin_floor_pct: float = 10.0


@dataclass(frozen=True)
class ForecastParams:
    """Forecast eligibility, backtest and band settings."""

    min_active_months: int = 6
    min_total_units: int = 20
    holdout: int = 3
    horizon: int = 3
    z: float = 1.96
    min_len: int = 6
    seasonal_min_len: int = 24
    season_length: int = 12
    ma_window: int = 3
    # Month up to which every series runs, with zeros after its last sale: "yyyy-MM", "last" (the
    # data's last month), or None: each series ends with its own last sale. Later sales stay.
    as_of: str | None = None
    # (alpha, beta, gamma) to use as they are instead of searching; None searches.
    fixed_weights: tuple[float, float, float] | None = None


@dataclass(frozen=True)
class Params:
    inventory: InventoryParams = field(default_factory=InventoryParams)
    forecast: ForecastParams = field(default_factory=ForecastParams)
    excluded_statuses: tuple = EXCLUDED_STATUSES
    # None: split at the month halfway between the first and last valid month.
    split_month: str | None = None
    currency: str = "$"
    trust_currency: str = "R$"
    # Upper bound on rows for a dimension table to be broadcast.
    broadcast_max_rows: int = 200_000
