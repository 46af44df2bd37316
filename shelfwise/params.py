"""Parameters of the pipeline, kept apart from the operators that use them."""

from __future__ import annotations

from dataclasses import dataclass, field

CATEGORIES = ("FOODS", "HOBBIES", "HOUSEHOLD")
ABC_CLASSES = ("A", "B", "C")
XYZ_CLASSES = ("X", "Y", "Z")
PERISHABLE_CATEGORY = "FOODS"
SERIES_KEY = ("item_id", "store_id")

# Which benefit-day flag belongs to a state; any other state uses the fallback.
STATE_FLAGS = {"CA": "snap_CA", "TX": "snap_TX"}
FALLBACK_STATE_FLAG = "snap_WI"


@dataclass(frozen=True)
class TimeGrain:
    """Row spacing of a demand panel and the windows that follow from it."""

    name: str
    days: int
    lags: tuple[int, ...]
    rolling: tuple[int, ...]
    season: int
    recent: int
    tail: int
    horizon: int
    min_demands: int = 30


DAY = TimeGrain("day", 1, (28, 35, 42, 56, 364), (28, 56), season=7, recent=365, tail=28, horizon=28)
WEEK = TimeGrain("week", 7, (4, 5, 6, 8, 52), (4, 8), season=4, recent=52, tail=4, horizon=4)


@dataclass(frozen=True)
class PolicyParams:
    """Cost and service assumptions of the inventory operators (daily demand by default)."""

    holding_rate: float = 0.20
    order_cost: float = 5.0
    lead_time: int = 7
    periods_per_year: int = 365
    cover_periods: int = 14
    naive_lot: int = 30
    margin_rate: float = 0.30
    disposal_rate: float = 0.10
    stockouts_per_year: int = 12
    naive_fill_pct: float = 85.0
    service_levels: dict[str, float] = field(
        default_factory=lambda: {"A": 0.98, "B": 0.95, "C": 0.90}
    )
    default_service_level: float = 0.90
    budgets: dict[str, float] = field(
        default_factory=lambda: {
            "Tight_50K": 50_000.0,
            "Normal_100K": 100_000.0,
            "Relaxed_200K": 200_000.0,
        }
    )


DAILY_POLICY = PolicyParams()
WEEKLY_POLICY = PolicyParams(lead_time=1, periods_per_year=52, cover_periods=2)
