"""Business parameters. The defaults are those of the marketplace data set."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Settings:
    calendar_start: date = date(2016, 9, 1)
    calendar_end: date = date(2018, 11, 1)  # exclusive
    excluded_statuses: tuple[str, ...] = ("canceled", "unavailable")
    delivered_status: str = "delivered"
    first_sales_year: int = 2017
    last_sales_year: int = 2018
    home_state: str = "SP"
    valuable_from: float = 200.0  # spend from which a lapsed customer is 'Cant Lose'
    tiles: int = 5
    best_is_high: bool = False  # True gives tile 5 to the best customers instead of tile 1
    fence: float = 1.5
    histogram_cap: float = 2000.0
    histogram_bins: int = 60
    underserved_min_customers: int = 500
    underserved_top: int = 12
