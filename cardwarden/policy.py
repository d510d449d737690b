"""Thresholds, tiers and labels of every rule, as one immutable argument."""

from __future__ import annotations

from dataclasses import dataclass

Tiers = tuple[tuple[float, float], ...]
Levels = tuple[tuple[float, str], ...]


@dataclass(frozen=True)
class RiskPolicy:
    """Rule parameters. Tiers and levels are listed from the highest bound down.

    A tier applies when the input is strictly above its bound; a level applies when the
    score is at least its bound.
    """

    # Fixed values of the daily rules.
    day_transactions: int = 10
    day_cities: int = 3
    day_amount: float = 1000.0
    alert_levels: Levels = ((3, "CRITICAL"), (2, "HIGH"))
    alert_floor: str = "MODERATE"

    # Fixed values of the lifetime score.
    volume_tiers: Tiers = ((15, 25.0), (10, 20.0), (5, 10.0))
    city_tiers: Tiers = ((10, 25.0), (5, 20.0), (3, 10.0))
    amount_tiers: Tiers = ((5000, 20.0), (2000, 15.0), (1000, 10.0))
    error_tiers: Tiers = ((30, 30.0), (20, 25.0), (10, 15.0), (5, 10.0))
    score_levels: Levels = ((70, "CRITICAL"), (50, "HIGH"), (30, "MODERATE"), (15, "LOW"))
    score_floor: str = "NORMAL"
    high_risk_score: float = 50.0

    # Fewest transactions for a rate to be reported.
    min_tx_error_ratio: int = 10
    min_tx_card_rate: int = 5
    min_tx_client_rate: int = 10
    min_tx_category_rate: int = 50

    # Report sizes and the parameters of the extra reports.
    top_categories: int = 10
    top_suspicious: int = 10
    sample_rows: int = 100_000
    low_risk_rate: float = 1.0
    night_end_hour: int = 5
    high_amount: float = 200.0
    max_speed_kmh: float = 900.0

    # True takes the worst alert level of a card by the order below, fixed values that a plain
    # text maximum of other words for the levels gives, instead of by severity.
    lexical_level_max: bool = False
    lexical_order: tuple[str, ...] = ("HIGH", "MODERATE", "CRITICAL")

    def __post_init__(self) -> None:
        for name in (
            "alert_levels",
            "volume_tiers",
            "city_tiers",
            "amount_tiers",
            "error_tiers",
            "score_levels",
        ):
            bounds = [bound for bound, _ in getattr(self, name)]
            if any(upper <= lower for upper, lower in zip(bounds, bounds[1:])):
                raise ValueError(f"{name}: bounds must fall from one entry to the next")

    @property
    def level_names(self) -> tuple[str, ...]:
        """Score levels from the worst to the mildest."""
        return tuple(name for _, name in self.score_levels) + (self.score_floor,)
