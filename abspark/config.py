"""Pipeline parameters.

Fixed values the results depend on (defaults of the analysed study):
start floor of tests and facts, minimum test length 7 days, significance
level 0.1, treatment-order share gate 0.01 (strictly above), opposite-delta
verdict threshold 0.33, share-of-treatment-orders edges 0.2 / 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PipelineConfig:
    start_floor: str = "2021-01-01"
    min_days: int = 7
    alpha: float = 0.1
    share_gate: float = 0.01
    opposite_threshold: float = 0.33
    share_low: float = 0.2
    share_high: float = 0.5
    # True: orders and session events must match a vertical type of the
    # test's target-group vendors; False: that filter is off.
    sub_vertical_filter: bool = True
    # Off by default = same results as the analysed study (see README).
    multi_vertical: bool = False
    exact_scheme_match: bool = False
    fix_profit_fallback: bool = False
    # Zone edges: straight lines in longitude and latitude, or great-circle
    # arcs (what the warehouse's geography type means).
    geodesic: bool = False
    # Exact Mann-Whitney p-value when one sample has at most this many
    # values and nothing is tied (normal approximation otherwise).
    exact_max_n: int = 8


# The fixtures derived from the star schema start in 1995.
FIXTURE_CONFIG = PipelineConfig(start_floor="1995-01-01")
