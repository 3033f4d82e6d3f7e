"""Named parameters with their defaults."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

# Limits and defaults that results depend on.
LIMIT_PER_CITY = 200
FILL_TARGET_PER_CITY = 120
MIN_TOPUP_LIMIT = 20
BUDGET_USD = Decimal("100.00")
RESERVE_PCT = Decimal("10.0")
SOURCE_2_UNIT_COST = Decimal("0.02")
SOURCE_1_UNIT_COST = Decimal("0.00")
SOURCE_2_CALL_CAP = 1000
SOURCE_1_CALL_CAP = 4500
SOURCE_1_WARN_AT = 4000
PAGES_PER_HOST = 5
CANDIDATE_PAGES = 12
MAX_ERROR_RUN = 3
DELAY_BASE_SECONDS = 1.0
BACKOFF_INITIAL_SECONDS = 2
BACKOFF_CAP_SECONDS = 60
ROBOTS_TTL_SECONDS = 3600
FAIL_ALERT_PCT = 15.0
PROGRESS_EVERY = 50
URLS_PER_CELL = 5
JOB_CLUES_PER_ROW = 5
SEARCH_NAME_CHARS = 80
JOB_CONFIDENCE = 0.8
EVIDENCE_PER_SITE = 3
EVIDENCE_PER_HOST = 5
TOP_VENDORS = 15
TOP_CLUES = 10
TOP_SITES = 10
STRONG_WEIGHT = 5
WEAK_WEIGHT = 1


@dataclass(frozen=True)
class CallBudget:
    """Call cap of a paid source: what the budget allows, at most the hard cap.

    Money is DECIMAL throughout: 90.00 / 0.02 is exactly 4500 calls. A budget of zero allows no calls.
    """

    budget: Decimal = BUDGET_USD
    reserve_pct: Decimal = RESERVE_PCT
    unit_cost: Decimal = SOURCE_2_UNIT_COST
    hard_cap: int = SOURCE_2_CALL_CAP

    @property
    def usable(self) -> Decimal:
        kept = max(Decimal(0), 1 - self.reserve_pct / 100)
        return max(Decimal(0), self.budget) * kept

    @property
    def cap(self) -> int:
        if self.unit_cost <= 0:
            return self.hard_cap
        return min(int(self.usable // self.unit_cost), self.hard_cap)
