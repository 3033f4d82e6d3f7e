"""All registered queries."""

from __future__ import annotations

from . import q_io, q_listings, q_log, q_sites, q_summary, q_urls  # noqa: F401
from . import q_streaming  # noqa: F401  (after the batch queries whose SQL it reuses)
from .registry import ORACLE, QUERIES  # noqa: F401
