"""All registered queries."""

from __future__ import annotations

from breachline.plans import (  # noqa: F401
    cleaning_queries,
    dashboard_queries,
    evaluation_queries,
    feature_queries,
    model_queries,
    quality_queries,
    source_queries,
)
from breachline.plans.registry import PLANS, SQL

__all__ = ["PLANS", "SQL"]
