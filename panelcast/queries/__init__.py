"""One runnable query per operator, each with the SQL that must agree with it."""

from __future__ import annotations

from panelcast.queries import adjust, channel, conform, deliver, history, impute, price, project, rules, runs, transfer
from panelcast.queries.registry import REGISTRY

__all__ = [
    "REGISTRY", "adjust", "channel", "conform", "deliver", "history", "impute", "price", "project", "rules", "runs",
    "transfer",
]
