"""The full query catalogue: importing the q_* modules fills the registry."""

from __future__ import annotations

from logscope.plans import q_activity, q_geo, q_parse, q_reports, q_sinks, q_streams  # noqa: F401
from logscope.plans.registry import REGISTRY, QuerySpec


def all_queries() -> dict[str, QuerySpec]:
    return dict(REGISTRY)
