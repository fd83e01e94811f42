"""Everything that is registered; each plans module brings its own queries."""

from __future__ import annotations

import importlib

MODULES: tuple[str, ...] = ("market_plans", "candle_plans", "structure_plans", "join_plans", "clean_plans", "desk_plans", "extra_plans", "payload_plans", "rule_plans", "stream_plans", "catalyst_plans", "table_plans", "portfolio_plans", "input_plans", "calendar_plans")


def register_all(register) -> None:
    for name in MODULES:
        importlib.import_module(f"tapeloom.plans.{name}").register_all(register)
