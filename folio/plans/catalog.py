"""Import every query module so the registry is filled, then hand it out."""

from __future__ import annotations

import importlib

from folio.plans.registry import REGISTRY, Query

_MODULES = ["folio.plans.q_text", "folio.plans.q_images", "folio.plans.q_telemetry", "folio.plans.q_data", "folio.plans.q_layout", "folio.plans.q_misc", "folio.plans.q_extra"]


def registry() -> dict[str, Query]:
    for m in _MODULES:
        importlib.import_module(m)
    return dict(REGISTRY)
