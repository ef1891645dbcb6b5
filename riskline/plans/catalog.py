"""Import every catalog module so its queries register, then expose the registry."""

from __future__ import annotations

import importlib

from riskline.plans.registry import REGISTRY, Entry

_MODULES = (
    "riskline.plans.catalog_rules",
    "riskline.plans.catalog_features",
    "riskline.plans.catalog_ingest",
    "riskline.plans.catalog_ledger",
    "riskline.plans.catalog_metrics",
    "riskline.plans.catalog_ml",
    "riskline.plans.catalog_pipeline",
    "riskline.plans.catalog_streaming",
    "riskline.plans.catalog_io",
)

for _m in _MODULES:
    importlib.import_module(_m)


def entries() -> dict[str, Entry]:
    return dict(REGISTRY)


FLAGSHIP = "top_flagged_merchants"
