"""Every query of the relational engine with its oracle, gathered from the modules of this package."""

from __future__ import annotations

from lodeplane.plans import composites, entities, forms, fusion, history_and_series, landing, polygons, relational, scalar, selection, shapes, sources_and_quality, spatial, stores
from lodeplane.plans.base import ORACLES, QUERIES

FLAGSHIP = "latest_event_per_user"
__all__ = [
    "FLAGSHIP", "ORACLES", "QUERIES", "composites", "entities", "forms", "fusion", "history_and_series", "landing", "polygons", "relational", "scalar", "selection", "shapes", "sources_and_quality", "spatial", "stores",
]
