"""Registered queries: one per operator, each with the SQL that states its expected result."""

from __future__ import annotations

from aislewatch.catalogue import (  # noqa: F401  (importing a module registers its queries)
    q_sources,
    q_html,
    q_json,
    q_urls,
    q_text,
    q_price,
    q_stock,
    q_validity,
    q_images,
    q_matching,
    q_enrich,
)
from aislewatch.catalogue.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
