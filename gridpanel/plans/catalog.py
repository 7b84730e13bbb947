"""All registered queries (importing the query modules fills the registry)."""
from __future__ import annotations

from . import (q_assemble, q_calendar, q_enrich, q_history, q_io, q_models, q_normalise,  # noqa: F401
               q_profiles, q_quality, q_streams)
from .registry import REGISTRY


def queries():
    return {k: fn for k, (fn, _) in REGISTRY.items()}


def oracle_sql():
    return {k: sql for k, (_, sql) in REGISTRY.items() if sql}
