"""All registered queries, gathered from the modules of this package."""

from __future__ import annotations

from textgrove.queries import evaluate, language, model, profile, sources, split, text, tokens, training  # noqa: F401
from textgrove.queries.common import QUERIES, SQL
from textgrove.queries.model import flagship

__all__ = ["QUERIES", "SQL", "flagship"]
