"""Importing the operator modules fills QUERIES and ORACLES."""

from __future__ import annotations

from . import hilbert_ann, jaccard, language_id, mixing, periodic_runs, pieces, pivot_index, quality_rules, secrets, sharding, token_records, url_filter, whitening  # noqa: F401
from .common import ORACLES, QUERIES  # noqa: F401
