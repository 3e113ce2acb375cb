"""All registered queries of the subpackage."""

from __future__ import annotations

from seriesloom.llm import classlm, decontam, jaccard, licenses, packing, periodic, quality, ranked, secrets, sharding, substrings, vectors, warc  # noqa: F401  (imports register the queries)
from seriesloom.llm.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
