"""All queries of this package, the pipeline included."""

from __future__ import annotations

import corpus_pipeline
from tidemark.llm.queries import ORACLES, QUERIES

QUERIES["pipeline"] = corpus_pipeline.run

__all__ = ["ORACLES", "QUERIES"]
