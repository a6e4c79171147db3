"""What the driver contract adds when this subpackage is there."""

from __future__ import annotations

import corpus_pipeline
from eventstrata.llm import queries

REGISTRY = {**queries.REGISTRY, "pipeline": corpus_pipeline.run}
EXPECTED = dict(queries.EXPECTED)
if corpus_pipeline.ORACLE_SQL is not None:
    EXPECTED["pipeline"] = corpus_pipeline.ORACLE_SQL
