"""A corpus-cleaning pipeline built from the corpus operators."""

from __future__ import annotations

from gleanery.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
