"""All queries of this subpackage: the operators' and the pipeline's."""

from corpus_pipeline import ORACLE_SQL, run

from docloom.llm.queries import ORACLES, QUERIES

QUERIES["pipeline"] = run
if ORACLE_SQL is not None:
    ORACLES["pipeline"] = ORACLE_SQL

__all__ = ["ORACLES", "QUERIES"]
