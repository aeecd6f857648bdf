"""From raw documents to packed training sequences; the stages are those of ``timeloom.llm.pipeline``."""

from timeloom.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
