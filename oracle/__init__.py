"""SQL counterparts of the registered queries, written from the rules rather than the code."""

from oracle.texts import ORACLE

__all__ = ["ORACLE"]
