"""Independent SQL for every query, used to compare results."""

from oracle.statements import STATEMENTS

__all__ = ["STATEMENTS"]
