"""Column references for names holding blanks, slashes, dots or parentheses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col_(name: str) -> Column:
    """``F.col`` for a top-level column whatever characters its name holds."""
    return F.col(quote(name))
