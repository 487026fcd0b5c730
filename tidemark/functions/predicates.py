"""Null-aware predicates used by the rules.

Source rules treat ``''`` and NULL as "absent" in some places and not in
others, so every rule is written with the primitive it used; these helpers
only name the two recurring shapes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: str | Column, string_typed: bool = True) -> Column:
    """Value is not NULL and (for strings) not ``''``."""
    c = _c(c)
    return (c != F.lit("")) & c.isNotNull() if string_typed else c.isNotNull()


def absent(c: str | Column, string_typed: bool = True) -> Column:
    """Value is NULL or (for strings) ``''``."""
    c = _c(c)
    return c.isNull() | (c == F.lit("")) if string_typed else c.isNull()


def is_string(df, name: str) -> bool:
    return isinstance(df.schema[name].dataType, StringType)


def any_equal(c: str | Column, values) -> Column:
    """``c = v1 OR c = v2 ...``; NULL when ``c`` is NULL, like the OR chain it replaces."""
    return _c(c).isin(list(values))
