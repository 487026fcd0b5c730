"""Text-date expressions.

Source systems store dates as ``yyyyMMdd`` text with ``00000000`` meaning
"unset". Lexicographic order on that text equals date order, so window filters
may stay on the text; anything that needs a real date goes through
``text_to_date``, which maps the sentinel (and any malformed text) to NULL
instead of raising under ANSI mode.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values shared with the source systems.
TEXT_DATE_FORMAT = "yyyyMMdd"
UNSET_TEXT_DATE = "00000000"
OPEN_END = _dt.date(9999, 12, 31)


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_to_date(c: str | Column) -> Column:
    """``yyyyMMdd`` text -> DATE; sentinel or malformed text -> NULL."""
    return F.try_to_date(_c(c), TEXT_DATE_FORMAT)


def date_to_text(c: str | Column) -> Column:
    """DATE (or timestamp) -> ``yyyyMMdd`` text."""
    return F.date_format(_c(c), TEXT_DATE_FORMAT)


def to_text(d: _dt.date) -> str:
    """Python date -> ``yyyyMMdd`` literal, for building pushed-down filters."""
    return d.strftime("%Y%m%d")
