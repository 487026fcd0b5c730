from tidemark.functions.dates import (
    OPEN_END,
    TEXT_DATE_FORMAT,
    UNSET_TEXT_DATE,
    date_to_text,
    text_to_date,
)
from tidemark.functions.predicates import absent, any_equal, present

__all__ = [
    "OPEN_END",
    "TEXT_DATE_FORMAT",
    "UNSET_TEXT_DATE",
    "absent",
    "any_equal",
    "date_to_text",
    "present",
    "text_to_date",
]
