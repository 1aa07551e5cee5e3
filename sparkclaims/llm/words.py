"""Words, lines and case as the operators of this package define them.

A word is a run of characters other than space and the controls 0x09 to 0x0D.
Only A-Z are lower-cased. The byte methods of Python split and lower alike.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[ \t-\r]+"
WORD = r"[^ \t-\r]+"

# The same in SQL for the checks.
SQL_BLANK_RUN = r"[\x20\x09-\x0D]+"
SQL_WORD = r"[^\x20\x09-\x0D]+"
SQL_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case; other letters stay."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words(text: Column) -> Column:
    """The words in order; none for null and blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)
