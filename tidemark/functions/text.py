"""Pattern functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._cols import ColumnOrName, as_col

__all__ = ["regexp_instr", "like_pattern", "with_flags", "empty_to_null"]

_REGEX_FLAGS = "imsux"


def with_flags(pattern: str, flags: str = "") -> str:
    """Prefix inline flags; an unknown flag is an error, not silently dropped."""
    unknown = sorted(set(flags) - set(_REGEX_FLAGS))
    if unknown:
        raise ValueError(f"unknown regex flags {unknown}, allowed: {_REGEX_FLAGS}")
    return f"(?{flags}){pattern}" if flags else pattern


def regexp_instr(
    value: ColumnOrName, pattern: str, position: int = 1, occurrence: int = 1, flags: str = ""
) -> Column:
    """1-based start of the n-th match at or after ``position``; 0 when there is none."""
    text = as_col(value)
    regex = with_flags(pattern, flags)
    tail = text if position == 1 else F.substring(text, F.lit(position), F.length(text))
    if occurrence == 1:
        start = F.regexp_instr(tail, F.lit(regex))
    else:
        # text up to the end of match n-1, then the first match behind it
        head = F.regexp_extract(tail, f"(?s)^((?:.*?(?:{regex})){{{occurrence - 1}}})", 1)
        rest = F.regexp_instr(
            F.substring(tail, F.length(head) + 1, F.length(tail)), F.lit(regex)
        )
        start = F.when((F.length(head) > 0) & (rest > 0), F.length(head) + rest).otherwise(
            F.when(text.isNotNull(), F.lit(0))
        )
    return F.when(start > 0, start + (position - 1)).otherwise(start)


def like_pattern(value: ColumnOrName, pattern: str, positive: bool = True) -> Column:
    matched = as_col(value).like(pattern)
    return matched if positive else ~matched


def empty_to_null(value: ColumnOrName) -> Column:
    return F.nullif(as_col(value), F.lit(""))
