"""Column expressions.  All are built-ins that stay inside generated JVM code.

Every cast and division is a ``try_`` form, so results are the same whether or
not the session runs in ANSI mode.
"""

from .dates import first_missed_on, month_number, to_day
from .numbers import (
    ceil_int,
    flag_below,
    keep_at_most,
    keep_between,
    only_if,
    parse_number,
    parse_whole,
    safe_ratio,
    strict_int,
    typed,
    yes_no_flag,
)
from .text import clear_tokens, is_missing_text, list_length, months_of_duration, normal_key

__all__ = [
    "ceil_int",
    "clear_tokens",
    "first_missed_on",
    "flag_below",
    "is_missing_text",
    "keep_at_most",
    "keep_between",
    "list_length",
    "month_number",
    "months_of_duration",
    "normal_key",
    "only_if",
    "parse_number",
    "parse_whole",
    "safe_ratio",
    "strict_int",
    "to_day",
    "typed",
    "yes_no_flag",
]
