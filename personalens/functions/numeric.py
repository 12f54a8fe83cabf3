"""Number helpers: guarded casts, guarded ratios, threshold buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Holds 26 digits before the point and 12 after it. More digits before the point
# are an error (never a silent NULL); more after it are rounded to 12.
NUMERIC = "decimal(38,12)"

# Fixed value: the text form the reports take as a number. Unsigned decimal
# text: digits, an optional dot, more digits ('12.' passes; '-1', '1e3', '.5' do
# not). \z anchors at the very end (Java's $ would also accept a trailing newline).
_UNSIGNED_DECIMAL = r"^[0-9]+\.?[0-9]*\z"


def guarded_number(text: Column) -> Column:
    """Text to NUMERIC when it looks like an unsigned decimal, else NULL."""
    return F.when(text.rlike(_UNSIGNED_DECIMAL), text.cast(NUMERIC))


def loose_number(text: Column) -> Column:
    """Unguarded text-to-number cast; text that is no number gives NULL instead of an error."""
    return F.when(text.rlike(_UNSIGNED_DECIMAL), text.cast(NUMERIC)).otherwise(text.try_cast(NUMERIC))


def safe_ratio(num: Column, den: Column, otherwise=0.0) -> Column:
    """num / den as DOUBLE when den > 0, else ``otherwise`` (never divides by 0)."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(otherwise))


def bucketize(value: Column, thresholds: Sequence[tuple[float, str]], default: str,
              inclusive: bool = True) -> Column:
    """First label whose threshold the value reaches; NULL falls to ``default``."""
    expr = None
    for limit, label in thresholds:
        cond = value >= limit if inclusive else value > limit
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default) if expr is not None else F.lit(default)
