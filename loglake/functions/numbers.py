"""Numbers held as text, read with the rules of Python's ``float``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts Python's float() accepts, with ASCII digits and single underscores
# between digits. Spark's own cast also takes "1d" or "0x1p3", hence the guard.
DIGITS = r"[0-9]+(_[0-9]+)*"
EXPONENT = rf"(e[+-]?{DIGITS})?"
DECIMAL = rf"({DIGITS}(\.({DIGITS})?)?{EXPONENT}|\.{DIGITS}{EXPONENT})"
DECIMAL_TEXT = rf"(?i)^\s*[+-]?{DECIMAL}\s*$"
FLOAT_TEXT = rf"(?i)^\s*[+-]?({DECIMAL}|inf(inity)?|nan)\s*$"
INFINITY_TEXT = r"(?i)^\s*[+-]?inf(inity)?\s*$"
NAN_TEXT = r"(?i)^\s*[+-]?nan\s*$"


def _matches(c: Column, pattern: str) -> Column:
    return F.coalesce(c.cast("string").rlike(pattern), F.lit(False))


def _cast(c: Column) -> Column:
    """Text that passed a guard as a number; the cast ignores white space around it."""
    return F.replace(c.cast("string"), F.lit("_"), F.lit("")).try_cast("double")


def to_number(c: Column) -> Column:
    """``float(text)``, null where Python would raise."""
    return (
        F.when(_matches(c, DECIMAL_TEXT), _cast(c))
        .when(_matches(c, INFINITY_TEXT), _cast(c))
        .when(_matches(c, NAN_TEXT), F.lit(float("nan")))
    )


def is_numeric_value(c: Column, allow_nan: bool = True) -> Column:
    """The text is a float; NaN and infinity count unless ``allow_nan`` is off (NaN only)."""
    if allow_nan:
        return _matches(c, FLOAT_TEXT)
    return _matches(c, FLOAT_TEXT) & ~_matches(c, NAN_TEXT)


def is_finite(number: Column) -> Column:
    """True for a number a time-series store accepts: no null, NaN or infinity."""
    return F.coalesce(~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))), F.lit(False))


def finite_only(c: Column) -> Column:
    """The text is a finite float. Digits alone do not settle it: ``1e999`` is infinite."""
    return _matches(c, DECIMAL_TEXT) & (F.abs(_cast(c)) < F.lit(float("inf")))


def fix_exponent(c: Column) -> Column:
    """Give an exponent number a fraction: ``1e5`` becomes ``1.0e5``."""
    bare = F.contains(c, F.lit("e")) & ~F.contains(c, F.lit("."))
    return F.when(bare, F.replace(c, F.lit("e"), F.lit(".0e"))).otherwise(c)


def is_nonzero_metric(name: Column, value: Column) -> Column:
    """Oldest load rule: a name, and a value that is a number other than zero (NaN passes)."""
    number = to_number(value)
    return F.coalesce((name != "") & (F.isnan(number) | (number != 0)), F.lit(False))
