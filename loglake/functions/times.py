"""Times: epochs, parsing, index suffixes. Text is read in the session time zone; ids and days are UTC always."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffix pattern per frequency, and the dates found in paths.
SUFFIX_PATTERNS = {
    "DAILY": "yyyy.MM.dd",
    "WEEKLY": "yyyy.MM.dd",
    "MONTHLY": "yyyy.MM",
    "YEARLY": "yyyy",
}
DAY_MS = 86_400_000
FREQUENCIES = ("NONE", *SUFFIX_PATTERNS)
DATE_IN_PATH = r"([0-9]{4})[-/:]([0-9]{1,2})[-/:]([0-9]{1,2})"


def epoch_s(c: Column) -> Column:
    """Whole seconds since the epoch; fractions are dropped."""
    return F.unix_timestamp(c)


def epoch_ms(c: Column) -> Column:
    """Whole seconds since the epoch, in milliseconds."""
    return F.unix_timestamp(c) * F.lit(1000).cast("long")


def parse_cli_time(c: Column) -> Column:
    """``2021 3 4 5:06:07.5``, padded or not; null if it does not parse."""
    return F.try_to_timestamp(c, F.lit("yyyy M d H:m:s.SSSSSS"))


def parse_iso_micros(c: Column) -> Column:
    """``2021-03-04T05:06:07.089000``, with or without the fraction."""
    return F.try_to_timestamp(c)


def utc_day(ms: Column) -> Column:
    """The UTC day of epoch milliseconds, whatever the session zone."""
    return F.date_from_unix_date(F.floor(ms / F.lit(DAY_MS)).cast("int"))


def utc_text(micros: Column, between: str = " ", digits: int = 6) -> Column:
    """Epoch microseconds as UTC text with a fraction of ``digits``, whatever the session zone."""
    day = F.floor(micros / F.lit(DAY_MS * 1000))
    rest = F.pmod(micros, F.lit(DAY_MS * 1000).cast("long"))

    def part(unit: int, size: int, width: int) -> Column:
        return F.lpad(F.pmod(F.floor(rest / F.lit(unit)), F.lit(size)).cast("string"), width, "0")

    return F.concat(
        F.date_from_unix_date(day.cast("int")).cast("string"), F.lit(between), part(3_600_000_000, 24, 2), F.lit(":"),
        part(60_000_000, 60, 2), F.lit(":"), part(1_000_000, 60, 2), F.lit("."), part(10 ** (6 - digits), 10 ** digits, digits))


def iso_utc_millis(ms: Column) -> Column:
    """Epoch milliseconds as ``yyyy-MM-ddTHH:mm:ss.SSSZ``."""
    return F.concat(utc_text(ms * F.lit(1000).cast("long"), "T", 3), F.lit("Z"))


def index_suffix(ts: Column, frequency: str = "NONE") -> Column:
    """Suffix of the index a time belongs to; weekly is named by its Monday."""
    if frequency == "NONE":
        return F.lit("")
    if frequency == "WEEKLY":
        ts = F.date_trunc("week", ts)
    return F.date_format(ts, SUFFIX_PATTERNS[frequency])


def index_name(base: str | Column, suffix: Column) -> Column:
    """``base-suffix``, or ``base`` alone for an empty suffix."""
    base = F.lit(base) if isinstance(base, str) else base
    return F.when(suffix == "", base).otherwise(F.concat(base, F.lit("-"), suffix))


def date_from_path(path: Column, whole_word: bool = True) -> Column:
    """First date in a path as struct(year, month, day), digits as written; '' if there is none."""
    pattern = rf"\b{DATE_IN_PATH}\b" if whole_word else DATE_IN_PATH
    return F.struct(
        F.regexp_extract(path, pattern, 1).alias("year"),
        F.regexp_extract(path, pattern, 2).alias("month"),
        F.regexp_extract(path, pattern, 3).alias("day"),
    )


def path_suffix(path: Column, ts: Column, frequency: str, whole_word: bool = True) -> Column:
    """Index suffix from the date in a file's path, else from the record time."""
    if frequency in ("NONE", "WEEKLY"):
        return index_suffix(ts, frequency)
    # One pattern for each row: a pattern for each part, in each place the suffix is used, takes longer than the id.
    date = F.regexp_extract(path, rf"\b{DATE_IN_PATH}\b" if whole_word else DATE_IN_PATH, 0)
    parts = {"DAILY": 3, "MONTHLY": 2, "YEARLY": 1}[frequency]
    written = F.substring_index(F.translate(date, "-/:", "..."), ".", parts)
    return F.coalesce(F.nullif(written, F.lit("")), index_suffix(ts, frequency))


def shift_hours(c: Column, hours: int) -> Column:
    return c + F.make_dt_interval(hours=F.lit(hours))
