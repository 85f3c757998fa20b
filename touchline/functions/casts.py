"""Lenient text casts: anything that does not parse becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text_of(c: str | Column) -> Column:
    return F.trim(col(c).cast("string"))


# What a cast can read, or a little more. A cast that fails inside ``try_cast`` raises and drops an exception, which costs
# a hundred times the cast, so text that is no number is told by its form and never cast.
_BLANK = r"[\x00-\x20\x7F]*"
WHOLE = rf"^{_BLANK}[+-]?[0-9]+{_BLANK}\z"
NUMBER = rf"(?i)^{_BLANK}[+-]?(?:[0-9]+\.?[0-9]*(?:e[+-]?[0-9]+)?|\.[0-9]+(?:e[+-]?[0-9]+)?|nan|inf|infinity|0x[0-9a-fp.+-]+)[df]?{_BLANK}\z"


def to_double(c: str | Column) -> Column:
    """Text or number to double. Java's number suffixes (``1d``, ``1f``) do not count as numbers."""
    if isinstance(c, str):
        return F.expr(_double_sql(f"trim(cast(`{c}` as string))"))
    text = _text_of(c)
    return F.when(~F.substring(text, -1, 1).isin("d", "D", "f", "F") & text.rlike(NUMBER), text.try_cast("double"))


def to_int(c: str | Column) -> Column:
    """Text or number to int, also by way of double, so that '3.0' is 3, '3.5' is 4 and '1e2' is 100."""
    if isinstance(c, str):
        text = f"trim(cast(`{c}` as string))"
        return F.expr(f"coalesce(case when {text} rlike r'{WHOLE}' then try_cast({text} as int) end, try_cast(round({_double_sql(text)}) as int))")
    text = _text_of(c)
    return F.coalesce(F.when(text.rlike(WHOLE), text.try_cast("int")), F.round(to_double(c)).try_cast("int"))


def _double_sql(text: str) -> str:
    # One expression text instead of a dozen calls: wide tables have many such columns.
    return f"case when substring({text}, -1, 1) not in ('d', 'D', 'f', 'F') and {text} rlike r'{NUMBER}' then try_cast({text} as double) end"


def to_date(c: str | Column) -> Column:
    """Year-first date text; a time of day behind the date is ignored."""
    text = F.trim(col(c).cast("string"))
    iso = F.regexp_replace(text, r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})([ T].*)?$", "$1-$2-$3")
    plain = r"^\d{4}-\d{1,2}-\d{1,2}$"
    # Text that is a plain date, as most is, is not rewritten.
    return F.when(text.rlike(plain), text.try_cast("date")).when(iso.rlike(plain), iso.try_cast("date"))


def to_match_date(c: str | Column) -> Column:
    """Date of a fixture record: ISO text or a yyyymmdd number."""
    text = F.trim(col(c).cast("string"))
    compact = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})(\.0)?$", "$1-$2-$3")
    return to_date(compact)


def to_long_date(c: str | Column) -> Column:
    """Date written out in English, as in 'August 14, 2021'."""
    return F.try_to_date(col(c), "MMMM d, yyyy")


def to_seconds(c: str | Column) -> Column:
    """Clock text 'H:mm' as seconds of the day; midnight when absent or unreadable."""
    text = F.trim(col(c).cast("string"))
    hours = F.substring_index(text, ":", 1).try_cast("int")
    minutes = F.regexp_extract(text, r":(\d{1,2})$", 1).try_cast("int")
    valid = text.rlike(r"^\d{1,2}:\d{1,2}$") & (hours < 24) & (minutes < 60)
    return F.when(valid, hours * 3600 + minutes * 60).otherwise(F.lit(0)).cast("int")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL for a zero or missing denominator."""
    return F.try_divide(numerator, denominator)


def present(c: str | Column) -> Column:
    """NaN counts as missing."""
    value = col(c).cast("double")
    return F.when(~F.isnan(value), value)
