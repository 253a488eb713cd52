"""Text to typed columns, with NULL for anything that does not conform."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from mostrador.schema import NULL_TOKENS

# Fixed patterns of accepted text.
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_INFINITY = r"(?i)^[+-]?inf(inity)?$"
_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"
_DATE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
_EXACT_DOUBLE = float(2**53)
# ISO 8601: calendar and week dates, basic and extended, with a time after any one character.
# A fraction may follow the last unit of a time, and is one of seconds.
_HOUR, _SIXTIETH = "([01][0-9]|2[0-3])", "([0-5][0-9])"
_INSTANT = (
    "^(?!0000)([0-9]{4})(?:-([0-9]{2})-([0-9]{2})|([0-9]{2})([0-9]{2})"
    "|-W([0-9]{2})(?:-([1-7])(?![0-9]))?|W([0-9]{2})(?:([1-7])(?![0-9])|(?![0-9])))"
    rf"(?:[\s\S]{_HOUR}(?::{_SIXTIETH}(?::{_SIXTIETH})?|{_SIXTIETH}{_SIXTIETH}?)?(?:[.,]([0-9]+))?)?\z"
)
_INSTANT_PARTS = "$1|$2$4|$3$5|$6$8|$7$9|$10|$11$13|$12$14|$15"
# White space of any script.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def blank_to_null(c: Column) -> Column:
    """NULL for the texts that stand for a missing value."""
    return F.when(~c.isin(*NULL_TOKENS), c)


def to_decimal(c: Column) -> Column:
    """Text to double. Infinities stay, NaN does not exist: the null tokens cover it."""
    text = F.trim(c)
    infinite = F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.when(text.rlike(_NUMBER), text.try_cast("double")).when(text.rlike(_INFINITY), infinite)


def to_integer(c: Column) -> Column:
    """Text to bigint; ``1.0`` is accepted as 1 because its value is integral."""
    # The second branch runs only for text that is no plain integer. Its value is named: written out three times for
    # every column, the code of a row is too long for the JVM to compile.
    integral = _named(
        to_decimal(c),
        lambda wide: F.when((wide == F.floor(wide)) & (F.abs(wide) <= _EXACT_DOUBLE), wide.try_cast("bigint")),
    )
    return F.coalesce(c.try_cast("bigint"), integral)


def to_sale_time(c: Column) -> Column:
    """ISO date or date-time without offset to a zone-less timestamp."""
    text = F.trim(c)
    return F.when(text.rlike(_TIMESTAMP), text.try_cast("timestamp_ntz"))


@cache
def _other_digits() -> tuple[str, str]:
    """The decimal digits of all other scripts, and the ASCII digit of each."""
    found = [(chr(c), unicodedata.decimal(chr(c), None)) for c in range(128, sys.maxunicode + 1)]
    pairs = [(c, str(d)) for c, d in found if d is not None]
    return "".join(c for c, _ in pairs), "".join(d for _, d in pairs)


def ascii_digits(c: Column) -> Column:
    """The text with the decimal digits of any script as ASCII ones."""
    return F.when(c.rlike(r"\p{Nd}") & c.rlike("[^\\x00-\\x7f]"), F.translate(c, *_other_digits())).otherwise(c)


def iso_instant(c: Column) -> Column:
    """ISO 8601 date or date and time without offset, in any of its forms, to a zone-less timestamp.

    Accepted: ``2026-01-05``, ``20260105``, ``2026-W02-1``, ``2026W021`` and a week without a day (its
    Monday); then any character and ``HH[[:]MM[[:]SS]]`` with a fraction, of which six digits count.
    """
    parts = F.split(F.regexp_replace(c, _INSTANT, _INSTANT_PARTS), r"\|")
    return F.when(c.rlike(_INSTANT), _named(parts, lambda p: _named(_date_of(p), lambda date: _instant_of(date, p))))


def _named(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def _part(parts: Column, at: int, default: str) -> Column:
    text = F.get(parts, F.lit(at))
    return F.when(text == "", default).otherwise(text)


def _date_of(parts: Column) -> Column:
    year, week = F.get(parts, F.lit(0)), F.get(parts, F.lit(3))
    calendar = F.concat_ws("-", year, F.get(parts, F.lit(1)), F.get(parts, F.lit(2))).try_cast("date")
    fourth = F.concat(year, F.lit("-01-04")).try_cast("date")  # is always in week 1
    monday = F.date_add(F.date_sub(fourth, F.weekday(fourth)), 7 * week.try_cast("int") - 7)
    day = _part(parts, 4, "1").try_cast("int") - 1
    # A week belongs to the year of its Thursday.
    exists = (F.year(F.date_add(monday, 3)) == year.try_cast("int")) & (F.year(F.date_add(monday, day)) < 10_000)
    return F.when(week == "", calendar).when(exists, F.date_add(monday, day))


def _instant_of(date: Column, parts: Column) -> Column:
    clock = F.concat_ws(":", *[_part(parts, at, "00") for at in (5, 6, 7)])
    micros = F.rpad(F.substring(F.get(parts, F.lit(8)), 1, 6), 6, "0")
    stamp = F.concat(date.cast("string"), F.lit(" "), clock, F.lit("."), micros)
    return stamp.try_cast("timestamp_ntz")


def to_birth_date(c: Column) -> Column:
    """Year-month-day text to date; any other form, and a time suffix, gives NULL."""
    return F.when(c.rlike(_DATE), c.try_cast("date"))
