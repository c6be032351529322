"""Column expressions shared by the reports. All are built-ins, so plans keep codegen."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(col: ColumnLike) -> Column:
    return F.col(col) if isinstance(col, str) else col


def age_years(at: ColumnLike, birthdate: ColumnLike) -> Column:
    """Whole years of 365.25 days, truncated toward zero (negative before birth)."""
    return (F.datediff(_c(at), _c(birthdate)) / F.lit(365.25)).cast("bigint")


def days_since(as_of: dt.date, day: ColumnLike) -> Column:
    """Days from ``day`` to ``as_of``, null where there is no day."""
    return F.datediff(F.lit(as_of), _c(day))


def shift_days(ts: ColumnLike, days: int) -> Column:
    """A date-time moved by whole days; the time of day stays."""
    return _c(ts) + F.expr(f"INTERVAL '{days}' DAY")


def on_day(ts: ColumnLike, day: dt.date) -> Column:
    """Whether a date-time falls on a day; written so that it reaches the scan as a range."""
    start = F.lit(dt.datetime.combine(day, dt.time())).cast("timestamp_ntz")
    return (_c(ts) >= start) & (_c(ts) < start + F.expr("INTERVAL '1' DAY"))


def up_to_day(ts: ColumnLike, day: dt.date) -> Column:
    """Whether a date-time falls on a day or before it."""
    next_day = dt.datetime.combine(day, dt.time()) + dt.timedelta(days=1)
    return _c(ts) < F.lit(next_day).cast("timestamp_ntz")


def between_days(
    ts: ColumnLike, start: dt.date, end: dt.date, end_inclusive_day: bool = False
) -> Column:
    """Between two days, both as midnights, so the rest of the end day is out.

    ``end_inclusive_day`` takes the whole end day in.
    """
    low = F.lit(dt.datetime.combine(start, dt.time())).cast("timestamp_ntz")
    if end_inclusive_day:
        return (_c(ts) >= low) & up_to_day(ts, end)
    high = F.lit(dt.datetime.combine(end, dt.time())).cast("timestamp_ntz")
    return _c(ts).between(low, high)


def in_year(ts: ColumnLike, year: int) -> Column:
    """Whether a date-time falls into a year; a range, so that it reaches the scan."""
    low, high = (F.lit(dt.datetime(y, 1, 1)).cast("timestamp_ntz") for y in (year, year + 1))
    return (_c(ts) >= low) & (_c(ts) < high)


def token_count(text: ColumnLike, delimiter: str) -> Column:
    """How many delimiters a string holds, by length difference."""
    without = F.replace(_c(text), F.lit(delimiter), F.lit(""))
    return F.round((F.length(_c(text)) - F.length(without)) / F.lit(len(delimiter))).cast("int")


def nth_token(text: ColumnLike, delimiter: str, n: int) -> Column:
    """The n-th token (from 1), or an empty string where there are fewer."""
    upto = F.substring_index(_c(text), delimiter, n)
    return F.when(
        token_count(text, delimiter) >= n - 1, F.substring_index(upto, delimiter, -1)
    ).otherwise(F.lit(""))


def position_in_list(item: str, text: ColumnLike, ignore_case: bool = False) -> Column:
    """Position (from 1) of an item in a comma list, 0 where absent, null for a null list."""
    searched = F.collate(_c(text), "UTF8_LCASE") if ignore_case else _c(text)
    return F.find_in_set(F.lit(item), searched)


def ranked_member(rank: str, text: ColumnLike, ignore_case: bool = False) -> Column:
    """The other member of a two-item comma list that holds a rank word.

    Rank first: the last token. Rank second: the first token. Otherwise null.
    """
    at = position_in_list(rank, text, ignore_case)
    return F.when(at == 1, F.substring_index(_c(text), ",", -1)).when(
        at == 2, F.substring_index(_c(text), ",", 1)
    )


def classify(code: ColumnLike, families: Mapping[str, Iterable[int]]) -> Column:
    """The first family whose set holds the code, or an empty string."""
    result = None
    for label, codes in families.items():
        member = _c(code).isin(*codes)
        result = F.when(member, label) if result is None else result.when(member, label)
    return result.otherwise(F.lit(""))


def any_of(slots: Sequence[ColumnLike], label: str) -> Column:
    """Whether some slot carries the label."""
    return F.array_contains(F.array(*(_c(s) for s in slots)), label)


def none_of(slots: Sequence[ColumnLike], label: str) -> Column:
    """Whether no slot carries the label."""
    return ~any_of(slots, label)


def label_code(code: ColumnLike, labels: Mapping[int, str], default: str) -> Column:
    """Simple CASE over a code; a null code takes the default."""
    result = F.lit(default)
    for key, label in reversed(list(labels.items())):
        result = F.when(_c(code) == key, label).otherwise(result)
    return result
