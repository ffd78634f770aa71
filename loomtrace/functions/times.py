"""Relative dates and foreign clocks, with the present as a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Seconds from 1601-01-01 to 1970-01-01.
_SINCE_1601 = 11_644_473_600

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def browser_time(micros: Column) -> Column:
    """A timestamp from microseconds since 1601."""
    return F.timestamp_micros(micros - F.lit(_SINCE_1601 * 1_000_000))


def to_browser_time(ts: Column) -> Column:
    return F.unix_micros(ts) + F.lit(_SINCE_1601 * 1_000_000)


def relative_day(today: Column, phrase: str) -> Column:
    """The day that a phrase names, seen from ``today``.

    ``tomorrow``; ``5th next month`` (the last day if the month is shorter); ``this
    Friday`` and ``next Monday`` (of this and of the next week, from Monday on);
    ``next week Sunday``; ``first Monday 4 months later``.
    """
    words = phrase.split()
    monday = F.date_sub(today, F.weekday(today))
    if phrase == "today":
        return today
    if phrase == "tomorrow":
        return F.date_add(today, 1)
    if words[1:] == ["next", "month"]:
        first = F.add_months(F.trunc(today, "MM"), 1)
        day = int("".join(c for c in words[0] if c.isdigit()))
        return F.least(F.date_add(first, day - 1), F.last_day(first))
    if words[0] == "this" and words[-1] in WEEKDAYS:
        return F.date_add(monday, WEEKDAYS.index(words[-1]))
    if words[0] == "next" and words[-1] in WEEKDAYS:
        return F.date_add(monday, 7 + WEEKDAYS.index(words[-1]))
    if words[0] == "first" and words[1] in WEEKDAYS and words[3:] == ["months", "later"]:
        first = F.add_months(F.trunc(today, "MM"), int(words[2]))
        return F.next_day(F.date_sub(first, 1), words[1][:3])
    raise ValueError(f"no such day: {phrase}")


def formatted(day: Column, pattern: str) -> Column:
    """A pattern with each placeholder replaced once: {DoW} {Month} {MonthFull} {Year} {Month0D} {MonthD} {Day0D} {DayD}."""
    shown = {"{DoW}": "EEE", "{Month}": "MMM", "{MonthFull}": "MMMM", "{Year}": "yyyy", "{Month0D}": "MM", "{MonthD}": "M", "{Day0D}": "dd", "{DayD}": "d"}
    parts, rest = [], pattern
    seen: set[str] = set()
    while rest:
        found = [(rest.index(k), k) for k in shown if k in rest and k not in seen]
        if not found:
            break
        at, key = min(found)
        parts += [F.lit(rest[:at]), F.date_format(day, shown[key])]
        seen.add(key)
        rest = rest[at + len(key) :]
    return F.concat(*parts, F.lit(rest))
