"""Scalar Column expressions (JVM built-ins only, so they stay inside whole-stage codegen).

Each function takes and returns a ``Column``.  Where the source system had a
parameter normaliser (applied to a user-typed filter value, not to data), a plain
Python twin is given as well (``*_param``).
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourmeter.functions.constants import (
    EVENT_TYPE_PARTS,
    FILE_DATE_PATTERN,
    MACHINE_TYPE_STARTS,
    NO_DRIVER,
    REASON_TEXT,
    UNKNOWN_FILTER,
)

# JS `\s` is Unicode-aware and also covers U+FEFF; Java needs (?U) plus FEFF spelled out.
_WS = r"(?U)[\s\x{FEFF}]+"


# words of printable ASCII with one space between: nothing to collapse
_PLAIN = r"\A[!-~]++(?: [!-~]++)*+\z"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def collapse(s) -> Column:
    """Null -> '', whitespace runs -> one space, trimmed."""
    s = _c(s)
    return F.when(s.rlike(_PLAIN), s).otherwise(F.trim(F.regexp_replace(F.coalesce(s, F.lit("")), _WS, " ")))


def header_key(s) -> Column:
    """Collapse, lower case, keep only [a-z0-9]."""
    return F.regexp_replace(F.lower(collapse(s)), "[^a-z0-9]", "")


def title_case(s) -> Column:
    """Lower case, then upper-case an ASCII letter at the start or after space, ' or -."""
    return raised(collapse(s))


def raised(collapsed) -> Column:
    """C5 of a collapsed string.

    ``initcap`` is not the same rule (it ignores ' and -), so the string is split
    after every separator and the first letter of each piece is raised.  A string of
    ASCII letters and digits is one piece, which needs no split.
    """
    low = F.lower(_c(collapsed))
    pieces = F.split(low, "(?<=[ '-])")
    each = F.transform(
        pieces,
        lambda p: F.when(
            F.substring(p, 1, 1).rlike("^[a-z]$"), F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))
        ).otherwise(p),
    )
    one = F.concat(F.upper(F.substring(low, 1, 1)), F.substring(low, 2, 1 << 30))
    return F.when(low.rlike(r"\A[a-z0-9]++\z"), one).otherwise(F.array_join(each, ""))


def without_prefix(collapsed, prefix: str = "") -> Column:
    """C3's first half: a collapsed branch without the configured leading company prefix (none unless given)."""
    return F.regexp_replace(_c(collapsed), "(?i)^" + re.escape(prefix) + r"\s*", "") if prefix else _c(collapsed)


def normalise_branch(s, prefix: str = "") -> Column:
    """Collapse, drop the configured leading company prefix (none unless given), title case; blank -> null."""
    stripped = without_prefix(collapse(s), prefix)
    return F.when(stripped == "", F.lit(None).cast("string")).otherwise(raised(stripped))


def normalise_ref(s) -> Column:
    """C4: collapse + upper case."""
    return F.upper(collapse(s))


def normalise_driver(first, surname) -> Column:
    """struct(first_name, surname, driver_key) or null when both parts are blank."""
    return driver_of(title_case(first), title_case(surname))


def driver_of(first_name, surname) -> Column:
    """C6 from both parts in title case."""
    fn, sn = _c(first_name), _c(surname)
    key = F.lower(F.trim(F.concat(fn, F.lit(" "), sn)))
    return F.when((fn == "") & (sn == ""), F.lit(None)).otherwise(
        F.struct(fn.alias("first_name"), sn.alias("surname"), key.alias("driver_key"))
    )


# years from 100, hours to 23, minutes and seconds to 59; the day is checked by the cast
_YEAR, _CLOCK = r"(?:0[1-9]|[1-9]\d)\d{2}", r"[T ](?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d$"
_ISO = rf"^{_YEAR}-\d{{2}}-\d{{2}}{_CLOCK}"
_DMY = rf"^\d{{2}}/\d{{2}}/{_YEAR}{_CLOCK}"


def parse_event_time(s) -> Column:
    """ISO (T or space) or dd/mm/yyyy HH:MM:SS, calendar-checked, else null.

    Both shapes have fixed places, are put together as ``yyyy-mm-dd hh:mi:ss`` and cast with ``try_cast``
    (31/02 -> null).  Years below 100 are rejected as the source's date check did.
    """
    return event_time_of(collapse(s))


def event_time_of(collapsed) -> Column:
    """C7 of a collapsed text."""
    t = _c(collapsed)

    def at(start: int, length: int) -> Column:
        return F.substring(t, start, length)

    iso = F.concat(at(1, 10), F.lit(" "), at(12, 8))
    dmy = F.concat(at(7, 4), F.lit("-"), at(4, 2), F.lit("-"), at(1, 2), F.lit(" "), at(12, 8))
    return F.when(t.rlike(_ISO), iso).when(t.rlike(_DMY), dmy).try_cast("timestamp_ntz")


def delivery_date_from_name(name) -> Column:
    """C8 (first half): date in a daily file name, or null."""
    n = _c(name)
    y = F.regexp_extract(n, FILE_DATE_PATTERN, 1)
    m = F.regexp_extract(n, FILE_DATE_PATTERN, 2)
    d = F.regexp_extract(n, FILE_DATE_PATTERN, 3)
    return F.when(y != "", F.concat_ws("-", y, m, d).try_cast("date"))


def data_date_from_name(name) -> Column:
    """C8 (second half): the day the events belong to = delivery - 1 day."""
    return F.date_sub(delivery_date_from_name(name), 1)


def file_basename(path) -> Column:
    """Last path segment of a file URI/path."""
    return F.regexp_extract(_c(path), r"([^/\\]+)$", 1)


def _first_match(p, pairs, like: str) -> Column:
    c = _c(p)
    out = F.lit(UNKNOWN_FILTER)
    for text, meaning in reversed(pairs):
        out = F.when(F.lower(c).like(like.format(text)), meaning).otherwise(out)
    return F.when(c.isNull() | (F.trim(c) == ""), F.lit(None).cast("string")).otherwise(out)


def norm_machine_type(p) -> Column:
    """C9 over a column: blank -> null, prefixes -> one of the three types, else __unknown__."""
    return _first_match(p, MACHINE_TYPE_STARTS, "{}%")


def norm_event_type(p) -> Column:
    """C10 over a column: ordered substring matches -> event code, else __unknown__."""
    return _first_match(p, EVENT_TYPE_PARTS, "%{}%")


def norm_machine_type_param(p: str | None) -> str | None:
    """C9 for a filter value typed by a user."""
    if blank(p):
        return None
    return next((m for text, m in MACHINE_TYPE_STARTS if p.lower().startswith(text)), UNKNOWN_FILTER)


def norm_event_type_param(p: str | None) -> str | None:
    """C10 for a filter value typed by a user."""
    if blank(p):
        return None
    return next((m for text, m in EVENT_TYPE_PARTS if text in p.lower()), UNKNOWN_FILTER)


def blank(p: str | None) -> bool:
    """True when an optional text filter means "no filter"."""
    return p is None or p.strip() == ""


def day_name(d) -> Column:
    """C11: full weekday name."""
    return F.date_format(_c(d), "EEEE")


def hours(seconds, digits: int = 2) -> Column:
    """Seconds / 3600 rounded half away from zero to ``digits`` decimals, as DOUBLE.

    Exact integer arithmetic (see ``hour_units``); double ``round`` gets ties wrong.
    """
    return (hour_units(seconds, digits) / F.lit(float(10 ** digits))).cast("double")


def hours_from_hundredths(h, digits: int = 1) -> Column:
    """Re-round a sum of hundredths of an hour to ``digits`` (<= 2) decimals, half up."""
    step = 10 ** (2 - digits)
    num = _c(h).cast("bigint") + F.lit(step // 2)
    q = (num - F.pmod(num, F.lit(step))) / F.lit(step)
    return (q.cast("bigint") / F.lit(float(10 ** digits))).cast("double")


def hour_units(seconds, digits: int = 2) -> Column:
    """Seconds -> whole 10^-digits hours, rounded half away from zero, as BIGINT (exact):
    sign(s) * floor((|s| * 10^d + 1800) / 3600)."""
    s = _c(seconds).cast("bigint")
    num = F.abs(s) * F.lit(10 ** digits) + F.lit(1800)
    q = ((num - F.pmod(num, F.lit(3600))) / F.lit(3600)).cast("bigint")
    return F.when(s < 0, -q).otherwise(q)


def hundredths(seconds) -> Column:
    """Seconds -> hundredths of an hour, half up, as BIGINT (for sums of rounded values)."""
    return hour_units(seconds, 2)


def period_param(date_from: str | None, date_to: str | None) -> tuple[str | None, str | None]:
    """Keep the range only if both ends are valid YYYY-MM-DD and from <= to."""

    def ok(s):
        if not isinstance(s, str) or not re.fullmatch(r"\d{4}-\d{2}-\d{2}", s):
            return None
        try:
            return _dt.date.fromisoformat(s)
        except ValueError:
            return None

    a, b = ok(date_from), ok(date_to)
    if a is None or b is None or a > b:
        return None, None
    return a.isoformat(), b.isoformat()


def period_columns(date_from, date_to) -> tuple[Column, Column]:
    """C13 over columns: both ends as dates, or two nulls unless both are valid and in order."""

    def valid(c):
        return F.when(_c(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(_c(c), F.lit("yyyy-MM-dd"))).cast("date")

    a, b = valid(date_from), valid(date_to)
    good = a.isNotNull() & b.isNotNull() & (a <= b)
    return F.when(good, a), F.when(good, b)


def reason_label(code) -> Column:
    """C14: plain words for a rejection reason; unknown codes get '_' -> ' '."""
    pairs = []
    for k, v in REASON_TEXT.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.element_at(F.create_map(*pairs), _c(code)), F.regexp_replace(_c(code), "_", " "))


def label_reason_list(text) -> Column:
    """C14 over a 'reason (n), reason (n)' list: relabel the leading code of each item."""
    items = F.filter(F.split(F.coalesce(_c(text), F.lit("")), ", "), lambda x: x != "")
    relabelled = F.transform(
        items,
        lambda x: F.concat(reason_label(F.regexp_extract(x, "^([a-z_]+)", 1)), F.regexp_replace(x, "^[a-z_]+", "")),
    )
    return F.array_join(relabelled, ", ")


def day_label(d, with_year: bool = True) -> Column:
    """C15: 'Tue 8 Sep 2026' (or without the year)."""
    return F.date_format(_c(d), "EEE d MMM yyyy" if with_year else "EEE d MMM")


def display_name(first, surname) -> Column:
    """Trimmed 'first surname'; a missing driver reads 'No driver logged on'."""
    name = F.when(_c(first).isNotNull() | _c(surname).isNotNull(), F.trim(F.concat_ws(" ", _c(first), _c(surname))))
    return F.coalesce(name, F.lit(NO_DRIVER))


def event_date(t) -> Column:
    """C17: calendar date of a wall-clock event time."""
    return F.to_date(_c(t))
