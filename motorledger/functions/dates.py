"""Dates written in many ways. Times are wall-clock: timestamps without zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from motorledger import values as V
from motorledger.functions.nulls import ColumnLike, as_col
from motorledger.functions.numbers import to_number

NTZ = "timestamp_ntz"
_DAY_MICROS = 86_400_000_000


# --- fixed values: other shapes in which the ledgers' dates are accepted, and their ISO order
_SHAPES = [
    (r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6"),
    (r"^(\d{4})(\d{2})(\d{2})( .*)?$", "$1-$2-$3$4"),
    (r"^(\d{4})\.(\d{1,2})\.(\d{1,2})( .*)?$", "$1-$2-$3$4"),
    (r"^(0?[1-9]|1[0-2])/(\d{1,2})/(\d{4})( .*)?$", "$3-$1-$2$4"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})( .*)?$", "$3-$2-$1$4"),
    (r"^(0?[1-9]|1[0-2])-(\d{1,2})-(\d{4})( .*)?$", "$3-$1-$2$4"),
    (r"^(\d{1,2})-(\d{1,2})-(\d{4})( .*)?$", "$3-$2-$1$4"),
]
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_NAMED = r"^(?i)(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.? +(\d{1,2}),? +(\d{4})( .*)?$"
_DAY_FIRST = r"^(?i)(\d{1,2})[ -](jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?,?[ -](\d{4})( .*)?$"


def when_at(text: str) -> Column:
    """A wall-clock literal."""
    return F.lit(text).cast(NTZ)


def _to_iso(text: Column) -> Column:
    """Slashes or the Chinese unit words become dashes."""
    words = F.replace(text, F.lit("年"), F.lit("-"))
    words = F.replace(F.replace(words, F.lit("月"), F.lit("-")), F.lit("日"), F.lit(""))
    return F.when(text.contains("年"), words).otherwise(F.replace(text, F.lit("/"), F.lit("-")))


def parse_ts(c: ColumnLike) -> Column:
    """Text in any usual form to a timestamp, else null.

    The forms are brought to the ISO one first, so a single cast decides. Trying one
    format after the other would cost an exception inside the task for every miss. The
    shape is checked on the text as it is: the cast also takes years of five and more
    digits, which here are months or days.
    """
    text = F.trim(as_col(c).cast("string"))
    iso = F.when(text.rlike(r"^\d{4}([-/年]|$)"), _to_iso(text))
    for shape, order in _SHAPES:
        iso = iso.when(text.rlike(shape), F.regexp_replace(text, shape, order))
    month = lambda name: F.floor((F.instr(F.lit(_MONTHS), F.lower(name)) + 2) / 3).cast("string")
    named = F.concat(F.regexp_replace(text, _NAMED, "$3-"), month(F.left(text, F.lit(3))), F.regexp_replace(text, _NAMED, "-$2$4"))
    day_first = F.concat(F.regexp_replace(text, _DAY_FIRST, "$3-"), month(F.regexp_extract(text, _DAY_FIRST, 2)), F.regexp_replace(text, _DAY_FIRST, "-$1$4"))
    return iso.when(text.rlike(_NAMED), named).when(text.rlike(_DAY_FIRST), day_first).try_cast(NTZ)


def parse_cn_date(c: ColumnLike) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` or ``yyyy年M月[d日]``, else null."""
    text = F.trim(as_col(c))
    monthly = text.contains("年") & text.contains("月") & ~text.contains("日")
    text = F.when(monthly, F.concat(text, F.lit("1日"))).otherwise(text)
    known = text.rlike(r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}|\d{4}年\d{1,2}月\d{1,2}日)$")
    return F.when(known, _to_iso(text).try_cast(NTZ))


def _first_day(year: Column, month: Column) -> Column:
    possible = year.between(1, 9999) & month.between(1, 12)
    return F.when(possible, F.make_date(year, month, F.lit(1)))


def _found(text: Column, pattern: str, group: int) -> Column:
    """Digits found by a pattern as a number, null when nothing is found."""
    digits = F.regexp_extract(text, pattern, group)
    return F.when(digits != "", digits.cast("int"))


def month_start(c: ColumnLike) -> Column:
    """First day of the month meant by the text, else null."""
    text = F.trim(as_col(c).cast("string"))
    cn = r"(\d{4})\s*年\s*(\d{1,2})\s*月"
    six = r"^(\d{4})(\d{2})$"
    named = [_first_day(_found(text, p, 1), _found(text, p, 2)) for p in (cn, six)]
    parsed = F.trunc(parse_ts(text).cast("date"), "month")
    return F.when(text.contains("年"), F.coalesce(named[0], parsed)).otherwise(
        F.coalesce(parsed, F.when(F.length(text) == 6, named[1]))
    )


def month_end_from(year: ColumnLike, month: ColumnLike) -> Column:
    """Last day of the month from digits found in a year text and a month text."""
    y, m = (_found(as_col(c).cast("string"), r"(\d{1,9})", 1) for c in (year, month))
    return F.last_day(_first_day(y, m))


def month_end(c: ColumnLike) -> Column:
    return F.last_day(as_col(c).cast("date"))


def excel_date(c: ColumnLike) -> Column:
    """Spreadsheet day number to date."""
    days = F.floor(to_number(c, default=None)).try_cast("int")
    return F.date_add(F.lit(V.EXCEL_EPOCH).cast("date"), days)


def same_month(a: ColumnLike, b: ColumnLike, yes=1, no=0) -> Column:
    a, b = (F.trunc(as_col(c).cast("date"), "month") for c in (a, b))
    return F.when(a == b, F.lit(yes)).otherwise(F.lit(no))


def days_between(later: ColumnLike, earlier: ColumnLike, inclusive: bool = False) -> Column:
    """Whole days, floored, so half a day back is -1."""
    micros = F.timestamp_diff("MICROSECOND", as_col(earlier).cast(NTZ), as_col(later).cast(NTZ))
    days = F.floor(micros / _DAY_MICROS).cast("int")
    return days + 1 if inclusive else days


def within_days(later: ColumnLike, earlier: ColumnLike, low: int = 0, high: int = 90) -> Column:
    inside = days_between(later, earlier).between(low, high)
    return F.when(inside, F.lit(V.YES)).otherwise(F.lit(V.NO))


def within_months(a: ColumnLike, b: ColumnLike, months: int = 3) -> Column:
    """Is ``a`` before ``b`` plus some months; a missing date says so."""
    a, b = as_col(a), as_col(b)
    limit = b + F.make_ym_interval(F.lit(0), F.lit(months))
    return (
        F.when(a.isNull() | b.isNull(), F.lit(V.DATE_MISSING))
        .when(a < limit, F.lit(V.YES))
        .otherwise(F.lit(V.NO))
    )


def later_date(a: ColumnLike, b: ColumnLike) -> Column:
    """``a`` when it is after ``b``, otherwise ``b`` even if that is null."""
    a, b = as_col(a), as_col(b)
    return F.when(a > b, a).otherwise(b)


def fmt_date(c: ColumnLike, fmt: str = "yyyy/MM/dd") -> Column:
    return F.date_format(as_col(c), fmt)


def by_threshold(date: ColumnLike, threshold: Column, before: ColumnLike, after: ColumnLike) -> Column:
    """Choose a column by date; an unknown date takes the later one."""
    return F.when(as_col(date) < threshold, as_col(before)).otherwise(as_col(after))


def date_label(c: ColumnLike, threshold: Column) -> Column:
    c = as_col(c)
    return (
        F.when(c.isNull(), F.lit(V.DATE_EMPTY))
        .when(c > threshold, F.lit(V.YES))
        .otherwise(F.lit(V.NO))
    )
