"""Dates and times in the forms that fixture files use, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE, clean, clean_or_empty, let, strip, strip_or_empty

_TIME = r"(\d{2})(?::(\d{2})(?::(\d{2})(?:[.,](\d+))?)?|(\d{2})(?:(\d{2})(?:[.,](\d+))?)?)?([+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)?"
_ISO = rf"^(?:(\d{{4}})-(\d{{2}})-(\d{{2}})|(\d{{4}})(\d{{2}})(\d{{2}})|(\d{{4}})-?W(\d{{2}})(?:-?(\d))?)(?:[\s\S]{_TIME})?$"


def _int(c: Column) -> Column:
    return c.try_cast("int")


def day_exists(year: Column, month: Column, day: Column) -> Column:
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    days = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    return F.coalesce((year >= 1) & month.between(1, 12) & (day >= 1) & (day <= days), F.lit(False))


def _groups(text: Column, form: str, n: int) -> Column:
    """The n groups of a whole text in one pass, empty where a group has no part; no group may hold a bar."""
    return F.split(F.regexp_replace(text, form, "|".join(f"${k}" for k in range(1, n + 1))), "[|]")


def iso_parts(text: Column) -> Column:
    """Struct day, time (seconds), fraction (six digits), offset (seconds, null if none); null if not an ISO date or time."""
    return let(F.when(text.rlike(_ISO), _groups(text, _ISO, 17)), _from_groups)


def _from_groups(groups: Column) -> Column:
    g = lambda *i: F.coalesce(*[F.nullif(groups[k - 1], F.lit("")) for k in i])
    year, month, day = _int(g(1, 4)), _int(g(2, 5)), _int(g(3, 6))
    plain = F.when(day_exists(year, month, day), F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd"))
    week_year, week, week_day = _int(g(7)), _int(g(8)), F.coalesce(_int(g(9)), F.lit(1))
    fourth = F.try_to_date(F.format_string("%04d-01-04", week_year), "yyyy-MM-dd")
    monday = F.date_sub(fourth, F.weekday(fourth))
    in_week = F.date_add(monday, (week - 1) * 7 + week_day - 1)
    last = F.weekofyear(F.try_to_date(F.format_string("%04d-12-28", week_year), "yyyy-MM-dd"))
    by_week = F.when((week >= 1) & (week <= last) & week_day.between(1, 7), in_week)
    zero = F.lit(0)
    h, m, s = F.coalesce(_int(g(10)), zero), F.coalesce(_int(g(11, 14)), zero), F.coalesce(_int(g(12, 15)), zero)
    fraction = F.rpad(F.substring(F.coalesce(g(13, 16), F.lit("")), 1, 6), 6, "0")
    digits = F.regexp_replace(g(17), "[+:-]", "")
    part = lambda at: F.coalesce(_int(F.nullif(F.substring(digits, at, 2), F.lit(""))), zero)
    size = part(1) * 3600 + part(3) * 60 + part(5)
    offset = F.when(g(17).isNotNull(), F.when(g(17).startswith("-"), -size).otherwise(size))
    ok = (h <= 23) & (m <= 59) & (s <= 59) & F.coalesce((part(3) <= 59) & (part(5) <= 59) & (size < 86400), F.lit(True))
    told = F.struct(F.when(ok, F.coalesce(plain, by_week)).alias("day"), (h * 3600 + m * 60 + s).alias("time"), fraction.alias("fraction"), offset.alias("offset"))
    return let(told, lambda t: F.when(t["day"].isNotNull(), t))


def _clock(seconds: Column) -> Column:
    return F.format_string("%02d:%02d:%02d", F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60)


def _offset(seconds: Column) -> Column:
    a = F.abs(seconds)
    short = F.format_string("%s%02d:%02d", F.when(seconds < 0, "-").otherwise("+"), F.floor(a / 3600), F.floor(a / 60) % 60)
    return F.when(a % 60 == 0, short).otherwise(F.concat(short, F.format_string(":%02d", a % 60)))


def _written(p: Column, offset: Column) -> Column:
    fraction = F.when(p["fraction"] == "000000", "").otherwise(F.concat(F.lit("."), p["fraction"]))
    return F.concat(F.date_format(p["day"], "yyyy-MM-dd"), F.lit("T"), _clock(p["time"]), fraction, offset)


# The further forms that are read, day first with slashes and dots.
_FORMS = (
    r"^(?<y>\d{4})-(?<m>\d{1,2})-(?<d>\d{1,2})(?: (?<h>\d{1,2}):(?<n>\d{1,2})(?::(?<s>\d{1,2}))?)?$",
    r"^(?<y>\d{4})/(?<m>\d{1,2})/(?<d>\d{1,2})(?: (?<h>\d{1,2}):(?<n>\d{1,2})(?::(?<s>\d{1,2}))?)?$",
    r"^(?<d>\d{1,2})/(?<m>\d{1,2})/(?<y>\d{4})$",
    r"^(?<d>\d{1,2})\.(?<m>\d{1,2})\.(?<y>\d{4})$",
)


def _form(text: Column, form: str) -> Column:
    names = [part[0] for part in form.split("(?<")[1:]]

    def told(g: Column) -> Column:
        y, m, d, h, n, s = (_int(F.nullif(g[names.index(k)], F.lit(""))) if k in names else F.lit(0) for k in "ymdhns")
        h, n, s = (F.coalesce(x, F.lit(0)) for x in (h, n, s))
        ok = (h <= 23) & (n <= 59) & (s <= 59) & day_exists(y, m, d)
        return F.when(ok, F.format_string("%04d-%02d-%02dT%02d:%02d:%02d+00:00", y, m, d, h, n, s))

    return F.when(text.rlike(form), let(_groups(text, form, len(names)), told))


def published_datetime(c: Column) -> Column:
    """ISO with its own offset, or with UTC where none is given; null if the text is in no known form."""
    text = F.regexp_replace(F.regexp_replace(clean(c), " UTC", "+00:00"), "Z$", "+00:00")
    iso = lambda t: let(iso_parts(t), lambda p: _written(p, _offset(F.coalesce(p["offset"], F.lit(0)))))
    return let(text, lambda t: F.coalesce(iso(t), *(_form(t, f) for f in _FORMS)))


def identity_datetime(c: Column) -> Column:
    """For comparing: UTC where there is an offset, as it is where there is none, the cleaned text otherwise."""

    def moved(p: Column) -> Column:
        seconds = p["time"] - F.coalesce(p["offset"], F.lit(0))
        days = F.floor(seconds / 86400).cast("int")
        at = F.struct(F.date_add(p["day"], days).alias("day"), (seconds - days * 86400).alias("time"), p["fraction"].alias("fraction"))
        return _written(at, F.when(p["offset"].isNotNull(), "+00:00").otherwise(""))

    return let(clean_or_empty(c), lambda t: F.coalesce(let(iso_parts(F.replace(t, F.lit("Z"), F.lit("+00:00"))), moved), t))


def is_iso(c: Column) -> Column:
    return iso_parts(F.replace(strip_or_empty(c), F.lit("Z"), F.lit("+00:00"))).isNotNull()


# Month names by number.
MONTHS = {
    1: "january jan", 2: "february feb", 3: "march mar", 4: "april apr", 5: "may", 6: "june jun", 7: "july jul", 8: "august aug",
    9: "september sep sept", 10: "october oct", 11: "november nov", 12: "december dec",
}
_REST = "([A-Za-z]+)(?U:[\\s\\x1c-\\x1f])+(\\p{Nd}{1,2})(?:(?U:[\\s\\x1c-\\x1f])+(\\p{Nd}{4}))?"
_WEEKDAY = "(?i)^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)(?U:[\\s\\x1c-\\x1f])+" + _REST
_BARE = "(?i)^" + _REST


def date_shaped(c: Column) -> Column:
    return let(strip(c), lambda text: text.rlike(_WEEKDAY) | text.rlike(_BARE))


def heading_date(c: Column, context_year: Column) -> Column:
    """The date that a line starts with, as struct year, month, day; null if there is none or it does not exist."""
    month_of = F.create_map(*[F.lit(x) for n, names in MONTHS.items() for name in names.split() for x in (name, n)])
    parts = lambda text, form: F.array(*(F.regexp_extract(text, form, i) for i in (1, 2, 3)))
    found = lambda text: F.when(text.rlike(_WEEKDAY), parts(text, _WEEKDAY)).when(text.rlike(_BARE), parts(text, _BARE))

    def read(p: Column) -> Column:
        g = p["g"]
        return F.struct(F.coalesce(_int(F.nullif(g[2], F.lit(""))), p["year"]).cast("int").alias("year"), month_of[F.lower(g[0])].alias("month"), _int(g[1]).alias("day"))

    def real(d: Column) -> Column:
        return F.when(day_exists(F.when(d["year"] == 0, 2000).otherwise(d["year"]), d["month"], d["day"]), d)

    whole = let(strip(c), lambda text: F.struct(found(text).alias("g"), context_year.alias("year")))
    return let(whole, lambda p: F.when(p["g"].isNotNull(), let(read(p), real)))


def clock_time(c: Column) -> Column:
    """The first h:mm or hh:mm of a line as struct hour, minute; null if there is none or it is no time of day."""
    form = "(?<!\\p{Nd})(\\p{Nd}{1,2}):(\\p{Nd}{2})(?!\\p{Nd})"
    read = F.struct(_int(F.regexp_extract(c, form, 1)).alias("hour"), _int(F.regexp_extract(c, form, 2)).alias("minute"))
    return let(read, lambda t: F.when((t["hour"] <= 23) & (t["minute"] <= 59), t))


__all__ = ["SPACE", "clock_time", "date_shaped", "heading_date", "identity_datetime", "is_iso", "published_datetime"]
