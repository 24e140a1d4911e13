"""String cleaning as Column expressions (white space as Python's str knows it)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = "(?U)[\\s\\x1c-\\x1f]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: The characters of SPACE.
_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Runs of white space that are not one plain space.
_RUN = "(?U)[\\s\\x1c-\\x1f&&[^ ]][\\s\\x1c-\\x1f]*| [\\s\\x1c-\\x1f]+"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_BLANKS))


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, _RUN, " ")


def clean(c: Column) -> Column:
    """Stripped, inner white space collapsed; null if nothing is left."""
    return F.nullif(collapse(strip(c.cast("string"))), F.lit(""))


def clean_or_empty(c: Column) -> Column:
    return F.coalesce(clean(c), F.lit(""))


def strip_or_empty(c: Column) -> Column:
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def identity_text(c: Column) -> Column:
    """For comparing names: lower case, punctuation as spaces, underscores kept."""
    spaced = F.regexp_replace(F.lower(clean_or_empty(c)), "(?U)[^\\p{L}\\p{N}_\\s\\x1c-\\x1f]", " ")
    return strip(collapse(spaced))


def without_score(c: Column) -> Column:
    """A name before a trailing result such as `2-1 (1-0)`."""
    return strip(F.regexp_replace(c, f"{SPACE}+\\p{{Nd}}+{SPACE}*[-–]{SPACE}*\\p{{Nd}}+[^\\n]*$", ""))


# Spellings of a status and what each means.
STATUSES = {
    "SCHEDULED": "SCHEDULED UPCOMING NOT_STARTED",
    "LIVE": "LIVE IN_PLAY PLAYING",
    "FINISHED": "FINISHED FT FULL_TIME COMPLETED",
    "POSTPONED": "POSTPONED",
    "CANCELLED": "CANCELLED CANCELED",
    "SUSPENDED": "SUSPENDED",
}


def status(c: Column) -> Column:
    meanings = F.create_map(*[F.lit(x) for meaning, spellings in STATUSES.items() for spelling in spellings.split() for x in (spelling, meaning)])
    return F.coalesce(meanings[F.upper(strip(c.cast("string")))], F.lit("UNKNOWN"))
