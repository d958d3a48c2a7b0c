"""Date columns. Days are literal: a time zone in the text never moves them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsluice.functions.binding import bind
from jobsluice.functions.text import WS, strip

_TIME = (
    r"([01]\d|2[0-3])(:[0-5]\d(:[0-5]\d([.,]\d+)?)?|[0-5]\d([0-5]\d([.,]\d+)?)?)?"
    r"(Z|[+-]([01]\d|2[0-3])(:?[0-5]\d(:?[0-5]\d)?)?)?"
)
_ISO = rf"^(\d{{4}}-\d{{2}}-\d{{2}}|\d{{8}})(.{_TIME})?$"
_DAY = r"([0-9]{1,2}[./][0-9]{1,2}[./][0-9]{2,4})"

# The labels in front of a posting day and of a deadline, in the
# order they are tried.
POSTING_LABELS = (rf"publi[eé]{WS}*le", "mise en ligne")
DEADLINE_LABELS = ("date limite", "d[ée]lai de candidature", "avant le")


def iso_day(c: Column) -> Column:
    """DATE of an ISO text (day, or day and time); NULL if it is no such text."""
    digits = F.replace(F.substring(c, 1, 10), F.lit("-"), F.lit(""))
    day = F.try_to_date(F.substring(digits, 1, 8), "yyyyMMdd")
    return F.when(c.rlike(_ISO) & ~F.startswith(c, F.lit("0000")), day)


def age_days(as_of: date, day: Column) -> Column:
    """Days from ``day`` to the run date; negative for the future."""
    return F.datediff(F.lit(as_of), day)


def french_day(c: Column) -> Column:
    """ISO text of ``d.m.Y``, ``d/m/Y`` or ``Y-m-d``; NULL otherwise, also for two-digit years."""
    shapes = (
        (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
        (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
        (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    )

    def parse(text: Column) -> Column:
        return F.coalesce(*[F.when(text.rlike(shape), F.try_to_date(text, fmt)) for shape, fmt in shapes])

    return bind(bind(strip(c), parse), _iso_text)


def _iso_text(day: Column) -> Column:
    return F.when(F.year(day) > 0, F.date_format(day, "yyyy-MM-dd"))


def rfc2822_day(c: Column) -> Column:
    """ISO text of the calendar day in a mail-style date, in its own offset."""
    pattern = r"[0-9]{1,2}\s+[A-Za-z]{3}[a-z]*\s+[0-9]{4}\s+[0-9]{1,2}[:.][0-9]{2}"

    def parse(words: Column) -> Column:
        # Month names take three characters each; a match elsewhere gives no whole number.
        at = F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.lower(F.substring(F.get(words, 1), 1, 3)))
        month = F.when(at % 3 == 1, ((at + 2) / 3).cast("int").cast("string"))
        return F.try_to_date(F.concat(F.get(words, 2), F.lit("-"), month, F.lit("-"), F.get(words, 0)), "yyyy-M-d")

    return bind(bind(F.split(F.regexp_extract(c, pattern, 0), r"\s+"), parse), _iso_text)


def labelled_day(text: Column, labels: tuple[str, ...]) -> Column:
    """The first label whose following date parses; labels are regular expressions."""
    found = [F.regexp_extract(text, rf"(?iu){label}[^0-9]*{_DAY}", 1) for label in labels]
    parsed = F.transform(F.array(*found), french_day)
    return F.get(F.filter(parsed, lambda day: day.isNotNull()), 0)


def before_t(c: Column) -> Column:
    """Text up to the first ``T``."""
    return F.substring_index(c, "T", 1)
