"""Scalar expressions: lists, names, dates and the text forms shown to people."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARLIEST_REGISTRATION = "1985-01-01"

# fixed values: accepted date forms of text responses, tried in this order; true = carries its own offset
DATE_FORMATS = [
    ("dd.MM.yyyy", False),
    ("yyyy. MM. dd.", False),
    ("yyyy.MM.dd", False),
    ("yyyy-MM-dd'T'HH:mm:ssXX", True),
    ("yyyy-MM-dd'T'HH:mm:ssXXX", True),
    ("yyyy-MM-dd", False),
    ("yyyy-MM-dd'T'HH:mm:ss", False),
]
_ISO = (r"^\d{4}-\d{2}-\d{2}"
        r"([T ]\d{2}(:?\d{2}(:?\d{2}([.,]\d{1,9})?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$")


# fixed values: what counts as white space, and what of it ends a line
LINE_ENDS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
SPACE = " \t\x1f\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200b)) + "\u202f\u205f\u3000" + LINE_ENDS


def strip_space(col: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.trim(col, F.lit(SPACE))


def words(col: Column) -> Column:
    """Text cut at white space of any kind; a blank text is one empty word."""
    return F.split(F.trim(F.translate(col, SPACE, " " * len(SPACE))), " +")


def lower_all(arr: Column) -> Column:
    return F.transform(arr, F.lower)


def iso_timestamp(text: Column) -> Column:
    """ISO text (T or blank between date and time, zone optional) to timestamp; NULL otherwise."""
    return F.when(text.rlike(_ISO), text.try_cast("timestamp"))


def iso_date(text: Column) -> Column:
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def midnight(day: Column) -> Column:
    return day.cast("timestamp")


def parse_timestamp_multi(text: Column) -> Column:
    """First of the accepted forms that fits; no offset means UTC (the session zone)."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)) for fmt, _ in DATE_FORMATS])


def render_timestamp(text: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss+zzzz` with the offset the text itself carried, '' when no form fits."""
    moment = parse_timestamp_multi(text)
    raw = F.regexp_extract(text, r"T\d{2}:\d{2}:\d{2}(Z|[+-]\d{2}:?\d{2})$", 1)
    offset = F.when((raw == "") | (raw == "Z"), F.lit("+0000")).otherwise(F.replace(raw, F.lit(":"), F.lit("")))
    seconds = ((F.substring(offset, 2, 2).try_cast("int") * 60 + F.substring(offset, 4, 2).try_cast("int")) * 60
               * F.when(offset.startswith("-"), -1).otherwise(1))
    local = F.timestamp_seconds(F.unix_seconds(moment) + seconds)
    return F.when(moment.isNull(), F.lit("")).otherwise(
        F.concat(F.date_format(local, "yyyy-MM-dd HH:mm:ss"), offset))


def plausible_registration(day: Column) -> Column:
    """NULL for dates before the first domain was ever registered."""
    return F.when(day >= F.lit(EARLIEST_REGISTRATION).cast("date"), day)


def registered_by_status(status: Column) -> Column:
    return status == "Not Available"


def url_short_name(url: Column) -> Column:
    """Server URL as a topic-safe name: no scheme, no slash at the end, `. / :` become `_`."""
    bare = F.regexp_replace(F.regexp_replace(url, "^https?://", ""), "/+$", "")
    return F.translate(bare, "./:", "___")


def referral_server(text: Column) -> Column:
    """Registrar's own WHOIS host named in a response, NULL if none."""
    host = F.regexp_extract(text, r"(?i)Registrar WHOIS Server:\s*(\S+)", 1)
    return F.when(host != "", host)


# --- display forms ----------------------------------------------------------------------------
def number_label(n: Column) -> Column:
    big = F.format_string("%.2fB", n / F.lit(1e9))
    mid = F.format_string("%.2fM", n / F.lit(1e6))
    return (F.when(n.isNull(), F.lit(None).cast("string")).when(n > 1_000_000_000, big)
            .when(n > 1_000_000, mid).otherwise(F.format_number(n, 0)))


def date_label(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def age_label(seconds: Column) -> Column:
    """`N days ago` in the largest unit that is not zero, from an age in whole seconds."""
    days = F.floor(seconds / 86400)
    rest = F.pmod(seconds, F.lit(86400))
    hours, minutes = F.floor(rest / 3600), F.floor(F.pmod(rest, F.lit(3600)) / 60)
    last = F.pmod(rest, F.lit(60))

    def ago(n: Column, unit: str) -> Column:
        return F.concat(n.cast("string"), F.lit(f" {unit} ago"))

    return (F.when(days != 0, ago(days, "days")).when(hours != 0, ago(hours, "hours"))
            .when(minutes != 0, ago(minutes, "minutes")).otherwise(ago(last, "seconds")))


def registered_label(flag: Column) -> Column:
    return F.when(flag.isNull(), "Unknown").when(flag, "Registered").otherwise("Available")


def empty_label(col: Column) -> Column:
    return F.when(col == "", F.lit("<empty>")).otherwise(col)


def short_text(col: Column, length: int = 50) -> Column:
    """Cut at a word end to at most `length` characters with three dots; up to 5 over is left whole."""
    cut = F.regexp_replace(F.substring(col, 1, length - 3), r" [^ ]*\z", "")
    return F.when(F.length(col) > length + 5, F.concat(cut, F.lit("..."))).otherwise(col)


def list_text(arr: Column) -> Column:
    return F.concat_ws(",", arr)
