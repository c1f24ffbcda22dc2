"""Date and time columns. Dates and times are text, as in the tables."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats of dates and times.
DATE_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\\z"


def parse_time(text: Column) -> Column:
    """Timestamp of a `yyyy-MM-dd HH:mm:ss` text; anything else is NULL.

    A cast behind a pattern takes a third of the time of a parse by format.
    """
    return F.when(text.rlike(TIME_PATTERN), text.try_cast("timestamp_ntz"))


def format_time(time: Column) -> Column:
    return F.substring(time.cast("string"), 1, 19)


def format_date(time: Column) -> Column:
    return time.cast("date").cast("string")


def date_hour(text: Column) -> Column:
    """`yyyy-MM-dd_HH` of a `yyyy-MM-dd HH:mm:ss` text; NULL where there is no time part."""
    hour = F.split_part(F.split_part(text, F.lit(" "), F.lit(2)), F.lit(":"), F.lit(1))
    key = F.concat(F.split_part(text, F.lit(" "), F.lit(1)), F.lit("_"), hour)
    return F.when(F.instr(text, " ") > 0, key)


def before(left: Column, right: Column) -> Column:
    return F.coalesce(parse_time(left) < parse_time(right), F.lit(False))


def after(left: Column, right: Column) -> Column:
    return F.coalesce(parse_time(left) > parse_time(right), F.lit(False))


def seconds_between(left: Column, right: Column) -> Column:
    """left - right in seconds; 0 where either text is not a time."""
    return F.coalesce(F.timestamp_diff("SECOND", parse_time(right), parse_time(left)), F.lit(0))


def today() -> Column:
    return F.date_format(F.current_date(), DATE_FORMAT)


def now() -> Column:
    return F.date_format(F.current_timestamp(), TIME_FORMAT)


def yesterday() -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), DATE_FORMAT)
