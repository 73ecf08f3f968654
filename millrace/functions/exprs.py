"""Column functions. All are built-in Spark expressions; there is no UDF."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Change types and their codes. Any other type has no code.
OP_CODES = {"bootstrap-insert": "I", "insert": "I", "update": "U", "delete": "D"}


def op_code(change_type: Column) -> Column:
    code = F.lit(None).cast("string")
    for name, letter in OP_CODES.items():
        code = F.when(change_type == name, letter).otherwise(code)
    return code


def fact_topic(table: Column, op: Column) -> Column:
    """``order_info`` inserted goes to ``DWD_ORDER_INFO_I``."""
    return F.concat(F.lit("DWD_"), F.upper(table), F.lit("_"), op)


# Fixed value: the first millisecond of the year 10000.
END_OF_TIME = 253_402_300_800_000


def plausible(epoch_ms: Column) -> Column:
    """Whether a clock's time lies in the years 1970 to 9999, as epoch ms does. Times in
    micro- or nanoseconds don't, and would overflow where they are turned into dates."""
    return F.coalesce((epoch_ms >= 0) & (epoch_ms < END_OF_TIME), F.lit(False))


def event_time(epoch_ms: Column) -> Column:
    return F.timestamp_millis(epoch_ms)


def event_date(epoch_ms: Column) -> Column:
    """Epoch ms to ``yyyy-MM-dd`` in the session's zone."""
    return F.to_date(F.timestamp_millis(epoch_ms)).cast("string")


def event_hour(epoch_ms: Column) -> Column:
    """Epoch ms to ``00`` .. ``23`` in the session's zone."""
    return F.lpad(F.hour(F.timestamp_millis(epoch_ms)).cast("string"), 2, "0")


def date_part(time_text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to its date, as text."""
    return F.try_element_at(F.split(time_text, " "), F.lit(1))


def hour_part(time_text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to its hour, as text; null without a time."""
    clock = F.try_element_at(F.split(time_text, " "), F.lit(2))
    return F.try_element_at(F.split(clock, ":"), F.lit(1))


def completed_years(birthday: Column, as_of: Column) -> Column:
    """Whole years from one date to another, counted in completed months.

    ``months_between`` treats two month-ends as a whole number of months, so
    someone born on 29 February would turn a year older on the 28th.
    """
    months = (F.year(as_of) - F.year(birthday)) * 12 + F.month(as_of) - F.month(birthday)
    days = F.dayofmonth(as_of) - F.dayofmonth(birthday)
    unfinished = (
        F.when((months > 0) & (days < 0), -1).when((months < 0) & (days > 0), 1).otherwise(0)
    )
    return ((months + unfinished) / 12).cast("int")


def age_text(birthday: Column, as_of: date | Column | None = None) -> Column:
    """Age in completed years as text; null for a birthday that is no date."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    return completed_years(birthday.try_cast("date"), today).cast("string")
