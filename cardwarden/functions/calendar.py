"""Wall-clock calendar expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# 1 = Sunday ... 7 = Saturday.
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def weekday_name(number: Column) -> Column:
    """Name of a weekday number; null stays null."""
    names = F
    for day, name in enumerate(WEEKDAYS, start=1):
        names = names.when(number == day, F.lit(name))
    return names


def day_number(moment: Column) -> Column:
    """Days since 1970 of a date or wall-clock timestamp."""
    return F.datediff(F.to_date(moment), F.lit("1970-01-01").cast("date")).cast("bigint")


def hour_number(day: Column, hour: Column) -> Column:
    """Hours since 1970 of a date and an hour of that day."""
    return day_number(day) * 24 + hour


def hour_start(number: Column) -> Column:
    """Wall-clock start of an hour number."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(number / 24).cast("int"))
    hour = F.pmod(number, F.lit(24)).cast("int")
    return day.cast("timestamp_ntz") + F.make_dt_interval(hours=hour)


def seconds_between(earlier: Column, later: Column) -> Column:
    """Seconds from one wall-clock timestamp to another, to the microsecond."""
    return (later - earlier).cast("decimal(20,6)").cast("double")


def month_year(text: Column) -> Column:
    """First day of the month in ``MM/YYYY`` text, null when it cannot be read."""
    return F.to_date(F.try_to_timestamp(text, F.lit("MM/yyyy")))
