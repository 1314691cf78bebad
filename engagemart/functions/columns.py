"""Column expressions shared by staging and marts. All stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from engagemart import constants as K

#: Digits to which an average can be rounded exactly.
MOST_AVERAGE_DIGITS = K.RATE_DIGITS + 8


def engagement(likes: Column, comments: Column) -> Column:
    """Likes plus comments; NULL if either is NULL or the sum leaves the type."""
    return F.try_add(likes, comments)


def engagement_rate(engaged: Column, followers: Column) -> Column:
    """Engagement per follower in percent; NULL for no followers."""
    return F.round(F.try_divide(engaged, followers) * 100, K.RATE_DIGITS)


def weekday_name(day_of_week: Column) -> Column:
    """English weekday for 1 (Sunday) to 7 (Saturday), whatever the locale.

    ``element_at`` over a constant array is no substitute: under ANSI it returns an
    element for a NULL index.
    """
    first, *others = K.WEEKDAYS
    name = F.when(day_of_week == 1, first)
    for number, weekday in enumerate(others, start=2):
        name = name.when(day_of_week == number, weekday)
    return name


def posting_time(ts: Column) -> dict[str, Column]:
    """Hour, day number and day name of a post."""
    day = F.dayofweek(ts)
    return {
        "post_time": F.hour(ts),
        "day_of_week": day,
        "post_day_of_week": weekday_name(day),
    }


def tag_name(user_name: Column) -> Column:
    """Account name without its house words; may be left empty."""
    return F.regexp_replace(user_name, K.TAG_NAME_NOISE, "")


def filled_name(name: Column, user_name: Column) -> Column:
    """Account name in place of an empty display name; NULL stays NULL."""
    return F.when(name == "", user_name).otherwise(name)


def utc_text(instant: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in UTC, independent of the session time zone."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.timestamp_add("SECOND", F.unix_seconds(instant), epoch).cast("string")


def source_time_text(raw: Column) -> Column:
    """Source timestamp as UTC text; NULL when it does not parse."""
    return utc_text(F.try_to_timestamp(raw, F.lit(K.SOURCE_TIME_FORMAT)))


def logical_time_text(logical_date: str) -> Column:
    """The run's logical date as UTC text (folded to a constant)."""
    return utc_text(F.to_timestamp(F.lit(logical_date)))


def exact_average(rate: Column, digits: int | None) -> Column:
    """Mean of rates that have two decimals, optionally rounded half up to ``digits``.

    Summed as whole hundredths, so neither the order in which partial sums meet nor a
    mean that lies exactly between two results can change the outcome from run to run.
    """
    whole_rate = F.rint(rate * 10**K.RATE_DIGITS).cast("bigint")
    return ratio_of_hundredths(F.sum(whole_rate.cast("decimal(18,0)")), F.count(rate), digits)


def ratio_of_hundredths(hundredths: Column, count: Column, digits: int | None) -> Column:
    """Exact quotient of summed hundredths and their number, optionally rounded half up; NULL for none."""
    if digits is None:
        return F.try_divide(hundredths.cast("double"), count * F.lit(10**K.RATE_DIGITS))
    shift = digits - K.RATE_DIGITS
    if digits > MOST_AVERAGE_DIGITS:
        raise ValueError(f"an average has at most {MOST_AVERAGE_DIGITS} digits")
    top = F.abs(hundredths) * F.lit(10 ** max(shift, 0)).cast("decimal(9,0)")
    bottom = (count * F.lit(10 ** max(-shift, 0))).cast("decimal(20,0)")
    # Integer division rounds half up; without any rate it stays NULL.
    whole = F.call_function("div", 2 * top + bottom, F.when(count > 0, 2 * bottom))
    return F.signum(hundredths) * whole / F.lit(float(10**digits))
