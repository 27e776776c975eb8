"""Small arithmetic used by the monitoring aggregates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from folioloom.functions.text import once


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` with one decimal, 0 when there is no whole.

    Rounded by the binary value, ties up: ``round`` would go by the shortest
    decimal form, where 0.35 looks like a tie although it lies below one.
    """
    def rounded(x: Column) -> Column:
        # Only quarters are exact ties; format_number would take them to even.
        nearest = F.replace(F.format_number(x, 1), F.lit(","), F.lit("")).cast("double")
        return F.when(x * 4 == F.floor(x * 4), F.floor(x * 10 + 0.5) / 10).otherwise(nearest)

    exact = F.try_divide(part.cast("double"), whole) * 100
    return F.when(whole > 0, once(exact, rounded)).otherwise(F.lit(0.0))


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds as a double, with the fraction."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(1_000_000.0)


def rate(count: Column, seconds: Column) -> Column:
    """``count`` per second, 0 without a positive duration."""
    return F.when(seconds > 0, F.try_divide(count, seconds)).otherwise(F.lit(0.0))


def day(col: Column) -> Column:
    return F.to_date(col)


# Texts of the time left (fixed values): "~n hours", "~n days" and these.
NOTHING_LEFT, NO_RATE = "Done!", "Calculating..."


def eta(pending: Column, per_second: Column) -> Column:
    """Human-readable time left: whole hours below one day, else whole days."""
    seconds = F.try_divide(pending.cast("double"), per_second)
    hours = F.concat(F.lit("~"), F.ceil(seconds / 3600).cast("string"), F.lit(" hours"))
    days = F.concat(F.lit("~"), F.ceil(seconds / 86400).cast("string"), F.lit(" days"))
    return (
        F.when(pending == 0, F.lit(NOTHING_LEFT))
        .when(F.coalesce(per_second, F.lit(0.0)) <= 0, F.lit(NO_RATE))
        .when(seconds / 86400 < 1, hours)
        .otherwise(days))
