"""Column expressions the operators share. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BYTES_PER_MB = 1024 * 1024


def total_price(price: Column | None = None, quantity: Column | None = None) -> Column:
    """Price times quantity, widened first: INT times INT would overflow on large orders."""
    price = F.col("price") if price is None else price
    quantity = F.col("quantity") if quantity is None else quantity
    return price.cast("bigint") * quantity


def with_total_price(df: DataFrame) -> DataFrame:
    return df.withColumn("total_price", total_price())


def money_text(amount: Column) -> Column:
    """Whole amount with thousands separators: 1500000 becomes 1,500,000."""
    return F.format_number(amount, 0)


def instant(text: Column) -> Column:
    """ISO-8601 text with an offset as an instant; null where the text is no time."""
    return F.try_to_timestamp(text)


def wall_text(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss")


def wall_time(time: Column, zone: str) -> Column:
    """The wall clock of `zone` at an instant, or at a time without zone taken as UTC; for display.

    The result has no zone and is the same in every session.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    shifted = F.unix_micros(F.from_utc_timestamp(time.cast("timestamp"), zone))
    of_instant = F.timestamp_add("MICROSECOND", shifted, epoch)
    of_plain = F.convert_timezone(F.lit("UTC"), F.lit(zone), time.cast("timestamp_ntz"))
    return F.when(F.typeof(time) == "timestamp", of_instant).otherwise(of_plain)


def megabytes(count: Column) -> Column:
    return count / F.lit(BYTES_PER_MB)


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from start to end as a double, the same for times with and without zone."""
    return (end - start).cast("interval second").cast("decimal(18,6)").cast("double")


# Seconds per unit of an interval written as a number and a unit.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def interval_seconds(text: str) -> int | None:
    """The length of an interval such as "10 minutes"; None for other notations."""
    number, _, unit = text.strip().lower().partition(" ")
    unit = unit.strip().removesuffix("s")
    return int(number) * UNIT_SECONDS[unit] if number.isdecimal() and unit in UNIT_SECONDS else None
