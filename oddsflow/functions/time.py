"""Time expressions and generated calendar / clock dimensions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_ms_to_ts(epoch_ms: Column | str) -> Column:
    """Epoch milliseconds -> timestamp, exact (no double division)."""
    return F.timestamp_millis(_c(epoch_ms))


def ts_seconds(ts: Column | str) -> Column:
    """Whole seconds since the epoch of a timestamp or timestamp_ntz (UTC session)."""
    return F.unix_seconds(_c(ts).cast("timestamp"))


def ts_millis(ts: Column | str) -> Column:
    """Milliseconds since the epoch of a timestamp or timestamp_ntz (UTC session)."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def minutes_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole minutes from ``earlier`` to ``later``, rounded half away from zero, as int.

    The difference is cut to whole seconds (towards zero), not the two times.
    """
    micros = F.unix_micros(_c(later).cast("timestamp")) - F.unix_micros(_c(earlier).cast("timestamp"))
    return F.round((micros / F.lit(1e6)).cast("long") / F.lit(60.0), 0).cast("int")


def minute_offset(epoch_ms: Column | str, anchor: Column | str) -> Column:
    """Minute of an epoch-ms event relative to a timestamp (negative before it).

    The anchor is taken at whole seconds, as ``unix_timestamp`` does.
    """
    diff = _c(epoch_ms) - ts_seconds(anchor) * F.lit(1000)
    return F.round(diff / F.lit(60000.0), 0).cast("int")


def date_key(ts: Column | str) -> Column:
    """Smart date key yyyymmdd as int."""
    ts = _c(ts)
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def time_key(ts: Column | str) -> Column:
    """Smart time key HHmm as int (00:05 -> 5)."""
    ts = _c(ts)
    return F.hour(ts) * 100 + F.minute(ts)


def epoch_ms_to_date(epoch_ms: Column | str) -> Column:
    """Epoch milliseconds -> date (UTC session)."""
    return F.to_date(F.timestamp_millis(_c(epoch_ms)))


# The calendar range of the date dimension.
CALENDAR_START = _dt.date(2015, 1, 1)
CALENDAR_END = _dt.date(2030, 1, 1)


def calendar_dim(spark: SparkSession, start: _dt.date = CALENDAR_START, end: _dt.date = CALENDAR_END) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive.

    Generated with ``spark.range`` over the day numbers, so the rows are
    produced in parallel tasks rather than from one exploded array.
    """
    n_days = (end - start).days + 1
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    days = spark.range(0, n_days, 1).select(d.alias("date"))
    return days.select(
        date_key("date").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.date_format("date", "MMM").alias("calendar_month"),
        F.dayofmonth("date").alias("day"),
        F.dayofweek("date").alias("day_of_week"),
        F.date_format("date", "EEE").alias("calendar_day"),
    )


def clock_dim(spark: SparkSession) -> DataFrame:
    """One row per minute of the day: time_key HHmm, 'HH:mm', hour, minute (1,440 rows)."""
    m = spark.range(0, 24 * 60, 1)
    hour = (F.col("id") / 60).cast("int")
    minute = (F.col("id") % 60).cast("int")
    return m.select(
        (hour * 100 + minute).alias("time_key"),
        F.format_string("%02d:%02d", hour, minute).alias("time"),
        hour.alias("hour"),
        minute.alias("minute"),
    )


def calendar_for(df: DataFrame, col: str) -> DataFrame:
    """Calendar rows for every day between the first and last date of ``col``.

    The bounds come from one aggregation (partial per task); the days are then
    generated from that single row, their number bounded by the date span.
    """
    bounds = df.agg(F.min(F.to_date(col)).alias("_lo"), F.max(F.to_date(col)).alias("_hi"))
    days = bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.select(
        date_key("date").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.date_format("date", "MMM").alias("calendar_month"),
        F.dayofmonth("date").alias("day"),
        F.dayofweek("date").alias("day_of_week"),
        F.date_format("date", "EEE").alias("calendar_day"),
    )


def clock_for(df: DataFrame, col: str) -> DataFrame:
    """Clock rows (time_key, 'HH:mm', hour, minute) for the minutes of day seen in ``col``."""
    ts = F.col(col)
    minutes = df.select(F.hour(ts).alias("hour"), F.minute(ts).alias("minute")).distinct()
    return minutes.select(
        (F.col("hour") * 100 + F.col("minute")).alias("time_key"),
        F.format_string("%02d:%02d", "hour", "minute").alias("time"),
        "hour", "minute",
    )


def minutes_for(df: DataFrame, col: str) -> DataFrame:
    """Every minute between the first and the last time in ``col``: minute, time_key, 'HH:mm'.

    The two bounds are one aggregated row; days are generated from it and
    minutes from the days, so no array is longer than a day's minutes.
    """
    step = F.expr("INTERVAL 1 MINUTE")
    bounds = df.agg(F.date_trunc("minute", F.min(col)).alias("lo"), F.date_trunc("minute", F.max(col)).alias("hi"))
    days = bounds.select("lo", "hi", F.explode(F.sequence(F.to_date("lo"), F.to_date("hi"), F.expr("INTERVAL 1 DAY"))).alias("day"))
    first = F.greatest(F.col("lo"), F.col("day").cast("timestamp"))
    last = F.least(F.col("hi"), (F.date_add("day", 1)).cast("timestamp") - step)
    minutes = days.select(F.explode(F.sequence(first, last, step)).alias("minute"))
    return minutes.select(F.col("minute").cast("timestamp_ntz").alias("minute"), time_key("minute").alias("time_key"),
                          F.date_format("minute", "HH:mm").alias("time"))
