"""Warnings about accepted events that look inconsistent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.scalar import codes, is_ipv4, percent

# The screen that click coordinates refer to.
SCREEN_WIDTH = 1920
SCREEN_HEIGHT = 1080


def video_is_inconsistent() -> Column:
    """Watched time longer than the video, or a percentage that does not follow."""
    watched, total = F.col("duration_seconds"), F.col("video_duration")
    expected = percent(watched, total)
    return (watched > total) | (F.round("watched_percentage", 2) != expected)


def click_is_off_screen() -> Column:
    x_ok = F.coalesce(F.col("x_coordinate"), F.lit(0)).between(0, SCREEN_WIDTH)
    y_ok = F.coalesce(F.col("y_coordinate"), F.lit(0)).between(0, SCREEN_HEIGHT)
    return ~(x_ok & y_ok)


def warnings() -> Column:
    checks = [
        F.when((F.col("event_type") == "video_watch") & video_is_inconsistent(), "video_inconsistent"),
        F.when((F.col("event_type") == "click") & click_is_off_screen(), "click_off_screen"),
        F.when(F.col("ip_address").isNotNull() & ~is_ipv4(F.col("ip_address")), "bad_ip_address"),
    ]
    return codes(*checks)


def with_warnings(df: DataFrame) -> DataFrame:
    return df.withColumn("warnings", warnings())
