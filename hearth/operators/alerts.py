"""Alert rule and message rows (instead of posting to a chat webhook)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ALERT_KEYWORD, ALERT_MAX_RENT, TARGET

# --- fixed values -----------------------------------------------------------
# Alert message: title, price, location, rooms.
MESSAGE = """🚨 **New Apartment Alert!** 🚨
**Title:** %s
**Price:** %s EUR
**Location:** %s
**Rooms:** %s"""
MISSING = "N/A"


def alert_rule(max_rent: float = ALERT_MAX_RENT, keyword: str = ALERT_KEYWORD) -> Column:
    """rent <= max_rent and the neighborhood contains the keyword (case-sensitive)."""
    return (F.col(TARGET) <= F.lit(max_rent)) & F.col("neighborhood").contains(keyword)


def alert_message() -> Column:
    """The message of a row; a missing part reads ``N/A``."""
    return F.format_string(MESSAGE, *[F.coalesce(F.col(c).cast("string"), F.lit(MISSING))
                                      for c in ("title", TARGET, "neighborhood", "rooms")])


def alert_rows(df: DataFrame, max_rent: float = ALERT_MAX_RENT, keyword: str = ALERT_KEYWORD) -> DataFrame:
    return (df.where(alert_rule(max_rent, keyword))
            .select("id", "title", TARGET, "neighborhood", "rooms", alert_message().alias("message")))
